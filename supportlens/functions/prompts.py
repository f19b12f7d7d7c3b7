"""Chat prompts (L1) and generator-output parsing (L10) as Column expressions.

A prompt is ``array<struct<role string, content string>>``: one system message
and one user message, built per row inside the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..sources.tables import py_strip
from .categories import TOP_CATEGORIES

REPLY_SYSTEM = (
    "You answer customer-support messages. Be courteous and brief, recognise the "
    "customer's problem, say what happens next, and use short numbered steps when "
    "they help. Do not promise what support cannot guarantee.")
JUDGE_SYSTEM = (
    "You grade a support reply to a customer message. Give three integer grades "
    "from 1 (poor) to 5 (excellent): relevance (does it address the message), "
    "helpfulness (is it specific and actionable), tone (is it polite and "
    "professional). Answer with one JSON object only, with the keys relevance, "
    "helpfulness, tone and explanation.")
CLASSIFY_SYSTEM = (
    "Assign the customer message to exactly one category and answer with the "
    "category name only. Categories: " + ", ".join(TOP_CATEGORIES) + ".")
SYNTHETIC_SYSTEM = (
    "You write realistic, varied customer-support messages for testing, one per line.")

# Per-task generation settings (temperature, max tokens, JSON mode).
TASK_SETTINGS = {
    "reply": {"temperature": 0.2, "max_tokens": 350, "json": False},
    "judge": {"temperature": 0.0, "max_tokens": 250, "json": True},
    "classify": {"temperature": 0.0, "max_tokens": 50, "json": False},
    "synthetic": {"temperature": 0.8, "max_tokens": 300, "json": False},
}

# Characters stripped from both ends of every generated line (fixed values).
SYNTHETIC_STRIP = "0123456789. "


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _messages(system: str, user: Column) -> Column:
    return F.array(
        F.struct(F.lit("system").alias("role"), F.lit(system).alias("content")),
        F.struct(F.lit("user").alias("role"), user.alias("content")))


def reply_prompt(query) -> Column:
    return _messages(REPLY_SYSTEM, F.concat(F.lit("Customer message:\n"),
                                            F.coalesce(_col(query), F.lit(""))))


def judge_prompt(query, reply) -> Column:
    body = F.to_json(F.struct(_col(query).alias("query"), _col(reply).alias("reply")),
                     {"ignoreNullFields": "false"})
    return _messages(JUDGE_SYSTEM, body)


def classify_prompt(query) -> Column:
    return _messages(CLASSIFY_SYSTEM, F.coalesce(_col(query), F.lit("")))


def synthetic_prompt(topic, n) -> Column:
    return _messages(SYNTHETIC_SYSTEM, F.format_string(
        "Write %d different customer messages about %s.", _col(n), _col(topic)))


def parse_synthetic(raw) -> Column:
    """Split on newlines, drop blank lines, strip 0-9 '.' ' ' from both
    ends of each remaining line (a line of only those characters becomes '')."""
    lines = F.filter(F.split(F.coalesce(_col(raw), F.lit("")), "\n"),
                     lambda ln: py_strip(ln) != "")
    return F.transform(lines, lambda ln: F.regexp_replace(ln, r"^[0-9. ]+|[0-9. ]+$", ""))
