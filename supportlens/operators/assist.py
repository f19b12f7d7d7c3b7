"""Language-model jobs on support texts.

Each takes a client factory and call settings (``model``, ``temperature``,
``max_tokens``; see ``models.chat_batch``) and makes exactly one call per row
or topic. Results are lazy: write them (``session.materialize``) before more
than one consumer reads them, or the calls are paid for again. With ``ledger=``
(a ``ledger.CallLedger``) answers are noted as tasks finish and calls that have
one are not made again, by this run or a later one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import categories as cat
from ..functions import judge as jg
from ..functions import prompts as pr
from . import models


def _call(prompts: DataFrame, key: str, client_factory: Callable, task: str, out: str, ledger=None,
          partitions: int | None = None, **call) -> DataFrame:
    if ledger is not None:  # cuts its own tasks
        return ledger.ask(prompts, key, "m", client_factory, task=task, out=out, **call)
    return models.chat_batch(prompts, key, "m", client_factory, task=task, out=out, partitions=partitions, **call)


def generate_replies(df: DataFrame, text: str, client_factory: Callable, key: str = "row_id",
                     out: str = "response", **call) -> DataFrame:
    """L3: (key, reply) for every query."""
    prompts = df.select(key, pr.reply_prompt(text).alias("m"))
    return _call(prompts, key, client_factory, "reply", out, **call)


def judge_replies(df: DataFrame, query: str, reply: str, client_factory: Callable,
                  key: str = "row_id", **call) -> DataFrame:
    """(key, ``scores``) with scores struct(relevance, helpfulness, tone, explanation)."""
    prompts = df.select(key, pr.judge_prompt(query, reply).alias("m"))
    raw = _call(prompts, key, client_factory, "judge", "raw", **call)
    return raw.select(key, jg.parse_judge("raw").alias("scores"))


def classify_queries(df: DataFrame, text: str, client_factory: Callable, key: str = "row_id",
                     **call) -> DataFrame:
    """(key, ``label``, ``label_in_taxonomy``)."""
    prompts = df.select(key, pr.classify_prompt(text).alias("m"))
    labels = _call(prompts, key, client_factory, "classify", "label", **call)
    return labels.withColumn("label_in_taxonomy", cat.in_taxonomy("label"))


def generate_synthetic(df: DataFrame, topic: str, client_factory: Callable, n: int = 5,
                       **call) -> DataFrame:
    """(topic, ``pos``, ``query``), one call for ``n`` queries per distinct topic."""
    topics = df.where(F.col(topic).isNotNull()).select(F.col(topic).alias("topic")).distinct()
    prompts = topics.select("topic", pr.synthetic_prompt("topic", F.lit(n)).alias("m"))
    raw = _call(prompts, "topic", client_factory, "synthetic", "raw", **call)
    return raw.select("topic", F.posexplode(pr.parse_synthetic("raw")).alias("pos", "query"))
