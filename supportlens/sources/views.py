"""Derived views over the driver tables (support queries, responses, judge
outputs, synthetic-generator outputs).

The driver tables hold none of the support-domain words, so these views add a
fixed template per row, chosen by key arithmetic, while keeping every row and
the whole original text. The SQL is written once and runs unchanged on Spark
SQL and on DuckDB (the oracle), so both engines see identical inputs.
"""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import DataFrame, SparkSession

from .tables import read_table

# Query templates, one per branch of the entity and cleaning
# rules; categories and sub-categories exercise every category rule.
SUPPORT_QUERIES_SQL = """
SELECT conv_id * 4294967296 + turn AS row_id, conv_id, turn,
  CASE (conv_id * 7 + turn) % 16
    WHEN 0  THEN 'I want a REFUND for order 123456, $45.50 charged twice!'
    WHEN 1  THEN 'plz help, i forgot password and cant open my account'
    WHEN 2  THEN 'Where is my delivery? paid 1,234.50 on monday'
    WHEN 3  THEN 'today'
    WHEN 4  THEN '12 may 2024'
    WHEN 5  THEN 'dont cancel, u said 3 days'
    WHEN 6  THEN 'update email and change address pls'
    WHEN 7  THEN 'summary of the market border'
    WHEN 8  THEN '2024-05-12'
    WHEN 9  THEN 'gonna close account thx'
    WHEN 10 THEN 'payment 99.999 failed for item a45 ref_777777'
    WHEN 11 THEN 'friday'
    WHEN 12 THEN 'shiping adress of the ordres acn be changed'
    WHEN 13 THEN '!!! 12345 ???'
    WHEN 14 THEN 'im happy, great relationship, thanks'
    ELSE '' END AS short_text,
  text AS long_text,
  CASE (conv_id * 5 + turn) % 6 WHEN 0 THEN 'order' WHEN 1 THEN 'Shipping' WHEN 2 THEN ''
    WHEN 3 THEN NULL WHEN 4 THEN 'REFUND' ELSE 'feedback' END AS category,
  CASE (conv_id * 3 + turn) % 9 WHEN 0 THEN 'Get Refund' WHEN 1 THEN 'cancel_order'
    WHEN 2 THEN 'Delivery options' WHEN 3 THEN 'set up shipping address' WHEN 4 THEN 'recover PASSWORD'
    WHEN 5 THEN 'cancel and refund' WHEN 6 THEN 'delete account' WHEN 7 THEN '' ELSE NULL END AS sub_category
FROM conversations WHERE role = 'user'
"""

# A reply is the assistant turn right after a user turn.
SUPPORT_RESPONSES_SQL = """
SELECT q.conv_id * 4294967296 + q.turn AS row_id, q.text AS query, a.text AS response,
  CASE (q.conv_id * 7 + q.turn) % 5 WHEN 0 THEN 'POSITIVE' WHEN 1 THEN 'NEGATIVE' WHEN 2 THEN 'POSITIVE'
    WHEN 3 THEN 'NEUTRAL' ELSE NULL END AS stub_sentiment
FROM conversations q JOIN conversations a ON a.conv_id = q.conv_id AND a.turn = q.turn + 1
WHERE q.role = 'user' AND a.role = 'assistant'
"""

# Judge outputs covering every parsing branch.
JUDGE_RAW_SQL = """
SELECT conv_id * 4294967296 + turn AS row_id,
  CASE (conv_id * 11 + turn) % 19
    WHEN 0 THEN '{"relevance":5,"helpfulness":4,"tone":5,"explanation":"ok"}'
    WHEN 1 THEN '{"relevance":"4","helpfulness":"4.7","tone":4.7}'
    WHEN 2 THEN '{"relevance":null,"helpfulness":null,"tone":null,"explanation":null}'
    WHEN 3 THEN '{}'
    WHEN 4 THEN 'not json'
    WHEN 5 THEN '[1,2]'
    WHEN 6 THEN '{"relevance":9,"helpfulness":-3,"tone":0}'
    WHEN 7 THEN '{"relevance":true,"helpfulness":"x","tone":" 2 ","explanation":""}'
    WHEN 8 THEN '{"relevance":3}'
    WHEN 9 THEN '{"tone":2,"explanation":"short"}'
    WHEN 10 THEN ''
    WHEN 11 THEN NULL
    WHEN 12 THEN '{"relevance":1e30,"helpfulness":99999999999999999999,"tone":"99999999999999999999","explanation":false}'
    WHEN 13 THEN '{"relevance":-1e30,"helpfulness":"-99999999999999999999","tone":1e-3,"explanation":0}'
    WHEN 14 THEN '{"relevance":4.999,"helpfulness":"+4","tone":false,"explanation":[]}'
    WHEN 15 THEN '{"relevance":[5],"helpfulness":{"a":5},"tone":"1e1","explanation":{}}'
    WHEN 16 THEN '{"explanation":"0"}'
    WHEN 17 THEN '{"explanation":"false"}'
    ELSE '{"relevance":1,"helpfulness":2,"tone":3,"explanation":"x"}' END AS raw
FROM conversations WHERE role = 'assistant'
"""

# Generator output shape (numbered lines, blank lines, a line
# made only of strip characters). Every event row is used.
SYNTHETIC_RAW_SQL = """
SELECT event_id AS topic_id,
  CASE event_id % 4 WHEN 0 THEN 'ORDER' WHEN 1 THEN 'SHIPPING' WHEN 2 THEN 'REFUND' ELSE 'ACCOUNT' END AS topic,
  concat('1. where is item ', CAST(event_id AS STRING), chr(10), chr(10), '2. ', event_type, ' failed.',
         chr(10), '   ', chr(10), '10) odd', chr(10), '3.') AS raw
FROM events
"""

VIEW_SQL = {
    "support_queries": SUPPORT_QUERIES_SQL,
    "support_responses": SUPPORT_RESPONSES_SQL,
    "judge_raw": JUDGE_RAW_SQL,
    "synthetic_raw": SYNTHETIC_RAW_SQL,
}

_BASE = {
    "support_queries": ("conversations",),
    "support_responses": ("conversations",),
    "judge_raw": ("conversations",),
    "synthetic_raw": ("events",),
}


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Build one derived view as a DataFrame over the tables in ``sf_dir``.

    Base tables are registered under names private to ``sf_dir`` so that the
    caller's own temp views of the same names are never replaced.
    """
    tag = hashlib.sha1(sf_dir.encode()).hexdigest()[:10]
    sql = VIEW_SQL[name]
    for base in _BASE[name]:
        private = f"_sl_{tag}_{base}"
        read_table(spark, sf_dir, base).createOrReplaceTempView(private)
        sql = re.sub(rf"\b(FROM|JOIN) {base}\b", rf"\1 {private}", sql)
    return spark.sql(sql)


def support_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, "support_queries")


def support_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, "support_responses")


def judge_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, "judge_raw")


def synthetic_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, "synthetic_raw")


def with_views(sql: str, *names: str) -> str:
    """Prefix ``sql`` with the named views as CTEs (for the DuckDB oracle)."""
    ctes = ",\n".join(f"{n} AS ({VIEW_SQL[n].strip()})" for n in names)
    body = sql.strip()
    if body[:4].upper() == "WITH":
        return f"WITH {ctes},\n{body[4:].lstrip()}"
    return f"WITH {ctes}\n{body}"
