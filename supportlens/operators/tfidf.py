"""Built-in offline text encoder (M1): TF-IDF as joins and aggregates.

weight(d, t) = tf(d, t) * ln((N + 1) / (df(t) + 1)), L2-normalised per text,
kept as long rows (key, term, weight) -- a sparse vector that never has to be
materialised as a dense array.

Plan: (key, term) counts are a two-phase aggregate, written once, so that no
text is taken apart twice; document frequency is an aggregate of that table by
term. Terms in many texts are few and most of the rows: their frequencies are
broadcast, and only the rows of other terms are joined by term, with the
frequencies from two on (a term without one is in one text). N enters as a
scalar subquery; the per-text norm is a window over the text's own terms (one
shuffle by key, each window bounded by the text's distinct terms).
"""

from __future__ import annotations

from math import ceil

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize, scratch_scope

COMMON = 200_000  # at most so many terms are broadcast: those with the largest share of the rows


def tfidf(tokens: DataFrame, key: str, token: str = "token", docs: DataFrame | None = None,
          scope: scratch_scope | None = None) -> DataFrame:
    """(key, term, weight) from (key, token) rows. ``docs`` (one row per text)
    defines N; by default N counts texts with at least one token."""
    tf = materialize(tokens.groupBy(key, F.col(token).alias("term")).agg(F.count(F.lit(1)).alias("tf")), scope=scope)
    n = (docs.select(F.count(F.lit(1))) if docs is not None
         else tf.select(F.count_distinct(key))).scalar()
    tf = tf.where(F.col("term").isNotNull())
    df_ = materialize(tf.groupBy("term").agg(F.count(F.lit(1)).alias("df")).where("df > 1"), scope=scope)
    # No more than COMMON terms can hold a COMMON-th of the rows each.
    often = max(2, ceil((df_.agg(F.sum("df")).first()[0] or 0) / COMMON))
    marked = tf.join(F.broadcast(df_.where(F.col("df") >= often)), "term", "left")
    others = (marked.where(F.col("df").isNull()).drop("df")
                    .join(df_.where(F.col("df") < often), "term", "left"))
    counted = marked.where(F.col("df").isNotNull()).unionByName(others)
    w = counted.withColumn("w", F.col("tf") * F.log((n + 1) / (F.coalesce("df", F.lit(1)) + 1)))
    norm = F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy(key)))
    return w.select(key, "term", F.when(norm > 0, F.col("w") / norm).otherwise(F.lit(0.0)).alias("weight"))


def tfidf_from_texts(docs: DataFrame, key: str, tokens_expr) -> DataFrame:
    """TF-IDF straight from a text table, with one shuffle of the text.

    The texts are hash-partitioned by ``key`` once; the per-text term counts
    reuse that partitioning (a hash partitioning on ``key`` satisfies grouping
    by (key, term)).
    """
    by_key = docs.repartition(key)
    toks = by_key.select(key, F.explode(tokens_expr).alias("token"))
    return tfidf(toks, key, docs=docs)
