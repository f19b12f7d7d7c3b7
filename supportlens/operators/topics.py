"""Per-topic samples and counts.

"First k in input order" is always first k by an explicit ordering key.
``row_number() <= k`` over a window lets Catalyst insert a WindowGroupLimit,
which trims every group to k rows on the map side before the shuffle, so a
topic holding a third of all rows still ships only k rows per partition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def topic_head(df: DataFrame, topic: str, order_key: str, k: int = 5) -> DataFrame:
    """M9: first k rows of every topic (flat rows), with their rank."""
    w = Window.partitionBy(topic).orderBy(order_key)
    return df.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def topic_samples(df: DataFrame, text: str, topic: str, order_key: str, k: int = 5) -> DataFrame:
    """M8: (topic, samples) with samples the first k texts of the topic in key order."""
    head = topic_head(df.select(topic, order_key, text), topic, order_key, k)
    return (head.groupBy(topic)
                .agg(F.array_sort(F.collect_list(F.struct(F.col(order_key).alias("k"),
                                                          F.col(text).alias("t")))).alias("s"))
                .select(topic, F.transform("s", lambda e: e["t"]).alias("samples")))


def unique_clusters(df: DataFrame, topic: str = "topic") -> DataFrame:
    """Number of distinct topics (one row)."""
    return df.agg(F.count_distinct(topic).alias("unique_clusters"))
