"""Topics that keep their numbers while data arrives (M4, M7).

``absorb`` is a mini-batch step: the batch goes to the served centroids, and
per topic the running mean and member count take it in, so a batch costs one
pass over the batch and rows taken in before are not read again. The numbers of
the topics do not change. ``served`` makes the means the centroids of the next
period; as each is the mean of the rows that its centroid drew, the summed
squared distance of all rows taken in cannot rise by it.

``match_topics`` gives the centroids of a new fit the numbers of the old ones:
of all pairs the closest go first, one to one, and what is left over or too
far gets numbers not used before. Centroids are k x d values with k a
parameter, so they are matched on the driver; rows never get there.

Defined cases: rows without a vector are not taken in; a topic that draws no
row keeps its mean (the centroid while it never had any); an empty batch
changes nothing; equal distances go by the smaller old, then new number.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from . import vectors as vx

STATE = "topic int, centroid array<double>, mean array<double>, members bigint"


def start(centroids: DataFrame, topic: str = "topic", centroid: str = "centroid") -> DataFrame:
    """The state (``topic``, ``centroid``, ``mean``, ``members``) before any row."""
    c = vx.as_double_array(centroid)
    return centroids.select(F.col(topic).cast("int").alias("topic"), c.alias("centroid"), c.alias("mean"),
                            F.lit(0).cast("long").alias("members"))


def absorb(state: DataFrame, batch: DataFrame, vec: str) -> DataFrame:
    """The state with the rows of a batch taken in, written once."""
    rows = batch.where(F.col(vec).isNotNull()).select(F.col(vec).alias("v"))
    drawn = vx.assign_nearest(rows, "v", state.select("topic", "centroid"))
    new = vx.centroid_means(drawn, "v", "topic").select(
        "topic", F.col("centroid").alias("m"), F.col("members").alias("n"))
    total = F.col("members") + F.col("n")
    moved = F.zip_with("mean", "m", lambda a, b: a + (b - a) * (F.col("n") / total))
    return materialize(state.join(new, "topic", "left").select(
        "topic", "centroid", F.when(F.col("n").isNull(), F.col("mean")).otherwise(moved).alias("mean"),
        F.coalesce(total, F.col("members")).alias("members")))


def served(state: DataFrame) -> DataFrame:
    """(``topic``, ``centroid``) for the next period: the running means."""
    return state.select("topic", F.col("mean").alias("centroid"))


def cost(rows: DataFrame, vec: str, centroids: DataFrame) -> DataFrame:
    """One row: the summed squared distance of the rows to their nearest centroid."""
    near = vx.assign_nearest(rows.where(F.col(vec).isNotNull()), vec, centroids)
    both = near.join(F.broadcast(centroids.select(F.col("topic").alias("__t"), F.col("centroid").alias("__c"))),
                     F.col("topic") == F.col("__t"))  # k rows
    return both.agg(F.coalesce(F.sum(vx.squared_distance(vx.as_double_array(vec), vx.as_double_array("__c"))),
                               F.lit(0.0)).alias("cost"))


def match_topics(old: DataFrame, new: DataFrame, farthest: float | None = None) -> DataFrame:
    """``new`` (topic, centroid) under the numbers of ``old``: (``topic``,
    ``centroid``, ``fit_topic``, ``distance``), distance null for new numbers.
    Pairs farther apart than ``farthest`` are not matched."""
    spark = old.sparkSession
    a, b = ([(r[0], np.array(r[1], float)) for r in t.select("topic", "centroid").orderBy("topic").collect()]
            for t in (old, new))
    pairs = sorted((float(np.linalg.norm(x - y)), i, j) for i, x in a for j, y in b)
    given: dict[int, tuple[int, float]] = {}
    taken = set()
    for d, i, j in pairs:
        if i not in taken and j not in given and (farthest is None or d <= farthest):
            taken.add(i)
            given[j] = i, d
    free = max((i for i, _ in a), default=-1) + 1
    rows = []
    for j, y in b:
        if j in given:
            rows.append((given[j][0], y.tolist(), j, given[j][1]))
        else:
            rows.append((free, y.tolist(), j, None))
            free += 1
    return spark.createDataFrame(rows, "topic int, centroid array<double>, fit_topic int, distance double")
