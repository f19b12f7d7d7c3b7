"""Aggregates and reports.

All reports are global or grouped aggregates with map-side partial
aggregation; global scalars (min/max) enter plans as scalar subqueries, which
Spark evaluates once and inlines as literals (no join, no single-partition
window over the data).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize

SCORE_METRICS = ("relevance", "helpfulness", "tone")


def length_histogram(df: DataFrame, col: str = "length", bins: int = 30) -> DataFrame:
    """A4: equal-width histogram over [min, max], last bin closed on the right.

    Empty bins are present. When min == max the range is widened by 0.5 on
    each side (numpy's rule). Output: bin (1..bins), bin_lo, bin_hi, n.
    """
    spark = df.sparkSession
    x = F.col(col).cast("double")
    # Pre-aggregate per distinct value: the histogram only ever sees the
    # (value, count) table, whatever the size of the input.
    # Written once: range and counts read it, the rows behind it are not redone.
    per_value = materialize(df.where(F.col(col).isNotNull()).groupBy(x.alias("v"))
                              .agg(F.count("*").alias("c")))
    lo0 = per_value.select(F.min("v")).scalar()
    hi0 = per_value.select(F.max("v")).scalar()
    same = lo0 == hi0
    lo = F.when(same, lo0 - 0.5).otherwise(lo0)
    hi = F.when(same, hi0 + 0.5).otherwise(hi0)
    b = F.least(F.floor(F.lit(float(bins)) * (F.col("v") - lo) / (hi - lo)).cast("int") + 1,
                F.lit(bins))
    counts = per_value.groupBy(b.alias("bin")).agg(F.sum("c").alias("n"))
    width = (hi - lo) / F.lit(float(bins))
    grid = spark.range(1, bins + 1).select(F.col("id").cast("int").alias("bin"))
    return (grid.join(F.broadcast(counts), "bin", "left")  # both sides hold <= bins rows
            .select("bin",
                    F.round(lo + (F.col("bin") - 1) * width, 4).alias("bin_lo"),
                    F.round(lo + F.col("bin") * width, 4).alias("bin_hi"),
                    F.coalesce(F.col("n"), F.lit(0)).cast("bigint").alias("n")))


def sentiment_by_category(df: DataFrame, category: str = "normalized_category",
                          sentiment: str = "sentiment") -> DataFrame:
    """Counts on the full grid of observed categories x observed sentiments.

    Rows with no sentiment are left out. ``category_total`` carries the order
    of the categories (descending total, then name). The grid is built from two
    aggregates joined on a constant-free key: every category row is paired with
    every observed label through an exploded label array, never a cross join
    of the data.
    """
    rows = df.where(F.col(sentiment).isNotNull())
    # categories x labels counts: tiny, read by four branches -> written once.
    counts = materialize(rows.groupBy(category, sentiment).agg(F.count("*").alias("n")))
    labels = counts.select(F.sort_array(F.collect_set(sentiment))).scalar()
    per_cat = counts.groupBy(category).agg(F.sum("n").alias("category_total"))
    grid = per_cat.select(category, "category_total", F.explode(labels).alias(sentiment))
    return (grid.join(counts, [category, sentiment], "left")
                .select(category, sentiment, F.coalesce("n", F.lit(0)).alias("n"),
                        "category_total")
                .orderBy(F.desc("category_total"), category, sentiment))


def _score_col(m: str):
    # An absent score counts as 0 in the aggregates (unlike the parser's defaults).
    return F.coalesce(F.col(m).cast("int"), F.lit(0))


def quality_averages(scores: DataFrame, metrics=SCORE_METRICS) -> DataFrame:
    """A1: one row: n, and per metric its sum and sum / max(1, n) rounded to 3 places."""
    n = F.count(F.lit(1))
    aggs = [n.alias("n")]
    for m in metrics:
        s = F.sum(_score_col(m))
        aggs.append(F.coalesce(s, F.lit(0)).cast("bigint").alias(f"sum_{m}"))
        aggs.append(F.round(F.coalesce(s, F.lit(0)) / F.greatest(F.lit(1), n), 3).alias(f"avg_{m}"))
    return scores.agg(*aggs)


def quality_distributions(scores: DataFrame, metrics=SCORE_METRICS) -> DataFrame:
    """A2: long rows (metric, score, n), partial-aggregated before the shuffle."""
    long = scores.select(F.explode(F.array(*[
        F.struct(F.lit(m).alias("metric"), _score_col(m).alias("score")) for m in metrics])).alias("x"))
    return (long.groupBy(F.col("x.metric").alias("metric"), F.col("x.score").alias("score"))
                .agg(F.count(F.lit(1)).alias("n")))


def quality_summary(scores: DataFrame, metrics=SCORE_METRICS) -> DataFrame:
    """A3: one row, also for empty input: n, averages, and each distribution as
    JSON text of a map with ascending keys. Distributions are tiny aggregates
    brought in as scalar subqueries."""
    avg = quality_averages(scores, metrics)
    # metrics x score values: tiny, read by one subquery per metric -> written once.
    dist = materialize(quality_distributions(scores, metrics))
    cols = [F.col("n")] + [F.col(f"avg_{m}") for m in metrics]
    for m in metrics:
        d = dist.where(F.col("metric") == m).select(
            F.to_json(F.map_from_entries(F.array_sort(F.collect_list(F.struct(
                F.col("score").cast("string"), F.col("n"))))))).scalar()
        cols.append(F.coalesce(d, F.lit("{}")).alias(f"dist_{m}"))
    return avg.select(*cols)
