"""Grouping sets with distinct counts, exact and by mergeable sketches.

``distinct_cube`` counts rows and distinct values for every subset of the
dimensions. Rows are first counted per (dimensions, value), so that the cube
expands that table and not the rows, and a cell that holds a third of all rows
arrives as partial counts.

``SketchStore`` keeps one cardinality sketch per period and cell. A period is
written on its own and replaces what was stored of it, so adding data reads the
new periods only and a repeated run changes nothing; reports merge the stored
sketches. A sketch of 2^lg_k registers has a relative standard error of about
1.04 / sqrt(2^lg_k) (1.6 % by default) whatever it counts, and merging adds
none.

Defined cases: null dimension values are a value of their own, told from a
total by ``level`` (bits from the first dimension on, 1 where it is summed
over); null values count as rows and never as distinct; an empty table gives
the grand total of 0 rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

LG_K = 12


def distinct_cube(df: DataFrame, dims: Sequence[str], value: str, distinct: str = "distinct_values") -> DataFrame:
    """Dimensions, ``level``, ``n`` and the exact number of distinct values."""
    leaves = df.groupBy(*dims, value).agg(F.count(F.lit(1)).alias("__n"))
    return leaves.cube(*dims).agg(
        F.grouping_id().cast("int").alias("level"), F.coalesce(F.sum("__n"), F.lit(0)).alias("n"),
        F.count_distinct(value).alias(distinct))


def _sketched(df: DataFrame, value: str) -> Column:
    kind = df.schema[value].dataType
    plain = isinstance(kind, (T.IntegerType, T.LongType, T.StringType, T.BinaryType))
    return F.col(value) if plain else F.col(value).cast("string")


def sketch_cells(df: DataFrame, dims: Sequence[str], value: str, lg_k: int = LG_K) -> DataFrame:
    """Dimensions, ``n`` and the sketch of the values of each cell."""
    return df.groupBy(*dims).agg(F.count(F.lit(1)).alias("n"),
                                 F.hll_sketch_agg(_sketched(df, value), lg_k).alias("sketch"))


def merged_cube(cells: DataFrame, dims: Sequence[str], distinct: str = "distinct_estimate") -> DataFrame:
    """Dimensions, ``level``, ``n``, the merged ``sketch`` and its estimate,
    for every subset of the dimensions, from stored cells alone."""
    merged = cells.cube(*dims).agg(F.grouping_id().cast("int").alias("level"),
                                   F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.hll_union_agg("sketch").alias("sketch"))
    return merged.withColumn(distinct, F.coalesce(F.hll_sketch_estimate("sketch"), F.lit(0)))


class SketchStore:
    """Sketches per period and cell as a table partitioned by period."""

    def __init__(self, spark: SparkSession, path: str, period: str, dims: Sequence[str], lg_k: int = LG_K):
        self.spark, self.path, self.period, self.dims, self.lg_k = spark, path, period, list(dims), lg_k

    def add(self, df: DataFrame, value: str) -> None:
        """Store the periods that occur in ``df``, each of them whole."""
        cells = sketch_cells(df, [self.period, *self.dims], value, self.lg_k)
        # one file per period, however many tasks held its cells
        (cells.repartition(self.period).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
              .partitionBy(self.period).parquet(self.path))

    def cells(self) -> DataFrame:
        return self.spark.read.parquet(self.path)

    def cube(self, dims: Sequence[str] | None = None, distinct: str = "distinct_estimate") -> DataFrame:
        """The report over the stored periods; by default of the store's own
        dimensions, the period may be one of them."""
        return merged_cube(self.cells(), self.dims if dims is None else dims, distinct)
