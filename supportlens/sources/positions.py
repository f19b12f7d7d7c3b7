"""Positions of rows in an ordered table, without gathering it.

Tables without a key are paired by position. A position is the number of rows
before, plus one: rows are range-partitioned by their order, sorted inside the
partitions and written; a row's place in its partition is then known, and the
rows of all partitions before it come from one count per partition, the only
thing that reaches the driver. No window runs over a whole table.

Rows that agree in the order columns stand in the order of a hash of the whole
row, so equal input gives equal positions, but for rows that are the same.
Nulls come first, as in any Spark sort.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import materialize, scratch_scope

_PLACE_BITS = 33  # monotonically_increasing_id: partition above, place in it below


def _sorted_parts(df: DataFrame, order_by: list, scope: scratch_scope | None) -> DataFrame:
    """Written rows with ``__part`` (ascending in the order) and ``__place``."""
    order = [*[F.col(c) if isinstance(c, str) else c for c in order_by],
             F.xxhash64(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])))]
    dealt = df.repartitionByRange(*order).sortWithinPartitions(*order)
    at = F.monotonically_increasing_id()
    return materialize(dealt.withColumn("__at", at).select(
        *[F.col(f"`{c}`") for c in df.columns], F.shiftright("__at", _PLACE_BITS).alias("__part"),
        F.col("__at").bitwiseAND((1 << _PLACE_BITS) - 1).alias("__place")), scope=scope)


def _with_offsets(parts: DataFrame, totals: DataFrame) -> DataFrame:
    """``__offset``: the total of all partitions before (one row each)."""
    before, rows = 0, []
    for part, n in sorted((r[0], r[1]) for r in totals.collect()):
        rows.append((part, before))
        before += n
    offsets = parts.sparkSession.createDataFrame(rows, "__part bigint, __offset bigint")
    return parts.join(F.broadcast(offsets), "__part")


def number_rows(df: DataFrame, order_by: list, out: str = "position",
                scope: scratch_scope | None = None) -> DataFrame:
    """All rows with their position (from 1) in the order of ``order_by``."""
    df = df.drop(out)
    parts = _sorted_parts(df, order_by, scope)
    both = _with_offsets(parts, parts.groupBy("__part").agg(F.count(F.lit(1))))
    return both.select(*[F.col(f"`{c}`") for c in df.columns], (F.col("__offset") + F.col("__place") + 1).alias(out))


def sums_before(df: DataFrame, order_by: list, size: Column, out: str = "before",
                scope: scratch_scope | None = None) -> DataFrame:
    """All rows with the sum of ``size`` (0 or more) over the rows before them."""
    df = df.drop(out).withColumn("__size", size.cast("bigint"))
    parts = _sorted_parts(df, order_by, scope)
    both = _with_offsets(parts, parts.groupBy("__part").agg(F.sum("__size")))
    here = F.sum("__size").over(Window.partitionBy("__part").orderBy("__place")) - F.col("__size")
    return both.withColumn(out, F.col("__offset") + here).drop("__part", "__place", "__offset", "__size")


def read_with_positions(spark: SparkSession, path: str, out: str = "position") -> DataFrame:
    """A Parquet table without a key, each row with its position in the files
    (files in the order of their names). The rows stay where they are read:
    Parquet numbers a file's rows, and only the files are summed up."""
    rows = spark.read.parquet(path)
    cols = [c for c in rows.columns if c != out]
    placed = rows.select(*[F.col(f"`{c}`") for c in cols], F.col("_metadata.file_path").alias("__file"),
                         F.col("_metadata.row_index").alias("__row"))
    files = sums_before(placed.groupBy("__file").agg(F.count(F.lit(1)).alias("__n")), ["__file"], F.col("__n"), "__before")
    return placed.join(files.select("__file", "__before"), "__file").select(
        *[F.col(f"`{c}`") for c in cols], (F.col("__before") + F.col("__row") + 1).alias(out))


def pair_by_position(left: DataFrame, right: DataFrame, left_order: list | None = None,
                     right_order: list | None = None, position: str = "position", how: str = "inner") -> DataFrame:
    """P3 without keys: the n-th row of one table beside the n-th of the other.
    A table with a ``position`` already (``read_with_positions``) needs no order;
    of tables of different length the rest goes, or stays with ``how="full"``."""
    def numbered(df: DataFrame, order: list | None) -> DataFrame:
        if order is None and position not in df.columns:
            raise ValueError(f"a table without {position!r} needs columns that order its rows")
        return df if order is None else number_rows(df, order, position)

    a, b = numbered(left, left_order), numbered(right, right_order)
    if clash := (set(a.columns) & set(b.columns)) - {position}:
        raise ValueError(f"columns of both tables: {sorted(clash)}")
    return a.join(b, position, how)
