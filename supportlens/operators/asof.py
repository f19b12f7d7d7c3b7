"""As-of join: each row with the latest earlier row of another table.

Both tables are put into one order (key, time, side) and range-partitioned by
all of it, so a key that holds a third of all rows is spread over as many
partitions as its rows fill. Each sorted partition streams through once and
keeps the latest row of the other table. Only rows of a partition's
first key may have their match in an earlier partition; it is found among the
last matches that the partitions hand on (a row each), by a window per key
over those rows alone, and broadcast.

Left rows without a match, a key or a time keep nulls. Right rows without a
key or a time match nothing. Of right rows with equal key and time the one
with the largest ``tie`` columns counts (default: of the row as JSON text).
Repeated left rows get a result each; empty tables are fine.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize, ship_package

ROW, HEAD, TAIL = 0, 1, 2  # left rows; the first and the last key of a partition


def _stream(batches, names):
    part = TaskContext.get().partitionId()
    key = last = None
    has, head = False, True

    def out(kind, k, left, right, is_open):
        n = len(k)
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(n, kind, dtype=np.int32)), pa.array(np.full(n, part, dtype=np.int32)), k, left, right,
             pa.array(is_open)], names=names)

    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        k, is_right, left, right = batch.columns
        codes = np.asarray(k.dictionary_encode().indices)
        new = np.empty(n, dtype=bool)
        new[1:] = codes[1:] != codes[:-1]
        first = k[0].as_py()
        if key is None:
            yield out(HEAD, k.slice(0, 1), left.slice(0, 1).take(pa.array([None], pa.int64())),
                      right.slice(0, 1).take(pa.array([None], pa.int64())), [False])
            key, last = first, right.slice(0, 1)
        new[0] = first != key
        at = np.arange(n)
        begin = np.maximum.accumulate(np.where(new, at, -1))
        hit = np.maximum.accumulate(np.where(np.asarray(pc.fill_null(is_right, False)), at, -1))
        here, carried = (hit >= begin) & (hit >= 0), (begin < 0) & has
        place = np.where(here, hit + 1, 0)
        found = here | carried
        match = pa.concat_arrays([last, right]).take(pa.array(place, mask=~found))
        lefts = np.flatnonzero(~np.asarray(is_right))
        if len(lefts):
            pick = pa.array(lefts)
            yield out(ROW, k.take(pick), left.take(pick), match.take(pick), ((begin < 0) & head & ~found)[lefts])
        key, has = k[n - 1].as_py(), bool(found[-1])
        last = match.slice(n - 1, 1)
        head = head and begin[-1] < 0
    if key is not None:
        yield out(TAIL, pa.array([key], pa.string()), left.slice(0, 1).take(pa.array([None], pa.int64())), last, [False])


def asof_join(left: DataFrame, right: DataFrame, by: list[str], left_time: str, right_time: str, prefix: str = "right_",
              strict: bool = False, tie: list[str] | None = None, partitions: int | None = None) -> DataFrame:
    """All rows of ``left`` with the columns of ``right`` (``prefix`` before
    their names) of its latest row with the same ``by`` at or before
    ``left_time`` (``strict``: before)."""
    ship_package(left.sparkSession)
    key = F.to_json(F.struct(*by))
    known = F.lit(True)
    for c in (*by, right_time):
        known = known & F.col(c).isNotNull()
    l_row, r_row = F.struct(*left.columns), F.struct(*right.columns)
    order_of = F.struct(*[F.col(c) for c in tie]) if tie else F.to_json(r_row)
    l_type, r_type = left.select(l_row.alias("x")).schema["x"].dataType, right.select(r_row.alias("x")).schema["x"].dataType
    tie_type = right.select(order_of.alias("x")).schema["x"].dataType
    lefts = left.select(key.alias("k"), F.col(left_time).alias("t"), F.lit(False).alias("is_right"), l_row.alias("l"),
                        F.lit(None).cast(r_type).alias("r"), F.lit(None).cast(tie_type).alias("tie"))
    rights = right.where(known).select(key.alias("k"), F.col(right_time).alias("t"), F.lit(True).alias("is_right"),
                                       F.lit(None).cast(l_type).alias("l"), r_row.alias("r"), order_of.alias("tie"))
    side = F.col("is_right") if strict else ~F.col("is_right")  # at equal times
    order = [F.col("k"), F.col("t"), side, F.col("tie"), F.xxhash64(F.to_json("l"))]
    dealt = lefts.union(rights).repartitionByRange(*([partitions] if partitions else []), *order)
    schema = T.StructType([
        T.StructField("kind", T.IntegerType()), T.StructField("part", T.IntegerType()), T.StructField("k", T.StringType()),
        T.StructField("l", l_type), T.StructField("r", r_type), T.StructField("open", T.BooleanType())])
    names = schema.names
    rows = dealt.sortWithinPartitions(*order).select("k", "is_right", "l", "r")
    found = materialize(rows.mapInArrow(lambda batches: _stream(batches, names), schema))
    # what the partitions before hand on to a partition's first key
    earlier = Window.partitionBy("k").orderBy("part", "kind").rowsBetween(Window.unboundedPreceding, -1)
    ends = found.where(F.col("kind") != ROW).select("part", "kind", "k", F.last("r", ignorenulls=True).over(earlier).alias("carry"))
    carry = ends.where((F.col("kind") == HEAD) & F.col("carry").isNotNull()).select("part", "carry")
    out = found.where(F.col("kind") == ROW).join(F.broadcast(carry), "part", "left")  # a row per partition
    match = F.when(F.col("open"), F.col("carry")).otherwise(F.col("r"))
    return out.select("l", match.alias("m")).select(
        *[F.col("l")[c].alias(c) for c in left.columns], *[F.col("m")[c].alias(prefix + c) for c in right.columns])
