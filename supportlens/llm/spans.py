"""Spans of texts: what the span-finding operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ship_package

Span = tuple[str, int, int]  # kind, start, end in code points, end exclusive

SPAN_TYPE = T.ArrayType(T.StructType([
    T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()),
    T.StructField("end", T.LongType())]))
_ARROW = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def span_table(df: DataFrame, find: Callable[[str], Sequence[Span]], id_col: str,
               text_col: str) -> DataFrame:
    """(id, ``spans``) per input row, in Arrow batches; a null text is empty."""
    ship_package(df.sparkSession)
    schema = T.StructType([T.StructField(id_col, df.schema[id_col].dataType),
                           T.StructField("spans", SPAN_TYPE)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = [[{"kind": k, "start": a, "end": b} for k, a, b in find(t.as_py() or "")]
                     for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, _ARROW)],
                                             names=[id_col, "spans"])

    return df.select(id_col, text_col).mapInArrow(run, schema)


def of_kinds(spans: Column, kinds: Sequence[str]) -> Column:
    return F.filter(spans, lambda s: s["kind"].isin(list(kinds)))


def listed(spans: Column) -> Column:
    """``kind:start:end`` of the spans in their order, comma-joined."""
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))


def count_of(spans: Column, kind: str) -> Column:
    return F.size(of_kinds(spans, [kind])).cast("long")
