"""Sinks: CSV (S6) and JSON-lines (S7) export, with readers for the round trip.

Writers are distributed (one file per partition) and target a folder on
shared storage. CSV cannot hold arrays/structs, so nested columns are written
as their JSON text first. CSV options keep text exact: RFC-4180 quoting
(``""`` inside quotes), no whitespace trimming, ``\\N`` for NULL so that an
empty string stays an empty string.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CSV_OPTIONS = {
    "header": "true", "quote": '"', "escape": '"', "nullValue": "\\N",
    "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
}


def nested_as_json(df: DataFrame) -> DataFrame:
    """Replace array/map/struct columns with their JSON text."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            cols.append(F.to_json(F.col(f.name)).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Header row, no index column, nested cells as JSON text."""
    nested_as_json(df).write.mode(mode).options(**CSV_OPTIONS).csv(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    return spark.read.schema(schema).options(multiLine="true", **CSV_OPTIONS).csv(path)


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One JSON record per line (a distributed stand-in for a JSON array)."""
    df.write.mode(mode).json(path)


def read_json(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    return spark.read.schema(schema).json(path)
