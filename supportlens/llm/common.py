"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the data folder, through Spark's own reader."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once per row.

    A lambda that refers to an outer expression re-evaluates it for every
    element; binding it as the only element of an array avoids that.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only. Pure ASCII text (byte length = character length)
    takes the built-in ``lower``, which agrees there and is faster."""
    return (F.when(F.octet_length(text) == F.char_length(text), F.lower(text))
             .otherwise(F.translate(text, UPPER, UPPER.lower())))


def _split(text: Column, separators: str) -> Column:
    return F.array_remove(F.split(text, separators), "")


def alnum_words(text: Column) -> Column:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the text, A-Z
    lower-cased; null text has none."""
    return _split(ascii_lower(F.coalesce(text, F.lit(""))), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def space_words(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of the text as written; null has none."""
    return _split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+")


def positions(n: Column) -> Column:
    """``[0, ..., n-1]``, empty for n <= 0."""
    return F.when(n > 0, F.sequence(F.lit(0), n.cast("int") - 1)).otherwise(
        F.array().cast("array<int>"))


class Scratch:
    """Intermediate tables of one operator run, as Parquet under the shared
    folder that ``spark.checkpoint.dir`` names (own folder when unset).

    They survive lost executors. ``drop`` deletes a table as soon as the
    tables made from it are written.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.base = scratch_path(spark, f"{name}-{uuid.uuid4().hex}")

    def write(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.base}/{name}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def path(self, name: str) -> str:
        return f"{self.base}/{name}"

    def drop(self, *names: str) -> None:
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        for name in names:
            path = jvm.org.apache.hadoop.fs.Path(f"{self.base}/{name}")
            path.getFileSystem(conf).delete(path, True)
