"""Table access: readers with declared schemas, header trimming (S1), text
column resolution (S2/S3) and key checks.

All functions are plan-time: they look at ``df.columns`` / schemas on the
driver and never touch row data.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels",
    "conversations",
)

# Declared schemas of the tables the operators read. Parquet carries its own
# schema; these are checked on entry so a wrong input fails at plan time.
SCHEMAS = {
    "conversations": T.StructType([
        T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()),
        T.StructField("role", T.StringType()), T.StructField("text", T.StringType())]),
    "documents": T.StructType([
        T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType())]),
    "labels": T.StructType([
        T.StructField("doc_id", T.LongType()), T.StructField("quality", T.IntegerType()),
        T.StructField("toxic", T.IntegerType())]),
    "embeddings": T.StructType([
        T.StructField("vec_id", T.LongType()),
        T.StructField("embedding", T.ArrayType(T.FloatType())),
        T.StructField("label", T.IntegerType())]),
    "benchmark": T.StructType([
        T.StructField("item_id", T.LongType()), T.StructField("text", T.StringType())]),
    "events": T.StructType([
        T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampNTZType()),
        T.StructField("user_id", T.LongType()), T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()), T.StructField("props", T.StringType())]),
}


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


# Tables whose rows carry long texts: every per-row operator on them is CPU
# heavy (regex, tokenising), so their scans must use the whole cluster.
TEXT_TABLES = ("documents", "conversations", "pages", "benchmark")


def _row_groups(paths: list[str]) -> int | None:
    """Row groups in a few local parquet files (footers only), None if unknown."""
    try:
        import pyarrow.parquet as pq

        return sum(pq.ParquetFile(p.removeprefix("file:")).num_row_groups for p in paths)
    except Exception:  # noqa: BLE001 - non-local filesystem: size is unknown
        return None


def spread(df: DataFrame) -> DataFrame:
    """Guarantee scan parallelism for CPU-heavy per-row work.

    A parquet row group is the smallest unit of scan parallelism. When the
    input has fewer files than the cluster has task slots, Spark's planned
    scan splits are consulted, and for local files also the row groups; the
    rows are round-robin repartitioned over all slots right after the scan
    (filters and column pruning still reach the parquet reader below) only
    when both say the scan alone would leave slots idle. With many files or
    many large splits, the common case at scale, nothing is added.
    """
    slots = df.sparkSession.sparkContext.defaultParallelism
    files = df.inputFiles()
    if len(files) >= slots:
        return df
    groups = _row_groups(files)
    if groups is not None and groups >= slots:
        return df
    if groups is None and df.rdd.getNumPartitions() >= slots:
        return df  # footers unreadable here: trust Spark's byte-based splits
    return df.repartition(slots)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one driver table; verify declared column names and types."""
    df = spark.read.parquet(table_path(sf_dir, name))
    declared = SCHEMAS.get(name)
    if declared is not None:
        have = {f.name: f.dataType for f in df.schema.fields}
        for f in declared.fields:
            if f.name not in have:
                raise ValueError(f"{name}: missing column {f.name}")
            if have[f.name] != f.dataType:
                raise ValueError(f"{name}.{f.name}: {have[f.name]} != {f.dataType}")
    return spread(df) if name in TEXT_TABLES else df


def register_tables(spark: SparkSession, sf_dir: str,
                    names: Iterable[str] = TABLES) -> None:
    """Expose driver tables as temp views for ``spark.sql``."""
    for name in names:
        read_table(spark, sf_dir, name).createOrReplaceTempView(name)


def trim_headers(df: DataFrame) -> DataFrame:
    """Strip surrounding whitespace from every column name."""
    new = [c.strip() for c in df.columns]
    if len(set(new)) != len(new):
        raise ValueError(f"trimmed column names collide: {new}")
    return df.toDF(*new)


# Fallback text-column names, tried in this order, case-sensitive.
TEXT_COLUMN_CANDIDATES = ("query", "Query", "text", "Text", "customer_query")


def resolve_text_column(df: DataFrame, preferred: str = "query",
                        candidates: Iterable[str] = TEXT_COLUMN_CANDIDATES) -> str:
    """``preferred`` when present, else the first existing candidate."""
    cols = list(df.columns)
    if preferred in cols:
        return preferred
    for c in candidates:
        if c in cols:
            return c
    raise KeyError(f"which column holds the texts? none of {[preferred, *candidates]} is among {cols}")


def query_column(df: DataFrame, preferred: str = "Queries") -> str:
    """S3: ``Queries`` when present, else the first column."""
    return preferred if preferred in df.columns else df.columns[0]


# Characters Python's ``str.strip()``/``str.split()`` treat as whitespace, as a
# regex class body usable by Java regex and RE2 alike (fixed values).
WS_CLASS = (r"\t\n\x0b\x0c\r\x1c-\x1f \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
            r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}")


def py_strip(col) -> "F.Column":
    """``str(x).strip()``: Spark ``trim`` removes spaces only."""
    return F.regexp_replace(col, f"^[{WS_CLASS}]+|[{WS_CLASS}]+$", "")


def load_query_texts(df: DataFrame, preferred: str = "query",
                     key: str = "row_id") -> DataFrame:
    """S2 as a DataFrame: (key, query) with the resolved column cast and
    stripped; a missing text is empty (Q1)."""
    name = resolve_text_column(df, preferred)
    return df.select(F.col(key), py_strip(F.coalesce(F.col(name).cast("string"), F.lit(""))).alias("query"))


def require_key(df: DataFrame, key: str = "row_id") -> DataFrame:
    """Check (lazily, as part of the plan) that ``key`` is present.

    Uniqueness is an input contract; ``assert_unique_key`` verifies it with one
    aggregate when a caller wants the check paid for.
    """
    if key not in df.columns:
        raise ValueError(f"ordering key {key!r} missing; every 'first k' needs it")
    return df


def assert_unique_key(df: DataFrame, key: str = "row_id") -> None:
    dup = df.groupBy(key).count().where("count > 1").limit(1).count()
    if dup:
        raise ValueError(f"{key} is not unique")


def read_any(spark: SparkSession, path: str, schema=None, sheet: str | None = None) -> DataFrame:
    """A table by its file type (Parquet, CSV with a header, JSON lines,
    workbook), column names trimmed. CSV and workbook columns are strings
    unless a schema is given; ``sheet`` names a workbook's sheet, the first by default."""
    kind = path.rstrip("/").rsplit(".", 1)[-1].lower()
    reader = spark.read if schema is None else spark.read.schema(schema)
    if kind in ("csv", "tsv"):
        df = (reader.option("header", True).option("multiLine", True).option("escape", '"')
                    .option("sep", "\t" if kind == "tsv" else ",").csv(path))
    elif kind in ("json", "jsonl", "ndjson"):
        df = reader.json(path)
    elif kind == "parquet":
        df = reader.parquet(path)
    elif kind == "xlsx":
        from .workbooks import read_workbooks

        df = read_workbooks(spark, path, sheet, schema)
    else:
        raise ValueError(f"{path}: neither Parquet, CSV, JSON nor a workbook")
    return trim_headers(df)


def load_two_tables(spark: SparkSession, queries_path: str, responses_path: str) -> tuple[DataFrame, DataFrame]:
    """The query table and the response table, headers trimmed."""
    return read_any(spark, queries_path), read_any(spark, responses_path)
