"""Every registered query against its DuckDB oracle on the smallest tables:
same columns, row count and order-insensitive values."""

import math
import re

import pytest

import __spark_entry__ as entry

from .conftest import SF_SMALL

# The training-data queries have tests of their own, which may not be installed.
QUERIES = {k: f for k, f in entry.queries().items() if not re.match(r"op\d+_|pipeline$", k)}
ORACLE = {k: v for k, v in entry.oracle_sql().items() if k in QUERIES}


def _norm(v):
    if v is None:
        return "<null>"
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{round(v, 6):.6f}"
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return str(v)


def _canon(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in data)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF_SMALL)
    got = [tuple(r) for r in df.collect()]
    rel = duck.sql(ORACLE[name])
    want = rel.fetchall()
    assert sorted(df.columns) == sorted(rel.columns)
    assert len(got) == len(want)
    assert _canon(df.columns, got) == _canon(rel.columns, want)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_rows_only_queries_run(spark, name):
    assert QUERIES[name](spark, SF_SMALL).count() > 0


def test_every_query_has_oracle_or_is_declared_rows_only():
    rows_only = {"kmeans_topics", "sentiment_model", "sentiment_model_auc", "support_topics"}
    assert set(QUERIES) - set(ORACLE) == rows_only


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() >= 0
    assert df.columns == entry.entry(spark).columns
