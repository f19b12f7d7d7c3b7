"""Cubes: exact counts against brute force, merged sketches against one pass."""

from itertools import product

from pyspark.sql import functions as F

from supportlens.operators import cubes
from supportlens.session import scratch_path

ROWS = [("a", "x", 1), ("a", "x", 1), ("a", None, 2), (None, "x", 1), (None, None, None), ("b", "y", 3), ("b", "y", None)]


def brute(rows):
    out = set()
    for by_g, by_h in product((True, False), repeat=2):
        cells = {}
        for g, h, v in rows:
            cells.setdefault((g if by_g else None, h if by_h else None), []).append(v)
        for (g, h), vs in cells.items():
            out.add((g, h, 2 * (not by_g) + (not by_h), len(vs), len({v for v in vs if v is not None})))
    return out


def test_exact_and_merged_cubes_equal_brute_force(spark):
    df = spark.createDataFrame(ROWS, "g string, h string, v bigint")
    assert {tuple(r) for r in cubes.distinct_cube(df, ["g", "h"], "v").collect()} == brute(ROWS)
    cells = cubes.sketch_cells(df, ["g", "h"], "v")
    got = cubes.merged_cube(cells, ["g", "h"]).drop("sketch").collect()
    assert {tuple(r) for r in got} == brute(ROWS)  # so few values are counted exactly


def test_empty(spark):
    none = spark.createDataFrame([], "g string, h string, v double")
    assert [tuple(r) for r in cubes.distinct_cube(none, ["g", "h"], "v").where("level = 3").collect()] in (
        [], [(None, None, 3, 0, 0)])
    assert cubes.sketch_cells(none, ["g"], "v").count() == 0


def test_store_merges_as_one_pass_within_the_stated_error(spark):
    df = spark.range(300_000).select(
        (F.col("id") % 7).alias("day"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("g"), F.col("id") % 5))
        .alias("g"), F.pmod(F.xxhash64("id"), F.lit(120_000)).alias("v"))
    store = cubes.SketchStore(spark, scratch_path(spark, "test-sketch-store"), "day", ["g"])
    for d in (0, 1):
        store.add(df.where(F.col("day") % 2 == d), "v")
    before = {r.g: r.distinct_estimate for r in store.cube().collect()}
    store.add(df.where("day = 4"), "v")  # a repeated period replaces itself
    got = {r.g: r for r in store.cube().collect()}
    assert {g: r.distinct_estimate for g, r in got.items()} == before
    assert sum(r.n for g, r in got.items() if g is not None) == got[None].n == 300_000
    exact = {r.g: r.distinct_values for r in cubes.distinct_cube(df, ["g"], "v").collect()}
    assert set(got) == set(exact)
    settled = lambda c: F.hll_sketch_estimate(F.hll_union(c, c))
    once = {r.g: r.e for r in df.cube("g").agg(F.hll_sketch_agg("v", cubes.LG_K).alias("s")).select(
        "g", settled("s").alias("e")).collect()}
    for r in store.cube().select("g", "distinct_estimate", settled("sketch").alias("e")).collect():
        assert r.e == once[r.g]
        assert abs(r.distinct_estimate - exact[r.g]) <= 5 * 1.04 / 64 * exact[r.g]
