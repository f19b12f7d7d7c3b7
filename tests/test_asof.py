import random

import pytest

from supportlens.operators.asof import asof_join


def brute(left, right, strict):
    out = []
    for k, t, v in left:
        best = max(((rt, w) for rk, rt, w in right if None not in (rk, rt, k, t) and rk == k and (rt < t or (rt == t and not strict))),
                   default=(None, None))
        out.append((k, t, v, *best))
    return sorted(out, key=str)


def run(spark, left, right, **kw):
    a = spark.createDataFrame(left, "u string, t int, v int")
    b = spark.createDataFrame(right, "u string, t int, w int")
    out = asof_join(a, b, ["u"], "t", "t", tie=["w"], **kw)
    assert out.columns == ["u", "t", "v", "right_u", "right_t", "right_w"]
    return sorted(((r.u, r.t, r.v, r.right_t, r.right_w) for r in out.collect()), key=str)


@pytest.mark.parametrize("partitions,strict", [(None, False), (1, True), (13, False), (40, True)])
def test_equals_the_definition(spark, partitions, strict):
    rnd = random.Random(partitions)
    user = lambda: rnd.choice(["a", "b", "hot", "hot", "hot", "only", None])
    left = [(user(), rnd.choice([*range(60), None]), i) for i in range(500)]
    right = [(rnd.choice(["a", "b", "hot", "hot", None, "none"]), rnd.choice([*range(0, 60, 3), None]), i) for i in range(200)]
    assert run(spark, left, right, partitions=partitions, strict=strict) == brute(left, right, strict)


def test_a_match_many_partitions_back(spark):
    """One early match for a user whose rows fill all partitions."""
    left = [("hot", i, i) for i in range(1, 600)] + [("other", 5, -1)]
    right = [("hot", 0, 7), ("hot", 400, 8)]
    assert run(spark, left, right, partitions=25) == brute(left, right, False)


def test_empty_tables_and_repeated_rows(spark):
    assert run(spark, [], [("a", 1, 1)]) == []
    assert run(spark, [("a", 1, 1)] * 2, []) == [("a", 1, 1, None, None)] * 2
    assert run(spark, [("a", 1, 1)] * 2, [("a", 1, 5), ("a", 1, 4)] * 2) == [("a", 1, 1, 1, 5)] * 2
