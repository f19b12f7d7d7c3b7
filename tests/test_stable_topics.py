"""Stable topic numbers: batches against one pass, matching of moved centroids."""

import numpy as np

from supportlens.operators import stable_topics as st
from supportlens.operators import vectors as vx


def blobs(seed, n=300, k=4, shift=0.0):
    rng = np.random.default_rng(seed)
    at = np.eye(k) * 10 + shift
    return [(i, (at[i % k] + rng.normal(size=k)).tolist()) for i in range(n)], at


def state_rows(state):
    return {r.topic: (r.members, np.array(r["mean"])) for r in state.collect()}


def test_batches_equal_one_pass_and_cost_does_not_rise(spark):
    rows, at = blobs(1)
    df = spark.createDataFrame([*rows, (999, None)], "id bigint, v array<double>")
    centroids = spark.createDataFrame([(i, (c + 2).tolist()) for i, c in enumerate(at)] + [(7, [500.0] * 4)],
                                      "topic int, centroid array<double>")
    whole = st.absorb(st.start(centroids), df, "v")
    parts = st.start(centroids)
    for q in ("id < 20", "id >= 20 and id < 290", "id < 0", "id >= 290"):
        parts = st.absorb(parts, df.where(q), "v")
    a, b = state_rows(whole), state_rows(parts)
    data = {i: np.array(v) for i, v in rows}
    near = {i: min(range(4), key=lambda c: ((data[i] - at[c] - 2) ** 2).sum()) for i in data}
    assert a[7][0] == b[7][0] == 0 and list(a[7][1]) == [500.0] * 4  # drew nothing, kept
    for t in range(4):
        own = [data[i] for i in data if near[i] == t]
        assert a[t][0] == b[t][0] == len(own)
        assert np.allclose(a[t][1], np.mean(own, axis=0)) and np.allclose(b[t][1], np.mean(own, axis=0))
    cost = lambda c: st.cost(df, "v", c).first()[0]
    assert cost(st.served(parts)) <= cost(centroids)
    brute = sum(min(((v - c) ** 2).sum() for c in [*(at + 2), np.full(4, 500.0)]) for v in data.values())
    assert abs(cost(centroids) - brute) < 1e-6


def test_a_new_fit_keeps_the_numbers(spark):
    first, second = (spark.createDataFrame(blobs(s, shift=x)[0], "id bigint, v array<double>") for s, x in ((2, 0), (3, 0.5)))
    fits = []
    for df, seed in ((first, 1), (second, 9)):
        model, labelled = vx.kmeans_fit(df, "v", k=4, seed=seed)
        fits.append((spark.createDataFrame([(i, c.tolist()) for i, c in enumerate(model.clusterCenters())],
                                           "topic int, centroid array<double>"), labelled))
    matched = st.match_topics(fits[0][0], fits[1][0])
    old = {r.id: r.topic for r in fits[0][1].collect()}
    new = {r.id: r.topic for r in vx.assign_nearest(second, "v", matched).collect()}
    assert old == new  # the same blob, the same number


def test_matching_cases(spark):
    table = lambda rows: spark.createDataFrame(rows, "topic int, centroid array<double>")
    old = table([(3, [0.0]), (5, [10.0])])
    new = table([(0, [9.0]), (1, [0.5]), (2, [100.0])])
    got = {r.fit_topic: (r.topic, r.distance) for r in st.match_topics(old, new).collect()}
    assert got == {0: (5, 1.0), 1: (3, 0.5), 2: (6, None)}
    far = {r.fit_topic: r.topic for r in st.match_topics(old, new, farthest=0.7).collect()}
    assert far == {1: 3, 0: 6, 2: 7}
    assert st.match_topics(old, new.limit(0)).count() == 0
    assert [r.topic for r in st.match_topics(old.limit(0), new).orderBy("fit_topic").collect()] == [0, 1, 2]
    assert st.absorb(st.start(old), spark.createDataFrame([], "v array<double>"), "v").count() == 2
    # equal distances: the smaller old number first
    assert [r.topic for r in st.match_topics(table([(1, [1.0]), (2, [-1.0])]), table([(0, [0.0])])).collect()] == [1]
