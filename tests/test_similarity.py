import numpy as np
import pytest

from supportlens.operators import similarity as sm

from .conftest import SF_SMALL


def frame(spark, vectors, ids=None):
    ids = list(range(len(vectors))) if ids is None else ids
    return spark.createDataFrame([(i, None if v is None else [float(x) for x in v]) for i, v in zip(ids, vectors)],
                                 "id bigint, v array<double>")


def brute(vectors, asked, k):
    m = np.array(vectors, dtype=float)
    n = np.linalg.norm(m, axis=1, keepdims=True)
    m = np.divide(m, n, out=np.zeros_like(m), where=n > 0)
    out = {}
    for q in asked:
        s = np.round(m @ m[q], sm.PLACES)
        out[q] = [i for i in sorted(range(len(m)), key=lambda i: (-s[i], i)) if i != q][:k]
    return out


def found(result):
    out = {}
    for r in sorted(result.collect(), key=lambda r: (r.query_id, r["rank"])):
        out.setdefault(r.query_id, []).append(r.id)
    return out


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(3)
    centers = rng.normal(size=(12, 8))
    m = np.repeat(centers, 50, axis=0) + 0.4 * rng.normal(size=(600, 8))
    m[100:300] = centers[0] + 0.01 * rng.normal(size=(200, 8))  # a hot list
    m[310] = m[311] = m[312]  # copies
    m[5] = 0
    return m


def test_exact_search_equals_all_pairs(spark, vectors):
    df = frame(spark, vectors)
    index = sm.VectorIndex(df, "id", "v", n_lists=12, chunk=40)
    assert index.lists.agg({"chunks": "max"}).first()[0] > 1  # the hot list is several tasks
    asked = [0, 5, 50, 100, 150, 310, 311, 599]
    got = index.search(df.where(df.id.isin(asked)), "id", "v", k=7, probes=2, exact=True, block=3)
    assert found(got) == brute(vectors, asked, 7)


def test_probed_lists_reach_the_recall(spark, vectors):
    df = frame(spark, vectors)
    index = sm.VectorIndex(df, "id", "v", n_lists=12)
    near, truth = (index.search(df, "id", "v", k=10, probes=3, exact=e) for e in (False, True))
    share = truth.select(sm.recall(near, truth).alias("r")).first().r
    assert 0.9 <= share <= 1.0
    every = index.search(df, "id", "v", k=10, probes=12)
    assert found(every) == found(truth)


def test_recall_on_the_embeddings_table(spark):
    emb = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet")
    index = sm.VectorIndex(emb, "vec_id", "embedding")
    asked = emb.where("vec_id % 50 = 0")
    probes = index.probes_for(0.95)
    assert 1 <= probes <= index.n_lists
    near, truth = (index.search(asked, "vec_id", "embedding", probes=probes, exact=e) for e in (False, True))
    hits = {(r.query_id, r.id) for r in near.collect()} & {(r.query_id, r.id) for r in truth.collect()}
    assert len(hits) >= 0.9 * truth.count()


def test_small_samples_index_every_row(spark, vectors):
    df = frame(spark, vectors)
    index = sm.VectorIndex(df, "id", "v", n_lists=6, train_rows=100)
    assert index.rows.count() == len(vectors)
    asked = [1, 200]
    assert found(index.search(df.where(df.id.isin(asked)), "id", "v", k=5, probes=1, exact=True)) == brute(vectors, asked, 5)


def test_nulls_empty_tables_and_few_rows(spark):
    df = frame(spark, [[1, 0], None, [0, 1], [1, 1]])
    index = sm.VectorIndex(df, "id", "v")
    assert found(index.search(df, "id", "v", k=10, exact=True)) == {0: [3, 2], 2: [3, 0], 3: [0, 2]}
    empty = sm.VectorIndex(df.limit(0), "id", "v")
    assert empty.search(df, "id", "v").count() == 0 and index.search(df.limit(0), "id", "v", exact=True).count() == 0
    twice = sm.VectorIndex(frame(spark, [[1, 0], [1, 0], [0, 1]], [7, 7, 8]), "id", "v")
    assert found(twice.search(frame(spark, [[1, 0]], [8]), "id", "v", k=5, exact=True)) == {8: [7, 7]}


def test_cosine(spark):
    df = spark.createDataFrame([([3.0, 4.0], [4.0, 3.0]), ([0.0, 0.0], [1.0, 0.0]), (None, [1.0, 0.0])], "a array<double>, b array<double>")
    got = [r.c for r in df.select(sm.cosine("a", "b").alias("c")).collect()]
    assert got[0] == pytest.approx(0.96) and got[1:] == [0.0, None]
