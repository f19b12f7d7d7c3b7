import numpy as np
from pyspark.sql import functions as F

from supportlens.operators import reports, topics, vectors


def test_histogram_matches_numpy(spark):
    rng = np.random.default_rng(3)
    xs = rng.integers(0, 57, 400).tolist()
    df = spark.createDataFrame([(int(x),) for x in xs], "length int")
    got = [r["n"] for r in reports.length_histogram(df, "length", 30).orderBy("bin").collect()]
    want, _ = np.histogram(xs, bins=30)
    assert got == want.tolist()


def test_histogram_single_value(spark):
    df = spark.createDataFrame([(5,)] * 7, "length int")
    h = reports.length_histogram(df, "length", 30).orderBy("bin").collect()
    want, _ = np.histogram([5] * 7, bins=30)
    assert [r["n"] for r in h] == want.tolist()
    assert h[0]["bin_lo"] == 4.5 and h[-1]["bin_hi"] == 5.5


def test_quality_summary_empty(spark):
    empty = spark.createDataFrame([], "relevance int, helpfulness int, tone int")
    r = reports.quality_summary(empty).collect()
    assert len(r) == 1
    assert (r[0]["n"], r[0]["avg_relevance"], r[0]["dist_tone"]) == (0, 0.0, "{}")


def test_quality_absent_scores_count_as_zero(spark):
    df = spark.createDataFrame([(5, 4, None), (3, None, 2)], "relevance int, helpfulness int, tone int")
    r = reports.quality_averages(df).first()
    assert (r["avg_relevance"], r["avg_helpfulness"], r["avg_tone"]) == (4.0, 2.0, 1.0)


def test_l2_normalize_zero_vector(spark):
    df = spark.createDataFrame([([0.0, 0.0],), ([3.0, 4.0],)], "v array<double>")
    got = [r["n"] for r in df.select(vectors.l2_normalize("v").alias("n")).collect()]
    assert got == [[0.0, 0.0], [0.6, 0.8]]


def test_assign_nearest_matches_numpy(spark):
    rng = np.random.default_rng(5)
    pts = rng.normal(size=(200, 4))
    cents = rng.normal(size=(6, 4))
    df = spark.createDataFrame([(i, p.tolist()) for i, p in enumerate(pts)], "id int, v array<double>")
    cdf = spark.createDataFrame([(j, c.tolist()) for j, c in enumerate(cents)], "topic int, centroid array<double>")
    got = {r["id"]: r["topic"] for r in vectors.assign_nearest(df, "v", cdf).collect()}
    want = ((pts[:, None, :] - cents[None, :, :]) ** 2).sum(-1).argmin(1)
    assert [got[i] for i in range(200)] == want.tolist()


def test_kmeans_properties(spark):
    emb = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    _, a = vectors.kmeans_fit(emb, "embedding", k=10, seed=42)
    _, b = vectors.kmeans_fit(emb, "embedding", k=10, seed=42)
    ra = {r["vec_id"]: r["topic"] for r in a.select("vec_id", "topic").collect()}
    rb = {r["vec_id"]: r["topic"] for r in b.select("vec_id", "topic").collect()}
    assert ra == rb and len(ra) == emb.count()
    assert set(ra.values()) <= set(range(10))
    # cost no worse than assigning by the given labels' centroids
    def cost(df, col):
        cents = vectors.centroid_means(df, "embedding", col)
        j = df.join(cents.withColumnRenamed("topic", col), col)
        return j.select(F.sum(vectors.squared_distance(vectors.as_double_array("embedding"),
                                                       "centroid")).alias("c")).first()["c"]
    assert cost(a, "topic") <= cost(emb.withColumnRenamed("label", "lab"), "lab") + 1e-9


def test_topic_samples_order_and_limit(spark):
    df = spark.createDataFrame([(t, i, f"x{i}") for i in range(30) for t in [i % 3]],
                               "topic int, k int, text string")
    got = {r["topic"]: r["samples"] for r in topics.topic_samples(df, "text", "topic", "k", 4).collect()}
    assert got == {0: ["x0", "x3", "x6", "x9"], 1: ["x1", "x4", "x7", "x10"], 2: ["x2", "x5", "x8", "x11"]}


def test_overall_report_parts(spark):
    from supportlens.plans import flows

    scores = spark.createDataFrame([(i, 1 + i % 5, 1 + i % 3, 2 + i % 4) for i in range(23)],
                                   "row_id long, relevance int, helpfulness int, tone int")
    topics_df = spark.createDataFrame([(i, i % 4) for i in range(23)], "row_id long, topic int")
    sents = spark.createDataFrame([(i, "POSITIVE" if i % 2 else "NEGATIVE") for i in range(23)],
                                  "row_id long, sentiment string")
    triples = scores.withColumn("query", F.concat(F.lit("q"), F.col("row_id").cast("string")))
    rep = flows.overall_report(scores, topics_df, sents, triples)
    assert set(rep) == {"quality", "unique_clusters", "sentiment_sample", "example_pairs"}
    assert rep["quality"].first()["n"] == 23
    assert rep["unique_clusters"].first()["unique_clusters"] == 4
    assert [r["row_id"] for r in rep["sentiment_sample"].collect()] == [0, 1, 2, 3, 4]
    assert [r["row_id"] for r in rep["example_pairs"].collect()] == [0, 1, 2]
