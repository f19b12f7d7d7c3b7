import math
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from supportlens.functions import text as tx
from supportlens.operators import tfidf as ti


def _brute(rows, n=None):
    tf = Counter((k, t) for k, t in rows)
    n = len({k for k, _ in rows if k is not None}) if n is None else n
    tf = {x: c for x, c in tf.items() if x[1] is not None}
    df = Counter(t for _, t in tf)
    w = {(k, t): c * math.log((n + 1) / (df[t] + 1)) for (k, t), c in tf.items()}
    norm = defaultdict(float)
    for (k, _), x in w.items():
        norm[k] += x * x
    return {(k, t): x / math.sqrt(norm[k]) if norm[k] > 0 else 0.0 for (k, t), x in w.items()}


@pytest.mark.parametrize("common", [1, 40, 200_000])
def test_weights_whichever_terms_are_broadcast(spark, monkeypatch, common):
    monkeypatch.setattr(ti, "COMMON", common)
    rnd = random.Random(2)
    rows = [(rnd.randrange(60), f"w{min(rnd.randrange(200), rnd.randrange(200))}") for _ in range(3000)]
    rows += [(k, "all") for k in range(60)] + [(None, "w1"), (None, "none"), (3, None), (70, "all")]
    got = ti.tfidf(spark.createDataFrame(rows, "k long, token string"), "k").collect()
    want = _brute(rows)
    assert len(got) == len(want)
    assert {(r.k, r.term): r.weight for r in got} == pytest.approx(want)


def test_texts_are_taken_apart_once(spark):
    docs = spark.createDataFrame([(1, "a b b"), (1, "b c"), (2, "c"), (None, "c d"), (None, ""), (4, None)], "k long, text string")
    out = ti.tfidf_from_texts(docs, "k", tx.basic_tokens("text"))
    assert "regexp" not in out._jdf.queryExecution().optimizedPlan().toString()
    want = _brute([(1, "a"), *[(1, "b")] * 3, (1, "c"), (2, "c"), (None, "c"), (None, "d")], n=6)
    assert {(r.k, r.term): r.weight for r in out.collect()} == pytest.approx(want)
    assert ti.tfidf_from_texts(docs.limit(0), "k", tx.basic_tokens("text")).count() == 0


def test_tokens_in_one_pass_are_those_of_the_steps(spark):
    texts = ["I'm  dont_know 12a3b ⅷ ½x² ٣٤ ärger ΑΣ", "thx\x1cu\x85 ur plz éte", "你好，世界 😀wanna", "", None, "__ 1 _1_"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    steps = tx.expand_shorthand(tx.tokenize(tx.clean_basic("t")))
    for r in df.select(tx.basic_tokens("t").alias("got"), steps.alias("want")).collect():
        assert r.got == r.want
    one = df.select(F.array(F.lit("im"), F.lit("x")).alias("t")).limit(1)
    assert one.select(tx.expand_shorthand("t", split_expansions=False).alias("o")).first().o == ["i am", "x"]
