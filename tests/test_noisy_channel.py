import itertools
import random

from pyspark.sql import functions as F

from supportlens.operators import noisy_channel as nc

from .conftest import SF_SMALL


def _texts(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "row_id bigint, t string")


def _corpus(spark, seed=3):
    """Sentences over few words with fixed followers, each word often seen."""
    rnd = random.Random(seed)
    openings = ["please send the invoice for my order", "where is the parcel that i ordered",
                "the parcel was damaged on delivery", "i want my money back for the order",
                "the form was sent from the office", "a letter came from the office today"]
    return spark.createDataFrame([(" ".join(rnd.choice(openings) for _ in range(20)),) for _ in range(400)], "text string")


def test_best_path_equals_trying_every_sentence():
    rnd = random.Random(1)
    for _ in range(300):
        words = [f"t{rnd.randrange(4)}" for _ in range(rnd.randint(0, 6))]
        options = {t: sorted([(t, 0), *((f"{t}{c}", rnd.randrange(3)) for c in "abc"[:rnd.randint(1, 3)])])
                   for t in set(words) if rnd.random() < 0.6}
        cost = {}
        for a, b in sorted(nc.lattice_edges(words, options)):
            cost[a, b] = rnd.randrange(6)

        def price(path):
            total, before, was = 0, "", False
            for t, w in zip(words, path):
                now = t in options
                total += (cost[before, w] if now or was else 0) + (dict(options[t])[w] if now else 0)
                before, was = w, now
            return total

        every = [p for p in itertools.product(*[[w for w, _ in options.get(t, [(t, 0)])] for t in words])]
        got = nc.best_path(words, options, cost)
        assert price(got) == min(map(price, every)) and tuple(got) in every


def test_planted_typos_are_mended_and_words_are_left(spark):
    channel = nc.Channel(_corpus(spark))
    cases = {"please send the invioce": "please send the invoice", "where is teh parcel": "where is the parcel",
             "the delivry was late": "the delivery was late", "damagd on arrival": "damaged on arrival",
             "monye back": "money back", "unrelated sentences stay": "unrelated sentences stay",
             "form the office": "form the office", "": "", "x y z": "x y z"}
    out = nc.correct_texts(_texts(spark, list(cases)), "row_id", "t", channel).collect()
    assert {" ".join(r.tokens): " ".join(r.corrected) for r in out} == cases


def test_context_decides_between_equally_close_words(spark):
    """'coat' and 'boat' are as frequent and as close to 'xoat'."""
    corpus = spark.createDataFrame([("the red coat hung there and a fast boat sailed by",)] * 500, "text string")
    out = nc.correct_texts(_texts(spark, ["a fast xoat", "the red xoat", "xoat"]), "row_id", "t", nc.Channel(corpus))
    got = {r.row_id: r.corrected[-1] for r in out.collect()}
    assert got == {0: "boat", 1: "coat", 2: "boat"}


def test_what_is_open_does_not_depend_on_corpus_size(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("text")
    ten = docs.withColumn("i", F.explode(F.sequence(F.lit(1), F.lit(10)))).select("text")
    vocab = nc.word_counts(docs).where("freq > 2").select(F.col("word").alias("token"))
    few, many = ({r.token for r in nc.candidates(vocab, nc.Channel(d)).collect()} for d in (docs, ten))
    assert few <= many and len(many) <= len(few) + 0.01 * vocab.count()


def test_share_of_rewritten_occurrences_is_small(spark):
    """A corpus corrected by its own counts: under 2 % of the occurrences change
    (the dictionary of 50 per million rewrites about a third)."""
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    out = nc.correct_texts(docs, "doc_id", "text", nc.Channel(docs))
    r = nc.rewrite_share(out).first()
    assert r.tokens > 50_000 and r.share < 0.02


def test_only_bigrams_that_are_asked_for_are_counted(spark, monkeypatch):
    corpus = spark.createDataFrame([("The cat, the dog; the cat",), ("cat the",), ("the",), (None,), ("",)] * 3, "text string")
    channel = nc.Channel(corpus)
    asked = spark.createDataFrame([("the", "cat"), ("cat", "the"), ("dog", "cat"), ("", "the")], "a string, b string")
    few = {(r.a, r.b): r.n for r in channel.bigrams(asked).collect()}
    assert few == {("the", "cat"): 6, ("cat", "the"): 6}
    assert channel.bigrams(asked.limit(0)).count() == 0
    texts = _texts(spark, ["a fast xoat", "the red xoat", "teh red cota"])
    told = spark.createDataFrame([("the red coat hung there and a fast boat sailed by",)] * 500, "text string")
    got = [sorted((r.row_id, r.corrected) for r in nc.correct_texts(texts, "row_id", "t", nc.Channel(told)).collect())]
    monkeypatch.setattr(nc, "ASKED", 0)  # more are asked for than are broadcast
    every = {(r.a, r.b): r.n for r in channel.bigrams(asked).collect()}
    assert every == few | {("the", "dog"): 3, ("dog", "the"): 3}
    got.append(sorted((r.row_id, r.corrected) for r in nc.correct_texts(texts, "row_id", "t", nc.Channel(told)).collect()))
    assert got[0] == got[1] == [(0, ["a", "fast", "boat"]), (1, ["the", "red", "coat"]), (2, ["the", "red", "coat"])]


def test_rows_without_key_empty_texts_and_empty_tables(spark):
    channel = nc.Channel(_corpus(spark))
    df = spark.createDataFrame([(1, "teh order"), (1, "my ordre"), (None, "teh order"), (None, None), (2, "")], "k long, t string")
    got = sorted((r.k or 0, " ".join(r.corrected)) for r in nc.correct_texts(df, "k", "t", channel).collect())
    assert got == [(0, ""), (0, "the order"), (1, "my order"), (1, "the order"), (2, "")]
    assert nc.correct_texts(df.limit(0), "k", "t", channel).count() == 0
    nothing = nc.Channel(spark.createDataFrame([], "text string"))
    assert [r.corrected for r in nc.correct_texts(df.where("k = 2 OR t = 'my ordre'"), "k", "t", nothing)
            .orderBy("k").collect()] == [["my", "ordre"], []]
    assert tuple(nc.rewrite_share(nc.correct_texts(df.limit(0), "k", "t", channel)).first()) == (0, 0, 0.0)
