import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from supportlens.llm import lexical_search as ls

from . import cases


def terms(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", low)


def brute(docs, items, k=10):
    """(id, text) of both -> sorted (item, rank, doc, score)."""
    bags = [(i, Counter(terms(t))) for i, t in docs]
    bags = [(i, c, sum(c.values())) for i, c in bags if c]
    n_docs, n_terms = len(bags), sum(n for _, _, n in bags)
    df = Counter(t for _, c, _ in bags for t in c)
    out = []
    for item, text in items:
        scored = []
        for i, c, n in bags:
            m = 100 - 90 + (90 * n * n_docs) // n_terms
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    * ((10 ** 9 * c[t]) // (1000 * c[t] + 8 * m)) for t in set(terms(text)) if c[t])
            if s > 0:
                scored.append((-s, i is None, i, s))
        out += [(item, r, i, s) for r, (_, _, i, s) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=str)


def got(frame):
    assert frame.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted(map(tuple, frame.collect()), key=str)


def bench(spark, items):
    return spark.createDataFrame(items, "item_id bigint, text string")


def data(seed, n=400, vocab=300):
    rnd = random.Random(seed)
    words = [f"w{int(rnd.paretovariate(0.6)) % vocab}" for _ in range(4000)]
    text = lambda k: rnd.choice([" ", ", ", "-"]).join(rnd.choice(words) for _ in range(k))
    docs = [(i, text(rnd.choice([0, 1, 5, 40, 300]))) for i in rnd.sample(range(10 ** 6), n)]
    docs += [(10 ** 6 + i, t) for i, (_, t) in enumerate(docs[:40])]  # copies: equal scores
    items = [(i, text(rnd.choice([1, 3, 30])).upper()) for i in range(25)]
    return docs, items


@pytest.mark.parametrize("window,shard", [(512, 8192), (16, 70), (4, 9)])
def test_ranks_equal_scoring_everything(spark, window, shard):
    docs, items = data(window)
    index = index_of(spark, docs, window, shard)
    assert got(ls.search(index, bench(spark, items), window=window)) == brute(docs, items)


def index_of(spark, docs, window, shard):
    frame = cases.plain(spark, [(i, t, "", "", 0) for i, t in docs]).repartition(3)
    return ls.Scratch(spark, "t").write(ls.build_index(frame, window=window, shard_docs=shard), "index")


def test_items_in_several_blocks_give_the_same(spark):
    docs, items = data(9)
    index = index_of(spark, docs, 64, 100)
    assert got(ls.search(index, bench(spark, items), window=64, per_block=4)) == brute(docs, items)


def test_blocks_are_skipped(spark):
    """Most blocks of common terms are never decompressed, results are the same."""
    rnd = random.Random(2)
    docs = [(i, " ".join(["the", *(f"c{rnd.randrange(20)}" for _ in range(30))]) + (" rare gem" if i % 200 == 7 else ""))
            for i in range(4000)]
    rows = ls.build_index(cases.plain(spark, [(i, t, "", "", 0) for i, t in docs]).coalesce(1), window=16).toArrow()
    head = rows.filter(ls.pc.is_null(rows["term"]))
    lists = rows.filter(ls.pc.is_valid(rows["term"]))
    df = lists["df"].to_pylist()
    n = len(docs)
    lists = lists.append_column("w", ls.pa.array([math.floor(1000 * math.log((2 * n + 2) / (2 * x + 1))) for x in df]))
    lens = np.asarray(head["lens"].combine_chunks().flatten())
    shard = ls.ShardSearch(lists, lens, np.arange(n), n, int(lens.sum()), window=16)
    at = {t: i for i, t in enumerate(lists["term"].to_pylist())}
    rows_ = np.array([at[t] for t in ("rare", "gem", "the", "c1", "c2", "c3")])
    places, scores = shard.best(rows_, 10)
    want = brute(docs, [(0, "rare gem the c1 c2 c3")])
    ids = np.asarray(head["ids"].combine_chunks().flatten())
    assert [(int(ids[p]), int(s)) for p, s in zip(places, scores)] == [(w[2], w[3]) for w in sorted(want, key=lambda w: w[1])]
    assert shard.looked_up < 0.3 * (shard.block[rows_] >= 0).sum()


def test_block_maxima_are_the_largest_entries():
    rnd = np.random.default_rng(4)
    block = np.sort(rnd.integers(0, 30, 500))
    block = np.unique(block, return_inverse=True)[1]
    n, tf = rnd.integers(1, 50, 500), rnd.integers(1, 9, 500)
    ends, top_tf, top_n = ls._fronts(block, n, tf)
    for docs, terms_ in ((10, 10), (10, 4000), (1000, 10)):
        entry = ls._entries(tf, ls._lengths(n, docs, terms_))
        tops = ls._entries(top_tf, ls._lengths(top_n, docs, terms_))
        for b, (lo, hi) in enumerate(zip([0, *ends], ends)):
            assert tops[lo:hi].max() == entry[block == b].max()


def test_varints():
    values = np.array([0, 1, 127, 128, 300, 16383, 16384, 2 ** 40, 5])
    data_, ends = ls.varints(values)
    assert (ls.read_varints(data_) == values).all() and ends[-1] == len(data_)
    assert len(ls.varints(np.empty(0, dtype=np.int64))[0]) == 0


def test_long_texts_in_pieces(monkeypatch):
    text = ("Über " + "x" * 50 + " a-b " * 40).encode()
    monkeypatch.setattr(ls, "PIECE", 16)
    assert [w.decode() for p in ls._pieces(text) for w in p] == terms(text.decode())
    shard = ls._Shard()
    shard.add(ls.pa.array([1]), text)
    assert shard.lens == [82] and sorted(np.concatenate(shard.tf)) == [1, 1, 40, 40]


def test_cases(spark):
    docs = cases.documents(spark)
    items = [(1, cases.PROSE), (1, cases.PROSE), (1, "mail"), (2, None), (3, ""), (None, "river mill"), (4, "word5 TALE é")]
    extra = bench(spark, items).selectExpr("*", "1 AS q", "2 AS term", "3 AS block")
    out = got(ls.rank_documents(docs, extra))
    want = brute([(r[0], r[1]) for r in cases.rows()], list(dict.fromkeys(items)))
    assert out == want
    assert ls.rank_documents(docs.limit(0), extra).count() == 0
    assert ls.rank_documents(docs, extra.limit(0)).count() == 0


def test_text_ids(spark):
    df = spark.createDataFrame([("b", "red fish"), ("a", "red fish"), ("é", "blue fish")], "k string, body string")
    items = spark.createDataFrame([("x", "red blue")], "q string, t string")
    out = ls.rank_documents(df, items, 2, "k", "body", "q", "t").collect()
    assert [(r.q, r["rank"], r.k) for r in sorted(out, key=lambda r: r["rank"])] == [("x", 1, "é"), ("x", 2, "a")]
