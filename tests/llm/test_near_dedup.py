import random

from supportlens.llm import near_dedup

from . import cases


def shingles(text, width):
    w = (text or "").encode().lower().split()
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + width]) for i in range(max(1, len(w) - width + 1)))


def brute(docs, width, percent=80):
    sets = {i: shingles(t, width) for i, t in docs}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b]:
                k = len(sets[a] & sets[b])
                if 100 * k >= percent * (len(sets[a]) + len(sets[b]) - k):
                    x, y = find(a), find(b)
                    root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i), find(i) == i) for i in ids}


def corpus(seed):
    """Exact copies, near copies with all shares of edits, chains, shared
    passages, short and empty texts."""
    rnd = random.Random(seed)
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(5))
    passage = [word() for _ in range(60)]
    out = []
    for _ in range(12):
        base = [word() for _ in range(rnd.choice([6, 20, 60, 70, 90, 300]))]
        current = list(base)
        for _ in range(rnd.randint(1, 14)):
            current = list(rnd.choice([base, current]))
            for _ in range(int(len(current) * rnd.choice([0, 0.02, 0.03, 0.05, 0.1]))):
                current[rnd.randrange(len(current))] = word()
            out.append(" ".join(current))
    out += [" ".join(passage + [word() for _ in range(rnd.randint(5, 60))]) for _ in range(60)]
    out += ["", " ", "one", "ONE", "one two", "one  two\n", None, None]
    rnd.shuffle(out)
    return list(enumerate(out))


def test_components_equal_all_pairs(spark):
    data = corpus(1)
    docs = cases.plain(spark, [(i, t, "", "", 0) for i, t in data])
    got = cases.by_id(near_dedup.near_duplicates(docs, width=4))
    assert {i: (r.n_shingles, r.component_id, r.kept) for i, r in got.items()} == brute(data, 4)


def test_cases(spark):
    docs = cases.documents(spark)
    got = near_dedup.near_duplicates(docs, width=5).collect()
    assert len(got) == len(cases.rows())
    comp = {r.doc_id: r.component_id for r in got if r.doc_id is not None}
    assert comp[6] == comp[7] == 1 and comp[2] == 2 and comp[3] == 3 and comp[8] == 8
    assert all(r.component_id is None and r.kept for r in got if r.doc_id is None)
    assert near_dedup.near_duplicates(docs.limit(0)).count() == 0


def test_one_row_of_each_group_stays(spark):
    data = [*cases.rows(), (1, cases.PROSE, "en", "a", 1), (20, "a row of its own text twice over", "", "", 0),
            (20, "a row of its own text twice over", "", "", 0)]
    out = near_dedup.one_per_group(cases.documents(spark, data))
    ids = sorted(r.doc_id for r in out.collect() if r.doc_id is not None)
    assert ids == [1, 2, 3, 4, 5, 8, 9, 10, 11, 12, 20]
    assert out.columns == cases.documents(spark).columns


def test_texts_of_one_id_are_one_node(spark):
    data = [(1, "alpha beta gamma delta epsilon zeta", "", "", 0), (5, "alpha beta gamma delta epsilon zeta", "", "", 0),
            (5, "one two three four five six seven", "", "", 0), (9, "one two three four five six seven", "", "", 0)]
    got = near_dedup.near_duplicates(cases.plain(spark, data), width=4)
    assert {r.component_id for r in got.collect()} == {1}


def test_different_texts_of_one_id_stay(spark):
    a, b = cases.PROSE, " ".join(reversed(cases.PROSE.split()))
    data = [(1, a, "", "", 0), (5, a, "", "", 0), (5, b, "", "", 0), (9, b, "", "", 0), (9, b, "", "", 0),
            (None, a, "", "", 0), (7, "short", "", "", 0), (7, None, "", "", 0)]
    docs = cases.plain(spark, data)
    got = near_dedup.one_per_group(docs)
    assert got.columns == docs.columns
    rows = sorted((r.doc_id or 0, r.text or "") for r in got.collect())
    assert rows == sorted([(0, a), (1, a), (5, b), (7, "short"), (7, "")])


def test_texts_that_share_a_passage_below_the_threshold_are_not_paired(spark, monkeypatch):
    """Texts of 100 shingles, 85 of them in all: similarity 85 / 115. None are
    linked, and the exact step does not join their rows."""
    rng = random.Random(4)
    passage = " ".join(f"p{i}" for i in range(89))  # 85 shingles of 5 words
    own = lambda: " ".join(f"o{rng.randrange(10 ** 9)}" for _ in range(15))
    texts = [f"{passage} {own()}" for _ in range(400)]
    pair = f"{passage} {own()}"
    texts += [pair, pair[:pair.rindex(" ")] + " changed"]
    joined, write = [], near_dedup.Scratch.write

    def counted(self, df, name):
        out = write(self, df, name)
        if name == "open-places":
            rare = self.spark.read.parquet(self.path("rare")).groupBy("v", "n", "pos").count()
            a = out.join(rare, ["v", "n", "pos"]).withColumnRenamed("count", "c")
            b = a.join(rare.toDF("v", "n2", "pos2", "c2"), ["v", "n2", "pos2"])
            joined.append((b.selectExpr("sum(c * c2)").first()[0] or 0, rare.agg({"count": "max"}).first()[0]))
        return out

    monkeypatch.setattr(near_dedup.Scratch, "write", counted)
    docs = cases.plain(spark, [(i, t, "", "", 0) for i, t in enumerate(texts)])
    got = cases.by_id(near_dedup.near_duplicates(docs, 5, 80))
    assert all(got[i].component_id == i for i in range(401)) and got[401].component_id == 400
    (rows, largest), = joined
    assert largest > 300 and rows < 2000  # one place of a shingle that all share has 400 texts
