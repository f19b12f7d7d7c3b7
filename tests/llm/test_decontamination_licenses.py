import random
import re

from pyspark.sql import functions as F

from supportlens.llm import decontamination as dc
from supportlens.llm import licenses as lic
from supportlens.llm.common import read

from . import cases


def words(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute(text, items, width):
    w, hit, found = words(text), set(), set()
    for item_id, item in items:
        v = words(item)
        k = min(width, len(v))
        for i in range(len(v) - k + 1 if v else 0):
            for at in range(len(w) - k + 1):
                if w[at:at + k] == v[i:i + k]:
                    hit.update(range(at, at + k))
                    found.add(str(item_id))
    return len(w), len(hit), sorted(found)


def data(seed=3):
    rnd = random.Random(seed)
    vocab = ["the", "of", "and", "a", *(f"w{i}" for i in range(12)), "été", "日本"]
    item = lambda n: " ".join(rnd.choice(vocab) for _ in range(n))
    items = [(i, item(rnd.choice([1, 3, 5, 8, 20]))) for i in range(12)]
    items += [(20, items[3][1].upper()), (21, None), (22, "..."), (23, items[3][1]), (None, "the of and a w1")]
    docs = []
    for i in range(60):
        parts = [item(rnd.randint(0, 30))]
        for _ in range(rnd.randint(0, 2)):
            parts += [rnd.choice(items)[1] or "", item(rnd.randint(0, 10))]
        docs.append((i, rnd.choice([" ", ", "]).join(parts), "", "", 0))
    return docs, items


def test_hits_equal_brute_force(spark):
    docs, items = data()
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    named = [(i, t) for i, t in items if i is not None]
    for width in (5, 10):
        got = cases.by_id(dc.contaminated_words(cases.plain(spark, docs), bench.where("item_id is not null"), width))
        for i, t, *_ in docs:
            r = got[i]
            assert (r.n_words, r.n_hit, r["items"]) == brute(t, named, width)
            assert sum(s.end - s.start for s in r.spans) == r.n_hit


def test_items_without_an_id_hit_and_are_not_listed(spark):
    words = [f"w{i}" for i in range(30)]
    docs = cases.plain(spark, [(1, " ".join(words[:12]), "", "", 0), (2, " ".join(words[12:]), "", "", 0),
                               (3, "clean " * 12, "", "", 0)])
    bench = spark.createDataFrame([(None, " ".join(words[:10])), (None, " ".join(words[12:23])), (7, " ".join(words[13:23]))],
                                  "item_id bigint, text string")
    got = {i: (r.n_hit, r["items"]) for i, r in cases.by_id(dc.contaminated_words(docs, bench)).items()}
    assert got == {1: (10, []), 2: (11, ["7"]), 3: (0, [])}
    assert [r.doc_id for r in dc.drop_contaminated(docs, bench).collect()] == [3]


def test_blocks_of_windows_give_the_same(spark, monkeypatch):
    docs, items = data(4)
    bench = spark.createDataFrame(items[:-1], "item_id bigint, text string")
    frame = cases.plain(spark, docs)
    want = sorted(map(str, dc.contaminated_words(frame, bench, 5).collect()))
    monkeypatch.setattr(dc, "BLOCK", 7)
    assert sorted(map(str, dc.contaminated_words(frame, bench, 5).collect())) == want


def test_cases_and_dropping(spark):
    docs = cases.documents(spark)
    bench = spark.createDataFrame([(1, cases.PROSE, "x"), (2, None, "y"), (3, "", "z")],
                                  "item_id bigint, text string, word string")
    got = dc.contaminated_words(docs, bench).collect()
    assert len(got) == len(cases.rows())
    for r, in_it in ((r, r.doc_id in (1, 6, 7)) for r in got if r.doc_id is not None):
        assert (r.n_hit > 0) == in_it
    kept = dc.drop_contaminated(docs, bench)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id or 0) for r in kept.collect()) == [0, 2, 3, 4, 5, 8, 9, 10, 11, 12]
    assert dc.contaminated_words(docs.limit(0), bench).count() == 0
    assert dc.drop_contaminated(docs, bench.limit(0)).count() == docs.count()


def test_license_labels(spark):
    grant = lic.TEMPLATES["mit"]
    broken = grant.replace("free of charge", "at no cost").replace("sublicense", "lend")
    data = [(1, "x " * 100 + grant + " y" * 50, "", "", 0), (2, broken, "", "", 0),
            (3, "under the MIT license, (Under The Mit License) cc-by nc CC-BY-NC", "", "", 0),
            (4, "the software and the person", "", "", 0), (5, None, "", "", 0), (6, "", "", "", 0)]
    got = cases.by_id(lic.licenses(cases.plain(spark, data)))
    assert got[1].labels == ["mit"] and got[1].score == 1.0 and got[1].n_base == 0 and got[1].first_word is None
    assert got[2].labels == ["mit"] and 0.8 <= got[2].score < 1
    assert (got[3].n_base, got[3].first_word, got[3].last_word) == (4, 0, 11)
    assert got[3].base_labels == ["cc-by-nc", "mit"]
    assert got[4].labels == [] and got[4].score == 0.0
    assert got[5].n_words == got[6].n_words == 0


def test_long_and_spread_notices(spark):
    full = lic.FULL_TEXTS["mit"]
    long = " ".join(f"w{i}" for i in range(200))
    bsd = lic.pattern_words(lic.TEMPLATES["bsd"])
    spread = " ".join(f"{w} {'x y z z z'[:2 * (4 + (i % 2)) - 1]}" for i, w in enumerate(bsd))
    assert 100 < len(spread.split()) <= 128
    # the grant is changed, the rest of the licence is not
    grant, rest = full[:len(lic.TEMPLATES["mit"])], full[len(lic.TEMPLATES["mit"]):]
    data = [(i, "q " * i + spread, "", "", 0) for i in range(0, 64, 9)]
    data += [(100, "q " * 70 + "rights to the software without restriction, granted free of charge " + rest, "", "", 0),
             (101, "v " * 33 + full, "", "", 0), (102, grant.replace("software", "work"), "", "", 0)]
    got = cases.by_id(lic.licenses(cases.plain(spark, data)))
    assert all(got[i].labels == ["bsd"] and got[i].score == 1.0 for i in range(0, 64, 9))
    assert got[100].labels == got[101].labels == ["mit"] and got[101].score == 1.0
    own = lic.licenses(cases.plain(spark, [(1, "a b " + long + " c", "", "", 0), (2, long[:300], "", "", 0)]),
                       templates={"long": long})
    own = cases.by_id(own)
    assert own[1].labels == ["long"] and own[1].score == 1.0 and own[2].labels == []


def test_short_notices_stand_together(spark):
    data = [(1, "x " * 70 + "(c) 2020 Someone. ALL RIGHTS RESERVED." + " y" * 70, "", "", 0), (2, "All rights reserved", "", "", 0),
            (3, "all of the rights were reserved", "", "", 0), (4, "all rights", "", "", 0),
            (5, "under the MIT license, all rights reserved", "", "", 0)]
    got = cases.by_id(lic.licenses(cases.plain(spark, data)))
    assert {i: r.labels for i, r in got.items()} == {
        1: ["all-rights-reserved"], 2: ["all-rights-reserved"], 3: [], 4: [], 5: ["all-rights-reserved", "mit"]}
    assert got[1].n_base == 0 and got[1].score == 1.0 and got[5].base_labels == ["mit"]


def brute_blocks(text, templates):
    """Labels and best share, from every block of every template."""
    w, labels, best = words(text), set(), 0.0
    for label, template in templates:
        every = words(template)
        own = set(every)
        short = len(every) < lic.SHORT
        need = len(own) if short else -(-len(own) * lic.PERCENT // 100)
        span = len(every) if short else 2 * max(lic.STRIDE, len(every))
        most = max((len(own & set(w[s:s + span])) for s in range(len(w))), default=0)
        if most >= need:
            labels.add(label)
            best = max(best, most / len(own))
    return sorted(labels), best


def shuffled_notices(seed):
    """Texts of template words in any order, density and repetition."""
    rnd = random.Random(seed)
    templates = {"one": " ".join(f"a{i}" for i in range(12)) + " the of a0",
                 "two": " ".join(f"b{i}" for i in range(9)) + " the of and a3 a4", "short": "all b1 a1"}
    docs = []
    for i in range(120):
        pool = rnd.choice(list(templates.values())).split()
        dense = rnd.choice([0.04, 0.08, 0.12, 0.3])
        text = [rnd.choice(pool) if rnd.random() < dense else f"x{rnd.randint(0, 9)}" for _ in range(rnd.randint(0, 500))]
        if i % 3 == 0:
            at = rnd.randint(0, len(text))
            some = [x for x in pool if rnd.random() < 0.9]
            rnd.shuffle(some)
            text[at:at] = [y for x in some for y in [x, *["x"] * rnd.randint(0, 14)]]
        docs.append((i, " ".join(text), "", "", 0))
    return docs, templates


def test_blocks_equal_brute_force(spark):
    for seed in (1, 2):
        docs, templates = shuffled_notices(seed)
        got = cases.by_id(lic.licenses(cases.plain(spark, docs), phrases={}, templates=templates))
        want = {i: brute_blocks(t, templates.items()) for i, t, *_ in docs}
        assert {i: (r.labels, r.score) for i, r in got.items()} == want
        assert 20 < sum(bool(labels) for labels, _ in want.values()) < 110


def test_documents_equal_brute_force(spark):
    every = [*lic.TEMPLATES.items(), *lic.NOTICES.items(), *lic.FULL_TEXTS.items()]
    docs = read(spark, "/root/testdata/sf0.001", "documents")
    got = cases.by_id(lic.licenses(docs, phrases={}))
    assert {i: (r.labels, r.score) for i, r in got.items()} == {
        r.doc_id: brute_blocks(r.text, every) for r in docs.collect()}


def test_positional_filter_removes_joined_words(spark):
    docs, templates = shuffled_notices(3)
    docs = cases.plain(spark, docs).selectExpr("doc_id id", "text")
    split = lic.alnum_words(F.col("text"))
    patterns = lic._pattern_table(spark, {}, list(templates.items()), lic.PERCENT)
    counts = lic.word_counts(docs, patterns.selectExpr("explode(words) word").distinct(), split)
    joined = lic._joined(docs, split, lic._prefixes(patterns, counts))
    near = joined.where(F.size(F.array_intersect("words", "near")) >= F.col("need"))
    assert lic._left_open(joined).count() < 0.7 * near.count()


def test_license_cases(spark):
    docs = cases.documents(spark)
    got = lic.licenses(docs).collect()
    assert len(got) == len(cases.rows())
    assert {r.doc_id: r.base_labels for r in got}[12] == ["apache-2", "mit"]
    assert lic.licenses(docs.limit(0)).count() == 0
