import random
import re
from itertools import permutations

import numpy as np

from supportlens.llm import filter_audit as fa

from . import cases

COLUMNS = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost",
           "shapley"]


def brute(rows, marks):
    """(id, text, part) rows and {id: (good, toxic)}, filter after filter over the documents."""
    docs, rank = [], lambda i: (i is None, i or 0)
    for i, text, part in rows:
        t = text or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        earlier = any((o or "") == t and rank(k) < rank(i) for k, o, _ in rows)
        fails = {"A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w),
                 "C": 100 * len(re.findall("[A-Z]", t)) > 3 * len(t), "D": bool(re.search(r"[#$%&*|]", t)), "E": earlier}
        docs.append((part or "", {k for k, v in fails.items() if v}, *marks.get(i, (0, 0))))
    out = []
    for part in {d[0] for d in docs}:
        mine = [d for d in docs if d[0] == part]
        steps, total = [], dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            left = mine
            for step, f in enumerate(order, 1):
                gone = [d for d in left if f in d[1]]
                left = [d for d in left if f not in d[1]]
                total[f] += len(gone)
                steps.append((part, "".join(order), step, len(left), len(gone), sum(f in d[1] for d in mine) - len(gone),
                              sum(d[1] == {f} for d in mine), sum(d[2] for d in gone), sum(d[3] for d in gone)))
        out += [(*s, total[s[1][s[2] - 1]]) for s in steps]
    return sorted(out)


def got(frame):
    assert frame.columns == COLUMNS
    return sorted(tuple(r) for r in frame.collect())


def data(seed=1):
    rnd = random.Random(seed)
    rows, texts = [], []
    for i in range(150):
        n = rnd.choice([3, 150, 199, 200, 260])
        vocab = rnd.choice([40, 99, 100, 400])
        word = rnd.choice(["w{}", "W{}", "é{}", "Word{}"])
        text = " ".join(word.format(rnd.randrange(vocab)) for _ in range(n)) + rnd.choice(["", "", " #", "|", "\v"])
        if texts and rnd.random() < 0.4:
            text = rnd.choice(texts)
        texts.append(text)
        rows.append((rnd.randrange(10 ** 6), text, rnd.choice(["en", "de", None])))
    marks = {i: (rnd.randint(0, 1), rnd.randint(0, 1)) for i, _, _ in rnd.sample(rows, 80)}
    return rows, marks


def tables(spark, rows, marks):
    labels = spark.createDataFrame([(i, *m) for i, m in marks.items()] or [(None, None, None)],
                                   "doc_id bigint, quality int, toxic int")
    return cases.plain(spark, [(i, t, p, "", 0) for i, t, p in rows]), labels


def test_steps_equal_filtering_the_documents(spark):
    rows, marks = data()
    out = got(fa.audit(*tables(spark, rows, marks)))
    assert out == brute(rows, marks) and len(out) == 3 * 600


def test_gray_walk_equals_each_subset_alone():
    cells = np.random.default_rng(5).integers(0, 50, (32, 3))
    states = fa.walk(cells)
    for active in range(32):
        assert (states[active] == cells[[m for m in range(32) if not m & active]].sum(axis=0)).all()


def test_cases_with_repeated_and_null_ids(spark):
    rows = [(r[0], r[1], r[2]) for r in cases.rows()]
    docs = cases.documents(spark)
    labels = spark.createDataFrame([(1, 1, 0, "x"), (1, 0, 1, "x"), (6, 1, None, "y"), (99, 1, 1, "z"), (None, 1, 1, "z")],
                                   "doc_id bigint, quality int, toxic int, mask string")
    assert got(fa.audit(docs, labels)) == brute(rows, {1: (1, 1), 6: (1, 0)})
    assert got(fa.audit(docs.limit(0), labels)) == []
    assert got(fa.audit(docs, labels.limit(0))) == brute(rows, {})


def test_hot_text_in_many_parts(spark):
    rows = [(i, "the same text", f"l{i % 40}") for i in range(2000)] + [(-1, "the same text", "l3")]
    assert got(fa.audit(*tables(spark, rows, {5: (1, 1)}))) == brute(rows[-1:] + rows[:2000], {5: (1, 1)})
