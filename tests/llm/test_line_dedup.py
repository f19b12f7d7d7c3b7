import hashlib
import random
import re

import pytest

from supportlens.llm import line_dedup as ld

from . import cases

WHITE = " \t\n\x0b\x0c\r"


def brute(rows, min_chars=10):
    """(id, text) -> kept text, by the definition; ids of None stand last."""
    rank = lambda i: (i is None, i or 0)
    key = lambda line: re.sub("[A-Z]", lambda m: m[0].lower(), line.strip(WHITE))
    holder = {}
    for i, text in rows:
        for line in (text or "").split("\n"):
            k = key(line)
            if len(k) >= min_chars and (k not in holder or rank(i) < rank(holder[k])):
                holder[k] = i
    return [(i, [x for x in (t or "").split("\n") if len(key(x)) < min_chars or holder[key(x)] == i])
            for i, t in rows]


def data(seed):
    rnd = random.Random(seed)
    pool = [f"line number {i} of the pool" for i in range(15)] + ["short", "", "ÉÉÉÉÉ été 日本", "日本語日本語日本語日", "日本語日本語日本語日本"]
    rows = []
    for i in rnd.sample(range(1000), 120):
        lines = [rnd.choice([str, str.upper, lambda x: f" \t{x}\r"])(rnd.choice(pool)) for _ in range(rnd.randint(0, 6))]
        rows.append((i, "\n".join(["the line that everybody has", *lines][rnd.randint(0, 1):])))
    return rows


def result(spark, docs, **kw):
    bitmaps = ld.keep_bitmaps(docs, **kw)
    return ld.kept_texts(docs, bitmaps).collect()


@pytest.mark.parametrize("partitions", [None, 1, 9, 40])
def test_kept_lines_equal_brute_force(spark, partitions):
    rows = data(partitions or 3)
    docs = cases.plain(spark, [(*r, "", "", 0) for r in rows])
    got = {r.doc_id: r for r in result(spark, docs, partitions=partitions)}
    for i, kept in brute(rows):
        text = dict(rows)[i]
        assert (got[i].text, got[i].n_lines) == ("\n".join(kept), text.count("\n") + 1)
        assert got[i].n_dropped == text.count("\n") + 1 - len(kept)


def test_runs_over_partition_borders(spark):
    """Few keys in many partitions: nearly every key is cut by borders."""
    rows = [(i, "\n".join(["a line of everybody"] * 3 + [f"a line of every third {i % 3}"] * 4)) for i in range(300)]
    docs = cases.plain(spark, [(*r, "", "", 0) for r in rows])
    got = {r.doc_id: r.n_dropped for r in result(spark, docs, partitions=30)}
    assert got == {i: 0 if i == 0 else 3 if i < 3 else 7 for i, _ in rows}


def test_bitmaps_are_small_and_exact(spark):
    docs = cases.plain(spark, [(1, "a long enough line", "", "", 0), (2, "x\na long enough line\n\nz", "", "", 0)])
    got = cases.by_id(ld.keep_bitmaps(docs))
    assert list(ld.unpack(got[2].bitmap, 4)) == [True, False, True, True] and got[2].n_dropped == 1
    assert list(ld.unpack(got[1].bitmap, 1)) == [True]
    assert len(ld.pack(1_000_000, slice(0))) < 500


def test_cases(spark):
    docs = cases.documents(spark)
    got = ld.kept_texts(docs, ld.keep_bitmaps(docs))
    assert got.columns[:len(docs.columns)] == docs.columns
    rows = got.collect()
    want = brute([(r[0], r[1]) for r in cases.rows()])
    norm = lambda x: sorted(x, key=str)
    assert norm((r.doc_id, r.text) for r in rows) == norm((i, "\n".join(k)) for i, k in want)
    assert ld.kept_texts(docs.limit(0), ld.keep_bitmaps(docs.limit(0))).count() == 0


def test_ids_and_rows_that_repeat(spark):
    line = "this line repeats"
    rows = [(4, line + "\na"), (4, line + "\na"), (4, line + "\nb"), (9, line + "\nc"), (None, line), (None, "only nulls hold it"),
            (None, "x\nonly nulls hold it")]
    docs = cases.plain(spark, [(*r, "", "", 0) for r in rows])
    got = sorted((str(r.doc_id), r.text) for r in result(spark, docs, partitions=5))
    assert got == sorted([("4", line + "\na")] * 2 + [("4", line + "\nb"), ("9", "c"), ("None", ""),
                                                      ("None", "only nulls hold it"), ("None", "x\nonly nulls hold it")])


def test_text_ids_and_long_documents(spark):
    body = "\n".join(f"line {i % 70000} of the tale" for i in range(120_000))
    df = spark.createDataFrame([("b", body), ("a", "line 5 of the tale\nown words of a"), ("c", body)], "key string, body string")
    maps = ld.keep_bitmaps(df, id_col="key", text_col="body", partitions=8)
    got = {r.key: r for r in ld.kept_texts(df, maps, "key", "body").collect()}
    assert (got["a"].n_dropped, got["b"].n_dropped, got["c"].n_dropped) == (0, 2, 120_000)
    assert hashlib.sha256(got["c"].body.encode()).hexdigest() == hashlib.sha256(b"").hexdigest()
