import gzip
import hashlib
import os
from collections import Counter
from glob import glob

import pytest
from hypothesis import assume, given, settings
from hypothesis import strategies as st

from supportlens.llm import mixing, warc
from supportlens.llm.common import Scratch

from . import cases

PAGES = [
    (1, "http://a/1", "x" * 2000), (2, "http://a/2", "x" * 2000), (3, None, "x" * 2000), (4, "u v\r\nX: y", "small"),
    (5, "http://a/5", "small"), (6, "", None), (7, "é", ""), (8, "h", "é" * 700 + "\r\n\r\nWARC/1.0\r\n"),
    (9, "h", "WARC/1.0\r\n\r\n" * 300), (10, "h", "line\n" * 5000), (11, "h", "日" * 4000), (11, "h", "日" * 4000),
    (12, "h", "ends in newline\n" * 100 + "\r\n"), (None, "h", "x" * 2000), (None, None, None), (13, "h", "\n" * 1500),
]


def pages(spark, rows=PAGES):
    return spark.createDataFrame(rows, "page_id bigint, url string, html string").selectExpr(
        "*", "'c' as digest", "1 as id", "'q' as target", "2 as bytes")


def written(spark, df, **kw):
    path = Scratch(spark, "warc-test").path("archives")
    warc.write_archives(df, path, **kw)
    return path


def expected(rows):
    best = {}
    for i, _, h in rows:
        if i is not None and len((h or "").encode()) >= 1000:
            best[h] = max(i, best.get(h, i))
    out = []
    for i, _, h in rows:
        data = (h or "").encode()
        target = best.get(h or "") if sum((h or "") == (x[2] or "") for x in rows) > 1 else None
        revisit = target is not None and target != i
        out.append((i, len(data), hashlib.sha1(data).hexdigest(), "revisit" if revisit else "response",
                    target if revisit else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("segment", [warc.SEGMENT, 1000])
def test_round_trip(spark, segment):
    path = written(spark, pages(spark), segment=segment)
    for chunk in (warc.CHUNK, 64):
        got = warc.records(warc.chunk_table(spark, path, chunk=chunk, data=False)).collect()
        assert sorted(map(tuple, got), key=str) == expected(PAGES)


def test_payload_of_many_segments(spark):
    """Characters of 1 to 4 bytes, so that segments end inside them."""
    text = "".join(chr(c) for c in (97, 233, 26085, 128512)) * 90_000
    rows = [(1, "u", text), (2, "u", text), (3, "u", "é" * warc.SEGMENT), (4, "u", "a" * warc.SEGMENT)]
    got = warc.records(warc.chunk_table(spark, written(spark, pages(spark, rows)), data=False)).collect()
    assert sorted(map(tuple, got), key=str) == expected(rows)


def test_large_payload_is_written_in_linear_time(spark):
    import time

    def seconds(mb):
        df = spark.range(1).selectExpr("id as page_id", "'u' as url", 
                                        f"repeat(if(id < 0, '', '0123456789abcdeé'), {mb << 16}) as html")
        start = time.monotonic()
        path = written(spark, df)
        took = time.monotonic() - start
        (row,) = warc.records(warc.chunk_table(spark, path, data=False)).collect()
        assert row.payload_bytes == mb * (17 << 16)
        return took

    seconds(1)
    assert seconds(70) < 20


def test_chunks_hold_the_payload(spark):
    rows = [(i, u, h) for i, u, h in PAGES if i is not None and i not in (1, 2, 11)]
    path = written(spark, pages(spark, rows), segment=700)
    chunks = warc.chunk_table(spark, path, chunk=333).collect()
    assert max(len(c.chunk) for c in chunks) <= 333
    for i, _, h in rows:
        own = sorted((c for c in chunks if c.id == str(i)), key=lambda c: c.chunk_no)
        assert [c.chunk_no for c in own] == list(range(len(own)))
        sha, data = hashlib.sha1(), b""
        for c in own:
            sha.update(c.chunk)
            data += c.chunk
            assert c.digest_so_far == sha.hexdigest() and c.bytes_so_far == len(data)
        assert data == (h or "").encode()


def test_archives_are_plain_warc(spark):
    """A reader that only knows the format: header lines, content length."""
    path = written(spark, pages(spark, PAGES[:8]))
    n = 0
    for f in glob(os.path.join("/" + path.removeprefix("file:").lstrip("/"), "*.gz")):
        data = gzip.open(f).read()
        while data:
            head, _, data = data.partition(b"\r\n\r\n")
            fields = dict(x.split(b": ", 1) for x in head.split(b"\r\n")[1:])
            assert head.startswith(b"WARC/1.0\r\n") and b"WARC-Record-ID" in fields
            size = int(fields[b"Content-Length"])
            assert data[size:size + 4] == b"\r\n\r\n"
            data = data[size + 4:]
            n += 1
    assert n == 8


def test_empty_pages(spark):
    path = written(spark, pages(spark, PAGES).limit(0))
    assert warc.records(warc.chunk_table(spark, path)).count() == 0


def test_damage_is_noticed(spark):
    chunks = warc.chunk_table(spark, written(spark, pages(spark, PAGES[3:5])), data=False)
    from pyspark.sql import functions as F

    with pytest.raises(Exception, match="does not fit"):
        warc.records(chunks.withColumn("payload_digest", F.lit("0"))).collect()


# -- mixing -------------------------------------------------------------------------

def brute_schedule(parts, blocks):
    """EDF slot by slot, looking at every source each time; the source that
    runs out first leaves its slot empty."""
    total, done, out, over, end, slot = sum(parts), [0] * len(parts), [], set(), None, 0
    while any(p and d < n for p, d, n in zip(parts, done, blocks)):
        ready = [(-(-(done[i] + 1) * total // p), i) for i, p in enumerate(parts)
                 if p and i not in over and done[i] * total // p <= slot]
        if ready:
            _, i = min(ready)
            if done[i] == blocks[i]:
                over.add(i)
                if end is not None:
                    continue  # a slot is left empty once only
                end = slot
            else:
                out.append((i, done[i], slot))
                done[i] += 1
        slot += 1
    return out, slot if end is None else end


def played(parts, blocks, size):
    ends, end = mixing.first_end(parts, blocks)
    jobs = [n + (i == ends) for i, n in enumerate(blocks)]
    cuts = mixing.stretches(parts, jobs, size)
    plan = [x for a, b in zip(cuts, [*cuts[1:], None]) for x in mixing.play(parts, jobs, a, b) if x[1] < blocks[x[0]]]
    return plan, min(end, plan[-1][2] + 1), len(cuts)


@given(st.lists(st.tuples(st.integers(0, 60) | st.sampled_from([333, 1000]), st.integers(1, 50)), min_size=1,
                max_size=8), st.sampled_from([1, 2, 5, 30, 10_000]))
@settings(max_examples=300, deadline=None)
def test_segments_make_the_schedule(sources, size):
    parts, blocks = [p for p, _ in sources], [n for _, n in sources]
    assume(any(parts))
    plan, end, _ = played(parts, blocks, size)
    assert ([x[:3] for x in plan], end) == brute_schedule(parts, blocks)
    assert all(r <= slot < d for _, _, slot, r, d in plan)


def test_segments_of_very_unequal_weights():
    """Light blocks are open over many segments, others run out early."""
    parts, blocks = [1, 3, 40_000, 17, 9_000, 2_500], [2, 3, 30_000, 60, 500, 4_000]
    plan, end, segments = played(parts, blocks, 1000)
    assert segments > 30 and ([x[:3] for x in plan], end) == brute_schedule(parts, blocks)


@pytest.mark.parametrize("weights", [{"a": 1}, {"a": 1, "b": 2, "c": 7}, {"a": 333, "b": 333, None: 334},
                                     {f"s{i}": 1 + i * i for i in range(9)}, {"a": 2 ** 0.5, "b": 3 ** 0.5, "c": 1e-3}])
def test_schedule_deviates_less_than_one_block(weights):
    parts = mixing.whole_parts(list(weights.values()))
    blocks = [200] * len(parts)
    plan, end, _ = played(parts, blocks, 40)
    assert ([x[:3] for x in plan], end) == brute_schedule(parts, blocks)
    total, so_far = sum(parts), Counter()
    for i, _, slot, _, _ in plan:
        if slot < end:
            so_far[i] += 1
            assert all(abs(so_far[x] * total - p * (slot + 1)) < total for x, p in enumerate(parts))


def test_segments_as_tasks(spark, monkeypatch):
    monkeypatch.setattr(mixing, "STRETCH", 50)
    parts, blocks = [5, 0, 900, 95], [40, 3, 900, 300]
    plan, end = mixing.slot_table(Scratch(spark, "mixing-test"), parts, blocks)
    got = sorted((r.i, r.blk, r.slot) for r in plan.collect())
    want, brute_end = brute_schedule([5, 0, 900, 95], blocks)
    last = max(slot for *_, slot in want)
    assert got == sorted([*want, *[(1, j, last + 2 + j) for j in range(3)]]) and end == brute_end


def test_mix_places_every_row(spark):
    data = [(i, f"t{i}", "", "a" if i % 3 else ("b" if i % 2 else None), 0) for i in range(3000)]
    docs = cases.plain(spark, data)
    weights = {"a": 3, "b": 1, None: 1}
    got = mixing.mix(docs, weights, block=8).collect()
    assert sorted(r.doc_id for r in got) == list(range(3000))
    assert len({(r.mix_slot, r.mix_offset) for r in got}) == 3000
    blocks = {(r.source, r.mix_block): (r.mix_slot, r.mix_release, r.mix_deadline) for r in got}
    assert all(r <= slot < d for slot, r, d in blocks.values())
    for s, n in Counter(r.source for r in got).items():  # blocks are full but for the last
        sizes = Counter(r.mix_block for r in got if r.source == s)
        assert sorted(sizes) == list(range(-(-n // 8))) and all(sizes[b] == 8 for b in range(n // 8))
    end = max(r.mix_slot for r in got if r.on_target)
    for t in range(0, end, 7):
        for s, w in weights.items():
            ran = sum(slot <= t for (x, _), (slot, *_) in blocks.items() if x == s)
            assert abs(ran - w * (t + 1) / 5) < 1


@pytest.mark.parametrize("sizes, weights", [
    ({"a": 1000, "b": 1000, "c": 1000}, {"a": 1, "b": 1, "c": 1}), ({"a": 2999, "b": 1}, {"a": 1, "b": 1e-5}),
    ({"a": 1500, "b": 800, "c": 100, None: 7}, None), ({"a": 9, "b": 1500, "c": 3}, {"a": 0, "b": 2, "c": 0.7})])
def test_deviation_from_unrounded_weights(spark, sizes, weights):
    from fractions import Fraction

    names = [s for s, n in sizes.items() for _ in range(n)]
    docs = cases.plain(spark, [(i, f"t{i}", "", s, 0) for i, s in enumerate(names)])
    got = sorted(mixing.mix(docs, weights, block=1).collect(), key=lambda r: r.mix_slot)
    assert sorted(r.doc_id for r in got) == list(range(len(names))) and len({r.mix_slot for r in got}) == len(names)
    weights = weights or {s: n ** 0.5 for s, n in sizes.items()}
    share = {s: Fraction(w) / sum(map(Fraction, weights.values())) for s, w in weights.items()}
    ran, last = Counter(), -1
    for r in got:
        if r.on_target:
            assert r.mix_slot == last + 1
            last = r.mix_slot
            ran[r.source] += 1
            assert all(abs(ran[s] - w * (last + 1)) < 1 for s, w in share.items())
        if share[r.source]:
            assert r.mix_release == r.mix_block // share[r.source] <= r.mix_slot < r.mix_deadline
    # a source has run out there
    assert last + 1 >= min(n / share[s] for s, n in sizes.items() if share[s]) - len(sizes)


def test_many_sources(spark):
    docs = cases.plain(spark, [(i, "t", "", f"s{i}", 0) for i in range(10_050)])
    got = mixing.mix(docs).select("doc_id", "mix_slot", "on_target").collect()
    assert len({r.mix_slot for r in got}) == len(got) == 10_050 and all(r.on_target for r in got)


def test_numbering_over_many_buckets(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BUCKET", 20)
    data = [(i, "same text", "", "hot" if i % 10 else "cold", 0) for i in range(2000)]
    got = mixing.mix(cases.plain(spark, data), block=16).collect()
    assert len({(r.source, r.mix_block, r.mix_offset) for r in got}) == 2000
    assert max(r.mix_block for r in got if r.source == "hot") == (1800 - 1) // 16


def test_mix_cases(spark):
    docs = cases.documents(spark)
    out = mixing.mix(docs)
    assert out.count() == len(cases.rows())
    assert [c for c in out.columns if not c.startswith("mix_") and c != "on_target"] \
        == [c for c in docs.columns if c != "mix_slot"]
    assert mixing.mix(docs.limit(0)).count() == 0
    with pytest.raises(ValueError):
        mixing.mix(docs, {"a": 1})
