import math
import re
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from supportlens.llm import quality_model as qm
from supportlens.llm import quality_rules as qr
from supportlens.llm.common import read
from supportlens.llm.queries import QUERIES

from . import cases

SMALL, MID = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    w = WORD.findall(text)
    windows = Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
    again = {j for i in range(len(w) - 4) if windows[tuple(w[i:i + 5])] > 1 for j in range(i, i + 5)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(again)


def measured(r):
    return r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words


def test_measures_equal_brute_force(spark):
    docs = read(spark, SMALL, "documents")
    got = cases.by_id(qr.score_texts(docs))
    for r in docs.collect():
        assert measured(got[r.doc_id]) == brute(r.text)
        n, *_, again = brute(r.text)
        assert got[r.doc_id].base_failed == (n < 10 or 100 * again > 20 * n)


def test_overlapping_repeats(spark):
    texts = ["a b c d e a b c d e", "a a a a a a a", "a b c d", "x a b c d e y a b c d e z",
             "a b c d e f\n a b c d e f \n\n\n"]
    docs = cases.plain(spark, [(i, t, "", "", 0) for i, t in enumerate(texts)])
    got = cases.by_id(qr.score_texts(docs))
    assert [measured(got[i]) for i in range(len(texts))] == [brute(t) for t in texts]


def test_cases(spark):
    docs = cases.documents(spark)
    got = qr.score_texts(docs).collect()
    assert sorted(map(measured, got)) == sorted(brute(r[1]) for r in cases.rows())
    assert not any(r.kept for r in got if r.n_words == 0)
    kept = qr.keep_texts(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id or 0 for r in kept.collect()) == sorted(r.doc_id or 0 for r in got if r.kept)
    assert qr.score_texts(docs.limit(0)).count() == qr.keep_texts(docs.limit(0)).count() == 0


def test_junk_goes_and_clean_texts_stay(spark):
    scored = qr.score_texts(read(spark, MID, "documents")).join(read(spark, MID, "labels"), "doc_id").collect()
    assert not any(r.kept for r in scored if r.quality == 0)
    assert all(r.kept for r in scored if r.quality == 1 and not r.base_failed)


def test_em_learns_accuracies(spark):
    """Votes drawn with known accuracies: the estimates come near them, among
    the bad texts that any rule notices (1 - 0.3 * 0.4 of them)."""
    rng = np.random.default_rng(5)
    n = 4000
    good = rng.random(n) < 0.8
    rows = []
    for g in good:
        sym, again = ((0, 0) if g else (rng.random() < 0.7, rng.random() < 0.6))
        rows.append((100, 500, 60 if sym else 0, 0, 2, 40 if again else 0, 60, 5, 0, 0))
    names = ("n_words word_chars n_symbols n_dup_lines n_lines n_repeat_words n_distinct n_common n_upper "
             "n_exclaim").split()
    model = qr.fit(spark.createDataFrame([tuple(map(int, r)) for r in rows], ", ".join(f"{c} bigint" for c in names)))
    assert abs(model["bad"]["vote_symbols"] - 0.7 / 0.88) < 0.1
    assert abs(model["bad"]["vote_repeats"] - 0.6 / 0.88) < 0.1
    assert abs(model["share"] - 0.82) < 0.05


def plain_em(table, rounds=100):
    """EM over [votes, failed, n], number by number: shares and rates of bad votes."""
    kinds = [None, *qr.KINDS.values()]
    first = [[0.002 if own is None else 0.9 if r in own else 0.1 for r in qr.RULES] for own in kinds]
    first_share = [0.9, *[0.1 / len(qr.KINDS)] * len(qr.KINDS)]
    total = sum(n for *_, n in table)

    def chances(share, trips, votes, failed):
        out = []
        for c in range(len(kinds)):
            p = 0.0 if c == 0 and failed else share[c]
            for t, v in zip(trips[c], votes):
                p *= t if v < 0 else 1 - t if v > 0 else 1.0
            out.append(p)
        return [p / sum(out) for p in out]

    share, trips = first_share, first
    for _ in range(rounds):
        parts = [(votes, [p * n for p in chances(share, trips, votes, failed)]) for votes, failed, n in table]
        share = [(sum(p[c] for _, p in parts) + first_share[c]) / (total + 1) for c in range(len(kinds))]
        trips = [[(sum(p[c] for v, p in parts if v[i] < 0) + (1 if c else total) * first[c][i])
                  / (sum(p[c] for v, p in parts if v[i]) + (1 if c else total))
                  for i in range(len(qr.RULES))] for c in range(len(kinds))]
    return share, trips, lambda votes: chances(share, trips, votes, False)[0]


@pytest.mark.parametrize("sf", [SMALL, MID])
def test_fit_and_verdicts_equal_plain_em(spark, sf):
    docs = read(spark, sf, "documents")
    measures = docs.select(qr.measures(F.col("text")).alias("m")).select("m.*")
    model, scored = qr.fit(measures), qr.score_texts(docs).collect()
    names = [f"vote_{n}" for n in qr.RULES]
    table = Counter((tuple(r[c] for c in names), r.base_failed) for r in scored)
    share, trips, p_good = plain_em([(v, failed, n) for (v, failed), n in table.items()])
    assert np.allclose(model["shares"], share, atol=1e-9) and np.allclose(model["trips"], trips, atol=1e-9)
    for r in scored:
        p = p_good([r[c] for c in names])
        assert abs(r.p_good - p) < 1e-9 and r.kept == (not r.base_failed and p >= 0.5)
    # free estimates: no rate stands where it started or on an end of its range
    assert all(abs(t - s) > 1e-9 and 0 < t < 1 for row, first in zip(trips, qr._start()[1]) for t, s in zip(row, first))


def test_one_bad_vote_against_many_good_ones(spark):
    """A text that trips only the symbol rule is bad where symbols go along with
    otherwise bad texts; one that few rules vote on at all is not."""
    scored = qr.score_texts(read(spark, "/root/testdata/sf0.1", "documents"))
    rows = scored.join(read(spark, "/root/testdata/sf0.1", "labels"), "doc_id").where("not base_failed").collect()
    good, bad = [r for r in rows if r.quality == 1], [r for r in rows if r.quality == 0]
    assert sum(r.kept for r in good) >= 0.995 * len(good)
    assert sum(r.kept for r in bad) <= 0.05 * len(bad)
    single = [r for r in bad if r.vote_symbols < 0 and min(r[f"vote_{n}"] for n in qr.RULES if n != "symbols") >= 0]
    assert single and not any(r.kept for r in single)


def ratings(spark, sf):
    return read(spark, sf, "labels").select("doc_id", qm.grade_of(F.col("quality"), F.col("toxic")).alias("grade"))


def test_ordinal_model_on_held_out_texts(spark):
    docs, rated = read(spark, "/root/testdata/sf0.1", "documents"), ratings(spark, "/root/testdata/sf0.1")
    held = F.pmod("doc_id", F.lit(5)) == 0
    scored = qm.score_texts(docs, qm.fit(docs, rated.where(~held))).join(rated.where(held), "doc_id").collect()
    by = lambda g: [r for r in scored if r.grade == g]
    mean = [np.mean([r.expected_grade for r in by(g)]) for g in (0, 1, 2)]
    assert mean[0] < mean[1] < mean[2]
    assert np.mean([r.kept for r in by(0)]) < 0.03
    assert np.mean([r.kept for r in by(2)]) > 0.97
    assert np.mean([r.kept for r in by(1)]) < 0.5
    assert all(r.p_at_least[0] >= r.p_at_least[1] for r in scored)


def brute_tokens(text):
    """Words and shapes of a text, from its characters."""
    text = text or ""
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    size = max(1, len(text.encode()))
    share = lambda chars: sum(c in chars for c in text) / size
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    shapes = {"size": math.log2(len(words) + 1), "new": 10 * len(set(words)) / max(1, len(words)),
              "sym": 4 * math.log2(1 + 100 * share("#*$%&|<>")), "cap": 10 * share(upper),
              "exc": 4 * math.log2(1 + 100 * share("!"))}
    return set(words), [f"\x00{k}{min(12, int(v))}" for k, v in shapes.items()] + ["\x00one"]


@pytest.mark.parametrize("sf", [SMALL, MID])
def test_query_equals_plain_scores_of_the_fitted_weights(spark, sf):
    docs = read(spark, sf, "documents")
    model = qm.fit(docs, ratings(spark, sf))
    got = cases.by_id(QUERIES["op4_quality_model"](spark, sf))
    assert len(got) == docs.count()
    weight = lambda t: model.weights.get(xxhash.xxh64_intdigest(t.encode()) % (1 << 31), 0.0)
    cut = [float(x) for x in model.thresholds]
    assert cut == sorted(cut) and len(cut) == 2
    for r in docs.collect():
        words, shapes = brute_tokens(r.text)
        score = sum(map(weight, words)) + sum(map(weight, shapes))
        tails = [1 / (1 + math.exp(-(score - t))) for t in cut]
        row = got[r.doc_id]
        assert abs(row.expected_grade - sum(tails)) < 2e-6 and abs(row.p_top_grade - tails[-1]) < 2e-6
        assert row.kept == (tails[-1] >= 0.5) or abs(tails[-1] - 0.5) < 1e-9


def test_ratings_with_columns_of_clashing_names(spark):
    docs = cases.documents(spark)
    rated = spark.createDataFrame([(1, 2, "x", 5), (5, 2, "y", 5), (9, 0, "z", 5), (10, 1, "", 5)],
                                  "doc_id bigint, grade int, text string, id bigint")
    plain, other = qm.fit(docs, rated.select("doc_id", "grade")), qm.fit(docs, rated)
    assert plain.weights == other.weights and list(plain.thresholds) == list(other.thresholds)


def test_ordinal_recovers_its_own_thresholds():
    rng = np.random.default_rng(3)
    x = rng.integers(0, 2, (4000, 3)).astype(float)
    score = x @ [2.0, -1.0, 0.5]
    grade = ((score[:, None] + rng.logistic(size=(4000, 1))) > [[-0.5, 1.5]]).sum(1)
    x = np.concatenate([x, np.ones((4000, 1))], axis=1)
    row, idx = np.nonzero(x)
    start = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=4000))])
    model = qm.OrdinalModel.fit(idx.astype(np.int32), start, grade, rounds=600, rate=0.05, decay=0.0)
    assert np.allclose(np.diff(model.thresholds), 2.0, atol=0.2)
    assert np.allclose([model.weights[i] for i in range(3)], [2.0, -1.0, 0.5], atol=0.2)


def test_ordinal_cases(spark):
    docs = cases.documents(spark)
    rated = spark.createDataFrame([(1, 2), (1, 2), (5, 2), (9, 0), (10, 1), (None, 0), (8, None), (99, 1)],
                                  "doc_id bigint, grade int")
    model = qm.fit(docs, rated)
    got = qm.score_texts(docs, model)
    assert got.count() == len(cases.rows())
    assert all(0 <= r.expected_grade <= 2 for r in got.collect())
    assert qm.score_texts(docs.limit(0), model).count() == 0
    assert qm.fit(docs, rated.limit(0)) is None
    assert all(r.kept for r in qm.score_texts(docs, None).collect())
    with pytest.raises(ValueError):
        qm.fit(docs, rated.where("grade = 2"))
