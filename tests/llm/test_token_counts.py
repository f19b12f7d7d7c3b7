import random

import pytest

from supportlens.llm import token_counts as tc

from . import cases

P = pytest.importorskip("public_tokenizers")
PATH = P.path("word_bpe_49k.json")
ALPHABET = "abcdefghij  'sST\n\t.,!'re've İſKéàßΣσς你好٣²½́😀\x00\x1c\x85\xa0"


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH)


def texts(n, length):
    rnd = random.Random(7)
    return ["".join(rnd.choice(ALPHABET) for _ in range(rnd.randint(0, length))) for _ in range(n)]


def size(library, text):
    return len(library.encode(text, add_special_tokens=False).ids)


def test_counts_equal_the_library(library):
    c = tc.PrefixCounter(PATH)
    special = ["a<|endoftext|>b <|startoftext|>", "<|endoftext", "I'RE don't 'r 're", "ΑΣ ΑΣΑ"]
    for t in texts(1500, 40) + special + [cases.PROSE]:
        assert c.count(t) == size(library, t), repr(t)


def test_every_prefix_is_exact(library):
    c = tc.PrefixCounter(PATH)
    for t in texts(150, 30) + [cases.PROSE[:120], "don't we'll 'r"]:
        normal = c.normalise(t)
        if c.normalise(normal) != normal:
            continue  # normalising is not settled after one step: prefixes of the result are other texts
        assert list(c.prefixes(t)) == [size(library, normal[:i]) for i in range(1, len(normal) + 1)]


def test_whole_words_settle_only_prefixes_on_their_way(library):
    """As the table of all prefixes, with a fraction of its look-ups."""
    class Counted(dict):
        asked = 0

        def get(self, key, default=None):
            self.asked += 1
            return super().get(key, default)

    c = tc.PrefixCounter(PATH)
    c.starts = Counted(c.starts)
    rnd = random.Random(11)
    words = ["".join(rnd.choice("aeinorstlhdéß") for _ in range(rnd.randint(1, 25))) for _ in range(800)]
    words += ["".join(rnd.choice(("erin", "ther", "anand", "bleble", "ing")) for _ in range(5)) for _ in range(400)]
    got = [c.word(w) for w in words]
    whole, c.starts.asked = c.starts.asked, 0
    for w, n in zip(words, got):
        s = c._bytes(w)
        assert n == c._closed(s, len(s), *c._table(s)) == size(library, w)
    assert whole < 0.6 * c.starts.asked


def test_fits_is_the_longest_prefix():
    c = tc.PrefixCounter(PATH)
    for t in texts(60, 40) + [cases.PROSE]:
        counts = [0, *c.prefixes(t)]
        for budget in (0, 1, 3, 7, 1000):
            assert c.fits(t, budget) == max(i for i, n in enumerate(counts) if n <= budget)


def test_table_and_cases(spark, library):
    docs = cases.documents(spark)
    got = tc.count_tokens(docs, PATH, budget=8).collect()
    want = sorted((r[0] or 0, len((r[1] or "").encode()), size(library, r[1] or "")) for r in cases.rows())
    assert sorted((r.doc_id or 0, r.n_bytes, r.n_tokens) for r in got) == want
    assert tc.count_tokens(docs.limit(0), PATH).count() == 0


def test_stored_prefixes_answer_budget_questions(spark, library):
    docs = cases.plain(spark, [(1, cases.PROSE * 60, "", "", 0), (2, None, "", "", 0), (3, "don't", "", "", 0)])
    table = tc.prefix_table(docs, PATH).cache()
    assert table.where("doc_id = 1").count() > 1
    best = cases.by_id(tc.longest_prefix(table, 100))
    direct = cases.by_id(tc.count_tokens(docs, PATH, budget=100))
    assert {k: r.n_fit for k, r in best.items()} == {k: r.n_fit for k, r in direct.items()}
    at = spark.createDataFrame([(1, 5000), (1, 0), (3, 4), (2, 9)], "doc_id bigint, position bigint")
    got = {(r.doc_id, r.position): r.n_tokens for r in tc.tokens_at(table, at).collect()}
    assert got == {(1, 5000): size(library, (cases.PROSE * 60)[:5000]), (1, 0): 0,
                   (3, 4): size(library, "don'"), (2, 9): None}
