"""Spelling suggestions against a brute-force reference on small fixtures."""

import random

from pyspark.sql import functions as F

from supportlens.operators import cleaning, lemmas, spelling


def dl(a: str, b: str) -> int:
    """Unrestricted Damerau-Levenshtein distance (Lowrance-Wagner)."""
    inf = len(a) + len(b)
    da: dict[str, int] = {}
    d = [[inf] * (len(b) + 2) for _ in range(len(a) + 2)]
    for i in range(len(a) + 1):
        d[i + 1][0], d[i + 1][1] = inf, i
    for j in range(len(b) + 1):
        d[0][j + 1], d[1][j + 1] = inf, j
    for i in range(1, len(a) + 1):
        db = 0
        for j in range(1, len(b) + 1):
            i1, j1 = da.get(b[j - 1], 0), db
            cost = 0 if a[i - 1] == b[j - 1] else 1
            if cost == 0:
                db = j
            d[i + 1][j + 1] = min(d[i][j] + cost, d[i + 1][j] + 1, d[i][j + 1] + 1,
                                  d[i1][j1] + (i - i1 - 1) + 1 + (j - j1 - 1))
        da[a[i - 1]] = i
    return d[len(a) + 1][len(b) + 1]


def brute_suggest(tokens, lexicon):
    out = {}
    for t in tokens:
        if len(t) <= 1 or t in lexicon:
            continue
        cands = [(dl(t, w), -f, w) for w, f in lexicon.items()]
        cands = [c for c in cands if c[0] <= 2]
        if cands:
            d, _, w = min(cands)
            out[t] = (w, d)
    return out


def test_distance_identities_random(spark):
    rng = random.Random(7)
    alpha = "abcé"
    pairs = set()
    while len(pairs) < 3000:
        a = "".join(rng.choice(alpha) for _ in range(rng.randint(1, 6)))
        b = "".join(rng.choice(alpha) for _ in range(rng.randint(1, 6)))
        if a != b:
            pairs.add((a, b))
    df = spark.createDataFrame(sorted(pairs), "a string, b string")
    got = {(r["a"], r["b"]): r["d"] for r in
           df.select("a", "b", spelling.dl_distance_upto2(F.col("a"), F.col("b")).alias("d")).collect()}
    for (a, b), d in got.items():
        want = dl(a, b)
        assert d == (want if want <= 2 else None), (a, b, d, want)


def test_suggest_matches_brute_force(spark):
    rng = random.Random(11)
    alpha = "abcdeéo"
    words = {"".join(rng.choice(alpha) for _ in range(rng.randint(2, 7))): rng.randint(20, 60)
             for _ in range(150)}
    tokens = sorted({"".join(rng.choice(alpha) for _ in range(rng.randint(1, 9))) for _ in range(400)})
    lex = spark.createDataFrame(sorted(words.items()), "word string, freq bigint")
    vocab = spark.createDataFrame([(t,) for t in tokens], "token string")
    got = {r["token"]: (r["suggestion"], r["distance"])
           for r in spelling.correction_table(vocab, lex).collect()}
    assert got == brute_suggest(tokens, words)


def test_long_tokens_have_no_candidates(spark):
    lex = spark.createDataFrame([("abc", 30)], "word string, freq bigint")
    vocab = spark.createDataFrame([("abcdef",), ("abcd",)], "token string")
    got = {r["token"]: r["suggestion"] for r in spelling.correction_table(vocab, lex).collect()}
    assert got == {"abcd": "abc"}


def test_lemma_rules(spark):
    lex = spark.createDataFrame([(w, 30) for w in ["box", "boxe", "city", "church", "man", "wolf",
                                                   "glass", "glasses", "bus"]],
                                "word string, freq bigint")
    vocab = spark.createDataFrame([(t,) for t in ["boxes", "cities", "churches", "men", "wolves",
                                                  "glasses", "buses", "zzz", "box"]], "token string")
    got = {r["token"]: r["lemma"] for r in lemmas.lemma_table(vocab, lex).collect()}
    assert got == {"boxes": "box", "cities": "city", "churches": "church", "men": "man",
                   "wolves": "wolf", "glasses": "glass", "buses": "bus"}


def test_clean_texts_end_to_end(spark):
    # Spelling runs before stop-word removal, so the dictionary must know the
    # stop words, as any real dictionary does (else "of" would become "box").
    lex = spark.createDataFrame([("shipping", 50), ("address", 40), ("order", 40), ("change", 30),
                                 ("box", 30), ("the", 90), ("of", 90), ("and", 90)],
                                "word string, freq bigint")
    df = spark.createDataFrame([(1, "Shiping adress of the ordres, 3 boxes!"), (2, ""), (3, None),
                                (4, "the of and")], "row_id long, text string")
    got = {r["row_id"]: (r["clean"], r["length"]) for r in
           cleaning.clean_texts(df, "row_id", "text", lex).collect()}
    assert got == {1: ("shipping address order box", 4), 2: ("", 0), 3: ("", 0), 4: ("", 0)}


def test_clean_columns_equals_per_column(spark):
    from supportlens.plans import catalog
    from supportlens.sources import views

    sf = "/root/testdata/sf0.001"
    r = views.support_responses(spark, sf)
    lex = catalog.lexicon(spark, sf)
    both = {x["row_id"]: (x["clean_query"], x["clean_response"]) for x in
            cleaning.clean_columns(r, "row_id", ["query", "response"], lex).collect()}
    q = {x["row_id"]: x["clean"] for x in cleaning.clean_texts(r, "row_id", "query", lex).collect()}
    a = {x["row_id"]: x["clean"] for x in cleaning.clean_texts(r, "row_id", "response", lex).collect()}
    assert both == {k: (q[k], a[k]) for k in q}


def test_lemma_exceptions_take_precedence(spark):
    lex = spark.createDataFrame([("mouse", 30), ("mice", 30), ("child", 30)], "word string, freq bigint")
    vocab = spark.createDataFrame([("mice",), ("children",)], "token string")
    exc = spark.createDataFrame([("mice", "mouse"), ("children", "child")], "form string, lemma string")
    got = {r["token"]: r["lemma"] for r in lemmas.lemma_table(vocab, lex, exceptions=exc).collect()}
    assert got == {"mice": "mouse", "children": "child"}


def test_corrections_do_not_depend_on_corpus_size(spark):
    """The same corpus ten times over knows the same words."""
    from pyspark.sql import functions as F

    from supportlens.operators import spelling

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text")
    ten = docs.crossJoin(F.broadcast(spark.range(10))).select("text")
    one, many = (spelling.build_lexicon(d, "text", per_million=50) for d in (docs, ten))
    assert {r.word: r.freq * 10 for r in one.collect()} == {r.word: r.freq for r in many.collect()}


def test_short_tokens_without_the_empty_key(spark):
    """Two-letter tokens: any word of up to two letters is within distance 2."""
    from supportlens.operators import spelling

    lex = spark.createDataFrame([("xy", 5), ("of", 9), ("q", 9), ("abc", 3), ("wxyz", 50)], "word string, freq bigint")
    vocab = spark.createDataFrame([("ab",), ("zz",), ("xz",), ("yz",)], "token string")
    got = {r.token: (r.suggestion, r.distance) for r in spelling.correction_table(vocab, lex).collect()}
    assert got == {"ab": ("abc", 1), "zz": ("of", 2), "xz": ("xy", 1), "yz": ("wxyz", 2)}


def test_rows_that_share_a_key_are_cleaned_each_for_itself(spark):
    from supportlens.operators import cleaning

    lex = spark.createDataFrame([("refund", 40), ("order", 40)], "word string, freq bigint")
    df = spark.createDataFrame([(1, "refnud now"), (1, "ordr"), (None, "ordr refund"), (None, None)], "k long, t string")
    got = sorted((r.k or 0, r.clean) for r in cleaning.clean_texts(df, "k", "t", lex).collect())
    assert got == [(0, ""), (0, "order refund"), (1, "order"), (1, "refund")]
