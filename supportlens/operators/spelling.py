"""Dictionary and spelling correction (T6) as joins.

The dictionary is a table ``(word, freq)``; by default it is learned from a
corpus (letter runs of a least share of all words).

Correction of an out-of-dictionary token longer than one character picks,
among dictionary words within Damerau-Levenshtein distance 2 (unrestricted:
any sequence of at most two insert/delete/substitute/adjacent-swap edits),
the one with the smallest distance, then the highest frequency, then the
alphabetically first. No candidate -> the token stays.

Plan (symmetric delete): every distinct unknown token and every dictionary
word emits the strings obtained by deleting up to two of its characters; two
strings within distance 2 always share such a key. Tokens and words are
equi-joined on the key, pairs are verified with built-in ``levenshtein`` plus
adjacent-swap variants (Spark's levenshtein has no transpositions), and the
best word per token is chosen by a two-phase ``min_by`` aggregate. Work is
proportional to the *distinct* vocabulary, not to the number of token
occurrences. Tokens longer than the longest dictionary word + 2 cannot have a
candidate and are skipped exactly, which also bounds the number of keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize, scratch_scope

LETTER_RUN_RE = r"\p{L}+"


def build_lexicon(df: DataFrame, text: str = "text", per_million: float = 1.0,
                  min_len: int = 2) -> DataFrame:
    """Dictionary ``(word, freq)`` from lower-cased letter runs of a corpus.

    A word counts as known from ``per_million`` occurrences per million words
    on: a share of the corpus, not a number of occurrences, so what is known
    does not change as the corpus grows and its misspellings with it. The
    default keeps ordinary rare words; a sparse dictionary (50 and more) makes
    the correction rewrite them into frequent neighbours. ``noisy_channel``
    corrects without any such limit.
    """
    words = df.select(F.explode(F.regexp_extract_all(F.lower(F.col(text)),
                                                      F.lit(LETTER_RUN_RE), 0)).alias("word"))
    counts = materialize(words.groupBy("word").agg(F.count(F.lit(1)).alias("freq")))
    total = counts.select(F.sum("freq")).scalar()
    return counts.where((F.col("freq") * 1_000_000 >= total * F.lit(float(per_million)))
                        & (F.length("word") >= min_len))


def _positions(n: Column) -> Column:
    # sequence(1, 0) would count down; an empty array is wanted instead.
    return F.when(n > 0, F.sequence(F.lit(1), n)).otherwise(F.array().cast("array<int>"))


def deletes1(w: Column) -> Column:
    """Strings with exactly one character of ``w`` deleted."""
    return F.transform(_positions(F.length(w)),
                       lambda i: F.concat(F.substr(w, F.lit(1), i - 1), F.substr(w, i + 1)))


def delete_keys(w: Column) -> Column:
    """``w`` and every non-empty string obtained by deleting one or two of its
    characters, as structs (``key``, ``edits``: 1 for ``w`` and one deletion)."""
    d1 = F.array_distinct(F.concat(F.array(w), deletes1(w)))
    d2 = F.array_except(F.flatten(F.transform(deletes1(w), deletes1)), d1)
    tag = lambda keys, n: F.transform(keys, lambda k: F.struct(
        k.alias("key"), F.lit(n).alias("edits")))
    return F.filter(F.concat(tag(d1, 1), tag(d2, 2)), lambda x: x["key"] != "")


def swaps(w: Column) -> Column:
    """All strings obtained by swapping one pair of adjacent characters."""
    n = F.length(w)
    return F.transform(_positions(n - 1), lambda i: F.concat(
        F.substr(w, F.lit(1), i - 1), F.substr(w, i + 1, F.lit(1)), F.substr(w, i, F.lit(1)),
        F.substr(w, i + 2)))


def dl_distance_upto2(a: Column, b: Column) -> Column:
    """Unrestricted Damerau-Levenshtein distance when it is 1 or 2, else NULL
    (a != b assumed). Built from ``levenshtein`` and adjacent swaps:
      d <= 1  iff  lev(a, b) <= 1 or b is a swap of a
      d <= 2  iff  lev(a, b) <= 2, or lev(swap(a), b) <= 1, or lev(a, swap(b)) <= 1,
                   or a and b share a swap.
    A swap costs two Levenshtein edits, so d <= 2 implies lev(a, b) <= 4: the
    banded ``levenshtein(a, b, 4)`` (-1 beyond 4) rejects most candidate pairs
    cheaply and the swap tests run only for lev in {2, 3, 4}, and for lev 4
    only when both strings have the same letters."""
    lev = F.levenshtein(a, b, 4)
    # lev 4 within Damerau 2 means two swaps, which keep the letter multiset:
    # compare sorted letters before building any swap.
    same_letters = F.array_sort(F.split(a, "")) == F.array_sort(F.split(b, ""))
    # Swap arrays are built only inside the branches that need them (a
    # subexpression used in some branches only is not hoisted by Catalyst).
    # A single swap keeps length and letters: test those before building swaps.
    swap_of_a = (F.length(a) == F.length(b)) & same_letters & F.array_contains(swaps(a), b)
    one_swap_then_edit = (F.exists(swaps(a), lambda s: F.levenshtein(s, b, 1) >= 0)
                          | F.exists(swaps(b), lambda s: F.levenshtein(a, s, 1) >= 0)
                          | F.arrays_overlap(swaps(a), swaps(b)))
    return (F.when(lev == 1, F.lit(1))
             .when(lev == 2, F.when(swap_of_a, F.lit(1)).otherwise(F.lit(2)))
             .when((lev == 3) | ((lev == 4) & same_letters),
                   F.when(one_swap_then_edit, F.lit(2))))


def unknown_tokens(vocab: DataFrame, lexicon: DataFrame, token: str = "token") -> DataFrame:
    """Tokens of a *distinct* vocabulary longer than one character that are not
    dictionary words (no second distinct: the vocabulary's shuffle is reused)."""
    return (vocab.select(token).where(F.length(token) > 1)
                 .join(lexicon.select(F.col("word").alias(token)), token, "left_anti"))


def _spread(df: DataFrame, col: str) -> DataFrame:
    """Deal rows over the configured shuffle partitions: key generation
    multiplies each row 50-200x, while a small vocabulary arrives in few
    partitions. An explicit count is not coalesced again by AQE."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(n, col)


def dictionary_keys(lexicon: DataFrame) -> DataFrame:
    """The dictionary's delete-key index ``(w, freq, key, edits)``.

    It depends on the dictionary only: build it once (and materialise it) when
    many cleaning runs or stream micro-batches share one dictionary.
    """
    return _spread(lexicon, "word").select(
        F.col("word").alias("w"), "freq", F.inline(delete_keys(F.col("word"))))


def _best(found: DataFrame) -> DataFrame:
    """Smallest distance, then highest frequency, then first in the alphabet."""
    rank = F.struct(F.col("d"), (-F.col("freq")).alias("nf"), F.col("w"))
    return (found.groupBy("t").agg(F.min_by(F.struct("w", "d"), rank).alias("best"))
                 .select("t", F.col("best.w").alias("w"), F.col("best.d").alias("d")))


def _matches(keys: DataFrame, index: DataFrame, distance: int) -> DataFrame:
    """(t, w, freq, d) of pairs that share a key and are ``distance`` apart."""
    gap = F.abs(F.length("t") - F.length("w")) <= distance
    lev = F.levenshtein("t", "w", 2 * distance)  # a swap costs two of its edits
    pairs = keys.join(index, "key").where(gap & (lev >= 1)).select("t", "w", "freq")
    # A close pair may share several keys; duplicates are harmless to the
    # per-token min_by, so no dedupe shuffle is paid. The distance is computed
    # after the join, once per surviving pair.
    scored = pairs.withColumn("d", dl_distance_upto2(F.col("t"), F.col("w")))
    return scored.where(F.col("d") == distance)


def suggest(unknown: DataFrame, lexicon: DataFrame, token: str = "token",
            lexicon_keys: DataFrame | None = None, scope: scratch_scope | None = None) -> DataFrame:
    """Best dictionary word per unknown token: ``(token, suggestion, distance)``.

    Distance 1 first, on keys of at most one deletion; only tokens without a
    hit go on to distance 2. Tokens without a candidate are absent from the
    result. ``lexicon_keys`` is a prebuilt ``dictionary_keys(lexicon)``.

    The empty key (everything deleted) is no key: only strings of up to two
    characters have it, and any two of them are within distance 2, so the most
    frequent such word stands for all of them.
    """
    max_word = lexicon.select(F.max(F.length("word"))).scalar()
    u = _spread(unknown.where(F.length(token) <= max_word + 2), token)
    u_keys = u.select(F.col(token).alias("t"), F.inline(delete_keys(F.col(token))))
    w_keys = lexicon_keys if lexicon_keys is not None else dictionary_keys(lexicon)
    near = F.col("edits") == 1
    one = materialize(_best(_matches(u_keys.where(near).drop("edits"), w_keys.where(near).drop("edits"), 1)),
                      scope=scope)
    rest = u_keys.drop("edits").join(one.select("t"), "t", "left_anti")
    two = _matches(rest, w_keys.drop("edits"), 2)
    short = lexicon.where(F.length("word") <= 2).select(
        F.min_by(F.struct("word", "freq"), F.struct(-F.col("freq"), F.col("word")))).scalar()
    tiny = (unknown.where(F.length(token) == 2).select(F.col(token).alias("t"))
                   .join(one.select("t"), "t", "left_anti")
                   .select("t", short["word"].alias("w"), short["freq"].alias("freq"), F.lit(2).alias("d"))
                   .where(F.col("w").isNotNull()))
    return one.union(_best(two.union(tiny))).toDF(token, "suggestion", "distance")


def correction_table(vocab: DataFrame, lexicon: DataFrame, token: str = "token",
                     lexicon_keys: DataFrame | None = None, scope: scratch_scope | None = None) -> DataFrame:
    """T6 for a *distinct* vocabulary: ``(token, suggestion, distance)`` for
    corrected tokens only."""
    return suggest(unknown_tokens(vocab, lexicon, token), lexicon, token, lexicon_keys, scope)
