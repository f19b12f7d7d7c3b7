"""Quality rules combined by weak supervision (operator 8).

Each rule votes good (1), bad (-1) or abstains (0) on a text; an abstention
says nothing. How far a rule can be trusted is not set by hand: expectation-
maximisation over the vote patterns of all texts estimates how often each rule
votes bad on good texts and on bad ones, and the share of good texts. Bad texts
come in kinds that trip different rules (``KINDS``), so they are a mixture: one
binary class would take a text that trips a single rule for a good one, since
all other rules vote for it. A text is kept when its posterior probability of
being good reaches one half, unless it fails one of two hard limits (too few
words, too many repeated ones); texts that fail one are known to be bad when
the rules are fitted.

Only DataFrame functions. All measures of a text are taken within its row: no
shuffle, no explosion into words. Texts are then grouped by their vote
pattern and hard limit, at most ``2 * 3 ** len(RULES)`` rows whatever the input,
and these counts are all that reaches the driver.

Defined cases: null and empty texts have no words and are not kept; repeated
rows and null ids get a result row each; an empty table gives an empty one
(the rules then keep their starting rates). Other columns are not read.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, let, positions, space_words

SPAN = 5  # words of a window that may repeat

# Frequent function words of the four languages.
FUNCTION_WORDS = (
    "the of and to in a is that it was for on are as with be by this at from "
    "der die und in den von zu das mit sich des auf ist im dem nicht ein eine "
    "de la le et les des en un du une que est pour qui dans par au sur pas "
    "el y a los del se las por con no para al lo como su").split()


def _covered(grams: Column) -> Column:
    """Words in windows that occur twice or more: windows sorted by hash and
    place stand next to their equals; the places of those, in order, each cover
    the words up to the next one, SPAN at most."""
    entries = F.array_sort(F.transform(grams, lambda g, i: F.struct(g.alias("g"), i.alias("i"))))

    def again(s):
        near = lambda x, i, d: F.get(s, i + d)["g"] == x["g"]
        twice = F.filter(s, lambda x, i: F.coalesce(near(x, i, -1), F.lit(False))
                         | F.coalesce(near(x, i, 1), F.lit(False)))
        return F.array_sort(F.transform(twice, lambda x: x["i"]))

    def words(p):
        steps = F.transform(p, lambda x, i: F.coalesce(F.least(
            F.get(p, i + 1) - x, F.lit(SPAN)), F.lit(SPAN)))
        return F.aggregate(steps, F.lit(0), lambda a, x: a + x)

    return let(let(entries, again), words)


def repeated_words(words: Column) -> Column:
    """Words of the array that lie in a SPAN-word window found more than once."""
    grams = F.transform(positions(F.size(words) - (SPAN - 1)),
                        lambda i: F.xxhash64(F.slice(words, i + 1, SPAN)))
    return let(grams, lambda g: F.when(F.size(F.array_distinct(g)) == F.size(g), F.lit(0))
               .otherwise(_covered(g))).cast("long")


def measures(text: Column) -> Column:
    """Struct of the measures the rules look at."""
    text = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    common = F.array(*[F.lit(w) for w in dict.fromkeys(FUNCTION_WORDS)])

    def of(words):
        n = F.size(words).cast("long")
        return F.struct(
            n.alias("n_words"),
            F.char_length(F.concat_ws("", words)).cast("long").alias("word_chars"),
            F.regexp_count(text, F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
            let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
            let(lines, F.size).cast("long").alias("n_lines"),
            repeated_words(words).alias("n_repeat_words"),
            F.size(F.array_distinct(words)).cast("long").alias("n_distinct"),
            F.size(F.array_intersect(words, common)).cast("long").alias("n_common"),
            F.regexp_count(text, F.lit("[A-Z]")).cast("long").alias("n_upper"),
            (F.char_length(text) - F.char_length(F.replace(text, F.lit("!"), F.lit("")))
             ).cast("long").alias("n_exclaim"))

    return let(space_words(text), of)


def _share(a: str, b: str) -> Column:
    return F.col(a) / F.greatest(F.col(b), F.lit(1))


def _vote(bad: Column, good: Column) -> Column:
    return F.when(bad, -1).when(good, 1).otherwise(0)


def _between(a: str, b: str, low: float, high: float) -> Column:
    return (_share(a, b) >= low) & (_share(a, b) <= high)


# Rules that each kind of bad text is expected to trip; where the fit starts,
# not what it is held to.
KINDS = {
    "noise": ("symbols",),
    "gibberish": ("common_words", "word_length"),
    "repetition": ("repeats", "lines", "variety"),
    "shouting": ("capitals", "exclamations"),
    "fragment": ("length",),
}

# name -> vote over the measures: bad at one end, good at the other, silent
# between them.
RULES = {
    "symbols": lambda: _vote(_share("n_symbols", "n_words") > 0.25, _share("n_symbols", "n_words") < 0.05),
    "repeats": lambda: _vote(_share("n_repeat_words", "n_words") > 0.2, F.col("n_repeat_words") == 0),
    "lines": lambda: _vote(_share("n_dup_lines", "n_lines") > 0.3, F.col("n_dup_lines") == 0),
    "word_length": lambda: _vote(~_between("word_chars", "n_words", 2, 15), _between("word_chars", "n_words", 3, 12)),
    "capitals": lambda: _vote(_share("n_upper", "word_chars") > 0.3, _share("n_upper", "word_chars") < 0.1),
    "variety": lambda: _vote(_share("n_distinct", "n_words") < 0.1, _share("n_distinct", "n_words") > 0.3),
    "common_words": lambda: _vote((F.col("n_common") == 0) & (F.col("n_words") >= 50), F.col("n_common") >= 3),
    "exclamations": lambda: _vote(_share("n_exclaim", "n_words") > 0.1, _share("n_exclaim", "n_words") < 0.02),
    "length": lambda: _vote(F.col("n_words") < 10, F.col("n_words") >= 50),
}

MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20


def base_failed() -> Column:
    return ((F.col("n_words") < MIN_WORDS)
            | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PERCENT))


def votes() -> list[Column]:
    return [rule().cast("int").alias(f"vote_{name}") for name, rule in RULES.items()]


# Shares and rates of bad votes that the fit starts from. The thresholds of the
# rules are such that a good text rarely trips one: ``GOOD_TRIPS`` is the prior
# of that rate and weighs as much as all texts together, at every size. The
# other priors weigh as much as one text.
GOOD_SHARE = 0.9
GOOD_TRIPS = 0.002
KIND_TRIPS, OTHER_TRIPS = 0.9, 0.1


def _start() -> tuple[np.ndarray, np.ndarray]:
    """Shares of the classes (good first, then the kinds) and, per class and
    rule, the share of bad votes among its votes."""
    share = np.array([GOOD_SHARE, *[(1 - GOOD_SHARE) / len(KINDS)] * len(KINDS)])
    trips = [[GOOD_TRIPS] * len(RULES)]
    trips += [[KIND_TRIPS if r in own else OTHER_TRIPS for r in RULES] for own in KINDS.values()]
    return share, np.array(trips)


def fit(measured: DataFrame, rounds: int = 100) -> dict:
    """Rates of the rules and shares of the classes by EM.

    ``measured`` has the measures as columns. Returns ``share`` (of good
    texts), ``good`` and ``bad`` (per vote column, how often it is right on good
    and on bad texts, of those it votes on), and what ``posterior`` needs:
    ``shares`` per class and ``trips``, the rates of bad votes per class and rule.
    """
    names = [f"vote_{n}" for n in RULES]
    table = (measured.select(*votes(), base_failed().alias("failed"))
                     .groupBy(*names, "failed").agg(F.count(F.lit(1)).alias("n")).collect())
    table.sort(key=lambda r: [*(r[c] for c in names), r["failed"]])
    vote = np.array([[r[c] for c in names] for r in table]).reshape(len(table), len(names))
    n = np.array([r["n"] for r in table], dtype=float)
    failed = np.array([r["failed"] for r in table], dtype=bool)
    against, voted = (vote < 0).astype(float), (vote != 0).astype(float)
    first_share, first = share, trips = _start()
    weight = np.array([n.sum(), *[1.0] * len(KINDS)])[:, None]
    part = np.zeros((len(table), len(share)))
    for _ in range(rounds if table else 0):
        odds = np.log(share) + against @ np.log(trips).T + (voted - against) @ np.log(1 - trips).T
        odds[failed, 0] = -np.inf
        part = np.exp(odds - odds.max(axis=1, keepdims=True))
        part *= (n / part.sum(axis=1))[:, None]
        share = (part.sum(axis=0) + first_share) / (n.sum() + 1)
        trips = (part.T @ against + weight * first) / (part.T @ voted + weight)
    bad = part[:, 1:].sum(axis=1)
    wrong = (bad @ against + first[1:].mean(axis=0)) / (bad @ voted + 1)
    return {"share": float(share[0]), "good": dict(zip(names, (1 - trips[0]).tolist())),
            "bad": dict(zip(names, wrong.tolist())),
            "shares": share.tolist(), "trips": trips.tolist()}


def posterior(model: dict) -> Column:
    """Probability of a good text from the vote columns."""
    against_good = F.lit(0.0)
    for share, trips in zip(model["shares"][1:], model["trips"][1:]):
        odds = F.lit(math.log(share / model["shares"][0]))
        for name, kind, good in zip(RULES, trips, model["trips"][0]):
            vote = F.col(f"vote_{name}")
            odds = odds + (F.when(vote < 0, math.log(kind / good))
                            .when(vote > 0, math.log((1 - kind) / (1 - good))).otherwise(0.0))
        against_good = against_good + F.exp(odds)
    return F.lit(1.0) / (F.lit(1.0) + against_good)


def score_texts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                model: dict | None = None) -> DataFrame:
    """Per input row: id, the measures, the votes, ``p_good``, ``base_failed``
    and ``kept``. Without a ``model`` the rules are fitted on these texts: the
    measures, a narrow table, are written once and read for both steps."""
    measured = df.select(F.col(id_col), measures(F.col(text_col)).alias("__m")).select(id_col, "__m.*")
    if model is None:
        measured = Scratch(df.sparkSession, "quality-rules").write(measured, "measures")
        model = fit(measured)
    voted = measured.select("*", *votes(), base_failed().alias("base_failed"))
    scored = voted.withColumn("p_good", posterior(model))
    return scored.withColumn("kept", ~F.col("base_failed") & (F.col("p_good") >= 0.5))


def keep_texts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows whose text is kept, all columns as they are. The texts are read
    twice (fit, filter), never shuffled."""
    model = fit(docs.select(measures(F.col(text_col)).alias("__m")).select("__m.*"))
    held = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"),
                       measures(F.col(text_col)).alias("__m")).select("__row", "__m.*")
    verdict = held.where(~base_failed()).select("__row", *votes()).where(posterior(model) >= 0.5)
    return verdict.select(*[F.col("__row")[c].alias(c) for c in docs.columns])
