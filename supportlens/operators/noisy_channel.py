"""Spelling correction in context (T6) as a noisy channel.

A text is the likeliest sequence of intended words. A word follows another
with an interpolated bigram probability learned from a corpus, and an intended
word is written with d edits (Damerau-Levenshtein, d <= 2) at a cost of
``EDIT`` each. Costs are whole thousandths of natural logarithms, so sums are
exact and the same on every engine.

No frequency makes a word "known": a token is open to correction only if some
corpus word explains it better on its own, i.e. is so much more frequent that
the likelihood ratio outweighs the edits (``e**(EDIT/1000)``, about 200, for
each). Ratios do not move as a corpus grows with its misspellings. Open tokens
then compete with their candidates along the whole text: a lattice with a node
per candidate, solved by dynamic programming, of equal costs the
alphabetically first.

Plan. Word counts are a table; of the corpus' bigrams only those are counted
that some lattice asks for, a small part of them all. Candidates are joined on
delete keys for distinct tokens, dealt over all tasks before their keys are
made; only words frequent enough to win against anything get keys (at two
edits: the square of the ratio), and only tokens rare enough to lose. Of each row only its open tokens travel, edges are costed once per
distinct pair of words, and the path is found row by row in Arrow batches.
Rows meet their candidates by a hash of their tokens, which equal texts share
and rows without a key too: no key holds a group of unlike rows together, and
a collision only adds entries that are not looked up.
"""

from __future__ import annotations

import math

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import text as tx
from ..session import materialize, scratch_scope, ship_package
from .spelling import LETTER_RUN_RE, _spread, delete_keys, dl_distance_upto2

EDIT = 5_300     # cost of an edit: an intended word is 200 times likelier written as it is
SEEN = 0.25      # occurrences that every word is credited with
CONTEXT = 0.7    # share of the bigram estimate; the rest goes by the word alone
MIN_TOKEN = 2    # single characters are left alone
ASKED = 2_000_000  # up to so many pairs of words are broadcast to the corpus; for more all its bigrams are counted


def _letter_runs(text) -> Column:
    return F.regexp_extract_all(F.lower(tx.as_text(text)), F.lit(LETTER_RUN_RE), 0)


def word_counts(corpus: DataFrame, text: str = "text") -> DataFrame:
    """(``word``, ``freq``) of all lower-cased letter runs: nothing is cut."""
    return (corpus.select(F.explode(_letter_runs(text)).alias("word"))
                  .groupBy("word").agg(F.count(F.lit(1)).alias("freq")))


def bigram_counts(corpus: DataFrame, text: str = "text", asked: DataFrame | None = None) -> DataFrame:
    """(``a``, ``b``, ``n``): letter runs that follow one another, all of them
    or those in ``asked`` (``a``, ``b``, whose hashes are broadcast) and the
    few that share a hash with one; counts are exact either way."""
    runs = corpus.select(_letter_runs(text).alias("w")).where(F.size("w") > 1)
    last = F.size("w") - 1
    pairs = F.arrays_zip(F.slice("w", F.lit(1), last).alias("a"), F.slice("w", F.lit(2), last).alias("b"))
    pairs = runs.select(F.inline(pairs).alias("a", "b"))
    if asked is not None:
        h = F.xxhash64("a", "b").alias("h")
        pairs = pairs.select("a", "b", h).join(F.broadcast(asked.select(h).distinct()), "h", "left_semi")
    return pairs.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n"))


class Channel:
    """Written word counts of a corpus, for use on any number of texts, and its
    bigrams as far as they are asked for."""

    def __init__(self, corpus: DataFrame, text: str = "text", scope: scratch_scope | None = None):
        self.corpus, self.text = corpus, text
        self.words = materialize(word_counts(corpus, text), scope=scope)
        total, distinct, top = self.words.agg(F.sum("freq"), F.count("word"), F.max("freq")).first()
        self.mass, self.top = (total or 0) + SEEN * distinct, top or 0

    def bigrams(self, asked: DataFrame, scope: scratch_scope | None = None) -> DataFrame:
        """(``a``, ``b``, ``n``) of the corpus' bigrams, of those in ``asked`` at least."""
        rows = asked.count()
        if not rows:
            return asked.select("a", "b", F.lit(0).cast("long").alias("n"))
        return materialize(bigram_counts(self.corpus, self.text, asked if rows <= ASKED else None), scope=scope)

    def share(self, freq: Column) -> Column:
        return (freq + F.lit(SEEN)) / F.lit(self.mass)

    def alone(self, freq: Column) -> Column:
        """Cost of a word without context."""
        return _cost(self.share(freq))


def _cost(p: Column) -> Column:
    return F.floor(-1000 * F.log(p)).cast("long")


def _least_freq(edits: int) -> int:
    """No word below this frequency explains even an unseen token better."""
    return max(1, math.floor(SEEN * math.exp(EDIT * edits / 1000) - SEEN) - 1)


def candidates(vocab: DataFrame, channel: Channel, token: str = "token",
               scope: scratch_scope | None = None) -> DataFrame:
    """(``token``, ``w``, ``e``): for distinct tokens that are open to
    correction every word that explains them better, and themselves; ``e`` is
    the cost of the edits."""
    if channel.top < _least_freq(1):
        return vocab.select(F.col(token).alias("token"), F.lit("").alias("w"), F.lit(0).cast("long").alias("e")).limit(0)
    known = channel.words.withColumn("cost", channel.alone(F.col("freq")))
    costs = known.select(F.col("word").alias("t"), "cost")
    unseen = channel.alone(F.lit(0))
    tokens = (vocab.select(F.col(token).alias("t")).where(F.length("t") >= MIN_TOKEN).join(costs, "t", "left")
                   .withColumn("cost", F.coalesce("cost", unseen))
                   # of the likeliest word an edit away, not even that would do
                   .where(F.col("cost") > channel.alone(F.lit(channel.top)) + EDIT))
    words = known.where((F.col("freq") >= _least_freq(1)) & (F.length("word") >= MIN_TOKEN)).select(
        F.col("word").alias("w"), F.col("freq").alias("f"), F.col("cost").alias("word_cost"))
    # A vocabulary is a small file that makes many keys: one task would make them all.
    keys = lambda df, c: _spread(df, c).select("*", F.inline(delete_keys(F.col(c))))
    t_keys, w_keys = keys(tokens, "t"), keys(words, "w")
    found = None
    for d in (1, 2):
        near = F.col("edits") == 1 if d == 1 else F.lit(True)
        rare = F.col("cost") > channel.alone(F.lit(channel.top)) + EDIT * d
        strong = F.col("f") >= _least_freq(d)
        pairs = (t_keys.where(near & rare).drop("edits").join(w_keys.where(near & strong).drop("edits"), "key")
                       .where((F.col("t") != F.col("w")) & (F.abs(F.length("t") - F.length("w")) <= d)
                              & (F.col("word_cost") + EDIT * d < F.col("cost")))
                       .select("t", "w").distinct())
        if d == 2:  # two letters may not turn into two others
            pairs = pairs.where(F.greatest(F.length("t"), F.length("w")) > 2)
        here = (pairs.withColumn("d", dl_distance_upto2(F.col("t"), F.col("w"))).where(F.col("d") == d)
                     .select(F.col("t").alias("token"), "w", (F.col("d") * EDIT).cast("long").alias("e")))
        found = here if found is None else found.union(here)
    found = materialize(found, scope=scope)
    itself = found.select("token").distinct().select("token", F.col("token").alias("w"), F.lit(0).cast("long").alias("e"))
    return found.union(itself)


def lattice_edges(tokens: list[str], options: dict[str, list]) -> set[tuple[str, str]]:
    """Pairs of neighbouring words with an open token among them; '' begins a text."""
    out, before, was_open = set(), [""], False
    for t in tokens:
        now = [w for w, _ in options[t]] if t in options else [t]
        if t in options or was_open:
            out.update((a, b) for a in before for b in now)
        before, was_open = now, t in options
    return out


def best_path(tokens: list[str], options: dict[str, list], cost: dict[tuple[str, str], int]) -> list[str]:
    """The cheapest word for each token. ``options``: (word, cost of the edits)
    of open tokens; ``cost`` of the ``lattice_edges``."""
    layer: dict[str, int] = {"": 0}
    steps: list[dict[str, str]] = []
    was_open = False
    for t in tokens:
        is_open = t in options
        if not (is_open or was_open):  # nothing to choose: costs do not matter
            steps.append({t: next(iter(layer))})
            layer = {t: 0}
            continue
        came: dict[str, str] = {}
        new: dict[str, int] = {}
        for w, e in options[t] if is_open else [(t, 0)]:
            new[w], came[w] = min((c + cost[a, w], a) for a, c in layer.items())
            new[w] += e
        steps.append(came)
        layer, was_open = new, is_open
        if not is_open:  # one node: the costs before it are settled
            layer = {t: 0}
    if not steps:
        return []
    word = min((c, w) for w, c in layer.items())[1]
    path = []
    for came in reversed(steps):
        path.append(word)
        word = came[word]
    return path[::-1]


def correct_tokens(rows: DataFrame, channel: Channel, tokens: str = "tokens",
                   scope: scratch_scope | None = None) -> DataFrame:
    """All rows and columns with ``corrected``, the token array after correction."""
    ship_package(rows.sparkSession)
    keep = [c for c in rows.columns if c != "corrected"]
    base = materialize(rows.select(F.struct(*keep).alias("row"), F.col(tokens).alias("t"),
                                   F.xxhash64(tokens).alias("rid")), scope=scope)
    each = base.select("rid", F.explode(F.array_distinct("t")).alias("token"))
    vocab = materialize(each.select("token").distinct(), scope=scope)
    options = materialize(candidates(vocab, channel, scope=scope).groupBy("token").agg(
        F.sort_array(F.collect_list(F.struct("w", "e"))).alias("c")), scope=scope)
    marked = each.join(options.select("token"), "token").distinct().join(options, "token")
    lattice = materialize(marked.groupBy("rid").agg(F.collect_list(F.struct("token", "c")).alias("open")), scope=scope)

    def as_options(value) -> dict[str, list]:
        return {o["token"]: [(x["w"], x["e"]) for x in o["c"]] for o in value or ()}

    pair = T.StructType([T.StructField("rid", T.LongType()), T.StructField("a", T.StringType()),
                         T.StructField("b", T.StringType())])

    def edges_of(batches):
        for batch in batches:
            out = [(rid.as_py(), a, b) for rid, t, o in zip(*batch.columns)
                   for a, b in lattice_edges(t.as_py(), as_options(o.as_py()))]
            r, a, b = zip(*out) if out else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array(r, pa.int64()), pa.array(a, pa.string()), pa.array(b, pa.string())], names=pair.names)

    edges = materialize(base.join(lattice, "rid").select("rid", "t", "open").mapInArrow(edges_of, pair).distinct(), scope=scope)
    side = lambda c: channel.words.select(F.col("word").alias(c), F.col("freq").alias(f"f_{c}"))
    asked = materialize(edges.select("a", "b").distinct(), scope=scope)
    known = (asked.join(channel.bigrams(asked, scope), ["a", "b"], "left")
                  .join(side("a"), "a", "left").join(side("b"), "b", "left"))
    alone = channel.share(F.coalesce("f_b", F.lit(0)))
    follows = F.coalesce(F.lit(CONTEXT) * F.col("n") / F.col("f_a"), F.lit(0.0)) + F.lit(1 - CONTEXT) * alone
    costs = materialize(known.select("a", "b", F.when(F.col("a") == "", _cost(alone)).otherwise(_cost(follows)).alias("cost")),
                        scope=scope)
    costed = edges.join(costs, ["a", "b"]).groupBy("rid").agg(F.collect_list(F.struct("a", "b", "cost")).alias("edges"))
    full = base.join(lattice, "rid", "left").join(costed, "rid", "left").select("row", "t", "open", "edges")
    schema = T.StructType([T.StructField("row", base.schema["row"].dataType), T.StructField("corrected", T.ArrayType(T.StringType()))])

    def solve(batches):
        for batch in batches:
            out = []
            for t, o, e in zip(*batch.columns[1:]):
                words = t.as_py()
                if o.is_valid:
                    cost = {(x["a"], x["b"]): x["cost"] for x in e.as_py()}
                    words = best_path(words, as_options(o.as_py()), cost)
                out.append(words)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.list_(pa.string()))], names=schema.names)

    done = full.mapInArrow(solve, schema)
    return done.select(*[F.col("row")[c].alias(c) for c in keep], "corrected")


def correct_texts(df: DataFrame, key: str, text: str, channel: Channel, scope: scratch_scope | None = None) -> DataFrame:
    """(key, ``tokens`` after T1-T5, ``corrected``) of every input row."""
    rows = df.select(key, tx.basic_tokens(text).alias("tokens"))
    return correct_tokens(rows, channel, scope=scope)


def rewrite_share(corrected: DataFrame) -> DataFrame:
    """One row: token occurrences, how many were rewritten, and their share."""
    changed = F.size(F.filter(F.arrays_zip("tokens", "corrected"), lambda p: p["tokens"] != p["corrected"]))
    return corrected.select(F.size("tokens").alias("n"), changed.alias("c")).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("tokens"), F.coalesce(F.sum("c"), F.lit(0)).alias("rewritten")).select(
        "tokens", "rewritten", F.round(F.col("rewritten") / F.greatest("tokens", F.lit(1)), 6).alias("share"))
