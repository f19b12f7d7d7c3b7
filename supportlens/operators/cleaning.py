"""The full cleaning recipe (T1-T12) as one Spark job.

T1-T5 and T7 are column expressions. Spelling (T6) and lemmas (T8) depend
only on the token, so they are computed once per *distinct* token and folded,
together with the stop-word filter, into a single rewrite table
``(token, out, drop)`` of the tokens that change or go. Of each row, only its
distinct tokens meet that table, and those that change come back as one map
per key, which is applied to the row's token array in place:

    rows --distinct tokens--> (key, token) --join rewrite--> --group by key--> map
    rows --left join map--> transform(tokens) --> clean

Stop words that the dictionary knows are never corrected, so they are filtered
out before anything is exploded. Neither positions nor unchanged tokens are
grouped or sorted. AQE splits the join partition of a hot token and
switches to a broadcast join when the measured rewrite table is small. Rows
keep their own token array: rows without tokens come out as '', and rows that
share a key, or have none, are cleaned each for itself.

The distinct vocabulary and the rewrite table are materialised (in the shared
folder): each is read by several plan branches, and a retried final stage
never repeats the spelling join. The input is read three times: materialise
it first if it is costly.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as tx
from ..session import materialize, scratch_scope
from . import lemmas, spelling


def explode_tokens(df: DataFrame, key: str, text: str, split_expansions: bool = True,
                   outer: bool = False) -> DataFrame:
    """(key, pos, token) after T1-T5."""
    gen = F.posexplode_outer if outer else F.posexplode
    return df.select(key, gen(tx.basic_tokens(text, None, split_expansions)).alias("pos", "token"))


def rewrite_table(tokens: DataFrame, lexicon: DataFrame, correct: bool = True,
                  lemmatize: bool = True, stop_words=tx.ENGLISH_STOP_WORDS,
                  lexicon_keys: DataFrame | None = None, exceptions: DataFrame | None = None,
                  scope: scratch_scope | None = None) -> DataFrame:
    """``(token, out, drop)`` for every distinct token that changes or is dropped."""
    vocab = materialize(tokens.where(F.col("token").isNotNull()).select("token").distinct(), scope=scope)
    if correct:
        corr = spelling.correction_table(vocab, lexicon, lexicon_keys=lexicon_keys, scope=scope)
        step = (vocab.join(corr, "token", "left")
                     .select("token", F.coalesce("suggestion", "token").alias("w")))
    else:
        step = vocab.select("token", F.col("token").alias("w"))
    drop = tx.is_stop_word(F.col("w"), stop_words) if stop_words else F.lit(False)
    step = step.withColumn("drop", drop)
    if lemmatize:
        # A corrected word is a vocabulary token or a dictionary word: lemmas of
        # both sets, so this branch does not re-run the spelling join.
        words = vocab.unionByName(lexicon.select(F.col("word").alias("token")))
        lem = lemmas.lemma_table(words, lexicon, exceptions=exceptions).select(F.col("token").alias("w"), "lemma")
        step = (step.join(lem, "w", "left")
                    .select("token", "drop",
                            F.when(F.col("drop"), None).otherwise(F.coalesce("lemma", "w")).alias("w")))
    out = (step.where(F.col("drop") | (F.col("w") != F.col("token")))
               .select("token", F.col("w").alias("out"), "drop"))
    return materialize(out, scope=scope)


def clean_tokens(df: DataFrame, key: str, text: str, lexicon: DataFrame, correct: bool = True,
                 lemmatize: bool = True, stop_words=tx.ENGLISH_STOP_WORDS,
                 split_expansions: bool = True,
                 lexicon_keys: DataFrame | None = None) -> DataFrame:
    """(key, pos, token, out) with out NULL for dropped tokens and for rows without tokens."""
    toks = explode_tokens(df, key, text, split_expansions, outer=True)
    rw = rewrite_table(toks, lexicon, correct, lemmatize, stop_words, lexicon_keys=lexicon_keys)
    return (toks.join(rw, "token", "left")
                .select(key, "pos", "token",
                        F.when(F.coalesce("drop", F.lit(False)), None)
                         .otherwise(F.coalesce("out", "token")).alias("out")))


def known_stop_words(lexicon: DataFrame, stop_words) -> list[str]:
    """Stop words the dictionary knows (at most the length of the list)."""
    words = list(stop_words or ())
    return [r[0] for r in lexicon.where(F.col("word").isin(words)).select("word").distinct().collect()] \
        if words else []


def clean_columns(df: DataFrame, key: str, cols: list[str], lexicon: DataFrame,
                  correct: bool = True, lemmatize: bool = True,
                  stop_words=tx.ENGLISH_STOP_WORDS, split_expansions: bool = True,
                  prefix: str = "clean_", lexicon_keys: DataFrame | None = None,
                  exceptions: DataFrame | None = None, scope: scratch_scope | None = None) -> DataFrame:
    """T11 + T12 together: clean several text columns of one table with a
    single vocabulary and one rewrite table. Output: key and ``prefix + col``
    for every column, one row per input row.

    ``lexicon_keys``: a prebuilt ``spelling.dictionary_keys(lexicon)`` to share
    across calls (e.g. stream micro-batches). ``exceptions``: (form, lemma)
    pairs that go before the lemma rules, e.g. irregular plurals."""
    gone = known_stop_words(lexicon, stop_words)

    def tokens(c: str):
        t = tx.basic_tokens(c, None, split_expansions)
        return F.filter(t, lambda w: ~w.isin(gone)) if gone else t

    names = [f"__tokens_{i}" for i in range(len(cols))]
    rows = df.select(F.col(key), *[tokens(c).alias(n) for c, n in zip(cols, names)])
    every = F.array_distinct(F.concat(*names)) if len(names) > 1 else F.array_distinct(names[0])
    each = rows.select(F.col(key).alias("__key"), F.explode(every).alias("token"))
    rewrite = rewrite_table(each, lexicon, correct, lemmatize, stop_words, lexicon_keys, exceptions, scope)
    # one entry per changed token of a key (rows that share a key agree on it)
    changed = (each.join(rewrite, "token").select(
        "__key", "token", F.when(~F.col("drop"), F.col("out")).alias("out")).distinct()
        .groupBy("__key").agg(F.map_from_entries(F.collect_list(F.struct("token", "out"))).alias("__map")))
    both = rows.join(changed, rows[key].eqNullSafe(changed["__key"]), "left")

    def cleaned(name: str):
        swap = lambda t: F.when(F.map_contains_key("__map", t),
                                F.try_element_at("__map", t)).otherwise(t)
        out = F.filter(F.transform(name, swap), lambda t: t.isNotNull())
        return tx.join_tokens(F.when(F.col("__map").isNull(), F.col(name)).otherwise(out))

    return both.select(rows[key], *[cleaned(n).alias(prefix + c) for c, n in zip(cols, names)])


def clean_texts(df: DataFrame, key: str, text: str, lexicon: DataFrame, correct: bool = True,
                lemmatize: bool = True, stop_words=tx.ENGLISH_STOP_WORDS,
                split_expansions: bool = True, lexicon_keys: DataFrame | None = None,
                exceptions: DataFrame | None = None, scope: scratch_scope | None = None) -> DataFrame:
    """(key, clean, length) for every input row (no tokens -> '', 0).
    The arguments are those of ``clean_columns``."""
    out = clean_columns(df, key, [text], lexicon, correct, lemmatize, stop_words, split_expansions,
                        "__clean_", lexicon_keys, exceptions, scope)
    return out.select(key, F.col(f"__clean_{text}").alias("clean")).withColumn(
        "length", tx.token_count("clean"))
