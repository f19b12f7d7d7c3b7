"""Noun lemmatisation (T8) as a join against the dictionary.

For each distinct token the candidate lemmas are the token itself and the
results of the noun suffix rules whose suffix it ends with; candidates not in
the dictionary are discarded; the shortest remaining candidate wins (ties
alphabetical); no candidate -> the token is unchanged. Optional exceptions
``(form, lemma)`` take precedence when given.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Noun suffix detachment rules (suffix, replacement), in order.
NOUN_RULES = (
    ("s", ""), ("ses", "s"), ("ves", "f"), ("xes", "x"), ("zes", "z"),
    ("ches", "ch"), ("shes", "sh"), ("men", "man"), ("ies", "y"),
)


def lemma_candidates(token):
    """array<string>: the token and every rule result that applies to it."""
    t = F.col(token) if isinstance(token, str) else token
    outs = [F.when(t.endswith(suf) & (F.length(t) >= len(suf)),
                   F.concat(F.substr(t, F.lit(1), F.length(t) - len(suf)), F.lit(rep)))
            for suf, rep in NOUN_RULES]
    return F.filter(F.array(t, *outs), lambda x: x.isNotNull())


def lemma_table(vocab: DataFrame, lexicon: DataFrame, token: str = "token",
                exceptions: DataFrame | None = None) -> DataFrame:
    """``(token, lemma)`` for distinct tokens whose lemma differs from the token."""
    distinct = vocab.select(token).distinct()
    cands = distinct.select(token, F.explode(lemma_candidates(token)).alias("cand"))
    known = cands.join(lexicon.select(F.col("word").alias("cand")), "cand", "left_semi")
    best = (known.groupBy(token)
                 .agg(F.min_by("cand", F.struct(F.length("cand"), F.col("cand"))).alias("lemma")))
    if exceptions is not None:
        exc = exceptions.select(F.col("form").alias(token), F.col("lemma").alias("exc"))
        best = (best.join(exc, token, "full")
                    .select(token, F.coalesce("exc", "lemma").alias("lemma")))
    return best.where(F.col("lemma") != F.col(token))
