"""Licence scan as an exact set-similarity join (operator 5).

Two kinds of pattern are looked for: short phrases whose words stand
consecutively, and licence templates as word sets that a text block contains
to at least ``percent`` per cent. A block is any run of twice as many words
as the template has, ``2 * STRIDE`` at least, wherever it starts. A template of
fewer than ``SHORT`` words is found only whole, in blocks of its own length: its
words would turn up apart in any long text.

All pattern words are ordered by their frequency in all documents. A template
of m words that is contained to k = ceil(percent m) words shares one of its
m - k + 1 rarest words with the block (prefix filter); a phrase shares its
rarest. The documents' words are joined with these prefix words, and blocks too
short for k words are left out (length filter). A block belongs to the first
place of the rarest template word in it, so a joined word answers for blocks
without rarer template words and without an earlier place of its own: they lie
between the nearest such words on both sides, and the words from its place in
the order on must come to k there (positional filter); a phrase must fit between
the ends of the text. The shared words are then counted in the blocks that are
left, each block for one joined word only.

Only DataFrame functions; the pattern table is a parameter of a few hundred
words and broadcast. Scan, join and verification are one stage; only found
patterns are shuffled.

Defined cases: null and empty texts have no words and no label; repeated rows
and null ids get a result row each; an empty table gives an empty one. Other
columns are not read.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, alnum_words
from .decontamination import word_counts

# Phrases that stand for a licence by themselves.
PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

# The standard notices of the licences.
TEMPLATES = {
    "mit": "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
           "software and associated documentation files, to deal in the software without "
           "restriction, including without limitation the rights to use, copy, modify, merge, "
           "publish, distribute, sublicense, and/or sell copies of the software",
    "apache-2": "Licensed under the Apache License, Version 2.0; you may not use this file except "
                "in compliance with the License. You may obtain a copy of the License at",
    "bsd": "Redistribution and use in source and binary forms, with or without modification, are "
           "permitted provided that the following conditions are met",
    "gpl": "This program is free software: you can redistribute it and/or modify it under the terms "
           "of the GNU General Public License as published by the Free Software Foundation",
    "gpl-3": "This work is licensed under the GNU General Public License, version 3",
    "mpl-2": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
    "cc-by": "This work is licensed under a Creative Commons Attribution International License",
    "all-rights-reserved": "All rights reserved. No part of this publication may be reproduced or "
                           "transmitted in any form without the prior written permission of the publisher",
}

# Short notices that stand by themselves.
NOTICES = {
    "all-rights-reserved": "All rights reserved",
}

# Whole licence texts, looked for besides the notices.
FULL_TEXTS = {
    "mit": TEMPLATES["mit"] + """, and to permit persons to whom the software is furnished to do so,
        subject to the following conditions: The above copyright notice and this permission notice shall be
        included in all copies or substantial portions of the Software. The software is provided "as is",
        without warranty of any kind, express or implied, including but not limited to the warranties of
        merchantability, fitness for a particular purpose and noninfringement. In no event shall the authors
        or copyright holders be liable for any claim, damages or other liability, whether in an action of
        contract, tort or otherwise, arising from, out of or in connection with the software or the use or
        other dealings in the software""",
    "bsd": TEMPLATES["bsd"] + """: Redistributions of source code must retain the above copyright notice, this
        list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above
        copyright notice, this list of conditions and the following disclaimer in the documentation and/or other
        materials provided with the distribution. This software is provided by the copyright holders and
        contributors "as is" and any express or implied warranties, including, but not limited to, the implied
        warranties of merchantability and fitness for a particular purpose are disclaimed. In no event shall the
        copyright holder or contributors be liable for any direct, indirect, incidental, special, exemplary, or
        consequential damages (including, but not limited to, procurement of substitute goods or services; loss of
        use, data, or profits; or business interruption) however caused and on any theory of liability, whether in
        contract, strict liability, or tort (including negligence or otherwise) arising in any way out of the use
        of this software, even if advised of the possibility of such damage""",
}

STRIDE = 64
PERCENT = 80
SHORT = 6  # words: a shorter template has to stand together


def pattern_words(text: str) -> list[str]:
    return re.findall(r"[0-9a-z\x80-\U0010FFFF]+",
                      re.sub("[A-Z]", lambda m: m[0].lower(), text))


def _pattern_table(spark, phrases: dict, templates: list[tuple[str, str]], percent: int) -> DataFrame:
    """(``pid``, ``label``, ``phrase``, ``words``, ``need``, ``span``: words of a block)."""
    rows = [(f"p{i}", label, True, ws, len(ws), len(ws)) for i, (label, ws) in enumerate(
        (lab, pattern_words(t)) for t, lab in phrases.items())]
    for i, (label, text) in enumerate(templates):
        every = pattern_words(text)
        ws = list(dict.fromkeys(every))
        need, span = math.ceil(len(ws) * percent / 100), 2 * max(STRIDE, len(every))
        rows.append((f"t{i}", label, False, ws, *((len(ws), len(every)) if len(every) < SHORT else (need, span))))
    return spark.createDataFrame(rows, "pid string, label string, phrase boolean, "
                                       "words array<string>, need int, span int")


def _prefixes(patterns: DataFrame, counts: DataFrame) -> DataFrame:
    """Prefix words of each pattern in the global order, the rarest first, with
    their ``offset`` in the pattern, the ``rarer`` pattern words before them in
    the order and the ``rest`` from them on."""
    each = patterns.select("*", F.posexplode("words").alias("offset", "word"))
    known = each.join(F.broadcast(counts), "word", "left")
    entry = F.struct(F.coalesce("n", F.lit(0)).alias("n"), F.col("word"), F.col("offset"))
    ordered = (known.groupBy("pid", "label", "phrase", "words", "need", "span")
                    .agg(F.sort_array(F.collect_list(entry)).alias("o")))
    # phrases: one word of whole containment (a repeated word counts once);
    # templates: m - k + 1
    upto = F.when(F.col("phrase"), F.lit(1)).otherwise(F.size("words") - F.col("need") + 1)
    place = ordered.withColumn("inorder", F.transform("o", lambda e: e["word"])).select(
        "*", F.posexplode(F.slice("o", F.lit(1), upto)).alias("ord", "e"))
    return place.select("e.word", "e.offset", "label", "phrase", "words", "need", "span",
                        F.slice("inorder", F.lit(1), F.col("ord")).alias("rarer"),
                        F.slice("inorder", F.col("ord") + 1, F.size("inorder")).alias("rest"))


def _joined(docs: DataFrame, words: Column, prefix: DataFrame) -> DataFrame:
    """Places of prefix words that a pattern can reach: the whole phrase, or
    ``near``, all words of the blocks that hold the word, which stands ``at``."""
    each = docs.select("id", "text", words.alias("w")).select(
        "id", "text", "w", F.posexplode("w").alias("pos", "word"))
    start = F.col("pos") - F.col("offset")
    same = ((start >= 0) & (start + F.size("words") <= F.size("w"))
            & (F.slice("w", start + 1, F.size("words")) == F.col("words")))
    low = F.greatest(F.col("pos") - F.col("span") + 1, F.lit(0))
    hits = each.join(F.broadcast(prefix), "word").where(
        F.when(F.col("phrase"), same).otherwise(F.size("w") >= F.col("need")))
    return hits.select(
        "id", F.xxhash64("text").alias("h"), "word", "label", "phrase", start.alias("start"), "words", "need",
        "span", "rarer", "rest", (F.col("pos") - low).alias("at"),
        F.when(~F.col("phrase"), F.slice("w", low + 1, F.col("pos") - low + F.col("span"))).alias("near"))


def _enough() -> Column:
    return F.col("phrase") | (F.size(F.array_intersect("rest", "near")) >= F.col("need"))


def _left_open(hits: DataFrame) -> DataFrame:
    """The positional filter: ``near`` cut to the words between the last rarer
    word, or place of the same word, before ``at`` and the first rarer one
    after it, if enough of the words that may follow in the order are there."""
    at, near, rarer = F.col("at"), F.col("near"), F.col("rarer")
    is_rarer = lambda i: F.array_contains(rarer, F.get(near, i))
    before = F.filter(F.when(at > 0, F.sequence(F.lit(0), at - 1)),
                      lambda i: (F.get(near, i) == F.col("word")) | is_rarer(i))
    after = F.filter(F.when(at + 1 < F.size(near), F.sequence(at + 1, F.size(near) - 1)), is_rarer)
    first = F.coalesce(F.array_max(before) + 1, F.lit(0))
    last = F.coalesce(F.get(after, F.lit(0)), F.size(near))
    cut = F.struct(first.alias("first"), F.slice(near, first + 1, last - first).alias("near"))
    enough = lambda b: F.size(F.array_intersect("rest", b["near"])) >= F.col("need")
    # exploded, so that this filter does not join the one before it: places
    # that fail that one must go before their rows are made
    blocks = F.when(F.col("phrase"), F.array(F.lit(None))).otherwise(F.filter(F.array(cut), enough))
    return hits.where(_enough()).withColumn("block", F.explode(blocks)).withColumn(
        "near", F.col("block")["near"]).withColumn("at", at - F.col("block")["first"]).drop("block")


def _block_overlap(near: Column, at: Column, tokens: Column, span: Column) -> Column:
    """The most of ``tokens`` in a block of ``span`` words of ``near`` with the
    word at ``at`` in it; the blocks that matter start with one of them."""
    shared = lambda start: F.size(F.array_intersect(tokens, F.slice(near, start + 1, span)))
    starts = F.filter(F.sequence(F.greatest(at - span + 1, F.lit(0)), at),
                      lambda s: F.array_contains(tokens, F.get(near, s)))
    middle = F.greatest(at - (span / 2).cast("int"), F.lit(0))  # holds most notices whole
    return (F.when(shared(middle) == F.size(tokens), F.size(tokens))
             .otherwise(F.array_max(F.transform(starts, shared))))


def licenses(df: DataFrame, phrases: dict | None = None, templates: dict | None = None,
             percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per input row: id, ``n_words``, ``n_base`` (places of phrases),
    ``first_word``, ``last_word`` (smallest and largest start), ``base_labels``
    and ``labels`` (sorted arrays) and ``score`` (1 for a phrase, else the
    largest share of a template found in a block, 0 without any)."""
    spark = df.sparkSession
    scratch = Scratch(spark, "licenses")
    docs = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    words = alnum_words(F.col("text"))
    wanted = [*TEMPLATES.items(), *NOTICES.items(), *FULL_TEXTS.items()] if templates is None else list(templates.items())
    patterns = _pattern_table(spark, PHRASES if phrases is None else phrases, wanted, percent)
    vocab = patterns.select(F.explode("words").alias("word")).distinct()
    counts = scratch.write(word_counts(docs, vocab, words), "counts")
    prefix = scratch.write(_prefixes(patterns, counts), "prefix")

    hits = _left_open(_joined(docs, words, prefix))
    shared = F.when(F.col("phrase"), F.size("words")).otherwise(
        _block_overlap(F.col("near"), F.col("at"), F.col("rest"), F.col("span")))
    # exploded, so that the count is made once and not again for the filter
    found = hits.select("id", "h", "label", "phrase", "start", F.size("words").alias("m"), F.explode(
        F.filter(F.array(shared), lambda n: n >= F.col("need"))).alias("shared"))
    # rows with the same id and text would count their places twice
    found = scratch.write(found.groupBy("id", "h", "label", "phrase", F.when(
        F.col("phrase"), F.col("start")).alias("start")).agg(
            F.max(F.col("shared") / F.col("m")).alias("score")), "found")
    base = F.col("phrase")
    per = found.groupBy("id", "h").agg(
        F.count(F.when(base, 1)).alias("n_base"),
        F.min(F.when(base, F.col("start"))).cast("long").alias("first_word"),
        F.max(F.when(base, F.col("start"))).cast("long").alias("last_word"),
        F.sort_array(F.collect_set(F.when(base, F.col("label")))).alias("base_labels"),
        F.sort_array(F.collect_set("label")).alias("labels"),
        F.max("score").alias("score"))
    rows = docs.select("id", F.xxhash64("text").alias("h"), F.size(words).cast("long").alias("n_words"))
    none = F.array().cast("array<string>")
    return rows.join(per, rows["id"].eqNullSafe(per["id"]) & (rows["h"] == per["h"]), "left").select(
        rows["id"].alias(id_col), "n_words", F.coalesce("n_base", F.lit(0)).alias("n_base"),
        "first_word", "last_word", F.coalesce("base_labels", none).alias("base_labels"),
        F.coalesce("labels", none).alias("labels"), F.coalesce("score", F.lit(0.0)).alias("score"))
