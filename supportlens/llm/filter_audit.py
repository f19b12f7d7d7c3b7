"""How filters interact: every order of five filters, step by step (operator 12).

A document fails a set of the five filters, one of 32 masks. Everything asked
for follows from how many documents of a part (here: a language) have which
mask, so the documents are read once and counted into (part, mask) cells. For
each part the 32 subsets of active filters are walked in Gray-code order: one
filter is toggled at a time, each cell keeps a counter of its active failures,
and a cell enters or leaves the running survivors when its counter reaches or
leaves 0. The survivors of all 32 states are stored; a step of an order is the
difference of two of them.

Whether an equal text stands under a smaller id is found without gathering the
copies: documents are counted per (text digest, part, mask, labels) with the
smallest id, after which a text has a row per combination however many copies
there are, and only those rows meet in the window that knows the smallest id
of all.

Defined cases: a null text is empty (it fails A, and E if another null or empty
text has a smaller id); a null part is the empty string; rows that share the
smallest id of a text all pass E; a null id is larger than all others, and
rows with one do not fail each other. A document is good or toxic if any of its label
rows says so; labels without a document, null labels and null label ids do nothing. An
empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

from hashlib import sha256
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ship_package
from .common import Scratch

FILTERS = "ABCDE"
SUBSETS = 1 << len(FILTERS)
UPPER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SYMBOLS = b"#$%&*|"
EARLIER = 1 << FILTERS.index("E")  # the one condition that needs other documents

COUNTS = ("n", "good", "toxic")


def own_failures(text: bytes) -> int:
    """Mask of the conditions A to D on one UTF-8 text."""
    words = text.split()  # on exactly the six ASCII white-space bytes
    n, distinct = len(words), len(set(words))
    points = len(text) if text.isascii() else len(text.decode())
    capitals = len(text) - len(text.translate(None, UPPER))
    return ((n < 200) | (100 * distinct < 50 * n) << 1 | (100 * capitals > 3 * points) << 2
            | (len(text.translate(None, SYMBOLS)) != len(text)) << 3)


def document_masks(docs: DataFrame, part_col: str = "lang", id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """Per row: ``doc``, ``part``, ``digest`` of the text, ``mask`` of A to D."""
    ship_package(docs.sparkSession)
    schema = T.StructType([T.StructField("doc", docs.schema[id_col].dataType), T.StructField("part", T.StringType()),
                           T.StructField("digest", T.BinaryType()), T.StructField("mask", T.IntegerType())])

    def run(batches):
        for batch in batches:
            texts = [t.as_py() or b"" for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([sha256(t).digest() for t in texts], pa.binary()),
                 pa.array([own_failures(t) for t in texts], pa.int32())], names=schema.names)

    part = F.coalesce(F.col(part_col).cast("string"), F.lit(""))
    return docs.select(F.col(id_col).alias("doc"), part.alias("part"),
                       F.col(text_col).cast("binary").alias("body")).mapInArrow(run, schema)


def mask_cells(docs: DataFrame, labels: DataFrame, scratch: Scratch, part_col: str = "lang",
               id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(``part``, ``mask`` of A to E, ``n``, ``good``, ``toxic``): documents per cell."""
    marks = labels.groupBy(F.col(id_col).alias("lid")).agg(
        F.coalesce(F.max(F.col("quality") == 1), F.lit(False)).alias("good"),
        F.coalesce(F.max(F.col("toxic") == 1), F.lit(False)).alias("toxic"))
    masks = document_masks(docs, part_col, id_col, text_col)
    marked = masks.join(marks, F.col("doc") == F.col("lid"), "left").select(
        "doc", "part", "digest", "mask", F.coalesce("good", F.lit(False)).alias("good"),
        F.coalesce("toxic", F.lit(False)).alias("toxic"))
    kind = ["digest", "part", "mask", "good", "toxic"]
    # the same document twice, then the copies of a text: (smallest id, its rows)
    rows = marked.groupBy("doc", *kind).agg(F.count(F.lit(1)).alias("c"))
    first = F.min(F.struct(F.col("doc").isNull().alias("none"), "doc", "c"))
    texts = scratch.write(rows.groupBy(*kind).agg(F.sum("c").alias("n"), first.alias("first")), "texts")
    least = F.min(F.struct("first.none", "first.doc")).over(Window.partitionBy("digest"))
    holds = F.struct("first.none", "first.doc").eqNullSafe(F.col("least"))
    # of a combination that holds the smallest id, the rows with that id pass E
    split = texts.withColumn("least", least).select(
        "part", "mask", "good", "toxic", "n", F.when(holds, F.col("first.c")).otherwise(0).alias("pass"))
    each = split.select("part", "good", "toxic", F.explode(F.array(
        F.struct(F.col("mask").alias("mask"), F.col("pass").alias("n")),
        F.struct(F.col("mask").bitwiseOR(EARLIER).alias("mask"), (F.col("n") - F.col("pass")).alias("n")))).alias("e"))
    only = lambda c: F.sum(F.when(F.col(c), F.col("e.n")).otherwise(0)).alias(c)
    return each.where("e.n > 0").groupBy("part", "e.mask").agg(F.sum("e.n").alias("n"), only("good"), only("toxic"))


def walk(cells: np.ndarray) -> np.ndarray:
    """Survivors of every set of active filters: ``cells`` and the result have
    a row per mask (of failures, of active filters) and a column per count."""
    active_failures = np.zeros(SUBSETS, dtype=np.int64)
    bits = np.arange(SUBSETS)
    survivors = cells.sum(axis=0)
    states = np.empty_like(cells)
    states[0] = survivors
    state = 0
    for i in range(1, SUBSETS):
        toggled = i & -i  # the bit in which the i-th Gray code differs from the one before
        state ^= toggled
        fails = (bits & toggled) != 0
        if state & toggled:
            leaves = fails & (active_failures == 0)
            active_failures[fails] += 1
            survivors = survivors - cells[leaves].sum(axis=0)
        else:
            active_failures[fails] -= 1
            survivors = survivors + cells[fails & (active_failures == 0)].sum(axis=0)
        states[state] = survivors
    return states


def subset_states(cells: DataFrame) -> DataFrame:
    """(``part``, ``active`` mask, survivors ``n``, ``good``, ``toxic``, and
    ``cell``: documents with exactly that mask), 32 rows per part."""
    ship_package(cells.sparkSession)
    schema = T.StructType([T.StructField("part", T.StringType()), T.StructField("active", T.IntegerType()),
                           *[T.StructField(c, T.LongType()) for c in (*COUNTS, "cell")]])

    def run(batches):
        for batch in batches:
            for part, entries in zip(*batch.columns):
                grid = np.zeros((SUBSETS, len(COUNTS)), dtype=np.int64)
                for e in entries.as_py():
                    grid[e["mask"]] = [e[c] for c in COUNTS]
                states = walk(grid)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part.as_py()] * SUBSETS, pa.string()), pa.array(range(SUBSETS), pa.int32()),
                     *[pa.array(states[:, i]) for i in range(len(COUNTS))], pa.array(grid[:, 0])], names=schema.names)

    by_part = cells.groupBy("part").agg(F.collect_list(F.struct("mask", *COUNTS)).alias("cells"))
    return by_part.mapInArrow(run, schema)


def order_steps(states: DataFrame) -> DataFrame:
    """Every step of every order as differences of stored states: ``part``,
    ``filter_order``, ``step``, ``kept``, ``removed``, ``redundant``,
    ``unique_fails``, ``good_lost``, ``toxic_lost``, ``shapley``."""
    spark = states.sparkSession
    plan = []
    for order in permutations(FILTERS):
        before = 0
        for step, letter in enumerate(order, 1):
            bit = 1 << FILTERS.index(letter)
            plan.append(("".join(order), step, before, before | bit, bit))
            before |= bit
    steps = F.broadcast(spark.createDataFrame(
        plan, "filter_order string, step int, before int, after int, bit int"))  # 600 rows
    entry = F.struct("active", *COUNTS, "cell")
    table = states.groupBy("part").agg(F.array_sort(F.collect_list(entry)).alias("at"))
    at = lambda mask, what: F.element_at("at", F.col(mask) + 1)[what]
    lost = lambda what: at("before", what) - at("after", what)
    # one row per part and first subset, then the steps that leave that subset
    rows = table.select("part", "at", F.explode(F.sequence(F.lit(0), F.lit(SUBSETS - 1))).alias("before"))
    rows = rows.join(steps, "before")
    fails = F.element_at("at", F.lit(1))["n"] - at("bit", "n")  # of this filter alone, among all
    out = rows.select("part", "filter_order", "step", "bit", at("after", "n").alias("kept"), lost("n").alias("removed"),
                      (fails - lost("n")).alias("redundant"), at("bit", "cell").alias("unique_fails"),
                      lost("good").alias("good_lost"), lost("toxic").alias("toxic_lost"))
    shapley = F.sum("removed").over(Window.partitionBy("part", "bit")).alias("shapley")
    return out.select("*", shapley).drop("bit")


def audit(docs: DataFrame, labels: DataFrame, part_col: str = "lang", id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """``order_steps`` of the documents' cells."""
    scratch = Scratch(docs.sparkSession, "filter-audit")
    cells = scratch.write(mask_cells(docs, labels, scratch, part_col, id_col, text_col), "cells")
    states = scratch.write(subset_states(cells), "states")
    scratch.drop("texts", "cells")
    return order_steps(states)
