"""Ranked lexical search with Block-Max MaxScore (operator 13).

Index. Documents are cut into shards of bounded size as they stream through
their scan partition; nothing is shuffled. A shard holds a row per term: its
postings (document, frequency) as varint bytes in blocks, one block per window
of ``WINDOW`` document places, and for each block the pairs of (frequency,
document length) that no other pair of the block beats. An entry grows with the
frequency and shrinks with the length, so the largest entry of a block is that of one of these
pairs, exactly, whatever the collection's totals turn out to be: block maxima are known before a
block is decompressed, and adding documents does not outdate an index.

Search. Terms of the items meet their rows by an equi-join on the term; a task
gets a shard's rows for a block of items. Per item, windows run in falling
order of the sum of their block maxima until that sum is below the k-th best
score so far. In a window, the lists whose global maxima together stay below
that score are non-essential: documents that stand in these alone are never
looked at. The essential lists propose candidates; a non-essential block is
decompressed only if some candidate's score plus the block maxima that are
left can still reach the k-th best. Shard heaps of k rows per item are merged
by a window over (item), which Spark trims to k rows in every task first.

Score of a document, in 64-bit integers: the sum over the item's distinct
terms of ``w * (10**9 * tf // (1000 * tf + 8 * m))`` with ``w = floor(1000 *
ln((2N + 2) / (2 df + 1)))`` and ``m = 10 + 90 * n * N // L``.

Defined cases: null and empty texts have no terms, are no documents to rank
and items without results. Equal scores go by ascending id, null ids last.
Rows that share an id are documents of their own and may both be ranked;
item rows with equal id and text are one item, equal ids with different
texts are ranked apart. Empty tables give no rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ship_package
from .common import Scratch, alnum_words

WINDOW = 512              # document places per block
SHARD_DOCS = 8_192
SHARD_POSTINGS = 4_000_000
PIECE = 1 << 20           # bytes of a text that are tokens at one time
ITEM_BLOCK = 500          # items that a task searches for together, on average
OUT_ROWS = 20_000         # rows per batch handed to Spark

_LETTERS = bytes(range(48, 58)) + bytes(range(97, 123)) + bytes(range(128, 256))
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b in _LETTERS else 32 for b in range(256))


# --- codes ------------------------------------------------------------------

def varints(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Seven bits a byte, the lowest first; (bytes, end of each value)."""
    size = np.ones(len(values), dtype=np.int64)
    bits = 7
    while len(values) and bits < 63 and (more := values >> bits).any():
        size += more > 0
        bits += 7
    ends = np.cumsum(size)
    out = np.empty(int(ends[-1]) if len(ends) else 0, dtype=np.uint8)
    for j in range(int(size.max(initial=0))):
        at = size > j
        out[(ends - size)[at] + j] = (values[at] >> (7 * j) & 127) | ((size[at] > j + 1) << 7)
    return out, ends


def read_varints(data: np.ndarray) -> np.ndarray:
    last = data < 128
    if last.all():
        return data.astype(np.int64)
    ends = np.flatnonzero(last)
    starts = np.concatenate([[0], ends[:-1] + 1])
    place = np.arange(len(data)) - np.repeat(starts, ends - starts + 1)
    return np.add.reduceat((data & 127).astype(np.int64) << (7 * place), starts)


# --- index ------------------------------------------------------------------

def _pieces(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text, a piece at a time."""
    at = 0
    while at < len(text):
        end = min(len(text), at + PIECE)
        if end < len(text):  # cut at a separator; a term longer than a piece stays whole
            while end < len(text) and _FOLD[text[end]] != 32:
                end += 1
        yield text[at:end].translate(_FOLD).split()
        at = end


class _Numbers(dict):
    def __missing__(self, term: bytes) -> int:
        n = self[term] = len(self)
        return n


class _Shard:
    """Postings of the documents taken so far."""

    def __init__(self, window: int = WINDOW):
        self.window = window
        self.terms, self.ids, self.lens = _Numbers(), [], []
        self.term: list[np.ndarray] = []
        self.tf: list[np.ndarray] = []
        self.sizes: list[int] = []
        self.postings = 0

    def add(self, doc: pa.Array, text: bytes) -> None:
        counts: np.ndarray | None = None
        numbers = None
        for words in _pieces(text):
            each = np.fromiter(map(self.terms.__getitem__, words), dtype=np.int64, count=len(words))
            got, n = np.unique(each, return_counts=True)
            if numbers is None:
                numbers, counts = got, n
            else:
                numbers, inverse = np.unique(np.concatenate([numbers, got]), return_inverse=True)
                counts = np.bincount(inverse, np.concatenate([counts, n])).astype(np.int64)
        if numbers is None or not len(numbers):
            return
        self.ids.append(doc)
        self.lens.append(int(counts.sum()))
        self.term.append(numbers)
        self.tf.append(counts)
        self.sizes.append(len(numbers))
        self.postings += len(numbers)

    def rows(self, shard: int, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        lens = np.array(self.lens, dtype=np.int64)
        ids = pa.concat_arrays(self.ids)
        yield _batch(schema, shard=pa.array([shard]), ids=_lists(ids, [0, len(ids)]),
                     lens=_lists(pa.array(lens), [0, len(lens)]))
        place = np.repeat(np.arange(len(lens)), self.sizes)
        term, tf = np.concatenate(self.term), np.concatenate(self.tf)
        order = np.argsort(term, kind="stable")
        place, term, tf = place[order], term[order], tf[order]
        window = place // self.window
        starts = _starts(term * (int(window[-1]) + len(lens)) + window)      # of blocks
        heads = _starts(term)                                                # of terms
        count = np.diff(np.append(starts, len(term)))
        gap = np.diff(place, prepend=0)
        gap[starts] = place[starts] - window[starts] * self.window
        data, ends = varints(np.stack([gap, tf], axis=1).ravel())
        block_end = ends[2 * (starts + count) - 1]
        # the blocks of term t are those from first[t] to first[t + 1]
        first = np.append(np.searchsorted(starts, heads), len(starts))
        byte0 = np.append(0, block_end)[first]
        tops, top_tf, top_n = _fronts(np.repeat(np.arange(len(starts)), count), lens[place], tf)
        top0 = np.append(0, tops)[first]
        names = list(self.terms)
        per_block = np.diff(first)
        table = _batch(
            schema, shard=pa.array(np.full(len(heads), shard)),
            term=pa.array([names[t] for t in term[heads]], pa.binary()).cast(pa.string()),
            df=pa.array(np.diff(np.append(heads, len(term)))),
            windows=_lists(pa.array(window[starts].astype(np.int32)), first),
            counts=_lists(pa.array(count.astype(np.int32)), first),
            ends=_lists(pa.array((block_end - np.repeat(byte0[:-1], per_block)).astype(np.int32)), first),
            tops=_lists(pa.array((tops - np.repeat(top0[:-1], per_block)).astype(np.int32)), first),
            top_tf=_lists(pa.array(top_tf), top0), top_n=_lists(pa.array(top_n), top0),
            data=pa.Array.from_buffers(pa.binary(), len(heads), [
                None, pa.py_buffer(byte0.astype(np.int32).tobytes()), pa.py_buffer(data.tobytes())]))
        for at in range(0, table.num_rows, OUT_ROWS):
            yield table.slice(at, OUT_ROWS)


def _starts(key: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.diff(key, prepend=key[0] - 1 if len(key) else 0))


def _lists(values: pa.Array, ends) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.asarray(ends, dtype=np.int32)), values)


def _batch(schema: pa.Schema, **columns) -> pa.RecordBatch:
    n = len(columns["shard"])
    return pa.RecordBatch.from_arrays(
        [columns[f.name].cast(f.type) if f.name in columns else pa.nulls(n, f.type) for f in schema], schema=schema)


def _fronts(block: np.ndarray, n: np.ndarray, tf: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per block (ascending numbers) the postings that no other one with a
    smaller length and a frequency as large makes useless: (end of each
    block's pairs, frequencies, lengths)."""
    order = np.argsort(block * (int(n.max()) + 1) + n, kind="stable")
    level = block[order] * (int(tf.max()) + 1) + tf[order]
    best = np.maximum.accumulate(level)
    keep = order[np.append(True, level[1:] > best[:-1])]
    return np.cumsum(np.bincount(block[keep])), tf[keep], n[keep]


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
                shard_docs: int = SHARD_DOCS, shard_postings: int = SHARD_POSTINGS) -> DataFrame:
    """Index rows: per shard one row with ``ids`` and ``lens`` of its documents
    (``term`` null), and a row per term."""
    ship_package(docs.sparkSession)
    ints, longs = T.ArrayType(T.IntegerType()), T.ArrayType(T.LongType())
    schema = T.StructType([
        T.StructField("shard", T.LongType()), T.StructField("term", T.StringType()), T.StructField("df", T.LongType()),
        *[T.StructField(c, ints) for c in ("windows", "counts", "ends", "tops")],
        T.StructField("top_tf", longs), T.StructField("top_n", longs), T.StructField("data", T.BinaryType()),
        T.StructField("ids", T.ArrayType(docs.schema[id_col].dataType)), T.StructField("lens", longs)])
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(schema)

    def run(batches):
        number = TaskContext.get().partitionId() << 32
        shard = _Shard(window)
        for batch in batches:
            for i, text in enumerate(batch.column(1)):
                shard.add(batch.column(0).slice(i, 1), text.as_py() or b"")
                if len(shard.lens) >= shard_docs or shard.postings >= shard_postings:
                    yield from shard.rows(number, arrow)
                    shard, number = _Shard(window), number + 1
        if shard.lens:
            yield from shard.rows(number, arrow)

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("body")).mapInArrow(run, schema)


# --- search -----------------------------------------------------------------

def item_terms(items: DataFrame, id_col: str = "item_id", text_col: str = "text",
               per_block: int = ITEM_BLOCK) -> DataFrame:
    """(``block``, ``term``, ``items``): the items of a block that hold a term."""
    q = items.select(F.struct(F.col(id_col).alias("id"), F.xxhash64(F.col(text_col)).alias("h")).alias("q"),
                     F.array_distinct(alnum_words(F.col(text_col))).alias("terms")).dropDuplicates(["q"])
    blocks = max(1, -(-items.count() // per_block))
    return (q.select(F.pmod(F.xxhash64("q"), F.lit(blocks)).cast("int").alias("block"), "q",
                     F.explode("terms").alias("term"))
             .groupBy("block", "term").agg(F.collect_list("q").alias("items")))


class ShardSearch:
    """The lists of one shard, in flat arrays, and the search over them."""

    def __init__(self, lists: pa.Table, lens: np.ndarray, rank: np.ndarray, n_docs: int, n_terms: int,
                 window: int = WINDOW):
        self.places = window
        flat = {c: lists.column(c).combine_chunks() for c in ("windows", "counts", "ends", "tops", "top_tf", "top_n")}
        value = {c: np.asarray(a.flatten(), dtype=np.int64) for c, a in flat.items()}
        self.first = _offsets(flat["windows"])
        top0 = _offsets(flat["top_tf"])
        self.weight = np.asarray(lists.column("w"), dtype=np.int64)
        self.data = lists.column("data").combine_chunks()
        self.window, self.count, self.end = value["windows"], value["counts"], value["ends"]
        self.rank, self.lens = rank, lens
        self.m = _lengths(lens, n_docs, n_terms)
        owner = np.repeat(np.arange(len(self.weight)), np.diff(self.first))
        begin = np.repeat(top0[:-1], np.diff(self.first))
        # pairs of block b: up to tops[b], from the end of the block before in the same list
        ends = begin + value["tops"]
        starts = np.where(_is_first(self.first, len(owner)), begin, np.append(0, ends[:-1]))
        entry = _entries(value["top_tf"], _lengths(value["top_n"], n_docs, n_terms))
        top = np.maximum.reduceat(entry, starts) * self.weight[owner]
        self.bound = np.zeros((len(self.weight), -(-len(lens) // window)), dtype=np.int64)
        self.bound[owner, self.window] = top
        self.block = np.full(self.bound.shape, -1, dtype=np.int64)
        self.block[owner, self.window] = np.arange(len(owner))
        self.decoded: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        self.looked_up = 0

    def postings(self, row: int, window: int) -> tuple[np.ndarray, np.ndarray]:
        """(places in the window, scores) of a block, decompressed once."""
        b = int(self.block[row, window])
        if b not in self.decoded:
            begin = 0 if b == self.first[row] else int(self.end[b - 1])
            raw = np.frombuffer(self.data[row].as_buffer(), dtype=np.uint8)[begin:int(self.end[b])]
            pair = read_varints(raw)
            place, tf = np.cumsum(pair[0::2]), pair[1::2]
            self.decoded[b] = place, _entries(tf, self.m[place + window * self.places]) * self.weight[row]
            self.looked_up += 1
        return self.decoded[b]

    def best(self, rows: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(places in the shard, scores) of the k best for the lists ``rows``."""
        rows = rows[np.argsort(self.bound[rows].max(axis=1), kind="stable")]
        bound = self.bound[rows]
        reach = np.cumsum(bound.max(axis=1))  # of the first lists together
        total = bound.sum(axis=0)
        places, scores = np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
        least = 1
        for window in np.argsort(-total, kind="stable"):
            if total[window] < least:
                break
            essential = int(np.searchsorted(reach, least))
            acc = np.zeros(self.places, dtype=np.int64)
            for i in range(essential, len(rows)):
                if bound[i, window]:
                    place, score = self.postings(rows[i], window)
                    acc[place] += score
            left = int(bound[:essential, window].sum())
            cand = np.flatnonzero(acc)
            for i in range(essential - 1, -1, -1):
                if not bound[i, window]:
                    continue
                cand = cand[acc[cand] + left >= least]
                if not len(cand):
                    break
                place, score = self.postings(rows[i], window)
                here = np.zeros(self.places, dtype=np.int64)
                here[place] = score
                acc[cand] += here[cand]
                left -= int(bound[i, window])
            cand = cand[acc[cand] >= least]
            if len(cand):
                places = np.concatenate([places, cand + window * self.places])
                scores = np.concatenate([scores, acc[cand]])
                order = np.lexsort((self.rank[places], -scores))[:k]
                places, scores = places[order], scores[order]
                if len(scores) == k:
                    least = max(1, int(scores[-1]))
        return places, scores


def _offsets(lists: pa.ListArray) -> np.ndarray:
    off = np.asarray(lists.offsets, dtype=np.int64)
    return off - off[0]


def _is_first(first: np.ndarray, n: int) -> np.ndarray:
    out = np.zeros(n, dtype=bool)
    out[first[:-1]] = True
    return out


def _lengths(n: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """m of documents with n terms."""
    if len(n) and 90 * int(n.max()) * n_docs >= 1 << 63:
        return np.array([10 + 90 * int(x) * n_docs // n_terms for x in n], dtype=np.int64)
    return 10 + 90 * n * n_docs // n_terms


def _entries(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return 1_000_000_000 * tf // (1000 * tf + 8 * m)


def search(index: DataFrame, items: DataFrame, k: int = 10, item_id: str = "item_id", item_text: str = "text",
           doc_id: str = "doc_id", scratch: Scratch | None = None, per_block: int = ITEM_BLOCK,
           window: int = WINDOW) -> DataFrame:
    """The k best documents of a written index per item: ``item_id``, ``rank``,
    ``doc_id``, ``score``. ``window`` is that of the index."""
    spark = index.sparkSession
    ship_package(spark)
    scratch = scratch or Scratch(spark, "lexical-search")
    shards = index.where("term IS NULL").select(F.col("shard").alias("of"), "ids", "lens")
    lists = index.where("term IS NOT NULL")
    n_docs, n_terms = shards.agg(F.sum(F.size("lens")), F.sum(F.aggregate(
        "lens", F.lit(0).cast("long"), lambda a, x: a + x))).first()
    wanted = scratch.write(item_terms(items, item_id, item_text, per_block), "terms")
    dfs = (lists.join(wanted.select("term").distinct(), "term", "left_semi").groupBy("term").agg(F.sum("df").alias("df")))
    weight = F.floor(1000 * F.log((2 * F.lit(n_docs) + 2) / (2 * F.col("df") + 1))).cast("long")
    weighted = scratch.write(wanted.join(dfs, "term").select("block", "term", "items", weight.alias("w")), "weights")
    blocks = weighted.agg(F.max("block")).first()[0]
    found = lists.join(weighted, "term").select(
        "shard", "block", "w", "items", "windows", "counts", "ends", "tops", "top_tf", "top_n", "data")
    every = shards.select("*", F.explode(F.sequence(F.lit(0), F.lit(blocks or 0))).alias("block"))
    id_type = index.schema["ids"].dataType.elementType
    q_type = weighted.schema["items"].dataType.elementType
    schema = T.StructType([T.StructField("q", q_type), T.StructField("doc", id_type), T.StructField("score", T.LongType())])
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(schema)

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return arrow.empty_table()
        ids = right.column("ids").combine_chunks().flatten()
        lens = np.asarray(right.column("lens").combine_chunks().flatten(), dtype=np.int64)
        rank = np.empty(len(ids), dtype=np.int64)
        rank[np.asarray(pc.sort_indices(ids, null_placement="at_end"))] = np.arange(len(ids))
        shard = ShardSearch(left, lens, rank, n_docs, n_terms, window)
        by_item: dict[tuple, list[int]] = {}
        for row, members in enumerate(left.column("items").to_pylist()):
            for q in members:
                by_item.setdefault((q["id"], q["h"]), []).append(row)
        q, places, scores = [], [], []
        for (i, h), rows in by_item.items():
            at, got = shard.best(np.array(rows), k)
            q += [{"id": i, "h": h}] * len(at)
            places.append(at)
            scores.append(got)
        at = np.concatenate(places)
        return pa.table([pa.array(q, arrow.field("q").type), ids.take(pa.array(at)).cast(arrow.field("doc").type),
                         pa.array(np.concatenate(scores))], schema=arrow)

    heaps = (found.groupBy("shard", "block").cogroup(every.groupBy("of", "block")).applyInArrow(run, schema))
    order = Window.partitionBy("q").orderBy(F.col("score").desc(), F.col("doc").asc_nulls_last())
    return (heaps.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
                 .select(F.col("q.id").alias(item_id), "rank", F.col("doc").alias(doc_id), "score"))


def rank_documents(docs: DataFrame, items: DataFrame, k: int = 10, doc_id: str = "doc_id", text_col: str = "text",
                   item_id: str = "item_id", item_text: str = "text", scratch: Scratch | None = None) -> DataFrame:
    """``search`` over an index of ``docs`` built for it."""
    scratch = scratch or Scratch(docs.sparkSession, "lexical-search")
    index = scratch.write(build_index(docs, doc_id, text_col), "index")
    out = scratch.write(search(index, items, k, item_id, item_text, doc_id, scratch), "ranked")
    scratch.drop("index", "terms", "weights")
    return out
