"""Benchmark decontamination as a prefix-filtered set join (operator 3).

The windows of the benchmark items (``width`` consecutive words; a shorter
item is one window) are looked for in every document. Containment must be
whole, so the necessary prefix of a window, its words ordered by how often
they occur in the documents, is its rarest word: a document word is joined
with the windows it is the rarest word of, the place of the word bounds where
the window would start and end, and the words there are compared.

Only DataFrame functions: the documents' words are exploded, joined with the
broadcast prefix table and verified within one stage, so nothing but true
occurrences is shuffled. The windows are broadcast in blocks of at most
``BLOCK`` rows, one pass over the documents for each block.

Defined cases: null and empty texts have no words; items without words are
never found; equal items are all reported; the windows of an item with a null
id are looked for and hit, but the item, having no name, is neither listed nor
counted; rows with the same id and text, and
null ids, get a result row each; empty tables give empty results or documents
without hits. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, alnum_words, positions

WIDTH = 10
BLOCK = 200_000  # windows broadcast at once (about 30 MB)


def _windows(items: DataFrame, width: int) -> DataFrame:
    """(``item_id``, ``window``) of every item."""
    words = items.select("item_id", alnum_words(F.col("text")).alias("w")).where(F.size("w") > 0)
    last = F.greatest(F.size("w") - width + 1, F.lit(1))
    at = words.select("item_id", "w", F.explode(positions(last)).alias("i"))
    return at.select("item_id", F.slice("w", F.col("i") + 1, width).alias("window"))


def word_counts(documents: DataFrame, vocabulary: DataFrame, words: Column) -> DataFrame:
    """How often the words of a (broadcast) vocabulary occur in all documents."""
    return (documents.select(F.explode(words).alias("word"))
                     .join(F.broadcast(vocabulary), "word", "left_semi")
                     .groupBy("word").agg(F.count(F.lit(1)).alias("n")))


def prefix_table(scratch: Scratch, documents: DataFrame, windows: DataFrame,
                 words: Column) -> DataFrame:
    """``windows`` with the rarest word of each and its offset: rows
    (``wid``, ``block``, ``word``, ``offset``, ``window``)."""
    vocab = scratch.write(windows.select(F.explode("window").alias("word")).distinct(), "vocabulary")
    parts = max(1, -(-vocab.count() // BLOCK))
    counts = None
    for i in range(parts):  # one part unless the benchmark has a very large vocabulary
        part = vocab.where(F.pmod(F.xxhash64("word"), F.lit(parts)) == i) if parts > 1 else vocab
        some = word_counts(documents, part, words)
        counts = some if counts is None else counts.union(some)
    counts = scratch.write(counts, "counts")
    each = windows.select("wid", F.posexplode("window").alias("offset", "word"))
    rarest = (each.join(counts, "word", "left")
                  .groupBy("wid").agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "word",
                                                     "offset")).alias("r")))
    return windows.join(rarest, "wid").select("wid", "block", "r.word", "r.offset", "window", "r.n")


def occurrences(scratch: Scratch, documents: DataFrame, benchmark: DataFrame, width: int, id_col: str,
                text_col: str, item_col: str, item_text: str) -> tuple[DataFrame, DataFrame]:
    """Written tables: (``id``, ``h``, ``start``, ``end``, ``wid``) of every
    window found, h being the hash of the text, and (``wid``, ``item_id``)."""
    docs = documents.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    items = benchmark.select(F.col(item_col).cast("string").alias("item_id"),
                             F.col(item_text).alias("text"))
    # Windows are numbered by their digest: the same in every attempt of a task.
    wid = F.md5(F.concat_ws(" ", "window"))
    of_item = scratch.write(_windows(items, width).distinct().select(wid.alias("wid"), "item_id", "window"),
                            "of_item")
    distinct = scratch.write(of_item.select("wid", "window").distinct(), "distinct")
    blocks = max(1, -(-distinct.count() // BLOCK))
    windows = distinct.select("wid", F.pmod(F.xxhash64("wid"), F.lit(blocks)).alias("block"), "window")
    words = alnum_words(F.col("text"))
    prefix = scratch.write(prefix_table(scratch, docs, windows, words).where("n > 0"), "prefix")
    hits = None
    for i in range(blocks):
        some = _occurrences(docs, prefix.where(F.col("block") == i) if blocks > 1 else prefix, words)
        hits = some if hits is None else hits.union(some)
    hits = scratch.write(hits, "hits")
    scratch.drop("prefix", "distinct", "counts", "vocabulary")
    return hits, of_item.select("wid", "item_id")


def contaminated_words(documents: DataFrame, benchmark: DataFrame, width: int = WIDTH,
                       id_col: str = "doc_id", text_col: str = "text",
                       item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """Per document row: id, ``n_words``, ``n_hit``, ``spans`` (merged word
    ranges, end exclusive) and ``items`` (ids with occurring windows, as sorted
    strings)."""
    scratch = Scratch(documents.sparkSession, "decontamination")
    hits, of_item = occurrences(scratch, documents, benchmark, width, id_col, text_col, item_col, item_text)
    span = F.struct(F.col("start"), F.col("end"))
    found = hits.groupBy("id", "h").agg(F.sort_array(F.collect_set(span)).alias("spans"))
    named = (hits.select("id", "h", "wid").distinct().join(of_item, "wid")
                 .groupBy("id", "h").agg(F.sort_array(F.collect_set("item_id")).alias("items")))
    same = lambda a, b: a["id"].eqNullSafe(b["id"]) & (a["h"] == b["h"])
    found = scratch.write(found.join(named, same(found, named)).select(
        found["id"], found["h"], _merged(F.col("spans")).alias("spans"), "items"), "found")
    scratch.drop("hits", "of_item")

    words = alnum_words(F.col("text"))
    base = documents.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).select(
        "id", F.xxhash64("text").alias("h"), F.size(words).cast("long").alias("n_words"))
    none = F.array().cast("array<struct<start:int,end:int>>")
    spans = F.coalesce("spans", none)
    covered = F.aggregate(spans, F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"])
    return base.join(found, same(base, found), "left").select(
        base["id"].alias(id_col), "n_words", covered.alias("n_hit"), spans.alias("spans"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"))


def drop_contaminated(documents: DataFrame, benchmark: DataFrame, width: int = WIDTH,
                      id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
                      item_text: str = "text") -> DataFrame:
    """The rows, all columns as they are, in whose text no window occurs."""
    scratch = Scratch(documents.sparkSession, "decontamination")
    hits, _ = occurrences(scratch, documents, benchmark, width, id_col, text_col, item_col, item_text)
    bad = scratch.write(hits.select("id", "h").distinct(), "bad").toDF("__bad_id", "__bad_h")
    scratch.drop("hits", "of_item")
    return documents.join(bad, documents[id_col].eqNullSafe(bad["__bad_id"])
                          & (F.xxhash64(documents[text_col]) == bad["__bad_h"]), "left_anti")


def _occurrences(docs: DataFrame, prefix: DataFrame, words: Column) -> DataFrame:
    """(``id``, ``h``, ``start``, ``end``, ``wid``) of every window found."""
    each = docs.select("id", "text", words.alias("w")).select(
        "id", "text", "w", F.posexplode("w").alias("pos", "word"))
    length = F.size("window")
    start = F.col("pos") - F.col("offset")
    # posexplode, join and comparison run in one stage: the word array of a
    # document is referred to, not copied, for each of its words
    return (each.join(F.broadcast(prefix.select("word", "offset", "window", "wid")), "word")
                .where((start >= 0) & (start + length <= F.size("w")))
                .where(F.slice("w", start + 1, length) == F.col("window"))
                .select("id", F.xxhash64("text").alias("h"), start.alias("start"),
                        (start + length).alias("end"), "wid"))


def _merged(spans: Column) -> Column:
    """Sorted ranges with overlapping and touching ones made one. Each range
    gives up what an earlier one covers: windows start in ascending order and
    the one before reaches furthest or is as long as its item."""
    kind = "struct<done:array<struct<start:int,end:int>>,s:int,e:int>"
    start = F.struct(F.array().cast("array<struct<start:int,end:int>>").alias("done"),
                     F.lit(-1).alias("s"), F.lit(-1).alias("e")).cast(kind)

    def step(a, x):
        apart = x["start"] > a["e"]
        closed = F.when(apart & (a["e"] >= 0), F.concat(a["done"], F.array(
            F.struct(a["s"].alias("start"), a["e"].alias("end"))))).otherwise(a["done"])
        return F.struct(closed.alias("done"), F.when(apart, x["start"]).otherwise(a["s"]).alias("s"),
                        F.greatest(a["e"], x["end"]).alias("e")).cast(kind)

    return F.aggregate(spans, start, step, lambda a: F.when(a["e"] >= 0, F.concat(a["done"], F.array(
        F.struct(a["s"].alias("start"), a["e"].alias("end"))))).otherwise(a["done"]))
