"""Near-duplicate groups by bottom-k sketches of one hash function (operator 6).

A text is the set of its word shingles, a shingle a 64-bit hash; its sketch is
the k smallest hashes. Texts link when their Jaccard similarity reaches the
threshold, and groups are the connected components of the links.

1. Texts with equal sets become one class, represented by its smallest id.
2. Inverted lists of the retained values give overlaps. A pair at the
   threshold shares nearly all of its union sketch, so a class that shares
   fewer than ``_least_shared`` of its values with anyone is on its own, and
   only the rarest values of a sketch (prefix filter) need lists at all:
   values of passages that very many texts quote drop out.
3. In each list everyone is paired with one leader, the member with the fewest
   values of its own. Union-sketch estimates filter these pairs, the Jaccard
   similarity of the full sets decides, components follow. The work is linear
   in the lists, whatever their length.
4. Lists whose members are still in several components are settled exactly:
   the full sets of their members are joined on their rarest shingles with
   length and positional bounds, members outside the leader's component
   against all. The bounds are compared per (length, position) of a shingle
   before its texts meet. Pairs inside a component are never made.

A sketch misses a link only if a pair at the threshold (0.8 or more) shares
fewer than ``_least_shared`` of k = 64 values, chance below 1e-10, or if fewer
than 0.4 of the union sketch agree, chance below 1e-10 as well; every reported
link is exact on the full sets.

Defined cases: null, empty or white-space texts have no shingles and link with
nothing (``component_id`` = own id). Equal rows and rows that share an id are
one node; each input row gets a result row. A row with a null id is not
compared: null ``component_id``, kept. An empty table gives an empty one. Other
columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ship_package
from .common import Scratch
from .components import connected_components

SKETCH = 64
MIN_SHARED = 26        # of a full sketch, by the bound above at threshold 0.8
BROADCAST_IDS = 500_000  # ids of candidate texts that are broadcast (8 bytes each)


def sketches(df: DataFrame, width: int, k: int = SKETCH, id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """Per row: ``id``, ``n`` (set size), ``sig`` (digest of the set), ``sketch``."""
    ship_package(df.sparkSession)
    schema = T.StructType([T.StructField("id", df.schema[id_col].dataType),
                           T.StructField("n", T.LongType()), T.StructField("sig", T.BinaryType()),
                           T.StructField("sketch", T.ArrayType(T.LongType()))])

    def run(batches):
        import xxhash

        from .shingles import shingle_set

        for batch in batches:
            n, sig, sketch = [], [], []
            for text in batch.column(1):
                s = shingle_set(text.as_py(), width)
                n.append(len(s))
                sig.append(xxhash.xxh3_128_digest(s.tobytes()))
                sketch.append(s[:k])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(sig, pa.binary()),
                 _lists(sketch)], names=["id", "n", "sig", "sketch"])

    return df.select(F.col(id_col), F.col(text_col).cast("binary")).mapInArrow(run, schema)


def _lists(parts: list[np.ndarray]) -> pa.ListArray:
    ends = np.zeros(len(parts) + 1, dtype=np.int32)
    np.cumsum([len(p) for p in parts], out=ends[1:])
    flat = np.concatenate(parts) if parts else np.empty(0, dtype=np.int64)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat, pa.int64()))


def full_sets(df: DataFrame, width: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: ``id`` and the whole ``set``."""
    ship_package(df.sparkSession)
    schema = T.StructType([T.StructField("id", df.schema[id_col].dataType),
                           T.StructField("set", T.ArrayType(T.LongType()))])

    def run(batches):
        from .shingles import shingle_set

        for batch in batches:
            sets = [shingle_set(text.as_py(), width) for text in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), _lists(sets)], names=["id", "set"])

    return df.select(F.col(id_col), F.col(text_col).cast("binary")).mapInArrow(run, schema)


def _least(n: Column, percent: int) -> Column:
    """ceil(percent/100 * n) in integers."""
    return F.floor((n * percent + 99) / 100).cast("int")


def _least_shared(n: Column, m: Column, percent: int) -> Column:
    """Retained values that a text of n shingles, m retained, shares with a
    text at the threshold. Both sketches are whole sets if the smaller could
    not reach beyond k: then the bound is exact; else MIN_SHARED of k."""
    whole = _least(F.lit(SKETCH), percent)
    return F.when(n <= whole, _least(n, percent)).otherwise(F.lit(MIN_SHARED))


def _verify(scratch: Scratch, pairs: DataFrame, known: DataFrame, sets: DataFrame,
            percent: int) -> DataFrame:
    """Pairs (``a``, ``b``) whose full sets reach the threshold."""
    side = lambda df, c, v: df.select(F.col("id").alias(c), F.col(v).alias(f"{v}_{c}"))
    both = pairs.join(side(known, "a", "sketch"), "a").join(side(known, "b", "sketch"), "b")
    union = F.slice(F.array_sort(F.array_union("sketch_a", "sketch_b")), 1, SKETCH)
    shared = F.size(F.array_intersect(union, F.array_intersect("sketch_a", "sketch_b")))
    likely = both.where(shared * 100 >= F.size(union) * (percent - 40)).select("a", "b")
    full = likely.join(side(sets, "a", "set"), "a").join(side(sets, "b", "set"), "b")
    common = F.size(F.array_intersect("set_a", "set_b")).cast("long")
    total = F.size("set_a") + F.size("set_b") - common
    return full.where(common * 100 >= total * percent).select("a", "b")


def near_duplicates(df: DataFrame, width: int = 5, percent: int = 80, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """Per input row: id, ``n_shingles``, ``component_id``, ``kept``."""
    if not 80 <= percent <= 100:
        raise ValueError("the sketch bounds are made for thresholds of 80 % and more")
    spark = df.sparkSession
    scratch = Scratch(spark, "near-dedup")
    rows = scratch.write(sketches(df, width, SKETCH, id_col, text_col), "rows")
    compared = rows.where(F.col("id").isNotNull() & (F.col("n") > 0))

    # 1. classes of equal sets
    groups = scratch.write(compared.groupBy("sig").agg(F.min("id").alias("rep"),
                                                       F.count(F.lit(1)).alias("members"))
                                   .where("members > 1").select("sig", "rep"), "groups")
    member = compared.select("id", "n", "sig", "sketch").join(groups, "sig", "left")
    classes = scratch.write(member.select("id", F.coalesce("rep", "id").alias("rep"), "n", F.when(
        F.coalesce("rep", "id") == F.col("id"), F.col("sketch")).alias("sketch")), "classes")
    reps = classes.where(F.col("sketch").isNotNull())
    # the sketches are the larger part: what comes later reads tables without
    sizes = scratch.write(rows.select("id", "n"), "sizes")
    members = scratch.write(classes.select("id", "rep"), "members")
    scratch.drop("rows", "groups")
    # an id of several texts joins their classes
    mixed = (members.groupBy("id").agg(F.min("rep").alias("a"), F.max("rep").alias("z"))
                    .where("a != z").select("id", "a"))
    same_id = members.select("id", F.col("rep").alias("b")).join(mixed, "id").select("a", "b")

    # 2. inverted lists of retained values
    lists = reps.select("id", "n", F.size("sketch").alias("m"), F.explode("sketch").alias("v"))
    counts = scratch.write(lists.groupBy("v").agg(F.count(F.lit(1)).alias("c")).where("c > 1"),
                           "counts")
    shared = scratch.write(lists.join(counts, "v"), "shared")
    scratch.drop("counts")
    need = _least_shared(F.col("n"), F.col("m"), percent)
    by_id = Window.partitionBy("id")
    rank = F.row_number().over(by_id.orderBy("c", "v"))
    own = F.col("m") - F.count(F.lit(1)).over(by_id)  # values nobody else retained
    lists = scratch.write(
        shared.withColumn("own", own).withColumn("rank", rank)
              .where((F.col("m") - F.col("own") >= need)
                     & (F.col("own") + F.col("rank") <= F.col("m") - need + 1))
              .select("v", "id", "n", (F.col("own") * 1000 / F.col("m")).cast("int").alias("own")),
        "lists")
    scratch.drop("shared")
    ids = scratch.write(lists.select("id").distinct(), "ids")
    known = scratch.write(reps.select("id", "sketch").join(ids, "id", "left_semi"), "known")
    scratch.drop("classes")
    small = ids.count() <= BROADCAST_IDS
    wanted = F.broadcast(ids) if small else ids
    texts = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    sets = scratch.write(full_sets(texts.join(wanted, "id", "left_semi"), width, "id", "text"), "sets")

    # 3. everyone against the leader of the list
    leaders = scratch.write(lists.groupBy("v").agg(F.min(F.struct("own", "id", "n")).alias("l"),
                                                   F.count(F.lit(1)).alias("c"))
                                 .where("c > 1").select("v", "l.id", "l.n")
                                 .toDF("v", "a", "n_a"), "leaders")
    close = F.least("n", "n_a") * 100 >= F.greatest("n", "n_a") * percent
    star = scratch.write(lists.join(leaders, "v").where((F.col("a") != F.col("id")) & close)
                              .select("a", F.col("id").alias("b")).distinct(), "star")
    links = scratch.write(_verify(scratch, star, known, sets, percent), "links")
    comp = connected_components(scratch, links, "first")

    # 4. lists with several components, exactly
    placed = scratch.write(
        lists.join(comp, F.col("id") == F.col("node"), "left")
             .select("v", "id", F.coalesce("component", "id").alias("component")), "placed")
    mixed_lists = placed.groupBy("v").agg(F.min("component").alias("a"), F.max("component").alias("z")) \
                        .where("a != z").select("v")
    mixed_lists = scratch.write(mixed_lists, "mixed")
    open_ids = scratch.write(placed.join(mixed_lists, "v", "left_semi")
                                   .select("id", "component").distinct(), "open")
    more = _rare_shingle_pairs(scratch, sets.join(open_ids, "id"), percent)
    more = scratch.write(more.join(star, ["a", "b"], "left_anti"), "more")
    late = scratch.write(_verify(scratch, more, known, sets, percent), "late")

    edges = links.union(late).union(same_id)
    comp = connected_components(scratch, edges, "final")
    scratch.drop("sets", "lists", "leaders", "star", "placed", "mixed", "open", "more", "known", "rare", "main", "side",
                 "open-places")

    # every row with its class and component
    of_class = scratch.write(
        members.join(comp, F.col("rep") == F.col("node"), "left")
               .groupBy("id").agg(F.min(F.coalesce("component", "rep")).alias("component_id")),
        "components")
    scratch.drop("members", "ids", "links", "late")
    out = sizes.join(of_class, "id", "left")
    component = F.coalesce("component_id", "id")
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"),
                      component.alias("component_id"),
                      F.coalesce(component == F.col("id"), F.lit(True)).alias("kept"))


def _rare_shingle_pairs(scratch: Scratch, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs of different components that can reach the threshold: a set join
    on the rarest shingles with length and positional bounds."""
    tokens = scratch.write(sets.select("id", "component", F.size("set").cast("long").alias("n"),
                                       F.explode("set").alias("v")), "tokens")
    often = scratch.write(tokens.groupBy("v").agg(F.count(F.lit(1)).alias("c")).where("c > 1"), "often")
    order = Window.partitionBy("id").orderBy("c", "v")
    # shingles of one set only come first in the order and match nothing
    single = F.col("n") - F.count(F.lit(1)).over(Window.partitionBy("id"))
    pos = F.row_number().over(order) + single
    prefix = F.col("n") - _least(F.col("n"), percent) + 1
    rare = scratch.write(tokens.join(often, "v").withColumn("pos", pos).where(F.col("pos") <= prefix)
                               .select("v", "id", "component", "n", "pos"), "rare")
    scratch.drop("tokens", "often")
    main = scratch.write(rare.groupBy("v").agg(F.min(F.struct("pos", "id", "component")).alias("l"))
                             .select("v", F.col("l.component").alias("main")), "main")
    side = scratch.write(rare.join(main, "v"), "side")
    left = side.where(F.col("component") != F.col("main"))
    # The length and position of a shingle bound the overlap, so they are
    # compared first, once for all sets that share them: sets that meet on a
    # common passage but cannot reach the threshold are never paired.
    place = ["v", "n", "pos"]
    mine = left.groupBy(*place).agg(F.min("component").alias("first"), F.max("component").alias("last"))
    theirs = rare.groupBy(*place).agg(F.min("component").alias("first2"), F.max("component").alias("last2"))
    theirs = theirs.toDF("v", "n2", "pos2", "first2", "last2")
    # overlap needed: |A n B| >= t/(1+t) (|A| + |B|), in integers
    room = F.least(F.col("n") - F.col("pos"), F.col("n2") - F.col("pos2")) + 1
    several = ((F.col("first") != F.col("first2")) | (F.col("last") != F.col("last2"))
               | (F.col("first") != F.col("last")))  # not all of one component
    open_ = scratch.write(
        mine.join(theirs, "v").where((F.least("n", "n2") * 100 >= F.greatest("n", "n2") * percent)
                                     & (room * (100 + percent) >= (F.col("n") + F.col("n2")) * percent) & several)
            .select("v", "n", "pos", "n2", "pos2"), "open-places")
    right = rare.toDF("v", "id2", "component2", "n2", "pos2")
    keep = ((F.col("component") != F.col("component2"))
            & ((F.col("id") < F.col("id2")) | (F.col("component2") == F.col("main"))))
    found = left.join(open_, place).join(right, ["v", "n2", "pos2"]).where(keep)
    return found.select(F.least("id", "id2").alias("a"), F.greatest("id", "id2").alias("b")).distinct()


def one_per_group(docs: DataFrame, width: int = 5, percent: int = 80, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """The rows that stay, all columns as they are: of each group the one with
    the smallest id (one of the rows that share id and text), and rows with a
    null id. Where rows of one id have different texts, a row is told by id
    and text, so that an id does not join what its texts do not."""
    digest = F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256)
    several = (docs.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("id"))
                   .agg(F.min(F.xxhash64(digest)).alias("a"), F.max(F.xxhash64(digest)).alias("z")).where("a != z"))
    if not several.isEmpty():
        key = "_".join(["key", *docs.columns])  # no column has that name
        node = F.when(F.col(id_col).isNotNull(), F.struct(F.col(id_col).alias("id"), digest.alias("text")))
        return _one_per_group(docs.withColumn(key, node), width, percent, key, text_col).drop(key)
    return _one_per_group(docs, width, percent, id_col, text_col)


def _one_per_group(docs: DataFrame, width: int, percent: int, id_col: str, text_col: str) -> DataFrame:
    scratch = Scratch(docs.sparkSession, "one-per-group")
    found = scratch.write(near_duplicates(docs, width, percent, id_col, text_col)
                          .select(id_col, "kept"), "found")
    gone = found.where(~F.col("kept")).select(id_col).distinct()
    stay = docs.join(gone, id_col, "left_anti").select(*docs.columns)
    again = found.where("kept").where(F.col(id_col).isNotNull()).groupBy(id_col).count().where("count > 1")
    again = scratch.write(again.select(id_col), "again")
    if again.isEmpty():
        return stay
    single = stay.join(again, id_col, "left_semi").select(*docs.columns).dropDuplicates([id_col])
    return stay.join(again, id_col, "left_anti").select(*docs.columns).union(single)
