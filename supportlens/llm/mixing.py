"""Mixing sources to target weights by Pfair scheduling (operator 10).

The rows of a source are cut into blocks. Block j of a source with weight w is
released at slot floor(j / w) and due by slot ceil((j + 1) / w); one block runs
per slot, of the released ones that with the earliest deadline. All blocks
meet their deadlines, so after any number of slots t each source is less than
one block off its share w * t.

Weights are taken as they are, as exact fractions, and nothing repeats. The
schedule is cut into segments of about ``STRETCH`` blocks, each played by a task
of its own and written as one row per ``block`` rows. What has run before a
segment needs no earlier segment: a block whose deadline has passed has run,
and of the at most one block per source that is released but not due, those
run that come first by deadline and still fit beside the others (``done_before``).
A lost task plays its own segment again. Rows are numbered within
their source without gathering it: by hash into buckets of about
``BUCKET`` rows, counted, the counts summed up over the buckets, and numbered
inside the bucket. A source that holds a third of all rows is as many buckets. The slots
of a bucket's blocks join it as one array.

No row is dropped or repeated. The first source that runs out leaves its slot
empty; the bound holds for all sources up to there (``on_target``). The others
go on inside their windows, in slots that would be those of a source without
rows too; slots in which no block is released stay empty.

Defined cases: rows with a null source are a source of their own; null ids and
repeated rows are rows like others; sources without a weight or with a
negative one raise an error unless weights are left out (then in proportion to
the square root of their size); sources of weight 0 come after all others; an empty table gives an empty one; columns named like the added ones
are replaced.
"""

from __future__ import annotations

import heapq
import math
from bisect import bisect_left
from collections.abc import Iterator, Sequence
from fractions import Fraction
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import ship_package
from .common import Scratch

BLOCK = 64
BUCKET = 4_096
STRETCH = 1 << 17  # blocks that one task schedules
LAST = (1 << 63) - 1
BATCH = 50_000  # schedule rows that a scheduling task holds


def done_before(parts: Sequence[int], jobs: Sequence[int], slot: int) -> list[int]:
    """How many blocks of each source have run before ``slot``, earliest
    deadline first (equal ones by source), without playing the slots before.

    A set of unit blocks fits before ``slot`` if from every earlier slot s on
    no more of them are released than slots are left, and serving by priority
    runs the set that takes in blocks by priority as long as they fit. All
    blocks due by ``slot`` fit, so only the room that these leave has to be
    known, at its least between the releases of the blocks in question."""
    total = sum(parts)
    due = [min(n, p * slot // total) for p, n in zip(parts, jobs)]
    open_ = sorted((-(-(j + 1) * total // p), i, j * total // p)
                   for i, (p, n, j) in enumerate(zip(parts, jobs, due)) if p and j < n and j * total // p < slot)
    out, room = list(due), slot - sum(due)
    if not open_ or room <= 0:
        return out

    def least_room(s: int) -> int:
        """A lower bound of total * room from any slot up to s on."""
        return sum(min(p * (slot - s), p * slot - j * total) for p, j in zip(parts, due))

    # further back than ``back`` there is room for all, but for the room as a whole
    floor = max(0, min(j * total // p for p, j in zip(parts, due) if p))
    back, step = slot, 1
    while back > floor and least_room(back) < len(open_) * total:
        back, step = max(floor, slot - step), step * 2

    points = sorted({r for _, _, r in open_})
    slack = np.full(len(points), slot, dtype=np.int64)  # least room for s in (points[k - 1], points[k]]

    def releases(p: int, j: int) -> Iterator[int]:
        while j > 0 and (r := (j - 1) * total // p) >= back:
            yield r
            j -= 1

    seen, k = 0, len(points) - 1
    for r in heapq.merge(*[releases(p, j) for p, j in zip(parts, due) if p], reverse=True):
        while k >= 0 and points[k] > r:
            if points[k] >= back:
                slack[k] = min(slack[k], slot - points[k] - seen)
            k -= 1
        seen += 1
        at = bisect_left(points, r)  # the interval that r lies in
        if at < len(points):
            slack[at] = min(slack[at], slot - r - seen)
    for m in range(k, -1, -1):
        if points[m] >= back:
            slack[m] = min(slack[m], slot - points[m] - seen)
    for _, i, r in open_:
        upto = bisect_left(points, r) + 1
        if room > 0 and slack[:upto].min() > 0:
            slack[:upto] -= 1
            room -= 1
            out[i] += 1
    return out


def play(parts: Sequence[int], jobs: Sequence[int], start: int = 0, stop: int | None = None) -> Iterator[tuple]:
    """(source, block, slot, release, deadline) of the blocks that run in slots
    from ``start`` to ``stop``, of sources with ``parts`` of the sum as weight:
    earliest deadline first among released blocks, equal ones by source."""
    total = sum(parts)
    done = done_before(parts, jobs, start) if start else [0] * len(parts)
    # the next block of each source waits for its release or is ready
    waiting = [(j * total // p, i, j) for i, (p, n, j) in enumerate(zip(parts, jobs, done)) if p and j < n]
    heapq.heapify(waiting)
    ready: list[tuple[int, int, int, int]] = []
    slot = start
    while waiting or ready:
        while waiting and waiting[0][0] <= slot:
            r, i, j = heapq.heappop(waiting)
            heapq.heappush(ready, (-(-(j + 1) * total // parts[i]), i, j, r))
        if not ready:
            slot = waiting[0][0]
            continue
        if stop is not None and slot >= stop:
            return
        d, i, j, r = heapq.heappop(ready)
        yield i, j, slot, r, min(d, LAST)
        slot += 1
        if j + 1 < jobs[i]:
            heapq.heappush(waiting, ((j + 1) * total // parts[i], i, j + 1))


def first_end(parts: Sequence[int], blocks: Sequence[int]) -> tuple[int, int]:
    """The source that runs out first and the slot that finds it empty: the
    first slot that serves a block after the last one of any source."""
    total = sum(parts)
    more = [n + 1 for n in blocks]
    over = lambda t: next((i for i, (a, b) in enumerate(zip(
        done_before(parts, more, t), blocks)) if a > b), None)
    low = min(n * total // p for n, p in zip(blocks, parts) if p)
    high = min(-(-(n + 1) * total // p) for n, p in zip(blocks, parts) if p)
    while low + 1 < high:  # nothing is over before slot ``low``, something is before ``high``
        middle = (low + high) // 2
        low, high = (low, middle) if over(middle) is not None else (middle, high)
    return over(high), high - 1


def stretches(parts: Sequence[int], jobs: Sequence[int], size: int) -> list[int]:
    """Slots that cut the schedule into parts of about ``size`` due blocks."""
    total, cuts = sum(parts), [0]
    due = lambda t: sum(min(n, p * t // total) for p, n in zip(parts, jobs))
    last = max((-(-n * total // p) for p, n in zip(parts, jobs) if p), default=0)
    for wanted in range(size, sum(n for p, n in zip(parts, jobs) if p), size):
        low, high = cuts[-1], last
        while low < high:
            middle = (low + high) // 2
            low, high = (middle + 1, high) if due(middle) < wanted else (low, middle)
        if low > cuts[-1]:
            cuts.append(low)
    return cuts


def _ordered(names) -> list:
    return sorted(names, key=lambda s: (s is not None, str(s)))


def whole_parts(weights: Sequence) -> list[int]:
    """Whole numbers in exactly the proportion of the weights."""
    exact = [Fraction(w) for w in weights]
    if any(w < 0 for w in exact) or (exact and not any(exact)):
        raise ValueError("weights are 0 or more, and one at least is above 0")
    scale = math.lcm(*[w.denominator for w in exact])
    return [int(w * scale) for w in exact]


def slot_table(scratch: Scratch, parts: Sequence[int], blocks: Sequence[int]) -> tuple[DataFrame, int]:
    """The schedule of all blocks, written as a table (``i``, ``blk``, ``slot``,
    ``r``, ``d``), and the slot in which a source first runs out. A task plays
    one segment, in batches; sources of weight 0 follow the last slot."""
    spark = scratch.spark
    ship_package(spark)
    kind = "i bigint, blk bigint, slot bigint, r bigint, d bigint"
    if not any(n for p, n in zip(parts, blocks) if p):
        plan, end, last = spark.createDataFrame([], kind), 0, -1
    else:
        ends, end = first_end(parts, blocks)
        jobs = [n + (i == ends) for i, n in enumerate(blocks)]
        cuts = stretches(parts, jobs, max(STRETCH, 64 * len(parts)))

        def run(batches):
            for batch in batches:
                for k in batch.column(0).to_pylist():
                    stop = cuts[k + 1] if k + 1 < len(cuts) else None
                    rows = (x for x in play(parts, jobs, cuts[k], stop) if x[1] < blocks[x[0]])
                    while some := list(islice(rows, BATCH)):
                        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*some)],
                                                         names=["i", "blk", "slot", "r", "d"])

        plan = scratch.write(spark.range(0, len(cuts), 1, len(cuts)).mapInArrow(run, kind), "played")
        last = plan.agg(F.max("slot")).collect()[0][0]
        end = min(end, last + 1)
    slot = last + 1
    for i, (p, n) in enumerate(zip(parts, blocks)):
        if not p and n:
            at = F.col("id") + slot + 1
            plan = plan.union(spark.range(n).select(F.lit(i).cast("long"), "id", at, at, at + 1))
            slot += n
    return plan, end


def source_sizes(docs: DataFrame, source_col: str) -> dict:
    return {r[0]: r[1] for r in docs.groupBy(source_col).count().collect()}


def mix(docs: DataFrame, weights: dict | None = None, source_col: str = "source", block: int = BLOCK,
        seed: int = 17) -> DataFrame:
    """All rows with ``mix_slot``, ``mix_release``, ``mix_deadline`` (slots),
    ``mix_block`` (number within the source), ``mix_offset`` (place in the
    block) and ``on_target``. Reading in order of (slot, offset) gives the mix."""
    added = ("mix_slot", "mix_release", "mix_deadline", "mix_block", "mix_offset", "on_target")
    spark = docs.sparkSession
    docs = docs.drop(*added)
    sizes = source_sizes(docs, source_col)
    if weights is None:
        weights = {s: math.sqrt(n) for s, n in sizes.items()}
    elif missing := sizes.keys() - weights.keys():
        raise ValueError(f"sources without a weight: {sorted(map(str, missing))}")
    names = _ordered(sizes)
    source_type = docs.schema[source_col].dataType.simpleString()
    scratch = Scratch(spark, "mixing")
    plan, end = slot_table(scratch, whole_parts([weights[s] for s in names]),
                           [-(-sizes[s] // block) for s in names])
    facts = spark.createDataFrame([(s, max(1, -(-sizes[s] // BUCKET)), i) for i, s in enumerate(names)],
                                  f"s {source_type}, buckets bigint, i bigint")

    # one struct, so that no column of the table can clash with those below
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    h = F.xxhash64(F.lit(seed), *[F.col(f"`{c}`") for c in docs.columns])
    rows = docs.select(row.alias("row"), F.col(f"`{source_col}`").alias("src"), h.alias("h"))
    rows = rows.join(F.broadcast(facts), F.col("src").eqNullSafe(F.col("s"))).select(
        "row", "i", "h", F.pmod(F.col("h"), F.col("buckets")).alias("bucket"))
    # the bucket counts are one row per BUCKET rows, summed up within groups of
    # BUCKET buckets and over the groups; each gets the slots of its blocks
    counts = rows.groupBy("i", "bucket").agg(F.count(F.lit(1)).alias("n"))
    counts = scratch.write(counts.withColumn("grp", F.floor(F.col("bucket") / BUCKET)), "counts")
    groups = counts.groupBy("i", "grp").agg(F.sum("n").alias("size")).withColumn(
        "base", F.sum("size").over(Window.partitionBy("i").orderBy("grp")) - F.col("size"))
    inside = F.sum("n").over(Window.partitionBy("i", "grp").orderBy("bucket")) - F.col("n")
    ranges = (counts.withColumn("inside", inside).join(groups.select("i", "grp", "base"), ["i", "grp"])
                    .withColumn("before", F.col("base") + F.col("inside"))
                    .withColumn("first", F.floor(F.col("before") / block)))
    each = ranges.select("i", "bucket", "before", "first", F.explode(F.sequence(
        "first", F.floor((F.col("before") + F.col("n") - 1) / block))).alias("blk"))
    offsets = scratch.write(each.join(plan, ["i", "blk"]).groupBy("i", "bucket", "before", "first").agg(
        F.sort_array(F.collect_list(F.struct("slot", "r", "d"))).alias("at")), "offsets")
    number = F.row_number().over(Window.partitionBy("i", "bucket").orderBy("h")) - 1
    placed = rows.withColumn("k", number).join(offsets, ["i", "bucket"])
    index = F.col("before") + F.col("k")
    blk = F.floor(index / block)
    out = placed.select("row", blk.alias("blk"), F.pmod(index, F.lit(block)).alias("off"),
                        F.col("at")[(blk - F.col("first")).cast("int")].alias("x"))
    return out.select(*[F.col("row")[c].alias(c) for c in docs.columns],
                      F.col("x.slot").alias("mix_slot"), F.col("x.r").alias("mix_release"),
                      F.col("x.d").alias("mix_deadline"), F.col("blk").alias("mix_block"),
                      F.col("off").alias("mix_offset"),
                      (F.col("x.slot") < F.lit(end)).alias("on_target"))
