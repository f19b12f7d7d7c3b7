"""Line deduplication over all documents (operator 11).

A line's key is the line without white space at its ends, A-Z lower-cased; it
is known by 128 bits of BLAKE2b. Of a key that stands in several documents
only the lines of the smallest document id stay. The result is a compressed
bitmap per document, bit i telling whether line i stays; texts are cut from
it afterwards (``kept_texts``).

1. Lines of ``min_chars`` code points and more become rows (key, document,
   position), written once.
2. These are range-partitioned by (key, document, position) and sorted the
   same way. The range is of the whole triple, so a line that a third of all
   documents share is spread over as many partitions as its rows fill.
3. Each partition streams through in Arrow batches with one key and one
   document carried over: the first document of a key keeps its lines, rows of
   later ones are dropped. Only a partition's first key may have begun before;
   its first document's rows stay open until the last key of every partition
   (one row each, broadcast) tells who holds that key first.
4. Dropped positions, not texts, are gathered per document and packed.

Defined cases: a null or empty text is one empty line. Rows with equal id and
text are one document in several rows, each with its result; rows with equal
id and different texts count as one document too (none drops the other's
lines), with a bitmap each. Rows with a null id count as one document after
all others. An empty table gives an empty one. Other columns pass through
``kept_texts`` and are not read; added columns replace those of the same name.
"""

from __future__ import annotations

import io
import zlib
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ship_package
from .common import Scratch

MIN_CHARS = 10
WHITE = b" \t\n\x0b\x0c\r"
FLUSH = 50_000  # line rows held before a batch goes out

DROPPED, OPEN, LAST = 0, 1, 2  # kinds of rows that ``_stream`` emits


def line_key(line: bytes, min_chars: int = MIN_CHARS) -> bytes | None:
    """Normalised line (UTF-8), or None when it is too short to count."""
    key = line.strip(WHITE).lower()
    if len(key) < min_chars or (len(key) < 4 * min_chars and len(key.decode()) < min_chars):
        return None
    return key


def _row_key(text: Column) -> Column:
    """Tells rows of one id with different texts apart."""
    return F.xxhash64(text)


def line_rows(docs: DataFrame, min_chars: int = MIN_CHARS, id_col: str = "doc_id",
              text_col: str = "text") -> DataFrame:
    """(``k1``, ``k2``: key, ``doc``, ``row``, ``pos``) of all lines that count."""
    ship_package(docs.sparkSession)
    schema = T.StructType([
        T.StructField("k1", T.LongType()), T.StructField("k2", T.LongType()),
        T.StructField("doc", docs.schema[id_col].dataType), T.StructField("row", T.LongType()),
        T.StructField("pos", T.LongType())])

    def out(batch, keys, owner, pos):
        k = np.frombuffer(b"".join(keys), dtype=np.int64).reshape(-1, 2)
        at = pa.array(owner, pa.int64())
        return pa.RecordBatch.from_arrays(
            [pa.array(k[:, 0]), pa.array(k[:, 1]), batch.column(0).take(at), batch.column(1).take(at),
             pa.array(pos, pa.int64())], names=["k1", "k2", "doc", "row", "pos"])

    def run(batches):
        for batch in batches:
            keys, owner, pos = [], [], []
            for i, text in enumerate(batch.column(2)):
                for p, line in enumerate(io.BytesIO(text.as_py() or b"")):
                    key = line_key(line, min_chars)
                    if key is not None:
                        keys.append(blake2b(key, digest_size=16).digest())
                        owner.append(i)
                        pos.append(p)
                        if len(keys) >= FLUSH:
                            yield out(batch, keys, owner, pos)
                            keys, owner, pos = [], [], []
            if keys:
                yield out(batch, keys, owner, pos)

    text = F.col(text_col)
    return docs.select(F.col(id_col).alias("doc"), _row_key(text).alias("row"), text.cast("binary").alias("body")).mapInArrow(run, schema)


def _equal(a: pa.Array, b: pa.Array) -> np.ndarray:
    """Equal values, two nulls too."""
    return np.asarray(pc.or_(pc.fill_null(pc.equal(a, b), False), pc.and_(pc.is_null(a), pc.is_null(b))))


def _stream(batches):
    """Rows of one sorted partition -> dropped rows, open rows, its last key."""
    key, first, head = None, None, True
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        k1, k2 = (batch.column(c).to_numpy(zero_copy_only=False) for c in (0, 1))
        doc = batch.column(2)
        if key is None:
            key, first = (k1[0], k2[0]), doc.slice(0, 1)
        new = np.empty(n, dtype=bool)
        new[0] = (k1[0], k2[0]) != key
        new[1:] = (k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1])
        begin = np.maximum.accumulate(np.where(new, np.arange(n), -1))
        known = pa.concat_arrays([first, doc])  # place 0: the key carried over
        same = _equal(known.take(pa.array(begin + 1)), doc)
        in_head = (begin < 0) if head else np.zeros(n, dtype=bool)
        for kind, pick in ((DROPPED, ~same), (OPEN, same & in_head)):
            at = pa.array(np.flatnonzero(pick))
            if len(at):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(at), kind, dtype=np.int32)), *[c.take(at) for c in batch.columns]],
                    names=["kind", *batch.schema.names])
        key = (k1[-1], k2[-1])
        first = known.slice(int(begin[-1]) + 1, 1)
        head = head and begin[-1] < 0
    if key is not None:
        none = pa.array([None], pa.int64())
        yield pa.RecordBatch.from_arrays(
            [pa.array([LAST], pa.int32()), pa.array([key[0]]), pa.array([key[1]]), first, none, none],
            names=["kind", "k1", "k2", "doc", "row", "pos"])


def dropped_lines(lines: DataFrame, scratch: Scratch, partitions: int | None = None) -> DataFrame:
    """(``doc``, ``row``, ``pos``) of the lines that go."""
    ship_package(lines.sparkSession)
    order = ["k1", "k2", F.col("doc").asc_nulls_last(), "row", "pos"]
    dealt = lines.repartitionByRange(*([partitions] if partitions else []), *order)
    schema = T.StructType([T.StructField("kind", T.IntegerType()), *lines.schema.fields])
    found = scratch.write(dealt.sortWithinPartitions(*order).mapInArrow(_stream, schema), "found")
    # one row per partition: who holds its last key first
    last = (found.where(F.col("kind") == LAST).groupBy("k1", "k2").agg(F.min("doc").alias("holder")))
    later = F.col("holder").isNotNull() & (F.col("doc").isNull() | (F.col("holder") < F.col("doc")))
    late = found.where(F.col("kind") == OPEN).join(F.broadcast(last), ["k1", "k2"]).where(later)
    return found.where(F.col("kind") == DROPPED).select("doc", "row", "pos").union(late.select("doc", "row", "pos"))


def pack(n_lines: int, dropped) -> bytes:
    """Compressed bitmap, bit i set if line i stays."""
    keep = np.ones(n_lines, dtype=bool)
    keep[dropped] = False
    return zlib.compress(np.packbits(keep, bitorder="little").tobytes())


def unpack(bitmap: bytes, n_lines: int) -> np.ndarray:
    bits = np.frombuffer(zlib.decompress(bitmap), dtype=np.uint8)
    return np.unpackbits(bits, count=n_lines, bitorder="little").astype(bool)


def keep_bitmaps(docs: DataFrame, min_chars: int = MIN_CHARS, id_col: str = "doc_id", text_col: str = "text",
                 partitions: int | None = None, scratch: Scratch | None = None) -> DataFrame:
    """Per row of ``docs``: id, ``row`` (hash of the text), ``n_lines``,
    ``n_dropped`` and ``bitmap`` (``unpack``)."""
    ship_package(docs.sparkSession)
    scratch = scratch or Scratch(docs.sparkSession, "line-dedup")
    lines = scratch.write(line_rows(docs, min_chars, id_col, text_col), "lines")
    gone = scratch.write(
        dropped_lines(lines, scratch, partitions).groupBy("doc", "row")
        .agg(F.sort_array(F.collect_set("pos")).alias("dropped")), "gone")
    scratch.drop("lines", "found")
    text = F.coalesce(F.col(text_col), F.lit(""))
    breaks = F.octet_length(text) - F.octet_length(F.replace(text, F.lit("\n"), F.lit("")))
    each = docs.select(F.col(id_col).alias("id"), _row_key(F.col(text_col)).alias("r"),
                       (breaks.cast("long") + 1).alias("n"))
    both = each.join(gone, F.col("id").eqNullSafe(F.col("doc")) & (F.col("r") == F.col("row")), "left")
    schema = T.StructType([
        T.StructField(id_col, docs.schema[id_col].dataType), T.StructField("row", T.LongType()),
        T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType()),
        T.StructField("bitmap", T.BinaryType())])

    def run(batches):
        for batch in batches:
            lost = [np.asarray(d.values, dtype=np.int64) if d.is_valid else () for d in batch.column(3)]
            maps = [pack(n.as_py(), d) if len(d) else pack(n.as_py(), slice(0)) for n, d in zip(batch.column(2), lost)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array([len(d) for d in lost], pa.int64()), pa.array(maps, pa.binary())],
                names=schema.names)

    return both.select("id", "r", "n", "dropped").mapInArrow(run, schema)


def kept_texts(docs: DataFrame, bitmaps: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All rows and columns of ``docs``, the text cut to the lines that stay
    (none: empty), with ``n_lines`` and ``n_dropped``."""
    ship_package(docs.sparkSession)
    cols = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    row = F.struct(*[F.col(f"`{c}`") for c in cols])
    left = docs.select(row.alias("d"), F.col(id_col).alias("id"), _row_key(F.col(text_col)).alias("r"))
    maps = bitmaps.dropDuplicates([id_col, "row"]).select(
        F.col(id_col).alias("mid"), "row", "n_lines", "n_dropped", "bitmap")
    both = left.join(maps, F.col("id").eqNullSafe(F.col("mid")) & (F.col("r") == F.col("row")))
    schema = T.StructType([T.StructField("d", left.schema["d"].dataType), T.StructField("n_lines", T.LongType()),
                           T.StructField("n_dropped", T.LongType()), T.StructField("kept", T.StringType())])

    def run(batches):
        for batch in batches:
            kept = []
            for n, gone, bitmap, text in zip(*[batch.column(i) for i in range(1, 5)]):
                body = text.as_py() or b""
                if gone.as_py():
                    stays = unpack(bitmap.as_py(), n.as_py())
                    body = b"\n".join([line for line, keep in zip(body.split(b"\n"), stays) if keep])
                kept.append(body)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(kept, pa.binary()).cast(pa.string())], names=schema.names)

    cut = both.select("d", "n_lines", "n_dropped", "bitmap", F.col("d")[text_col].cast("binary").alias("body")).mapInArrow(run, schema)
    return cut.select(*[F.col("kept").alias(c) if c == text_col else F.col("d")[c].alias(c) for c in cols],
                      "n_lines", "n_dropped")
