"""WARC archives as a chunked record table (operator 7).

Writing: one record per page, payloads of more than ``SEGMENT`` bytes as a
first record and continuation records (record segmentation of WARC 1.0), cut
at byte offsets of the UTF-8 form, so that the pieces of a payload cost its
length once; a segment may end inside a character. Of records with equal payloads
of at least ``MIN_REVISIT`` bytes the one with the largest id is the response,
the others are revisits that refer to it and store no payload. The archives
are written by Spark's text writer (the blank lines between records are its
line separator), gzip-compressed, into any file system Spark writes to.

Reading: the lines of an archive stream through a parser that follows the
content lengths and emits rows (record id, chunk number, chunk, bytes and
digest so far); a record is never put together. gzip files are read whole by
one task each, segments of a record follow one another in one file, so the
SHA-1 goes on from chunk to chunk.

Equal payloads are found on (digest, id) pairs; only digests that repeat are
joined back, broadcast while there are at most ``BROADCAST_GROUPS`` of them.

Defined cases: a null payload is an empty one; a null url has no target
field; a null id gives a record with null id, never a response that others
refer to, and rows that repeat the largest id are all responses; an empty
table gives no records. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from urllib.parse import unquote_plus

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ship_package
from .common import Scratch

SEGMENT = 262_144          # bytes of payload in one stored segment
CHUNK = 65_536             # bytes of payload in one row of the chunk table
MIN_REVISIT = 1_000
BROADCAST_GROUPS = 200_000  # repeated payloads broadcast (about 70 bytes each)
DATE = "2024-01-01T00:00:00Z"  # of all records unless the caller names another

_ID = "urn:page:"


def _id(col: Column) -> Column:
    return F.concat(F.lit(_ID), F.coalesce(F.concat(F.lit("v"), F.url_encode(col.cast("string"))), F.lit("n")))


def _field(name: str, value: Column) -> Column:
    """One header line; a null value leaves it out."""
    return F.coalesce(F.concat(F.lit(name + ": "), value, F.lit("\r\n")), F.lit(""))


def write_archives(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url",
                   payload_col: str = "html", date: str = DATE, segment: int = SEGMENT) -> None:
    """Write one record per row as gzip-compressed archives under ``path``."""
    scratch = Scratch(pages.sparkSession, "warc")
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"),
                        F.coalesce(F.col(payload_col), F.lit("")).alias("payload"))
    rows = rows.select("*", F.sha1("payload").alias("digest"), F.octet_length("payload").alias("bytes"))
    repeated = scratch.write(
        rows.where(F.col("bytes") >= MIN_REVISIT).groupBy("digest")
            .agg(F.max("id").alias("target"), F.count(F.lit(1)).alias("n")).where("n > 1")
            .select("digest", "target"), "repeated")
    if repeated.count() <= BROADCAST_GROUPS:
        repeated = F.broadcast(repeated)
    typed = rows.join(repeated, "digest", "left").withColumn(
        "revisit", F.col("target").isNotNull() & ~F.col("id").eqNullSafe(F.col("target")))
    pieces = F.when(F.col("revisit"), 1).otherwise(
        F.greatest(F.ceil(F.col("bytes") / segment), F.lit(1)))
    # the pieces are cut before they are exploded: no row carries the payload on
    cut = F.transform(F.sequence(F.lit(1), F.col("pieces")), lambda no: F.struct(no.alias("no"), F.substring(
        "payload", (no - 1) * segment + 1, segment).cast("string").alias("p")))
    cut = F.when(F.col("revisit"), F.array(F.struct(F.lit(1).alias("no"), F.lit("").alias("p")))).otherwise(cut)
    each = (typed.withColumn("pieces", pieces.cast("int")).withColumn("payload", F.encode("payload", "UTF-8"))
                 .select("id", "url", "digest", "bytes", "target", "revisit", "pieces", F.inline(cut)))
    first, many = F.col("no") == 1, F.col("pieces") > 1
    kind = F.when(F.col("revisit"), "revisit").when(first, "response").otherwise("continuation")
    only = lambda when, value: F.when(when, value)
    uri = F.regexp_replace("url", r"[\x00-\x20\x7F]", "%20")
    own = F.concat(F.lit("<"), _id(F.col("id")), F.lit(">"))
    record = F.concat(
        F.lit("WARC/1.0\r\n"), _field("WARC-Type", kind),
        _field("WARC-Record-ID", F.when(first, own).otherwise(
            F.concat(F.lit("<"), _id(F.col("id")), F.lit("/"), F.col("no").cast("string"), F.lit(">")))),
        _field("WARC-Date", F.lit(date)), _field("WARC-Target-URI", uri),
        _field("WARC-Payload-Digest", only(first, F.concat(F.lit("sha1:"), F.col("digest")))),
        _field("X-Payload-Length", only(first, F.col("bytes").cast("string"))),
        _field("WARC-Refers-To", only(F.col("revisit"), F.concat(F.lit("<"), _id(F.col("target")), F.lit(">")))),
        _field("WARC-Profile", only(F.col("revisit"), F.lit(
            "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"))),
        _field("WARC-Segment-Number", only(many, F.col("no").cast("string"))),
        _field("WARC-Segment-Origin-ID", only(~first, own)),
        _field("WARC-Segment-Total-Length", only(many & (F.col("no") == F.col("pieces")),
                                                 F.col("bytes").cast("string"))),
        F.lit("Content-Type: text/html\r\n"),
        _field("Content-Length", F.octet_length("p").cast("string")), F.lit("\r\n"), F.col("p"))
    (each.select(record.alias("value"))
         .write.option("lineSep", "\r\n\r\n").option("compression", "gzip").text(path))
    scratch.drop("repeated")


class _Parser:
    """Lines of archives in, rows of the chunk table out."""

    def __init__(self, chunk: int, data: bool):
        self.chunk, self.data = chunk, data
        self.head: dict[str, str] = {}
        self.state, self.left, self.part = "start", 0, bytearray()
        self.id, self.no, self.total, self.sha = None, 0, 0, hashlib.sha1()

    def feed(self, line: bytes) -> Iterator[tuple]:
        data = line + b"\n"
        if self.state == "body":
            take = data[:self.left]
            self.left -= len(take)
            yield from self._payload(take)
            data = data[len(take):]
            if self.left:
                return
            self.state = "gap"
            yield from self._end()
        if self.state == "gap":  # CR LF CR LF, whole lines but for the first
            if data.strip():
                raise ValueError(f"record {self.head.get('warc-record-id')}: length does not fit")
            self.gap = getattr(self, "gap", 0) + data.count(b"\n")
            if self.gap < 2:
                return
            self.state, self.gap = "start", 0
            return
        text = data.rstrip(b"\r\n").decode()
        if self.state == "start":
            if not text.startswith("WARC/"):
                raise ValueError(f"not the start of a record: {text[:40]!r}")
            self.head, self.state = {}, "head"
        elif text:
            name, _, value = text.partition(": ")
            self.head[name.lower()] = value
        else:
            yield from self._begin()

    def _begin(self) -> Iterator[tuple]:
        if self.head["warc-type"] != "continuation":
            self.first = self.head
            self.id, self.no, self.total, self.sha = self.head["warc-record-id"], 0, 0, hashlib.sha1()
        self.left = int(self.head["content-length"])
        self.state = "body"
        if not self.left:
            self.state = "gap"
            yield from self._end()

    def _payload(self, data: bytes) -> Iterator[tuple]:
        self.part += data
        while len(self.part) > self.chunk:
            piece, self.part = bytes(self.part[:self.chunk]), self.part[self.chunk:]
            yield self._row(piece, False)

    def _end(self) -> Iterator[tuple]:
        more = "warc-segment-number" in self.head and "warc-segment-total-length" not in self.head
        if not more:
            piece, self.part = bytes(self.part), bytearray()
            yield self._row(piece, True)

    def _row(self, piece: bytes, last: bool) -> tuple:
        self.sha.update(piece)
        self.total += len(piece)
        h, no = self.first, self.no
        self.no += 1
        return (_page(self.id), no, piece if self.data else None, self.total, self.sha.hexdigest(), last,
                h["warc-type"], _page(h.get("warc-refers-to")), int(h["x-payload-length"]),
                h["warc-payload-digest"].removeprefix("sha1:"))


def _page(record: str | None) -> str | None:
    mark = (record or "").removeprefix("<" + _ID).removesuffix(">")
    return unquote_plus(mark[1:]) if mark.startswith("v") else None


_FIELDS = [("id", pa.string(), "string"), ("chunk_no", pa.int64(), "bigint"), ("chunk", pa.binary(), "binary"),
           ("bytes_so_far", pa.int64(), "bigint"), ("digest_so_far", pa.string(), "string"),
           ("last", pa.bool_(), "boolean"), ("record_type", pa.string(), "string"),
           ("refers_to", pa.string(), "string"), ("payload_bytes", pa.int64(), "bigint"),
           ("payload_digest", pa.string(), "string")]


def chunk_table(spark: SparkSession, path: str, chunk: int = CHUNK, data: bool = True) -> DataFrame:
    """The archives under ``path`` as rows (``id``, ``chunk_no``, ``chunk``,
    ``bytes_so_far``, ``digest_so_far``, ``last``, and of the record
    ``record_type``, ``refers_to``, declared ``payload_bytes`` and
    ``payload_digest``). ``data=False`` leaves the chunks themselves out."""
    ship_package(spark)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parser = _Parser(chunk, data)
        for batch in batches:
            rows, size = [], 0
            for line in batch.column(0):
                for row in parser.feed(line.as_py()):
                    rows.append(row)
                    size += len(row[2] or b"")
                    if size > 1 << 24:  # keep output batches small as well
                        yield _batch(rows)
                        rows, size = [], 0
            if rows:
                yield _batch(rows)

    lines = spark.read.option("lineSep", "\n").text(path).select(F.col("value").cast("binary"))
    return lines.mapInArrow(run, ", ".join(f"{n} {t}" for n, _, t in _FIELDS))


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t, _) in zip(zip(*rows), _FIELDS)],
                                      names=[n for n, _, _ in _FIELDS])


def records(chunks: DataFrame, id_type: str = "bigint") -> DataFrame:
    """One row per record: of a response the size and digest of the payload
    that was read, of a revisit those it declares."""
    revisit = F.col("record_type") == "revisit"
    bad = ~revisit & ((F.col("digest_so_far") != F.col("payload_digest"))
                      | (F.col("bytes_so_far") != F.col("payload_bytes")))
    digest = F.when(bad, F.raise_error(F.concat(F.lit("payload does not fit its digest: "), "id"))) \
              .when(revisit, F.col("payload_digest")).otherwise(F.col("digest_so_far"))
    return chunks.where("last").select(
        F.col("id").cast(id_type).alias("page_id"),
        F.when(revisit, F.col("payload_bytes")).otherwise(F.col("bytes_so_far")).alias("payload_bytes"),
        digest.alias("payload_digest"), "record_type", F.col("refers_to").cast(id_type).alias("refers_to"))
