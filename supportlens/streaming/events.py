"""Event-time streams: windowed counts and pairing of queries with replies.

* ``windowed_counts``: counts per tumbling window and group, kept as state
  until the watermark (the latest time seen less ``delay``) has passed the
  window's end. A row that comes after that is late and left out. Micro-batches
  hand on the windows they changed (update mode); ``latest`` reads the
  newest state of each window from the sink.
* ``pair_stream``: a two-sided join of queries with replies of the same
  conversation within ``within`` of the query. Both sides are state until the
  watermark proves that nothing can match any more; a query without a reply
  comes out then, with nulls.

Sinks are Parquet folders. Updates go to ``epoch=`` folders with overwrite, so
a replayed micro-batch replaces its own output; the join appends through
Spark's file sink, which commits each micro-batch once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def windowed_counts(events: DataFrame, time: str, group: str, width: str = "1 hour", delay: str = "1 day",
                    measures: dict[str, Column] | None = None) -> DataFrame:
    """(``window_start``, group, ``n``, measures) of a stream or a table."""
    timed = events.withWatermark(time, delay) if events.isStreaming else events
    extra = [c.alias(name) for name, c in (measures or {}).items()]
    out = timed.groupBy(F.window(time, width).alias("w"), group).agg(F.count(F.lit(1)).alias("n"), *extra)
    return out.select(F.col("w.start").alias("window_start"), group, "n", *[name for name in measures or {}])


def write_updates(stream: DataFrame, sink: str, checkpoint: str, available_now: bool = True):
    """Start the query: every micro-batch's changed windows in a folder of its own."""
    def run(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite").parquet(f"{sink.rstrip('/')}/epoch={epoch}")

    writer = stream.writeStream.outputMode("update").foreachBatch(run).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="30 seconds")).start()


def latest(spark: SparkSession, sink: str, keys: list[str]) -> DataFrame:
    """The newest state of each window from the updates."""
    rows = spark.read.parquet(sink)
    values = [c for c in rows.columns if c not in (*keys, "epoch")]
    last = rows.groupBy(*keys).agg(F.max_by(F.struct(*values), "epoch").alias("v"))
    return last.select(*keys, *[F.col("v")[c].alias(c) for c in values])


def pair_stream(queries: DataFrame, replies: DataFrame, key: str, query_time: str, reply_time: str,
                within: str = "1 hour", delay: str = "1 hour") -> DataFrame:
    """Queries with their replies: same ``key``, the reply after the query and
    within ``within``. Of queries without one, nulls. Column names differ."""
    q = queries.withWatermark(query_time, delay).withColumnRenamed(key, "__key") if queries.isStreaming else \
        queries.withColumnRenamed(key, "__key")
    r = replies.withWatermark(reply_time, delay) if replies.isStreaming else replies
    near = ((F.col("__key") == F.col(key)) & (F.col(reply_time) > F.col(query_time))
            & (F.col(reply_time) <= F.col(query_time) + F.expr(f"INTERVAL {within}")))
    both = q.join(r, near, "left").drop(key).withColumnRenamed("__key", key)
    return both


def write_pairs(stream: DataFrame, sink: str, checkpoint: str, available_now: bool = True):
    writer = (stream.writeStream.outputMode("append").format("parquet").option("path", sink)
              .option("checkpointLocation", checkpoint))
    return (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="30 seconds")).start()


def replay(df: DataFrame, time: str, path: str, batches: int = 4, files: int = 2) -> int:
    """Write a table as ``batches`` arrivals of ``files`` files, the earliest
    times first, to be streamed again (``maxFilesPerTrigger``). Returns the
    files per arrival."""
    lo, hi = (x.timestamp() if x is not None else 0.0 for x in df.agg(F.min(time), F.max(time)).first())
    step = (hi - lo) / batches or 1.0
    at = F.least(F.floor((F.col(time).cast("double") - lo) / step), F.lit(batches - 1))
    for i in range(batches):
        df.where(at == i).repartition(files).write.mode("append").parquet(path)
    return files
