"""Incremental processing of newly arriving support texts (Structured Streaming).

The reference processes one workbook at a time; here new files landing in a
folder are picked up as a file stream and every micro-batch runs the same
batch operators (cleaning with the dictionary joins, entities) through
``foreachBatch``. Output for micro-batch ``e`` is written to ``<sink>/epoch=e``
with overwrite, so a replayed batch after a failure replaces its own output:
together with the checkpointed source offsets this gives exactly-once files.
``trigger(availableNow=True)`` drains what is there and stops (batch-style
runs and tests); a long-running job uses a processing-time trigger instead.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import entities as ent
from ..operators import cleaning, spelling
from ..session import materialize, scratch_scope


def support_text_stream(spark: SparkSession, path: str, schema: T.StructType,
                        files_per_batch: int | None = None) -> DataFrame:
    """Streaming DataFrame over parquet files under ``path`` (folder or glob).
    ``files_per_batch`` bounds a micro-batch; by default it takes what is there."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def clean_micro_batches(stream: DataFrame, key: str, text: str, lexicon: DataFrame,
                        sink: str, checkpoint: str, available_now: bool = True, entities_on: str = "raw"):
    """Run the full cleaning + entities on every micro-batch; returns the query.

    Entities come from the text as written (``entities_on="clean"``: from the
    cleaned one, which has no digits, so neither order numbers nor amounts).

    The dictionary and its delete-key index are static: both are materialised
    once, before the stream starts, and every micro-batch joins against them.
    """
    lex = materialize(lexicon)
    lex_keys = materialize(spelling.dictionary_keys(lex))

    def run(batch: DataFrame, epoch_id: int) -> None:
        # Per-batch intermediates (vocabulary, rewrite table) are removed once
        # the batch output is written, so a long-running stream leaves nothing.
        with scratch_scope(batch.sparkSession) as scope:
            if entities_on == "clean":
                out = (cleaning.clean_texts(batch, key, text, lex, lexicon_keys=lex_keys, scope=scope)
                               .withColumn("entities", F.to_json(ent.extract_entities("clean"))))
            else:  # rows that share a key are told apart by their texts
                rows = batch.withColumn("__row", F.struct(F.col(key).alias("key"), F.xxhash64(text).alias("h")))
                found = rows.select("__row", F.to_json(ent.extract_entities(text)).alias("entities")).dropDuplicates(["__row"])
                out = (cleaning.clean_texts(rows, "__row", text, lex, lexicon_keys=lex_keys, scope=scope)
                               .join(found, "__row")
                               .select(F.col("__row.key").alias(key), "clean", "length", "entities"))
            out.write.mode("overwrite").parquet(f"{sink.rstrip('/')}/epoch={epoch_id}")

    writer = stream.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="30 seconds")
    return writer.start()


def read_sink(spark: SparkSession, sink: str) -> DataFrame:
    """All micro-batch outputs written so far."""
    return spark.read.parquet(sink).drop("epoch")
