"""Model calls that are paid once: an append-only ledger of answers.

A call is named by the digest of its messages and settings. The ledger is a
Parquet folder of (digest, text, error, task) rows that tasks append to as
they finish: the writer's commit protocol moves a task's file into the folder
when that task is done, not when the job is, so a job that fails, or is
killed, leaves every finished task's answers behind. Before calling, the
digests that have an answer are anti-joined away. A task makes at most
``calls_per_task`` calls, which is the most that a lost task costs.

Equal calls are made once and their answer is given to every row that asks.
Answers that failed for good (``on_error="null"``) are noted with their error and
asked again by the next run. A task whose commit was cut off may leave a
second row for a digest; the first text in order counts. Two runs at the
same time do not see each other's answers: they may both pay for a call.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.prompts import TASK_SETTINGS
from ..session import materialize
from . import models

SCHEMA = "digest string, text string, error string, task string"
# Finished tasks' files are moved to the folder at once.
_TASK_COMMIT = {"mapreduce.fileoutputcommitter.algorithm.version": "2"}


def call_digest(messages: Column | str, task: str, settings: dict | None = None) -> Column:
    """Digest of one call: its messages and everything the model is told."""
    m = F.col(messages) if isinstance(messages, str) else messages
    options = json.dumps({"task": task, **TASK_SETTINGS[task], **(settings or {})}, sort_keys=True)
    return F.sha2(F.concat(F.lit(options), F.lit("\n"), F.coalesce(F.to_json(m), F.lit(""))), 256)


class CallLedger:
    """The ledger in folder ``path``, made by the first call."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def rows(self) -> DataFrame:
        """Everything noted so far."""
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        if not folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(folder):
            return self.spark.createDataFrame([], SCHEMA)
        return self.spark.read.schema(SCHEMA).parquet(self.path)

    def answers(self) -> DataFrame:
        """(``digest``, ``text``) of the calls that have an answer."""
        return self.rows().where("error IS NULL").groupBy("digest").agg(F.min("text").alias("text"))

    def ask(self, df: DataFrame, key: str, messages: str, client_factory: Callable, task: str = "reply",
            out: str = "text", settings: dict | None = None, calls_per_task: int = 200,
            on_error: str = "fail", **call) -> DataFrame:
        """(key, out[, error]) of every row; only calls without an answer are made."""
        asked = materialize(df.select(key, messages, call_digest(messages, task, settings).alias("__digest")))
        todo = (asked.dropDuplicates(["__digest"]).select(F.col("__digest").alias("digest"), messages)
                     .join(self.answers().select("digest"), "digest", "left_anti"))
        todo = materialize(todo)
        n = todo.count()
        if n:
            made = models.chat_batch(todo, "digest", messages, client_factory, task=task, out="text", on_error=on_error,
                                     settings=settings, partitions=-(-n // calls_per_task), **call)
            if on_error != "null":
                made = made.withColumn("error", F.lit(None).cast("string"))
            (made.select("digest", "text", "error", F.lit(task).alias("task"))
                 .write.mode("append").options(**_TASK_COMMIT).parquet(self.path))
        known = self.answers().select(F.col("digest").alias("__digest"), F.col("text").alias(out))
        found = asked.join(known, "__digest", "left")
        if on_error != "null":
            return found.select(key, out)
        errors = (self.rows().where("error IS NOT NULL").groupBy(F.col("digest").alias("__digest"))
                      .agg(F.max("error").alias("__error")))
        return found.join(errors, "__digest", "left").select(
            key, out, F.when(F.col(out).isNull(), F.col("__error")).alias("error"))
