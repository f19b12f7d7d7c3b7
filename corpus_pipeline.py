"""The corpus pipeline: raw documents to a mixed training corpus.

Each stage takes (spark, docs, sf_dir) and returns the documents it passes on;
``run`` writes every stage's rows as Parquet under the shared folder and reads
them back for the next one. Stages before the last return the columns they
were given; the last adds the mixing columns.

Decisions: texts that the quality rules reject go; of a group of
near-duplicates (five-word shingles, similarity 0.8) the document with the
smallest id stays; documents in which a benchmark window occurs go; personal
data are replaced by their kind in brackets (``n_chars`` follows the text);
every row that is left gets its place in the mix. Defined results for nulls,
empty texts and repeated rows are those of the operators.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from supportlens.llm import decontamination, mixing, near_dedup, personal_data, quality_rules
from supportlens.llm.common import Scratch, read


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.keep_texts(docs)


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.one_per_group(docs, width=5, percent=80)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.drop_contaminated(docs, read(spark, sf_dir, "benchmark"))


def remove_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    clean = personal_data.redact(docs)
    if "n_chars" not in docs.columns:
        return clean
    size = F.char_length("text").cast(docs.schema["n_chars"].dataType)
    return clean.withColumn("n_chars", F.coalesce(size, F.col("n_chars")))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


STAGES = [
    ("quality_rules", quality),
    ("near_dedup", deduplicate),
    ("decontamination", decontaminate),
    ("personal_data", remove_personal_data),
    ("source_mix", mix),
]

# The fitted rules and trees of two stages cannot be stated in SQL; the tests
# hold the stages against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "pipeline")
    docs = read(spark, sf_dir, "documents")
    before = None
    for name, stage in STAGES:
        docs = scratch.write(stage(spark, docs, sf_dir), name)
        if before:
            scratch.drop(before)
        before = name
    return docs
