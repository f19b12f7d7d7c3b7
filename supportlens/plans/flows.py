"""End-to-end compositions (P1-P3, A5): many operators, one wide result keyed
by ``row_id``.

Alignment is always by key (joins), never by position. The output of every
model stage is written (shared ``spark.checkpoint.dir``) before anything else
reads it, so each call is made once per row, and a lost executor repeats at
most the calls of its own unfinished tasks.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import categories as cat
from ..functions import entities as ent
from ..operators import assist, cleaning, models, reports, sentiment, topics, vectors
from ..session import materialize


def pair_query_response(queries: DataFrame, responses: DataFrame, key: str = "row_id") -> DataFrame:
    """Align replies with their queries by key (inner join)."""
    return queries.join(responses, key)


def first_n(df: DataFrame, n: int, key: str = "row_id") -> DataFrame:
    """First n rows in key order (TakeOrderedAndProject: per-partition
    top-n, then a merge of n x partitions rows)."""
    return df.orderBy(key).limit(n)


def generate_and_judge(queries: DataFrame, text: str, client_factory: Callable,
                       key: str = "row_id", partitions: int | None = None,
                       reply_settings: dict | None = None, judge_settings: dict | None = None,
                       **call) -> DataFrame:
    """(key, query, response, scores); one reply call and one judge call per
    query. Settings (``model``, ``temperature``, ``max_tokens``) per stage."""
    replies = materialize(assist.generate_replies(queries, text, client_factory, key, settings=reply_settings,
                                                  partitions=partitions, **call), spread_out=True)
    pairs = queries.select(key, F.col(text).alias("query")).join(replies, key)
    scores = materialize(assist.judge_replies(pairs, "query", "response", client_factory, key,
                                              settings=judge_settings, partitions=partitions, **call))
    return pairs.join(scores, key)


def entity_source(raw: str, clean: str, entities_on: str) -> str:
    """Entities are taken from the raw text by default: the cleaned one has no
    digits, so order numbers and amounts cannot be found in it."""
    return {"raw": raw, "clean": clean}[entities_on]


def support_artifacts(queries: DataFrame, text: str, lexicon: DataFrame, client_factory: Callable,
                      encoder_factory: Callable, dim: int, sentiment_factory: Callable,
                      k: int = 10, seed: int = 42, key: str = "row_id", with_topics: bool = True,
                      entities_on: str = "raw", exceptions: DataFrame | None = None, **generate) -> DataFrame:
    """Queries -> replies + scores -> clean both -> embed both, cluster the
    queries -> entities of the queries -> sentiment of cleaned replies, one row
    per query that got a reply."""
    gen = generate_and_judge(queries, text, client_factory, key, **generate)
    # Queries and replies share one vocabulary and one rewrite table; only the
    # texts are read for it, not the scores.
    cleaned = cleaning.clean_columns(gen.select(key, "query", "response"), key, ["query", "response"],
                                     lexicon, exceptions=exceptions)
    source = entity_source("query", "clean_query", entities_on)
    wide = (gen.join(cleaned, key)
               .withColumn("query_entities", ent.extract_entities(source))
               .withColumn("response_sentiment",
                           models.classify_batch(F.col("clean_response"), sentiment_factory))
               .withColumn("query_embedding",
                           models.encode_batch(F.col("clean_query"), encoder_factory, dim))
               .withColumn("response_embedding",
                           models.encode_batch(F.col("clean_response"), encoder_factory, dim)))
    # k-means scans its input once per iteration, and callers read the result
    # more than once: write the model outputs.
    wide = materialize(wide, spread_out=with_topics)
    if with_topics:
        _, wide = vectors.kmeans_fit(wide, "query_embedding", k=k, seed=seed, out="topic")
    return wide


def app_flow(queries: DataFrame, text: str, lexicon: DataFrame, responses: DataFrame,
             sentiment_factory: Callable, key: str = "row_id", clean_before_sentiment: bool = False,
             entities_on: str = "raw", exceptions: DataFrame | None = None, n: int | None = None,
             encoder_factory: Callable | None = None, dim: int = 16, k: int = 10, seed: int = 42) -> DataFrame:
    """Clean + length + entities + category on queries; sentiment of the
    (raw, by default) reply of each query; queries without a reply keep NULL.
    ``n`` takes the first n queries only (default: all of them). With an
    encoder, the cleaned queries are clustered into ``topic``."""
    if n is not None:
        queries = first_n(queries, n, key)
    c = cleaning.clean_texts(queries, key, text, lexicon, exceptions=exceptions)
    resp = responses
    if clean_before_sentiment:
        resp = cleaning.clean_texts(responses, key, "response", lexicon, exceptions=exceptions).select(
            key, F.col("clean").alias("response"))
    sent = resp.select(key, models.classify_batch(F.col("response"), sentiment_factory).alias("reply_sentiment"))
    out = (queries.join(c, key, "left")
                  .withColumn("entities", F.to_json(ent.extract_entities(entity_source(text, "clean", entities_on)))))
    if "category" in queries.columns:
        out = out.withColumn("normalized_category",
                             cat.normalize_category("category", "sub_category"))
    out = out.join(sent, key, "left")
    if encoder_factory is not None:
        out = materialize(out.withColumn("embedding", models.encode_batch(F.col("clean"), encoder_factory, dim)),
                          spread_out=True)
        _, out = vectors.kmeans_fit(out, "embedding", k=k, seed=seed, out="topic")
    return out


def app_summaries(flow: DataFrame, key: str = "row_id") -> dict[str, DataFrame]:
    """The tables beside P2's rows: sentiment counts and shares of the replies,
    and the first five queries of each topic if there are topics."""
    labels = flow.where(F.col("reply_sentiment").isNotNull()).select(F.col("reply_sentiment").alias("sentiment"))
    out = {"sentiment_counts": sentiment.sentiment_counts(labels), "sentiment_share": sentiment.sentiment_share(labels)}
    if "topic" in flow.columns:
        out["topic_samples"] = topics.topic_samples(flow, "clean", "topic", key, 5)
    return out


def overall_report(scores: DataFrame, topics_df: DataFrame | None, sentiments: DataFrame | None,
                   triples: DataFrame | None, key: str = "row_id") -> dict[str, DataFrame]:
    """A5: the parts of the overall report as DataFrames (nothing printed)."""
    out = {"quality": reports.quality_summary(scores)}
    if topics_df is not None:
        out["unique_clusters"] = topics.unique_clusters(topics_df, "topic")
    if sentiments is not None:
        out["sentiment_sample"] = first_n(sentiments, 5, key)
    if triples is not None:
        out["example_pairs"] = first_n(triples, 3, key)
    return out


def prepare_queries(df: DataFrame, lexicon: DataFrame, key: str = "row_id",
                    text_col: str | None = None) -> DataFrame:
    """Every input column plus ``clean`` and ``length``; the text column is
    ``Queries`` when present, else the first column (unless given)."""
    from ..sources.tables import query_column

    col = text_col or query_column(df)
    c = cleaning.clean_texts(df, key, col, lexicon)
    return df.join(c, key, "left")
