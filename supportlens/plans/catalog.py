"""Registered queries: one per operator, each (spark, sf_dir) -> DataFrame.

Every query covers all rows of its tables, or of the views derived from them.
Queries on texts read the whole texts (a template with the support domain's
words, then the conversation turn); the judge-output, category and
generator-output views are templates chosen by the row's keys, and the
whole-string date rule is fed the template alone. Results are flat scalar
columns so they compare value-for-value with the DuckDB oracle in
``oracle.py``.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as tx
from ..operators import reports
from ..session import materialize, scratch_path
from ..sources import positions, tables, views, workbooks

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


def _docs(spark, sf):
    return tables.read_table(spark, sf, "documents")


def support_text(spark, sf) -> DataFrame:
    """Support queries with one text column: template + whole conversation turn."""
    return views.support_queries(spark, sf).select(
        "row_id", F.concat_ws(" ", "short_text", "long_text").alias("query_text"))


# --- S1-S3 -------------------------------------------------------------------

@query("load_trim_headers")
def q_load_trim_headers(spark, sf):
    d = _docs(spark, sf)
    padded = d.toDF(*[f"  {c}\t" for c in d.columns])
    return tables.trim_headers(padded)


@query("resolve_text_column")
def q_resolve_text_column(spark, sf):
    conv = tables.read_table(spark, sf, "conversations")
    return tables.load_query_texts(conv.withColumn("row_id", F.col("conv_id") * 4294967296 + F.col("turn")))


# --- T1-T5, T7, T9, T10, A4 --------------------------------------------------

@query("clean_basic")
def q_clean_basic(spark, sf):
    return _docs(spark, sf).select("doc_id", tx.clean_basic("text").alias("clean_basic"))


@query("tokenize")
def q_tokenize(spark, sf):
    return _docs(spark, sf).select(
        "doc_id", F.posexplode(tx.tokenize(tx.clean_basic("text"))).alias("pos", "token"))


@query("expand_shorthand")
def q_expand_shorthand(spark, sf):
    return support_text(spark, sf).select(
        "row_id", F.posexplode(tx.basic_tokens("query_text")).alias("pos", "token"))


@query("remove_stopwords")
def q_remove_stopwords(spark, sf):
    return support_text(spark, sf).select(
        "row_id", tx.clean_without_dictionary("query_text").alias("clean"))


@query("query_length")
def q_query_length(spark, sf):
    # T10 counts the tokens of the full clean text (spelling and lemmas included).
    from ..operators import cleaning as _cleaning

    c = _cleaning.clean_texts(support_text(spark, sf), "row_id", "query_text", lexicon(spark, sf))
    return c.select("row_id", "length")


@query("length_histogram")
def q_length_histogram(spark, sf):
    return reports.length_histogram(q_query_length(spark, sf), "length", 30)


# --- E1-E7 -------------------------------------------------------------------

from ..functions import categories as cat  # noqa: E402
from ..functions import dates  # noqa: E402
from ..functions import entities as ent  # noqa: E402


def _short(spark, sf):
    return views.support_queries(spark, sf).select(
        "row_id", ent.lowered("short_text").alias("s"))


def _whole(spark, sf):
    return support_text(spark, sf).select("row_id", ent.lowered("query_text").alias("s"))


@query("entity_order_id")
def q_entity_order_id(spark, sf):
    return _whole(spark, sf).select("row_id", ent.order_id(F.col("s")).alias("order_id"))


@query("entity_amount")
def q_entity_amount(spark, sf):
    return _whole(spark, sf).select("row_id", ent.amount(F.col("s")).alias("amount"))


@query("entity_date")
def q_entity_date(spark, sf):
    return _short(spark, sf).select("row_id", ent.date_entity(F.col("s")).alias("date"))


@query("entity_date_mentions")
def q_entity_date_mentions(spark, sf):
    """E3 anywhere: every date in the whole queries, with its place."""
    found = support_text(spark, sf).select("row_id", F.inline(dates.date_mentions("query_text")))
    return found.select("row_id", "start", "end", "mention", "date")


@query("entity_account_action")
def q_entity_account_action(spark, sf):
    return _whole(spark, sf).select(
        "row_id", F.posexplode(ent.account_actions(F.col("s"))).alias("pos", "action"))


@query("entity_intent")
def q_entity_intent(spark, sf):
    return _whole(spark, sf).select(
        "row_id", F.posexplode(ent.intents(F.col("s"))).alias("pos", "intent"))


def explode_entities(df: DataFrame, key: str, text_col: str) -> DataFrame:
    return (df.select(key, F.posexplode(ent.extract_entities(text_col)).alias("pos", "e"))
              .select(key, "pos", F.col("e.type").alias("type"), F.col("e.value").alias("value")))


@query("extract_entities")
def q_extract_entities(spark, sf):
    return explode_entities(support_text(spark, sf), "row_id", "query_text")


@query("entities_on_raw")
def q_entities_on_raw(spark, sf):
    return explode_entities(_docs(spark, sf), "doc_id", "text")


# --- C1-C3 -------------------------------------------------------------------

@query("normalize_category")
def q_normalize_category(spark, sf):
    return views.support_queries(spark, sf).select(
        "row_id", cat.normalize_category("category", "sub_category").alias("normalized_category"))


@query("add_normalized_category")
def q_add_normalized_category(spark, sf):
    q = views.support_queries(spark, sf).select(
        "row_id", "category", F.col("sub_category").alias("Sub Category"))
    return cat.add_normalized_category(q).select("row_id", "category", "normalized_category")


@query("sentiment_by_category")
def q_sentiment_by_category(spark, sf):
    return reports.sentiment_by_category(q_normalize_category(spark, sf).join(q_add_sentiment(spark, sf), "row_id"))


# --- L1, L4, L5, L10, A1-A3 --------------------------------------------------

from ..functions import judge as jg  # noqa: E402
from ..functions import prompts as pr  # noqa: E402


@query("build_prompts")
def q_build_prompts(spark, sf):
    r = views.support_responses(spark, sf)
    tasks = F.array(
        F.struct(F.lit("synthetic").alias("task"), pr.synthetic_prompt("query", F.lit(3)).alias("m")),
        F.struct(F.lit("reply").alias("task"), pr.reply_prompt("query").alias("m")),
        F.struct(F.lit("judge").alias("task"), pr.judge_prompt("query", "response").alias("m")),
        F.struct(F.lit("classify").alias("task"), pr.classify_prompt("query").alias("m")))
    return (r.select("row_id", F.explode(tasks).alias("t"))
             .select("row_id", F.col("t.task").alias("task"),
                     F.posexplode("t.m").alias("pos", "msg"))
             .select("row_id", "task", "pos", F.col("msg.role").alias("role"),
                     F.col("msg.content").alias("content")))


@query("coerce_score")
def q_coerce_score(spark, sf):
    v = F.try_parse_json("raw")
    return views.judge_raw(spark, sf).select(
        "row_id", jg.coerce_score(F.try_variant_get(v, "$.helpfulness", "variant")).alias("score"))


def judge_scores(spark, sf) -> DataFrame:
    return views.judge_raw(spark, sf).select("row_id", jg.parse_judge("raw").alias("s")).select(
        "row_id", "s.relevance", "s.helpfulness", "s.tone", "s.explanation")


def judged_replies(spark, sf) -> DataFrame:
    """Scores of every reply, written once: the reports read them repeatedly."""
    from ..session import materialize
    return materialize(q_judge_replies(spark, sf))


@query("parse_judge_scores")
def q_parse_judge_scores(spark, sf):
    return judge_scores(spark, sf)


@query("parse_synthetic_queries")
def q_parse_synthetic_queries(spark, sf):
    return views.synthetic_raw(spark, sf).select(
        "topic_id", "topic", F.posexplode(pr.parse_synthetic("raw")).alias("pos", "query"))


@query("llm_quality_avg")
def q_llm_quality_avg(spark, sf):
    return reports.quality_averages(judged_replies(spark, sf))


@query("llm_quality_dist")
def q_llm_quality_dist(spark, sf):
    return reports.quality_distributions(judged_replies(spark, sf))


@query("llm_quality_summary")
def q_llm_quality_summary(spark, sf):
    return reports.quality_summary(judged_replies(spark, sf))


# --- M3-M10 ------------------------------------------------------------------

from ..operators import topics as tp  # noqa: E402
from ..operators import vectors as vx  # noqa: E402


def _emb(spark, sf):
    return tables.read_table(spark, sf, "embeddings")


@query("l2_normalize")
def q_l2_normalize(spark, sf):
    # Scale each component by its 1-based position so the input is not unit length.
    scaled = F.transform(vx.as_double_array("embedding"), lambda x, i: x * (i + 1))
    return (_emb(spark, sf).select("vec_id", F.posexplode(vx.l2_normalize(scaled)).alias("pos", "x"))
            .select("vec_id", "pos", F.round("x", 4).alias("value")))


def label_centroids(spark, sf):
    return vx.centroid_means(_emb(spark, sf), "embedding", "label")


def assigned(spark, sf):
    return vx.assign_nearest(_emb(spark, sf), "embedding", label_centroids(spark, sf))


@query("kmeans_assign")
def q_kmeans_assign(spark, sf):
    return assigned(spark, sf).select("vec_id", "topic")


@query("kmeans_step")
def q_kmeans_step(spark, sf):
    step = vx.centroid_means(assigned(spark, sf), "embedding", "topic")
    return (step.select("topic", "members", F.posexplode("centroid").alias("pos", "x"))
                .select("topic", "pos", F.round("x", 4).alias("value"),
                        F.col("members").cast("bigint").alias("members")))


@query("kmeans_topics")
def q_kmeans_topics(spark, sf):
    _, labelled = vx.kmeans_fit(_emb(spark, sf), "embedding", k=10, seed=42)
    return labelled.select("vec_id", "topic")


@query("unique_clusters")
def q_unique_clusters(spark, sf):
    return tp.unique_clusters(assigned(spark, sf), "topic")


@query("topic_samples")
def q_topic_samples(spark, sf):
    lab = tables.read_table(spark, sf, "labels")
    docs = _docs(spark, sf).join(lab, "doc_id").select(
        "doc_id", "text", (F.col("quality") * 2 + F.col("toxic")).alias("topic"))
    s = tp.topic_samples(docs, "text", "topic", "doc_id", 5)
    return s.select("topic", F.posexplode("samples").alias("pos", "sample"))


@query("topic_head")
def q_topic_head(spark, sf):
    return tp.topic_head(_emb(spark, sf).select(F.col("label").alias("topic"), "vec_id"),
                         "topic", "vec_id", 5)


# --- T6, T8, T11, T12 --------------------------------------------------------

from ..operators import cleaning, lemmas, noisy_channel, spelling  # noqa: E402


def lexicon(spark, sf):
    """Dictionary learned from the whole ``documents`` corpus, materialised once:
    the cleaning plan reads it in several branches."""
    from ..session import materialize
    return materialize(q_build_lexicon(spark, sf))


@query("build_lexicon")
def q_build_lexicon(spark, sf):
    return spelling.build_lexicon(_docs(spark, sf), "text", per_million=50)


def _support_tokens(spark, sf):
    return cleaning.explode_tokens(support_text(spark, sf), "row_id", "query_text")


@query("spell_suggest")
def q_spell_suggest(spark, sf):
    vocab = _support_tokens(spark, sf).select("token").distinct()
    return spelling.correction_table(vocab, lexicon(spark, sf))


@query("spell_correct")
def q_spell_correct(spark, sf):
    return cleaning.clean_texts(support_text(spark, sf), "row_id", "query_text", lexicon(spark, sf),
                                correct=True, lemmatize=False, stop_words=()).select("row_id", "clean")


def _noisy(spark, sf):
    """Counts of the documents and of the queries themselves, which hold the
    words of their domain."""
    texts = support_text(spark, sf)
    corpus = _docs(spark, sf).select("text").union(texts.select("query_text"))
    return noisy_channel.correct_texts(texts, "row_id", "query_text", noisy_channel.Channel(corpus))


@query("spell_noisy_channel")
def q_spell_noisy_channel(spark, sf):
    return _noisy(spark, sf).select("row_id", F.concat_ws(" ", "tokens").alias("written"),
                                    F.concat_ws(" ", "corrected").alias("corrected"))


@query("spell_rewrite_share")
def q_spell_rewrite_share(spark, sf):
    return noisy_channel.rewrite_share(_noisy(spark, sf))


@query("lemmatize")
def q_lemmatize(spark, sf):
    return lemmas.lemma_table(_support_tokens(spark, sf), lexicon(spark, sf))


@query("clean_text")
def q_clean_text(spark, sf):
    return cleaning.clean_texts(support_text(spark, sf), "row_id", "query_text",
                                lexicon(spark, sf)).select("row_id", "clean")


@query("prepare_queries")
def q_prepare_queries(spark, sf):
    q = support_text(spark, sf).withColumnRenamed("query_text", "Queries")
    return flows.prepare_queries(q, lexicon(spark, sf))


@query("prepare_first_column")
def q_prepare_first_column(spark, sf):
    """S3: no column is called ``Queries``, so the first one holds the texts."""
    q = support_text(spark, sf).select(F.col("query_text").alias("message"), "row_id")
    return flows.prepare_queries(q, lexicon(spark, sf))


@query("clean_responses")
def q_clean_responses(spark, sf):
    r = views.support_responses(spark, sf)
    return cleaning.clean_texts(r, "row_id", "response", lexicon(spark, sf)).select("row_id", "clean")


# --- L2, L3, L6, L7, L9, L10, M1, N1-N5 --------------------------------------

from ..operators import asof, assist, models, sentiment, similarity, tfidf  # noqa: E402
from ..operators.ledger import CallLedger  # noqa: E402
from ..session import ensure_checkpoint_dir, materialize  # noqa: E402


@query("llm_batch")
def q_llm_batch(spark, sf):
    r = views.support_responses(spark, sf).select(
        "row_id", pr.judge_prompt("query", "response").alias("m"))
    return models.chat_batch(r, "row_id", "m", models.stub_chat_client, task="judge", on_error="null")


@query("generate_replies")
def q_generate_replies(spark, sf):
    return assist.generate_replies(support_text(spark, sf), "query_text", models.stub_chat_client)


def _ledger_runs(spark, sf):
    """The replies of all queries asked for twice over one ledger."""
    ledger = CallLedger(spark, scratch_path(spark, f"ledger-{uuid.uuid4().hex}"))
    for _ in range(2):
        replies = assist.generate_replies(support_text(spark, sf), "query_text", models.stub_chat_client, ledger=ledger)
    return ledger, replies


@query("llm_ledger")
def q_llm_ledger(spark, sf):
    return _ledger_runs(spark, sf)[1]


@query("llm_ledger_facts")
def q_llm_ledger_facts(spark, sf):
    """What two runs paid for: one ledger row per different query."""
    ledger, replies = _ledger_runs(spark, sf)
    asked = replies.agg(F.count(F.lit(1)).alias("asked"), F.count("response").alias("answered"))
    return asked.withColumn("paid", ledger.rows().agg(F.count(F.lit(1)).alias("n")).scalar())


@query("judge_replies")
def q_judge_replies(spark, sf):
    r = views.support_responses(spark, sf)
    return assist.judge_replies(r, "query", "response", models.stub_chat_client).select("row_id", "scores.*")


@query("generate_and_score")
def q_generate_and_score(spark, sf):
    out = flows.generate_and_judge(support_text(spark, sf), "query_text", models.stub_chat_client)
    return out.select("row_id", "response", "scores.*")


@query("classify_queries")
def q_classify_queries(spark, sf):
    return assist.classify_queries(support_text(spark, sf), "query_text", models.stub_chat_client)


@query("generate_synthetic")
def q_generate_synthetic(spark, sf):
    # One request per distinct topic (event type) of all events.
    events = tables.read_table(spark, sf, "events")
    return assist.generate_synthetic(events, "event_type", models.stub_chat_client, n=5)


@query("truncate_tokens")
def q_truncate_tokens(spark, sf):
    return _docs(spark, sf).select("doc_id", tx.truncate_tokens("text", 256).alias("truncated"))


@query("add_sentiment")
def q_add_sentiment(spark, sf):
    r = views.support_responses(spark, sf)
    return r.select("row_id", models.classify_batch(F.col("response"), models.stub_sentiment_model,
                                                    batch_size=64, max_tokens=256).alias("sentiment"))


@query("sentiment_lexicon")
def q_sentiment_lexicon(spark, sf):
    s = support_text(spark, sf)
    return s.select("row_id", sentiment.lexicon_sentiment("query_text").alias("sentiment"),
                    sentiment.lexicon_score(tx.basic_tokens("query_text")).alias("score"))


@query("sentiment_model")
def q_sentiment_model(spark, sf):
    docs = _docs(spark, sf)
    train = docs.join(tables.read_table(spark, sf, "labels"), "doc_id").select("doc_id", "text", "quality")
    model = sentiment.train_text_classifier(train, "text", "quality")
    return sentiment.predict_text_classifier(model, docs.select("doc_id", "text")).select(
        "doc_id", "sentiment", F.round("p_positive", 4).alias("p_positive"))


@query("sentiment_model_auc")
def q_sentiment_model_auc(spark, sf):
    """Held-out AUC of the trained classifier: deterministic 80/20 split of the
    labelled documents by a hash of doc_id (the split is the feature here)."""
    lab = _docs(spark, sf).join(tables.read_table(spark, sf, "labels"), "doc_id").select(
        "doc_id", "text", "quality")
    held_out = F.pmod(F.xxhash64("doc_id"), F.lit(5)) == 0
    train, test = lab.where(~held_out), lab.where(held_out)
    model = sentiment.train_text_classifier(train, "text", "quality")
    value = sentiment.auc(model, test, "quality")
    n = test.count()
    return spark.createDataFrame([(float(value), int(n))], "auc double, test_rows bigint")


@query("sentiment_counts")
def q_sentiment_counts(spark, sf):
    return sentiment.sentiment_counts(q_add_sentiment(spark, sf))


@query("sentiment_share")
def q_sentiment_share(spark, sf):
    return sentiment.sentiment_share(q_add_sentiment(spark, sf))


@query("embed_tfidf")
def q_embed_tfidf(spark, sf):
    docs = _docs(spark, sf)
    w = tfidf.tfidf_from_texts(docs, "doc_id", tx.remove_stopwords(tx.basic_tokens("text")))
    return w.select("doc_id", "term", F.round("weight", 4).alias("weight"))


def _embedded(spark, sf, normalize: bool):
    s = support_text(spark, sf)
    emb = models.encode_batch(F.col("query_text"), models.stub_encoder(16), dim=16, batch_size=64,
                              normalize=normalize)
    return (s.select("row_id", emb.alias("e")).select("row_id", F.posexplode("e").alias("pos", "x"))
             .select("row_id", "pos", F.round(F.col("x").cast("double"), 4).alias("value")))


@query("embed_batch_model")
def q_embed_batch_model(spark, sf):
    return _embedded(spark, sf, True)


@query("embed_batch_raw")
def q_embed_batch_raw(spark, sf):
    return _embedded(spark, sf, False)


def cluster_facts(fitted: DataFrame, again: DataFrame, vector: str, key: str, k: int) -> DataFrame:
    """What holds of any correct clustering: every row labelled 0..k-1, the same
    labels from the same seed, and a cost that one refinement step from the
    labels' own means does not worsen by more than rounding."""
    fitted = materialize(fitted.select(key, vector, "topic"))
    same = fitted.join(again.select(F.col(key), F.col("topic").alias("topic2")), key)
    means = vx.centroid_means(fitted, vector, "topic").select("topic", "centroid")
    cost = F.aggregate(F.zip_with(vx.as_double_array(vector), "centroid", lambda a, b: (a - b) * (a - b)),
                       F.lit(0.0), lambda a, b: a + b)
    own = fitted.join(means, "topic").select(F.sum(cost).alias("own"))
    near = vx.assign_nearest(fitted.select(key, vector), vector, means).join(means, "topic")
    best = near.select(F.sum(cost).alias("best"))
    return fitted.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.min("topic") >= 0, F.lit(True)).alias("low"),
                      F.coalesce(F.max("topic") < k, F.lit(True)).alias("high")).select(
        "n", (F.col("low") & F.col("high")).alias("labels_in_range"),
        (same.where(F.col("topic") != F.col("topic2")).select(F.count(F.lit(1))).scalar() == 0).alias("same_again"),
        (own.select("own").scalar() <= best.select("best").scalar() * 1.01 + 1e-9).alias("settled"))


@query("kmeans_topics_facts")
def q_kmeans_topics_facts(spark, sf):
    fits = [vx.kmeans_fit(_emb(spark, sf), "embedding", k=10, seed=42)[1] for _ in range(2)]
    return cluster_facts(*fits, "embedding", "vec_id", 10)


@query("sentiment_model_facts")
def q_sentiment_model_facts(spark, sf):
    """What holds of any trained classifier here: a label and a probability for
    every document, and an AUC of 0.9 or more on the texts it was trained on
    (``sentiment_model_auc`` has the held-out AUC)."""
    docs = _docs(spark, sf)
    train = materialize(docs.join(tables.read_table(spark, sf, "labels"), "doc_id").select("doc_id", "text", "quality"))
    model = sentiment.train_text_classifier(train, "text", "quality")
    out = sentiment.predict_text_classifier(model, docs.select("doc_id", "text"))
    ok = F.col("p_positive").between(0, 1) & F.col("sentiment").isin("POSITIVE", "NEGATIVE")
    return out.agg(F.count(F.lit(1)).alias("n"), F.min(ok).alias("in_range")).withColumn(
        "auc_above_floor", F.lit(sentiment.auc(model, train, "quality") >= 0.9))


# --- S4-S7, E7, P1-P3, A5, streaming -----------------------------------------

import uuid  # noqa: E402

from ..plans import flows  # noqa: E402
from ..session import scratch_path  # noqa: E402
from ..sources import writers  # noqa: E402
from ..streaming import events, live  # noqa: E402


@query("sample_first_n")
def q_sample_first_n(spark, sf):
    return flows.first_n(support_text(spark, sf), 5)


@query("example_pairs")
def q_example_pairs(spark, sf):
    # the rows to show first: only they are judged
    r = flows.first_n(views.support_responses(spark, sf).select("row_id", "query", "response"), 3)
    r = materialize(r)
    scores = assist.judge_replies(r, "query", "response", models.stub_chat_client)
    return r.join(scores, "row_id").select("row_id", "query", "response", "scores.*")


@query("sentiment_sample")
def q_sentiment_sample(spark, sf):
    r = materialize(flows.first_n(views.support_responses(spark, sf).select("row_id", "response"), 5))
    return r.select("row_id", models.classify_batch(F.col("response"), models.stub_sentiment_model,
                                                    batch_size=64, max_tokens=256).alias("sentiment"))


@query("pair_query_response")
def q_pair_query_response(spark, sf):
    rs = views.support_responses(spark, sf).select("row_id", "response")
    return flows.pair_query_response(support_text(spark, sf), rs)


def _nearest_embeddings(spark, sf, exact):
    emb = tables.read_table(spark, sf, "embeddings")
    index = similarity.VectorIndex(emb, "vec_id", "embedding")
    return index.search(emb.where(F.col("vec_id") % 50 == 0), "vec_id", "embedding", k=10, exact=exact)


@query("similar_exact")
def q_similar_exact(spark, sf):
    """The ten nearest vectors of every vector whose id is divisible by 50."""
    out = _nearest_embeddings(spark, sf, exact=True)
    return out.select("query_id", "rank", "id", F.round("similarity", 4).alias("similarity"))


@query("similar_recall")
def q_similar_recall(spark, sf):
    """Whether the probed lists hold nine tenths of the true neighbours."""
    emb = tables.read_table(spark, sf, "embeddings")
    index = similarity.VectorIndex(emb, "vec_id", "embedding")
    asked = emb.where(F.col("vec_id") % 50 == 0)
    probes = index.probes_for(0.95, k=10)
    near, truth = (materialize(index.search(asked, "vec_id", "embedding", k=10, probes=probes, exact=e))
                   for e in (False, True))
    return truth.agg(F.count(F.lit(1)).alias("neighbours")).withColumn(
        "recall_reached", similarity.recall(near, truth) >= 0.9)


@query("reply_similarity")
def q_reply_similarity(spark, sf):
    """How close each reply is to its query, from the embeddings of both."""
    r = views.support_responses(spark, sf)
    pair = r.select("row_id", *[models.encode_batch(F.col(c), models.stub_encoder(16), 16, normalize=False).alias(c)
                              for c in ("query", "response")])
    return pair.select("row_id", F.round(similarity.cosine("query", "response"), 4).alias("similarity"))


@query("asof_events")
def q_asof_events(spark, sf):
    """Each purchase with its user's latest click before it."""
    events = tables.read_table(spark, sf, "events").select("event_id", "user_id", "ts", "event_type", "value")
    out = asof.asof_join(events.where("event_type = 'purchase'"), events.where("event_type = 'click'"), ["user_id"],
                         "ts", "ts", prefix="click_", strict=True, tie=["event_id"])
    return out.select("event_id", "user_id", "click_event_id", F.round("click_value", 4).alias("click_value"),
                      F.date_format("click_ts", "yyyy-MM-dd HH:mm:ss").alias("click_at"))


@query("pair_by_position")
def q_pair_by_position(spark, sf):
    """The n-th user turn beside the n-th assistant turn, no key between them."""
    turns = tables.read_table(spark, sf, "conversations")
    side = lambda role, c, t: turns.where(F.col("role") == role).select(
        F.col("conv_id").alias(f"{c}_conv"), F.col("turn").alias(f"{c}_turn"), F.col("text").alias(t))
    return positions.pair_by_position(side("user", "query", "query"), side("assistant", "reply", "response"),
                                      ["query_conv", "query_turn"], ["reply_conv", "reply_turn"])


# --- topics that keep their numbers --------------------------------------------

from ..operators import stable_topics as st  # noqa: E402


@query("topics_absorb")
def q_topics_absorb(spark, sf):
    """The embeddings taken into the label centroids in two batches: members of
    each topic, and whether the means cost no more than the centroids."""
    emb, state = _emb(spark, sf), st.start(label_centroids(spark, sf))
    before = st.cost(emb, "embedding", state.select("topic", "centroid")).scalar()
    for half in (0, 1):
        state = st.absorb(state, emb.where(F.pmod("vec_id", F.lit(2)) == half), "embedding")
    after = st.cost(emb, "embedding", st.served(state)).scalar()
    return state.where("members > 0").select("topic", "members", (after <= before * (1 + 1e-9)).alias("cost_not_worse"))


@query("topics_matched")
def q_topics_matched(spark, sf):
    """The nearest centroid of every embedding after the same centroids came
    back from a fit under other numbers."""
    old = st.start(label_centroids(spark, sf)).select("topic", "centroid")
    again = old.select((F.lit(1000) - F.col("topic")).alias("topic"), "centroid")
    return vx.assign_nearest(_emb(spark, sf), "embedding", st.match_topics(old, again)).select("vec_id", "topic")


# --- cubes with distinct counts, exact and sketched ----------------------------

from ..operators import cubes  # noqa: E402


def dated_events(spark, sf) -> DataFrame:
    return tables.read_table(spark, sf, "events").select(
        F.to_date("ts").alias("day"), "event_type", "user_id", "props")


@query("activity_cube")
def q_activity_cube(spark, sf):
    """Events and distinct users by day and type, with all totals."""
    return cubes.distinct_cube(dated_events(spark, sf), ["day", "event_type"], "user_id", "users")


@query("text_cube")
def q_text_cube(spark, sf):
    """Documents and distinct texts by language and source, with all totals."""
    return cubes.distinct_cube(_docs(spark, sf), ["lang", "source"], "text", "texts")


@query("activity_sketches_facts")
def q_activity_sketches_facts(spark, sf):
    """Sketches stored in three runs, the last of which repeats a day, against
    the exact cube and against sketches made in one pass."""
    events, dims = dated_events(spark, sf), ["day", "event_type"]
    store = cubes.SketchStore(spark, scratch_path(spark, f"sketches-{uuid.uuid4().hex}"), "day", ["event_type"])
    odd = F.pmod(F.dayofmonth("day"), F.lit(2)) == 1
    for part in (events.where(odd), events.where(~odd), events.where(F.dayofmonth("day") == 3)):
        store.add(part, "user_id")
    merged = store.cube(dims, "merged").select(*dims, "level", "n", "sketch", "merged")
    once = events.cube(*dims).agg(F.grouping_id().cast("int").alias("level"),
                                  F.hll_sketch_agg("user_id", cubes.LG_K).alias("whole"))
    exact = cubes.distinct_cube(events, dims, "user_id", "users").drop("n")
    both = [F.col(f"m.{d}").eqNullSafe(F.col(f"o.{d}")) for d in (*dims, "level")]
    rows = merged.alias("m").join(once.alias("o"), both).select("m.*", "o.whole").alias("m").join(exact.alias("o"), both)
    # a sketch merged with itself has the same registers and no history
    settled = lambda c: F.hll_sketch_estimate(F.hll_union(c, c))
    near = F.abs(F.col("merged") - F.col("users")) <= 1 + 0.08 * F.col("users")  # five standard errors
    return rows.select("m.day", "m.event_type", "m.level", "m.n", "users",
                       (settled("sketch") == settled("whole")).alias("same_as_one_pass"), near.alias("near_exact"))


@query("workbook_roundtrip")
def q_workbook_roundtrip(spark, sf):
    """All conversation turns written as workbooks and read back."""
    turns = tables.read_table(spark, sf, "conversations")
    books = materialize(workbooks.to_workbooks(turns, "Queries"))
    return workbooks.parse_workbooks(books, "Queries", turns.schema, name_col="name")


@query("entities_on_clean")
def q_entities_on_clean(spark, sf):
    c = cleaning.clean_texts(support_text(spark, sf), "row_id", "query_text", lexicon(spark, sf))
    return explode_entities(c, "row_id", "clean")


def _processed_queries(spark, sf):
    q = support_text(spark, sf)
    c = cleaning.clean_texts(q, "row_id", "query_text", lexicon(spark, sf))
    return q.join(c, "row_id").withColumn("entities", ent.extract_entities("query_text"))


@query("export_csv_roundtrip")
def q_export_csv_roundtrip(spark, sf):
    ensure_checkpoint_dir(spark)
    path = scratch_path(spark, f"export-csv-{uuid.uuid4().hex}")
    writers.write_csv(_processed_queries(spark, sf), path)
    return writers.read_csv(spark, path, "row_id bigint, query_text string, clean string, "
                                         "length int, entities string")


@query("export_json_roundtrip")
def q_export_json_roundtrip(spark, sf):
    ensure_checkpoint_dir(spark)
    lab = tables.read_table(spark, sf, "labels")
    docs = _docs(spark, sf).join(lab, "doc_id").select(
        "doc_id", "text", (F.col("quality") * 2 + F.col("toxic")).alias("topic"))
    path = scratch_path(spark, f"export-json-{uuid.uuid4().hex}")
    writers.write_json(tp.topic_samples(docs, "text", "topic", "doc_id", 5), path)
    back = writers.read_json(spark, path, "topic int, samples array<string>")
    return back.select("topic", F.posexplode("samples").alias("pos", "sample"))


@query("support_artifacts")
def q_support_artifacts(spark, sf):
    wide = flows.support_artifacts(
        support_text(spark, sf), "query_text", lexicon(spark, sf), models.stub_chat_client,
        models.stub_encoder(16), 16, models.stub_sentiment_model, with_topics=False)
    return wide.select("row_id", "query", "response", "scores.relevance", "scores.helpfulness",
                       "scores.tone", "scores.explanation", "clean_query", "clean_response",
                       F.to_json("query_entities").alias("query_entities"), "response_sentiment")


def _topic_artifacts(spark, sf):
    return flows.support_artifacts(
        support_text(spark, sf), "query_text", lexicon(spark, sf), models.stub_chat_client,
        models.stub_encoder(16), 16, models.stub_sentiment_model, with_topics=True)


@query("support_topics")
def q_support_topics(spark, sf):
    return _topic_artifacts(spark, sf).select("row_id", "topic")


@query("support_topics_facts")
def q_support_topics_facts(spark, sf):
    fitted = _topic_artifacts(spark, sf)
    again = vx.kmeans_fit(fitted.drop("topic"), "query_embedding", k=10, seed=42)[1]
    return cluster_facts(fitted, again, "query_embedding", "row_id", 10)


@query("support_embeddings")
def q_support_embeddings(spark, sf):
    """Query and reply embeddings of the pipeline."""
    wide = flows.support_artifacts(
        support_text(spark, sf), "query_text", lexicon(spark, sf), models.stub_chat_client,
        models.stub_encoder(16), 16, models.stub_sentiment_model, with_topics=False)
    return wide.select("row_id", F.posexplode(F.arrays_zip("query_embedding", "response_embedding")).alias("pos", "e")) \
        .select("row_id", "pos", F.round(F.col("e.query_embedding").cast("double"), 4).alias("query_value"),
                F.round(F.col("e.response_embedding").cast("double"), 4).alias("response_value"))


@query("overall_report")
def q_overall_report(spark, sf):
    """A5: the parts of the report as one table (part, row, content)."""
    scored = materialize(q_judge_replies(spark, sf))
    parts = flows.overall_report(scored, assigned(spark, sf), q_sentiment_sample(spark, sf),
                                 q_example_pairs(spark, sf))
    out = None
    for name, df in sorted(parts.items()):
        # content: "column=value" of the part's columns in alphabetical order
        content = F.concat_ws("; ", *[F.concat(F.lit(c + "="), F.coalesce(F.col(c).cast("string"), F.lit("null")))
                                      for c in sorted(df.columns) if c != "row_id"])
        key = F.col("row_id") if "row_id" in df.columns else F.lit(0).cast("bigint")
        part = df.select(F.lit(name).alias("part"), key.alias("row_id"), content.alias("content"))
        out = part if out is None else out.unionByName(part)
    return out


@query("flagship")
def q_flagship(spark, sf):
    qs = views.support_queries(spark, sf).select(
        "row_id", F.concat_ws(" ", "short_text", "long_text").alias("query_text"),
        "category", "sub_category")
    rs = views.support_responses(spark, sf).select("row_id", "response")
    out = flows.app_flow(qs, "query_text", lexicon(spark, sf), rs, models.stub_sentiment_model)
    return out.select("row_id", "clean", "length", "entities", "normalized_category",
                      "reply_sentiment")


def _cleaned_stream(spark, sf, entities_on):
    ensure_checkpoint_dir(spark)
    run = scratch_path(spark, f"stream-{uuid.uuid4().hex}")
    conv_schema = tables.SCHEMAS["conversations"]
    stream = (live.support_text_stream(spark, f"{sf.rstrip('/')}/conversations*.parquet", conv_schema)
                  .where(F.col("role") == "user")
                  .select((F.col("conv_id") * 4294967296 + F.col("turn")).alias("row_id"), "text"))
    lex = q_build_lexicon(spark, sf)  # written by the stream setup
    q = live.clean_micro_batches(stream, "row_id", "text", lex, f"{run}/sink", f"{run}/checkpoint", entities_on=entities_on)
    q.awaitTermination()
    return live.read_sink(spark, f"{run}/sink").select("row_id", "clean", "length", "entities")


@query("stream_clean")
def q_stream_clean(spark, sf):
    return _cleaned_stream(spark, sf, "clean")


def _event_times(spark, sf):
    return tables.read_table(spark, sf, "events").select(
        "event_id", "event_type", "value", F.col("ts").cast("timestamp").alias("ts"))


@query("stream_window_counts")
def q_stream_window_counts(spark, sf):
    """Events per hour and type, counted as they arrive in several micro-batches."""
    ensure_checkpoint_dir(spark)
    run = scratch_path(spark, f"stream-{uuid.uuid4().hex}")
    rows = _event_times(spark, sf)
    files = events.replay(rows, "ts", f"{run}/arrivals")
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", files).parquet(f"{run}/arrivals")
    # arrivals are cut by time: a delay of two of them loses nothing
    counts = events.windowed_counts(stream, "ts", "event_type", "1 hour", "20 days",
                                    {"largest": F.max("value"), "last_event": F.max("event_id")})
    events.write_updates(counts, f"{run}/sink", f"{run}/checkpoint").awaitTermination()
    out = events.latest(spark, f"{run}/sink", ["window_start", "event_type"])
    return out.withColumn("window_start", F.date_format("window_start", "yyyy-MM-dd HH:mm:ss")).withColumn(
        "largest", F.round("largest", 4))


@query("stream_pairing")
def q_stream_pairing(spark, sf):
    """User turns with the assistant turns that follow, two streams joined as
    they arrive. A turn's time is made of its conversation and number."""
    ensure_checkpoint_dir(spark)
    run = scratch_path(spark, f"stream-{uuid.uuid4().hex}")
    at = F.timestamp_seconds(1_700_000_000 + F.col("conv_id") * 3600 + F.col("turn"))
    turns = tables.read_table(spark, sf, "conversations").withColumn("at", at)
    files = events.replay(turns, "at", f"{run}/arrivals")
    # turns far ahead on both sides settle all queries before them: the first
    # moves the watermark, the second is a micro-batch that sees it moved (with
    # a key: rows that cannot join are filtered before they are seen)
    for seconds in (1 << 40, (1 << 40) + 1):
        spark.createDataFrame([(-1, None, r, None) for r in ("user", "assistant")], turns.drop("at").schema).withColumn(
            "at", F.timestamp_seconds(F.lit(seconds))).repartition(files).write.mode("append").parquet(f"{run}/arrivals")
    side = lambda role: (spark.readStream.schema(turns.schema).option("maxFilesPerTrigger", files)
                         .parquet(f"{run}/arrivals").where(F.col("role") == role))
    asked = side("user").select("conv_id", "turn", F.col("text").alias("query"), F.col("at").alias("asked_at"))
    given = side("assistant").select("conv_id", F.col("text").alias("response"), F.col("at").alias("replied_at"))
    pairs = events.pair_stream(asked, given, "conv_id", "asked_at", "replied_at", "1 second", "1 day")
    events.write_pairs(pairs, f"{run}/sink", f"{run}/checkpoint").awaitTermination()
    done = spark.read.parquet(f"{run}/sink").where("turn IS NOT NULL")
    return done.select("conv_id", "turn", "query", "response")
