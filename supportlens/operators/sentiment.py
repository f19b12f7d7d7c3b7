"""Sentiment.

Two offline classifiers besides user models (``models.classify_batch``):

* ``lexicon_sentiment`` -- a column expression: positive minus negative word
  hits over the cleaned tokens, ties POSITIVE (our own small word lists).
* ``train_text_classifier`` -- an MLlib pipeline (tokens -> hashed TF -> IDF ->
  logistic regression) trained on a labelled table; fully distributed.

Counts and shares are aggregates over the label column.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as tx
from ..session import materialize

BINARY_LABELS = ("POSITIVE", "NEGATIVE")

# Our own word lists for the offline lexicon classifier.
POSITIVE_WORDS = ("good", "great", "happy", "thanks", "thank", "love", "excellent", "awesome",
                  "pleased", "helpful", "glad", "perfect", "wonderful", "resolved", "appreciate",
                  "fast", "easy", "nice", "satisfied", "quick")
NEGATIVE_WORDS = ("bad", "terrible", "angry", "failed", "fail", "broken", "cant", "never",
                  "worst", "problem", "issue", "late", "wrong", "poor", "disappointed", "twice",
                  "forgot", "lost", "slow", "missing")


def lexicon_score(tokens) -> Column:
    t = F.col(tokens) if isinstance(tokens, str) else tokens
    pos = F.size(F.filter(t, lambda w: w.isin(list(POSITIVE_WORDS))))
    neg = F.size(F.filter(t, lambda w: w.isin(list(NEGATIVE_WORDS))))
    return pos - neg


def lexicon_sentiment(text) -> Column:
    """N1 (offline): POSITIVE when positive hits >= negative hits."""
    score = lexicon_score(tx.basic_tokens(text))
    return F.when(score >= 0, F.lit("POSITIVE")).otherwise(F.lit("NEGATIVE"))


def sentiment_counts(df: DataFrame, col: str = "sentiment", labels=BINARY_LABELS) -> DataFrame:
    """Count per label in fixed order; zero counts kept, other labels dropped."""
    order = df.sparkSession.createDataFrame(
        [(lab, i) for i, lab in enumerate(labels)], f"{col} string, ord int")
    counts = df.where(F.col(col).isin(list(labels))).groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    return (order.join(F.broadcast(counts), col, "left")  # both sides <= len(labels) rows
                 .select(col, "ord", F.coalesce("n", F.lit(0)).alias("n")).orderBy("ord"))


def sentiment_share(df: DataFrame, col: str = "sentiment") -> DataFrame:
    """Percentage per observed label (missing labels excluded), descending."""
    counts = materialize(df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("n")))
    total = counts.select(F.sum("n")).scalar()
    return (counts.select(col, F.round(F.col("n") * 100.0 / total, 4).alias("share"))
                  .orderBy(F.desc("share"), col))


def train_text_classifier(train: DataFrame, text: str, label: str, num_features: int = 1 << 18,
                          reg: float = 0.01, max_iter: int = 50):
    """N1 (trained): MLlib pipeline fitted on (text, label 0/1)."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import IDF, HashingTF, RegexTokenizer

    stages = [
        RegexTokenizer(inputCol=text, outputCol="_tok", pattern=r"[^\p{L}]+", toLowercase=True),
        HashingTF(inputCol="_tok", outputCol="_tf", numFeatures=num_features),
        IDF(inputCol="_tf", outputCol="_features"),
        LogisticRegression(featuresCol="_features", labelCol=label, regParam=reg, maxIter=max_iter,
                           predictionCol="_pred", probabilityCol="_prob", rawPredictionCol="_raw"),
    ]
    return Pipeline(stages=stages).fit(train.withColumn(label, F.col(label).cast("double")))


def predict_text_classifier(model, df: DataFrame, labels=("NEGATIVE", "POSITIVE")) -> DataFrame:
    from pyspark.ml.functions import vector_to_array

    out = model.transform(df)
    return (out.withColumn("sentiment", F.when(F.col("_pred") == 1.0, F.lit(labels[1]))
                           .otherwise(F.lit(labels[0])))
               .withColumn("p_positive", vector_to_array("_prob")[1])
               .drop("_tok", "_tf", "_features", "_raw", "_prob", "_pred"))


def auc(model, df: DataFrame, label: str) -> float:
    """Area under ROC of a trained classifier (reads one ML summary value)."""
    from pyspark.ml.evaluation import BinaryClassificationEvaluator

    out = model.transform(df.withColumn(label, F.col(label).cast("double")))
    return BinaryClassificationEvaluator(rawPredictionCol="_raw", labelCol=label).evaluate(out)


def add_sentiment_column(df: DataFrame, text_col: str, model_factory, batch_size: int = 64,
                         max_length: int = 256, out: str = "sentiment") -> DataFrame:
    """Add one label per row from a user model (batches of ``batch_size``,
    inputs cut to ``max_length`` tokens), loaded once per Python worker."""
    from .models import classify_batch

    return df.withColumn(out, classify_batch(F.col(text_col).cast("string"), model_factory,
                                             batch_size=batch_size, max_tokens=max_length))
