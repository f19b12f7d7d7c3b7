"""Ordinal quality model: cumulative-link regression on hashed text (operator 4).

Ratings are grades 0 < 1 < ... < K-1. One weight vector over hashed words and
shapes of a text gives a score, K-1 ordered thresholds cut it into grades:
P(grade >= k) = sigmoid(score - threshold_k). The tail probabilities select
texts, their sum is the expected grade.

The model is fitted on the driver on a bounded sample of the rated texts
(``MAX_TRAIN``, chosen by a hash of the id); every text is then scored whole,
in Arrow batches without a shuffle.

Defined cases: null and empty texts have only their shape features; texts
without a rating and ratings without a text are not used to fit; of repeated
ratings of an id the lowest counts; without ratings of at least two grades the
model is refused with an error unless the table of texts or of ratings is
empty (every text then gets the top grade); repeated rows and null ids get a
result row each. Other columns are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ship_package

MAX_TRAIN = 20_000   # rated texts used to fit
BUCKETS = 1 << 31    # of the hash; the model holds weights for those that pass:
MIN_TEXTS = 5        # a bucket that fewer sample texts have gets no weight,
MIN_Z = 3.0          # nor one whose texts' mean grade differs by less (standard errors)
WORD_CACHE = 200_000  # remembered per Python worker (memory bound only)

_SYMBOLS = b"#*$%&|<>"
_UPPER = bytes(range(65, 91))
# A-Z lower-cased, other ASCII but letters and digits to spaces
_WORDS = bytes(c if c > 127 else ord(chr(c).lower()) if chr(c).isalnum() else 32 for c in range(256))


def _bucket(token: bytes) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(token) % BUCKETS


def shape_tokens(text: bytes, n: int, distinct: int) -> list[bytes]:
    """Coarse measures of a text as tokens of their own."""
    size = max(1, len(text))
    step = lambda x: b"%d" % min(12, int(x))
    return [b"\x00size" + step(math.log2(n + 1)), b"\x00new" + step(10 * distinct / max(1, n)),
            b"\x00sym" + step(4 * math.log2(1 + 100 * (len(text) - len(text.translate(None, _SYMBOLS))) / size)),
            b"\x00cap" + step(10 * (len(text) - len(text.translate(None, _UPPER))) / size),
            b"\x00exc" + step(4 * math.log2(1 + 100 * text.count(b"!") / size)),
            b"\x00one"]


def text_tokens(text: bytes | None) -> tuple[set[bytes], list[bytes]]:
    """Distinct words (letters and digits, A-Z lower-cased) and shape tokens."""
    text = text or b""
    words = text.translate(_WORDS).split()
    distinct = set(words)
    return distinct, shape_tokens(text, len(words), len(distinct))


def text_features(text: bytes | None) -> np.ndarray:
    """Buckets of the words and shapes present; each counts once, so that a
    telling word weighs as much in a long text as in a short one."""
    words, shape = text_tokens(text)
    return np.fromiter((_bucket(w) for w in [*words, *shape]), dtype=np.int32, count=len(words) + len(shape))


class OrdinalModel:
    """Shared weights (bucket -> weight, 0 for all others) and ordered thresholds."""

    def __init__(self, weights: dict[int, float], thresholds: np.ndarray):
        self.weights, self.thresholds = weights, thresholds

    def tails(self, scores: np.ndarray) -> np.ndarray:
        """P(grade >= 1), ..., P(grade >= K-1) in columns, never rising."""
        return 1 / (1 + np.exp(-(scores[:, None] - self.thresholds[None, :])))

    @classmethod
    def fit(cls, idx: np.ndarray, start: np.ndarray, grade: np.ndarray,
            rounds: int = 200, rate: float = 0.1, decay: float = 1e-4) -> OrdinalModel:
        """Maximum likelihood by Adam over rows ``idx[start[i]:start[i + 1]]``.
        Thresholds are a first one and positive gaps, so they stay ordered."""
        k = int(grade.max())
        rows = np.repeat(np.arange(len(grade)), np.diff(start))
        buckets, col = np.unique(idx, return_inverse=True)
        seen = np.bincount(col)
        off = np.bincount(col, ((grade - grade.mean()) / max(grade.std(), 1e-9))[rows])
        used = (seen >= min(MIN_TEXTS, len(grade))) & (np.abs(off) >= MIN_Z * np.sqrt(seen))
        keep = used[col]  # entries of the buckets that get a weight, numbered anew
        rows, col = rows[keep], (np.cumsum(used) - 1)[col[keep]]
        buckets = buckets[used]
        size = len(buckets)
        share = np.array([np.clip((grade >= g).mean(), 0.01, 0.99) for g in range(1, k + 1)])
        first = -np.log(share / (1 - share))
        gaps = np.log(np.maximum(np.diff(first), 0.1))
        params = [np.zeros(size), np.concatenate([first[:1], gaps])]
        m, v = ([np.zeros_like(p) for p in params] for _ in range(2))
        n = len(grade)
        for step in range(1, rounds + 1):
            w, th = params
            cut = np.concatenate([th[:1], th[0] + np.cumsum(np.exp(th[1:]))])
            score = np.bincount(rows, w[col], n)
            s = 1 / (1 + np.exp(-(score[:, None] - cut)))
            up = np.concatenate([np.ones((n, 1)), s], 1)[np.arange(n), grade]      # P(>= grade)
            over = np.concatenate([s, np.zeros((n, 1))], 1)[np.arange(n), grade]   # P(> grade)
            p = np.maximum(up - over, 1e-9)
            d_up, d_over = up * (1 - up), over * (1 - over)
            g_score = (d_up - d_over) / p / n
            g_cut = np.zeros(k)
            np.add.at(g_cut, grade[grade > 0] - 1, -(d_up / p / n)[grade > 0])
            np.add.at(g_cut, grade[grade < k], (d_over / p / n)[grade < k])
            tail = g_cut[::-1].cumsum()[::-1]
            g_th = np.concatenate([tail[:1], tail[1:] * np.exp(th[1:])])
            grads = [np.bincount(col, g_score[rows], size) - decay * w, g_th]
            for i, g in enumerate(grads):
                m[i] = 0.9 * m[i] + 0.1 * g
                v[i] = 0.99 * v[i] + 0.01 * g * g
                params[i] = params[i] + rate * (m[i] / (1 - 0.9 ** step)) / (
                    np.sqrt(v[i] / (1 - 0.99 ** step)) + 1e-8)
        w, th = params
        cut = np.concatenate([th[:1], th[0] + np.cumsum(np.exp(th[1:]))])
        return cls(dict(zip(buckets.tolist(), w.tolist())), cut)


def grade_of(quality: Column, toxic: Column) -> Column:
    """Grades of the two ratings: 0 poor, 1 good but toxic, 2 good."""
    return F.when(quality == 0, 0).when(toxic == 1, 1).otherwise(2).cast("int")


def fit(docs: DataFrame, ratings: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        grade_col: str = "grade", max_train: int = MAX_TRAIN) -> OrdinalModel | None:
    """Fit on the rated texts; ``ratings`` has (id, grade)."""
    ship_package(docs.sparkSession)
    rated = (ratings.where(F.col(id_col).isNotNull() & F.col(grade_col).isNotNull())
                    .groupBy(F.col(id_col).alias("id")).agg(F.min(grade_col).alias("grade")))
    n = rated.count()
    if n > max_train:
        share = int(max_train / n * (1 << 30))
        rated = rated.where(F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < share)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("text")) \
               .join(F.broadcast(rated), "id").select("id", "grade", "text")
    schema = T.StructType([T.StructField("id", docs.schema[id_col].dataType), T.StructField("grade", T.IntegerType()),
                           T.StructField("idx", T.ArrayType(T.IntegerType()))])

    def run(batches):
        for batch in batches:
            found = [text_features(t.as_py()) for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(found, pa.list_(pa.int32()))],
                names=["id", "grade", "idx"])

    table = rows.select("id", F.col("grade").cast("int").alias("grade"), "text").mapInArrow(run, schema).toArrow()
    table = table.combine_chunks().sort_by("id")  # the same order, so the same sums, every time
    if not table.num_rows:
        return None
    grade = table["grade"].to_numpy()
    if len(np.unique(grade)) < 2:
        raise ValueError("ratings of two grades at least are needed")
    idx = table["idx"].combine_chunks()
    start = np.concatenate([[0], np.cumsum(np.diff(idx.offsets.to_numpy()))])
    return OrdinalModel.fit(idx.flatten().to_numpy(), start, grade)


def score_texts(docs: DataFrame, model: OrdinalModel | None, id_col: str = "doc_id", text_col: str = "text",
                select: int | None = None, at_least: float = 0.5) -> DataFrame:
    """Per row: id, ``score``, ``p_at_least`` (tail probabilities of grades 1,
    2, ...), ``expected_grade`` and ``kept``: P(grade >= ``select``) of
    ``at_least`` or more, by default of the top grade."""
    ship_package(docs.sparkSession)
    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType), T.StructField("score", T.DoubleType()),
                           T.StructField("p_at_least", T.ArrayType(T.DoubleType())),
                           T.StructField("expected_grade", T.DoubleType()), T.StructField("kept", T.BooleanType())])

    def run(batches):
        known: dict[bytes, float] = {}
        for batch in batches:
            if len(known) > WORD_CACHE:
                known.clear()
            scores = np.array([_score(model, known, t.as_py()) for t in batch.column(1)])
            tails = model.tails(scores) if model else np.ones((len(scores), 1))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(scores), pa.array(list(tails), pa.list_(pa.float64())),
                 pa.array(tails.sum(1)), pa.array(tails[:, -1 if select is None else select - 1] >= at_least)],
                names=[id_col, "score", "p_at_least", "expected_grade", "kept"])

    return docs.select(F.col(id_col), F.col(text_col).cast("binary")).mapInArrow(run, schema)


def _score(model: OrdinalModel | None, known: dict[bytes, float], text: bytes | None) -> float:
    if model is None:
        return 0.0
    words, shape = text_tokens(text)
    total = 0.0
    try:
        total = math.fsum([known[w] for w in words])
    except KeyError:
        for w in words:
            if w not in known:
                known[w] = model.weights.get(_bucket(w), 0.0)
        total = math.fsum([known[w] for w in words])
    return total + math.fsum(model.weights.get(_bucket(s), 0.0) for s in shape)
