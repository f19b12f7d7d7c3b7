"""Model boundary: language models, encoders and classifiers as batch jobs.

Models are *user supplied*. The engine owns the columns it sends, the
partitioned execution, batching, retries and parsing:

* ``chat_batch`` (L2): ``mapInPandas`` over (key, messages) rows. A client is
  built once per partition by ``client_factory``; each row is one completion
  call ``client(messages, temperature=, max_tokens=, json=[, model=]) -> str``
  under a ``RetryPolicy``. Only the key and prompt
  columns cross into Python; ``partitions`` bounds the number of concurrent
  callers. Failure policy: ``"fail"`` (raise, as the reference does) or
  ``"null"`` (NULL text plus an ``error`` column).
* ``encode_batch`` (M1) and ``classify_batch`` (N1): iterator Pandas UDFs that
  load the model once per Python worker and feed it ``batch_size`` texts at
  a time.

Model calls have side effects, so callers persist outputs (``checkpoint``)
before a second model stage reads them; speculative execution is off.
"""

from __future__ import annotations

import random
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.prompts import TASK_SETTINGS
from ..functions.text import truncate_tokens
from ..session import ship_package

class ModelCallError(RuntimeError):
    """A call that failed for good; ``attempts`` were made."""

    def __init__(self, message: str, attempts: int):
        super().__init__(message)
        self.attempts = attempts


@dataclass(frozen=True)
class RetryPolicy:
    """When and how often a model call is made again.

    An error is permanent when it says so (``retryable = False``), carries a
    client-side status (400-499 but for 408, 409, 425 and 429) or is a mistake
    in the call itself (``TypeError``, ``ValueError``); asking again would cost
    money for the same answer. Everything else may pass. Pauses double from
    ``pause`` up to ``longest`` and are shortened by up to ``jitter`` at random,
    so that many tasks do not come back at the same moment; an error's own
    ``retry_after`` (seconds) replaces the pause. No pause follows the last
    attempt, and none is begun that would end after ``budget`` seconds.
    """

    attempts: int = 5
    pause: float = 1.25
    longest: float = 30.0
    jitter: float = 0.25
    budget: float = 300.0

    def permanent(self, error: Exception) -> bool:
        said = getattr(error, "retryable", None)
        if said is not None:
            return not said
        status = getattr(error, "status_code", getattr(error, "status", None))
        if isinstance(status, int):
            return 400 <= status < 500 and status not in (408, 409, 425, 429)
        return isinstance(error, TypeError | ValueError)

    def pauses(self, draw: Callable[[], float] = random.random) -> Iterator[float]:
        """The pauses between attempts, one fewer than attempts."""
        for i in range(self.attempts - 1):
            yield min(self.longest, self.pause * 2 ** i) * (1 - self.jitter * draw())

    def run(self, call: Callable[[], str | None], sleep: Callable[[float], None] = time.sleep,
            clock: Callable[[], float] = time.monotonic, draw: Callable[[], float] = random.random) -> str:
        """The answer without surrounding white space, '' for none."""
        end, made, left = clock() + self.budget, 0, self.pauses(draw)
        while True:
            made += 1
            try:
                answer = call()
            except Exception as error:  # noqa: BLE001 - clients raise errors of their own
                wait = None if self.permanent(error) else next(left, None)
                if wait is not None:
                    wait = getattr(error, "retry_after", None) or wait
                if wait is None or clock() + wait > end:
                    raise ModelCallError(f"{type(error).__name__} on attempt {made}: {error}", made) from error
                sleep(wait)
            else:
                return answer.strip() if answer else ""


def _messages_to_py(m) -> list[dict]:
    return [{"role": x["role"], "content": x["content"]} for x in (m if m is not None else [])]


def chat_batch(df: DataFrame, key: str, messages: str, client_factory: Callable[[], Callable],
               task: str = "reply", out: str = "text", partitions: int | None = None,
               on_error: str = "fail", retry: RetryPolicy = RetryPolicy(),
               settings: dict | None = None, concurrency: int = 1) -> DataFrame:
    """L2: one completion per row -> (key, out[, error]).

    ``settings`` overrides the task's ``temperature``, ``max_tokens`` and
    ``json`` and may name a ``model``; they are passed on to the client.
    ``concurrency`` > 1 overlaps that many I/O-bound calls inside each task
    (a thread pool; output order is kept). Cluster-wide concurrency is then
    at most partitions x concurrency, which is how a rate limit is respected.
    """
    options = {**TASK_SETTINGS[task], **(settings or {})}
    key_type = df.schema[key].dataType
    fields = [T.StructField(key, key_type), T.StructField(out, T.StringType())]
    if on_error == "null":
        fields.append(T.StructField("error", T.StringType()))
    schema = T.StructType(fields)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from concurrent.futures import ThreadPoolExecutor

        client = client_factory()

        def one(m):
            msgs = _messages_to_py(m)
            try:
                return retry.run(lambda: client(msgs, **options)), None
            except ModelCallError as e:
                if on_error != "null":
                    raise
                return None, str(e)

        pool = ThreadPoolExecutor(max_workers=concurrency) if concurrency > 1 else None
        for pdf in batches:
            results = list(pool.map(one, pdf[messages]) if pool else map(one, pdf[messages]))
            res = pd.DataFrame({key: pdf[key].values, out: [r[0] for r in results]})
            if on_error == "null":
                res["error"] = [r[1] for r in results]
            yield res
        if pool:
            pool.shutdown()

    ship_package(df.sparkSession)
    src = df.select(key, messages)
    if partitions:
        src = src.repartition(partitions)
    return src.mapInPandas(run, schema)


def encode_batch(texts: Column, encoder_factory: Callable[[], Callable], dim: int,
                 batch_size: int = 64, normalize: bool = True) -> Column:
    """M1/M2: ``array<float>`` embedding per text, model loaded once per worker.

    ``encoder_factory()`` returns ``encode(list[str]) -> array-like (n, dim)``.
    """
    import numpy as np
    from pyspark.sql import SparkSession

    ship_package(SparkSession.getActiveSession())

    @F.pandas_udf(T.ArrayType(T.FloatType()))
    def _encode(it: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encode = encoder_factory()
        for s in it:
            vals = s.fillna("").astype(str).tolist()
            parts = [np.asarray(encode(vals[i:i + batch_size]), dtype=np.float32).reshape(-1, dim)
                     for i in range(0, len(vals), batch_size)]
            mat = np.vstack(parts) if parts else np.zeros((0, dim), dtype=np.float32)
            if normalize:
                norms = np.linalg.norm(mat, axis=1, keepdims=True)
                mat = np.where(norms > 0, mat / np.where(norms > 0, norms, 1), 0)
            yield pd.Series(list(mat.astype(np.float32)))

    return _encode(texts)


def classify_batch(texts: Column, model_factory: Callable[[], Callable],
                   batch_size: int = 64, max_tokens: int | None = 256) -> Column:
    """One label per text; texts are cut to ``max_tokens`` whitespace tokens
    (the model's input limit) before they are sent."""
    from pyspark.sql import SparkSession

    ship_package(SparkSession.getActiveSession())
    if max_tokens:
        texts = truncate_tokens(texts, max_tokens)

    @F.pandas_udf(T.StringType())
    def _classify(it: Iterator[pd.Series]) -> Iterator[pd.Series]:
        predict = model_factory()
        for s in it:
            vals = s.fillna("").astype(str).tolist()
            labels: list[str] = []
            for i in range(0, len(vals), batch_size):
                labels.extend(predict(vals[i:i + batch_size]))
            yield pd.Series(labels, dtype=object)

    return _classify(texts)


# ---------------------------------------------------------------------------
# Deterministic stand-ins for hosted models. Their outputs are simple functions
# of the input text, so every model stage can be checked end to end (also
# against SQL) without network access.
# ---------------------------------------------------------------------------

STUB_LABELS = ("ORDER", "SHIPPING", "REFUND", "ACCOUNT", "CANCEL", "OTHER")


def stub_chat_client():
    """A chat client whose answer depends only on the last message and task."""
    def complete(messages, temperature=0.2, max_tokens=350, json=False, model=None):
        user = messages[-1]["content"] if messages else ""
        n = len(user)
        if json:
            return ('{"relevance":%d,"helpfulness":%d,"tone":%d,"explanation":"length %d"}'
                    % (1 + n % 5, 1 + n % 7, 2 + n % 4, n))
        if max_tokens == TASK_SETTINGS["classify"]["max_tokens"]:
            return STUB_LABELS[n % 6]
        if temperature == TASK_SETTINGS["synthetic"]["temperature"]:
            return "\n".join(f"{i}. {user} #{i}" for i in range(1, 4)) + "\n\n"
        return f"  Thanks for writing. We read {n} characters.  "
    return complete


def stub_sentiment_model():
    """Binary labels from text length parity."""
    def predict(texts):
        return ["POSITIVE" if len(t) % 2 == 0 else "NEGATIVE" for t in texts]
    return predict


def stub_encoder(dim: int = 16):
    """Hashed bag of words (md5: the same in every process and in SQL)."""
    import hashlib

    import numpy as np

    def factory():
        def encode(texts):
            out = np.zeros((len(texts), dim), dtype=np.float32)
            for r, t in enumerate(texts):
                for w in t.split():
                    out[r, int(hashlib.md5(w.encode()).hexdigest()[:4], 16) % dim] += 1.0
            return out
        return encode
    return factory
