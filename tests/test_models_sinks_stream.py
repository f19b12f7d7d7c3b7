import uuid

import numpy as np
import pytest
from pyspark.sql import functions as F

from supportlens.functions import prompts as pr
from supportlens.operators import models
from supportlens.session import scratch_path
from supportlens.sources import writers

from .conftest import SF_SMALL


FLAT = {"draw": lambda: 0.0}  # no jitter


def test_retry_pauses_and_strip():
    calls, sleeps = [], []

    def flaky():
        calls.append(1)
        if len(calls) < 3:
            raise RuntimeError("busy")
        return "  ok \n"
    policy = models.RetryPolicy()
    assert policy.run(flaky, sleep=sleeps.append, **FLAT) == "ok"
    assert sleeps == [1.25, 2.5]
    assert policy.run(lambda: None) == ""


def test_retry_gives_up_without_a_last_pause():
    sleeps = []

    def down():
        raise ConnectionError("down")
    with pytest.raises(models.ModelCallError) as e:
        models.RetryPolicy(longest=4.0).run(down, sleep=sleeps.append, **FLAT)
    assert sleeps == [1.25, 2.5, 4.0, 4.0] and e.value.attempts == 5


def test_permanent_errors_and_budget():
    class Refused(Exception):
        status_code = 401

    class Busy(Exception):
        status_code, retry_after = 429, 7.0

    def error(e):
        def call():
            raise e
        return call
    for e in (Refused("no"), TypeError("bad call")):
        with pytest.raises(models.ModelCallError) as got:
            models.RetryPolicy().run(error(e), sleep=lambda s: pytest.fail("no pause"))
        assert got.value.attempts == 1
    sleeps = []
    with pytest.raises(models.ModelCallError) as got:
        models.RetryPolicy(budget=15.0).run(error(Busy()), sleep=sleeps.append, clock=lambda: sum(sleeps))
    assert sleeps == [7.0, 7.0] and got.value.attempts == 3
    assert all(0.9 <= p <= 1.25 for p in [next(models.RetryPolicy().pauses()) for _ in range(50)])


def failing_client():
    def complete(messages, **kw):
        if "bad" in messages[-1]["content"]:
            raise RuntimeError("refused")
        return "fine"
    return complete


def test_chat_batch_null_policy(spark):
    df = spark.createDataFrame([(1, "good"), (2, "bad")], "row_id long, q string")
    p = df.select("row_id", pr.classify_prompt("q").alias("m"))
    out = {r["row_id"]: (r["text"], r["error"] is None) for r in models.chat_batch(
        p, "row_id", "m", failing_client, task="classify", on_error="null",
        retry=models.RetryPolicy(attempts=2, pause=0.0)).collect()}
    assert out == {1: ("fine", True), 2: (None, False)}


def test_chat_batch_fail_policy(spark):
    df = spark.createDataFrame([(2, "bad")], "row_id long, q string")
    p = df.select("row_id", pr.classify_prompt("q").alias("m"))
    with pytest.raises(Exception):
        models.chat_batch(p, "row_id", "m", failing_client, task="classify",
                          retry=models.RetryPolicy(attempts=1)).collect()


def test_encode_normalised_and_raw(spark):
    df = spark.createDataFrame([("a b c",), ("",), ("a a",)], "t string")
    enc = models.stub_encoder(8)
    norm = [np.linalg.norm(r["e"]) for r in df.select(models.encode_batch(F.col("t"), enc, 8).alias("e")).collect()]
    assert np.allclose(sorted(norm), [0.0, 1.0, 1.0])
    raw = [sum(r["e"]) for r in df.select(models.encode_batch(F.col("t"), enc, 8, normalize=False).alias("e")).collect()]
    assert sorted(raw) == [0.0, 2.0, 3.0]


def test_csv_round_trip_exact(spark):
    df = spark.createDataFrame([(1, 'a "q", b\nline2 ', "", ["x", "y"]), (2, None, "  lead", [])],
                               "id long, t string, u string, arr array<string>")
    path = scratch_path(spark, f"t-{uuid.uuid4().hex}")
    writers.write_csv(df, path)
    back = writers.read_csv(spark, path, "id long, t string, u string, arr string")
    assert sorted(back.collect()) == [(1, 'a "q", b\nline2 ', "", '["x","y"]'), (2, None, "  lead", "[]")]


def test_stream_equals_batch(spark):
    import __spark_entry__ as entry

    s = entry.queries()["stream_clean"](spark, SF_SMALL)
    from supportlens.operators import cleaning
    from supportlens.plans import catalog
    conv = spark.read.parquet(f"{SF_SMALL}/conversations.parquet").where("role = 'user'").select(
        (F.col("conv_id") * 4294967296 + F.col("turn")).alias("row_id"), "text")
    b = cleaning.clean_texts(conv, "row_id", "text", catalog.lexicon(spark, SF_SMALL))
    assert sorted(s.select("row_id", "clean").collect()) == sorted(b.select("row_id", "clean").collect())


def test_chat_batch_concurrency_keeps_order(spark):
    df = spark.createDataFrame([(i, "x" * i) for i in range(50)], "row_id long, q string")
    p = df.select("row_id", pr.reply_prompt("q").alias("m"))
    seq = sorted(models.chat_batch(p, "row_id", "m", models.stub_chat_client).collect())
    par = sorted(models.chat_batch(p, "row_id", "m", models.stub_chat_client, concurrency=8).collect())
    assert seq == par and len(par) == 50


def test_reference_shaped_helpers(spark):
    from supportlens.functions.entities import add_entities_column
    from supportlens.operators.sentiment import add_sentiment_column
    from supportlens.plans.flows import prepare_queries

    lex = spark.createDataFrame([("refund", 40), ("order", 40), ("please", 30)], "word string, freq bigint")
    df = spark.createDataFrame([(1, "Refund my ordr pls!"), (2, None)], "row_id long, Queries string")
    prep = prepare_queries(df, lex)
    assert prep.columns == ["row_id", "Queries", "clean", "length"]
    got = {r["row_id"]: (r["clean"], r["length"]) for r in prep.collect()}
    assert got == {1: ("refund order please", 3), 2: ("", 0)}
    ents = add_entities_column(prep).where("row_id = 1").first()["entities"]
    assert [(e["type"], e["value"]) for e in ents] == [("Intent", "Refund"), ("Intent", "Order")]
    s = add_sentiment_column(prep, "clean", models.stub_sentiment_model).orderBy("row_id").collect()
    assert [r["sentiment"] for r in s] == ["NEGATIVE", "POSITIVE"]


def test_scratch_scope_removes_its_own_tables(spark):
    import os

    from supportlens.session import materialize, scratch_scope

    with scratch_scope(spark) as outer:
        with scratch_scope(spark) as scope:
            other = materialize(spark.range(4))
            m = materialize(spark.range(10), scope=scope)
            kept = materialize(spark.range(3), scope=outer)
            assert m.count() == 10
            path = scope.paths[0]
            assert os.path.exists(path.removeprefix("file:"))
        assert not os.path.exists(path.removeprefix("file:"))
        assert kept.count() == 3
    assert other.count() == 4


def counting_client(folder):
    """A stub client that leaves one file per call, named by the task."""
    def factory():
        import os
        import uuid

        answer = models.stub_chat_client()

        def complete(messages, **kw):
            task = "judge" if kw["json"] else "reply"
            open(os.path.join(folder, f"{task}-{kw.get('model')}-{uuid.uuid4().hex}"), "w").close()
            return answer(messages, **{k: v for k, v in kw.items() if k != "model"})
        return complete
    return factory


def calls(folder):
    import collections
    import os

    return dict(collections.Counter("-".join(f.split("-")[:2]) for f in os.listdir(folder)))


def test_every_model_call_is_made_once(spark, tmp_path):
    from supportlens.plans import flows

    lex = spark.createDataFrame([("refund", 40), ("order", 40), ("please", 30)], "word string, freq bigint")
    q = spark.createDataFrame([(i, f"please refund ordr {i}") for i in range(23)], "row_id long, t string")
    for i, run in enumerate((
            lambda c: flows.generate_and_judge(q, "t", c, reply_settings={"model": "m1"}, judge_settings={"model": "m2"}),
            lambda c: flows.support_artifacts(q, "t", lex, c, models.stub_encoder(4), 4, models.stub_sentiment_model,
                                              with_topics=False, reply_settings={"model": "m1"}, judge_settings={"model": "m2"}),
            lambda c: flows.support_artifacts(q, "t", lex, c, models.stub_encoder(4), 4, models.stub_sentiment_model, k=2,
                                              reply_settings={"model": "m1"}, judge_settings={"model": "m2"}))):
        folder = tmp_path / str(i)
        folder.mkdir()
        assert run(counting_client(str(folder))).count() == 23
        assert calls(folder) == {"reply-m1": 23, "judge-m2": 23}


def test_synthetic_calls_once_per_topic(spark, tmp_path):
    from supportlens.operators import assist

    df = spark.createDataFrame([("a",), ("b",), ("a",), (None,)], "topic string")
    out = assist.generate_synthetic(df, "topic", counting_client(str(tmp_path)), n=3).collect()
    assert {r.topic for r in out} == {"a", "b"} and calls(tmp_path) == {"reply-None": 2}


def test_app_flow_topics_and_summaries(spark):
    from supportlens.plans import flows

    lex = spark.createDataFrame([("refund", 40), ("order", 40), ("please", 30), ("knife", 9)], "word string, freq bigint")
    q = spark.createDataFrame([(i, f"Please refund order 1234{i} knives") for i in range(12)], "row_id long, t string")
    r = spark.createDataFrame([(i, "thanks" + "x" * i) for i in range(0, 12, 2)], "row_id long, response string")
    exc = spark.createDataFrame([("knives", "knife")], "form string, lemma string")
    out = flows.app_flow(q, "t", lex, r, models.stub_sentiment_model, exceptions=exc, n=10,
                         encoder_factory=models.stub_encoder(8), dim=8, k=2)
    rows = out.collect()
    assert len(rows) == 10 and all("1234" in x.entities and x.clean.endswith("knife") for x in rows)
    assert all(x.topic in (0, 1) for x in rows)
    parts = flows.app_summaries(out)
    assert [(x.sentiment, x.n) for x in parts["sentiment_counts"].collect()] == [("POSITIVE", 5), ("NEGATIVE", 0)]
    assert [x.share for x in parts["sentiment_share"].collect()] == [100.0]
    clean = flows.app_flow(q, "t", lex, r, models.stub_sentiment_model, entities_on="clean").collect()
    assert not any("1234" in x.entities for x in clean)


def test_read_any(spark, tmp_path):
    from supportlens.sources import tables

    (tmp_path / "q.csv").write_text(' query ,n\n"a, ""b""\nc",1\n')
    (tmp_path / "r.jsonl").write_text('{"response": "ok"}\n')
    q, r = tables.load_two_tables(spark, str(tmp_path / "q.csv"), str(tmp_path / "r.jsonl"))
    assert q.columns == ["query", "n"] and q.first()["query"] == 'a, "b"\nc'
    assert [x.response for x in r.collect()] == ["ok"]
    with pytest.raises(ValueError):
        tables.read_any(spark, "x.xlsx")


def test_runs_from_another_working_directory(tmp_path):
    """The correctness driver imports __spark_entry__ from elsewhere: Python
    workers must still import the package (shipped with addPyFile)."""
    import os
    import subprocess
    import sys

    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    script = f"""
import importlib.util
spec = importlib.util.spec_from_file_location("__spark_entry__", "{repo}/__spark_entry__.py")
m = importlib.util.module_from_spec(spec); spec.loader.exec_module(m)
from pyspark.sql import SparkSession
s = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
print("COUNT", m.queries()["generate_replies"](s, "{SF_SMALL}").count(),
      m.queries()["add_sentiment"](s, "{SF_SMALL}").count())
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", script], cwd=tmp_path, env=env,
                         capture_output=True, text=True, timeout=600)
    assert "COUNT" in out.stdout, out.stderr[-2000:]
