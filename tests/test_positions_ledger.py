import os
import random
import uuid

import pytest
from pyspark.sql import functions as F

from supportlens.functions import prompts as pr
from supportlens.operators import assist, models
from supportlens.operators.ledger import CallLedger
from supportlens.sources import positions

from .conftest import SF_SMALL


# --- positions ---------------------------------------------------------------

def test_positions_follow_the_order(spark):
    rnd = random.Random(2)
    data = [(rnd.randrange(50), rnd.choice(["x", "y", None]), i) for i in range(3000)] + [(None, "x", -1)] * 2
    df = spark.createDataFrame(data, "a int, b string, i int").repartition(7)
    got = positions.number_rows(df, ["a", "b"]).collect()
    assert sorted(r.position for r in got) == list(range(1, len(data) + 1))
    key = lambda r: (r.a is not None, r.a or 0, r.b is not None, r.b or "")
    assert [key(r) for r in sorted(got, key=lambda r: r.position)] == sorted(map(key, got))
    again = positions.number_rows(df.repartition(3), ["a", "b"]).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))


def test_a_hot_order_value_and_sums_before(spark):
    df = spark.range(5000).select(F.when(F.col("id") % 3 > 0, 7).otherwise(F.col("id")).alias("k"), "id")
    got = positions.sums_before(df, ["k", "id"], F.col("id") % 4).collect()
    total = 0
    for r in sorted(got, key=lambda r: (r.k, r.id)):
        assert r.before == total
        total += r.id % 4
    assert positions.number_rows(df.limit(0), ["k"]).count() == 0


def test_no_window_over_everything(spark, capsys):
    df = spark.read.parquet(f"{SF_SMALL}/conversations.parquet")
    positions.number_rows(df, ["conv_id", "turn"]).explain()
    plan = capsys.readouterr().out
    assert "Window" not in plan and "SinglePartition" not in plan


def test_positions_of_files(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(1000).select(F.col("id"), F.lit(5).alias("position")).repartitionByRange(6, "id").sortWithinPartitions("id").write.parquet(path)
    got = positions.read_with_positions(spark, path).collect()
    assert sorted((r.position, r.id) for r in got) == [(i + 1, i) for i in range(1000)]


def test_pairing_tables_of_different_length(spark):
    a = spark.createDataFrame([(3, "c"), (1, "a"), (2, "b")], "k int, q string")
    b = spark.createDataFrame([("z", 9.0), ("y", 8.0)], "r string, s double")
    inner = positions.pair_by_position(a, b, ["k"], ["r"]).collect()
    assert sorted((r.position, r.q, r.r) for r in inner) == [(1, "a", "y"), (2, "b", "z")]
    full = positions.pair_by_position(a, b, ["k"], ["r"], how="full").collect()
    assert sorted((r.position, r.q, r.r) for r in full) == [(1, "a", "y"), (2, "b", "z"), (3, "c", None)]
    with pytest.raises(ValueError):
        positions.pair_by_position(a, b, ["k"])
    with pytest.raises(ValueError):
        positions.pair_by_position(a, a, ["k"], ["k"])


# --- ledger ------------------------------------------------------------------

def counting_client(folder, fail_on=None):
    """A client that leaves a file per call and breaks on one message."""
    def factory():
        def complete(messages, **options):
            user = messages[-1]["content"]
            if fail_on and fail_on in user:
                raise TypeError("broken")  # permanent: no pauses
            with open(os.path.join(folder, uuid.uuid4().hex), "w") as f:
                f.write(user)
            return f"answer to {user[-12:]}"
        return complete
    return factory


def calls(folder):
    return [open(os.path.join(folder, n)).read().split("\n", 1)[1] for n in os.listdir(folder)]


def queries(spark, n=60):
    return spark.createDataFrame([(i, f"query number {i % 40:03d}") for i in range(n)], "row_id bigint, q string")


def test_a_rerun_pays_only_what_was_not_committed(spark, tmp_path):
    folder, ledger = tmp_path / "calls", CallLedger(spark, str(tmp_path / "ledger"))
    folder.mkdir()
    ask = lambda **kw: assist.generate_replies(
        queries(spark), "q", counting_client(str(folder), **kw), ledger=ledger, calls_per_task=5)
    with pytest.raises(Exception, match="broken"):
        ask(fail_on="number 017").collect()
    first = calls(folder)
    committed = ledger.answers().count()
    assert 0 < committed <= len(first) < 40  # finished tasks stay, the broken one is not there
    got = {r.row_id: r.response for r in ask().collect()}
    assert got == {i: "answer to " + f"query number {i % 40:03d}"[-12:] for i in range(60)}
    assert len(calls(folder)) - len(first) == 40 - committed
    assert set(calls(folder)) == {f"query number {i:03d}" for i in range(40)}
    ask().collect()
    assert len(calls(folder)) - len(first) == 40 - committed  # nothing is left to pay


def test_settings_and_tasks_are_calls_of_their_own(spark, tmp_path):
    folder, ledger = tmp_path / "calls", CallLedger(spark, str(tmp_path / "ledger"))
    folder.mkdir()
    df = queries(spark, 3).select("row_id", pr.reply_prompt("q").alias("m"))
    client = counting_client(str(folder))
    for settings in (None, {"temperature": 0.9}, None, {"model": "other"}):
        assert ledger.ask(df, "row_id", "m", client, settings=settings).count() == 3
    assert len(calls(folder)) == 9
    ledger.ask(df, "row_id", "m", client, task="classify").count()
    assert len(calls(folder)) == 12
    assert ledger.ask(df.limit(0), "row_id", "m", client).count() == 0


def test_errors_are_noted_and_asked_again(spark, tmp_path):
    folder, ledger = tmp_path / "calls", CallLedger(spark, str(tmp_path / "ledger"))
    folder.mkdir()
    df = queries(spark, 4).select("row_id", pr.reply_prompt("q").alias("m"))
    out = ledger.ask(df, "row_id", "m", counting_client(str(folder), "number 002"), on_error="null").collect()
    assert {r.row_id: (r.text is None, bool(r.error)) for r in out} == {
        i: (i == 2, i == 2) for i in range(4)}
    out = ledger.ask(df, "row_id", "m", counting_client(str(folder)), on_error="null").collect()
    assert all(r.text and r.error is None for r in out) and len(calls(folder)) == 4


def test_flow_with_a_ledger_equals_the_flow(spark, tmp_path):
    from supportlens.plans import flows

    df = queries(spark, 20)
    plain = flows.generate_and_judge(df, "q", models.stub_chat_client).collect()
    noted = flows.generate_and_judge(df, "q", models.stub_chat_client,
                                     ledger=CallLedger(spark, str(tmp_path / "ledger"))).collect()
    assert sorted(map(str, plain)) == sorted(map(str, noted))
