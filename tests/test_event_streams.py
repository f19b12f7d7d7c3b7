import datetime as dt
import time

from pyspark.sql import functions as F

from supportlens.streaming import events as ev

T0 = dt.datetime(2024, 1, 1)


def arrive(spark, path, rows, schema):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)
    time.sleep(0.05)  # files are taken in the order of their times


def minutes(n):
    return T0 + dt.timedelta(minutes=n)


def test_late_rows_are_left_out_and_windows_add_up(spark, tmp_path):
    path, schema = str(tmp_path / "in"), "at timestamp, kind string"
    arrive(spark, path, [(minutes(5), "a"), (minutes(50), "a"), (minutes(70), "b")], schema)
    arrive(spark, path, [(minutes(20), "a"), (minutes(300), "b")], schema)   # 20: in time (watermark 10)
    arrive(spark, path, [(minutes(290), "b")], schema)                       # Spark counts the watermark from the next one on
    arrive(spark, path, [(minutes(30), "a"), (minutes(310), "a")], schema)   # 30: its window closed at 60
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)
    counts = ev.windowed_counts(stream, "at", "kind", "1 hour", "1 hour", {"last": F.max("at")})
    ev.write_updates(counts, str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination()
    got = sorted((r.window_start, r.kind, r.n) for r in
                 ev.latest(spark, str(tmp_path / "out"), ["window_start", "kind"]).collect())
    assert got == [(minutes(0), "a", 3), (minutes(60), "b", 1), (minutes(240), "b", 1), (minutes(300), "a", 1),
                   (minutes(300), "b", 1)]


def test_a_table_gives_the_same_windows(spark):
    df = spark.createDataFrame([(minutes(5), "a"), (minutes(59), "a"), (minutes(60), "a")], "at timestamp, kind string")
    got = sorted((r.window_start, r.n) for r in ev.windowed_counts(df, "at", "kind").collect())
    assert got == [(minutes(0), 2), (minutes(60), 1)]


def test_pairs_across_micro_batches(spark, tmp_path):
    qs, rs = str(tmp_path / "q"), str(tmp_path / "r")
    q_schema, r_schema = "id long, q string, asked timestamp", "id long, r string, given timestamp"
    arrive(spark, qs, [(1, "one", minutes(0)), (2, "two", minutes(1)), (3, "three", minutes(2))], q_schema)
    arrive(spark, rs, [(1, "reply one", minutes(3)), (9, "nobody asked", minutes(3))], r_schema)
    arrive(spark, qs, [(4, "four", minutes(30)), (5, "five", minutes(31))], q_schema)
    arrive(spark, rs, [(2, "reply two, later", minutes(20)), (3, "too late", minutes(90))], r_schema)
    for i in (1, 2):
        arrive(spark, qs, [(-i, "end", minutes(10_000 + i))], q_schema)
        arrive(spark, rs, [(-9, "end", minutes(10_000 + i))], r_schema)
    read = lambda p, s: spark.readStream.schema(s).option("maxFilesPerTrigger", 1).parquet(p)
    pairs = ev.pair_stream(read(qs, q_schema), read(rs, r_schema), "id", "asked", "given", "1 hour", "1 hour")
    ev.write_pairs(pairs, str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination()
    got = sorted((r.id, r.q, r.r) for r in spark.read.parquet(str(tmp_path / "out")).where("id > 0").collect())
    assert got == [(1, "one", "reply one"), (2, "two", "reply two, later"), (3, "three", None),
                   (4, "four", None), (5, "five", None)]


def test_replay_arrives_in_order(spark, tmp_path):
    df = spark.range(100).select("id", F.timestamp_seconds(F.col("id") * 60).alias("at"))
    path = str(tmp_path / "in")
    assert ev.replay(df, "at", path, batches=4, files=2) == 2
    assert spark.read.parquet(path).count() == 100
    ev.replay(df.limit(0), "at", str(tmp_path / "none"))


def test_stream_entities_come_from_the_text_as_written(spark, tmp_path):
    from supportlens.streaming import live

    path, schema = str(tmp_path / "in"), "k long, t string"
    arrive(spark, path, [(1, "refund order 123456, $45.50"), (1, "nothing"), (None, "pay 7")], schema)
    lex = spark.createDataFrame([("refund", 9), ("order", 9)], "word string, freq bigint")
    got = {}
    for on in ("raw", "clean"):
        stream = spark.readStream.schema(schema).parquet(path)
        out = str(tmp_path / on)
        live.clean_micro_batches(stream, "k", "t", lex, out, str(tmp_path / f"ck-{on}"), entities_on=on).awaitTermination()
        got[on] = sorted((r.k or 0, r.clean, r.entities.count("OrderID") + r.entities.count("Amount"))
                         for r in live.read_sink(spark, out).collect())
    assert [r[:2] for r in got["raw"]] == [r[:2] for r in got["clean"]] == [(0, "pay"), (1, "nothing"), (1, "refund order")]
    assert [r[2] for r in got["raw"]] == [1, 0, 2] and [r[2] for r in got["clean"]] == [0, 0, 0]
