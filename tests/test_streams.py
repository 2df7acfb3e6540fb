"""Each live operator gives what its table form gives on the same rows."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from patchloom.operators import trials as D
from patchloom.operators.scoring import score
from patchloom.streaming import live
from tests.helpers import tuples

BASE = datetime(2024, 1, 1)


def as_stream(spark, tmp_path, df, chunks, name="in"):
    """Write a table in several files and read them one file per trigger, in order."""
    folder = tmp_path / name
    rows, schema = df.collect(), df.schema
    size = -(-len(rows) // chunks)
    for i in range(chunks):
        part = spark.createDataFrame(rows[i * size : (i + 1) * size], schema)
        part.coalesce(1).write.mode("append").json(str(folder))
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(str(folder))


def run(df, name, mode="append"):
    q = df.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True).start()
    q.awaitTermination(180)
    assert q.exception() is None
    return df.sparkSession.table(name)


def test_score_stream(spark, tmp_path):
    from tests.test_scoring import completions, outcomes

    stream = as_stream(spark, tmp_path, completions(spark), 3)
    got = run(live.score_stream(stream, outcomes(spark)).select("task_id", "gen", "reward"), "scores")
    want = score(completions(spark), outcomes(spark))
    assert tuples(got, "task_id", "gen", "reward") == tuples(want, "task_id", "gen", "reward")


def test_score_stream_to_files_with_the_shared_checkpoint(spark, tmp_path):
    from tests.test_scoring import completions, outcomes

    scored = live.score_stream(as_stream(spark, tmp_path, completions(spark), 2), outcomes(spark))
    slim, out = scored.select("task_id", "gen", "reward"), str(tmp_path / "out")
    for _ in range(2):  # the second start finds its progress and adds nothing
        live.start_files(slim, f"scores_{tmp_path.name}", out, available_now=True).awaitTermination(120)
        assert spark.read.parquet(out).count() == 6


def events(spark, n=200):
    rnd = random.Random(2)
    at, rows = BASE, []
    for i in range(n):
        at += timedelta(minutes=rnd.choice([1, 2, 45, 90]))
        rows.append((i, at, i % 3, i % 4 == 0))
    return spark.createDataFrame(rows, "id int, ts timestamp, who int, ok boolean")


def test_live_rates(spark, tmp_path):
    df = events(spark)
    table = live.live_rates(df, F.col("ok"), width="6 hours")
    got = run(live.live_rates(as_stream(spark, tmp_path, df, 4), F.col("ok"), width="6 hours"), "rates")
    want = tuples(table, "start", "total", "hits")
    # append mode closes a window once the watermark has passed it, so the last stay open
    closed = tuples(got, "start", "total", "hits")
    assert closed == want[: len(closed)] and len(want) - len(closed) <= 2


def test_live_rates_drop_late_rows(spark, tmp_path):
    df = events(spark, 100)
    late = spark.createDataFrame([(999, BASE, 0, True)], df.schema)
    stream = as_stream(spark, tmp_path, df.union(late), 5)
    got = run(live.live_rates(stream, F.col("ok"), width="6 hours"), "late_rates")
    first = got.orderBy("start").first()
    assert first.total == live.live_rates(df, F.col("ok"), width="6 hours").orderBy("start").first().total


def test_live_early_stop(spark, tmp_path):
    rnd = random.Random(8)
    rows = []
    for step in range(1, 60):
        for trial in range(4):
            bad = rnd.random()
            value = None if bad < 0.1 else float("inf") if bad < 0.15 else 10 / step + rnd.random()
            rows.append((trial, step, value))
    schema = "trial bigint, step bigint, eval_loss double"
    df = spark.createDataFrame(rows, schema)
    safe = df.withColumn("eval_loss", D.finite(F.col("eval_loss")))  # JSON has no infinity
    for patience, threshold in ((3, 0.0), (5, 0.3)):
        name = f"stops_{patience}"
        stream = as_stream(spark, tmp_path, safe, 7, name)
        got = run(live.live_early_stop(stream, patience, threshold), name)
        assert tuples(got, "trial", "stop_step") == tuples(
            D.early_stop(df, patience, threshold), "trial", "stop_step"
        )


def test_dedupe(spark, tmp_path):
    df = events(spark, 30)
    stream = as_stream(spark, tmp_path, df.union(df.orderBy("id")), 1)
    got = run(live.dedupe_results(stream, ["id"]), "dedupe")
    assert got.count() == 30
    assert live.dedupe_results(df.union(df), ["id"]).count() == 30


def test_differing_repeats_keep_the_earliest(spark):
    rows = [(1, "2024-01-01 00:00:02", "b"), (1, "2024-01-01 00:00:01", "c"), (1, "2024-01-01 00:00:01", "a"), (1, None, "0"), (2, None, "x"), (None, "2024-01-01 00:00:03", "n")]
    for order in (rows, rows[::-1]):
        df = spark.createDataFrame(order, "id long, ts string, kind string").repartition(3)
        out = live.dedupe_results(df, ["id"])
        assert out.columns == ["id", "ts", "kind"]
        assert sorted((r.id or 0, r.kind) for r in out.collect()) == [(0, "n"), (1, "a"), (2, "x")]


def test_idle_sessions(spark, tmp_path):
    df = events(spark, 120)
    table = live.idle_sessions(df, ["who"], gap="47 minutes")
    want, open_ = [], {}
    for r in df.orderBy("ts").collect():
        s = open_.get(r.who)
        if s and r.ts - s[2] <= timedelta(minutes=47):
            s[1], s[2] = s[1] + 1, r.ts
        else:
            open_[r.who] = s = [r.ts, 1, r.ts]
            want.append((r.who, s))
    want = sorted((w, s[1], s[0], s[2]) for w, s in want)
    ts = {w: [r.ts for r in df.orderBy("ts").collect() if r.who == w] for w in range(3)}
    assert any(b - a == timedelta(minutes=47) for t in ts.values() for a, b in zip(t, t[1:]))
    assert tuples(table, "who", "events", "first_event", "last_event") == want
    got = run(live.idle_sessions(as_stream(spark, tmp_path, df, 4), ["who"], gap="47 minutes"), "sessions")
    closed = tuples(got, "who", "events", "first_event", "last_event")
    assert set(closed) <= set(want) and len(want) - len(closed) <= 6


def test_sessions_of_events_at_the_same_time(spark):
    at = [BASE, BASE, BASE + timedelta(hours=3), BASE + timedelta(hours=3), BASE + timedelta(hours=3, minutes=1)]
    df = spark.createDataFrame([(1, t) for t in at], "who int, ts timestamp").repartition(3)
    assert tuples(live.idle_sessions(df, ["who"]), "events") == [(2,), (3,)]


def test_checkpoint_location(spark):
    assert live.checkpoint_location(spark, "x").endswith("/x")


def test_materialize(spark):
    from patchloom.plans.flows import materialize

    df = materialize(spark.range(10).groupBy().count())
    assert df.first()[0] == 10 and "RDD" in df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("batch", ["2", "10000"])
def test_user_functions(spark, batch):
    from patchloom.functions.udfs import map_examples, register_reward

    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        def length(completions, bonus):
            return [None if c is None else len(c) + bonus for c in completions]

        column = register_reward(spark, "length_reward", length, bonus=1)
        df = spark.createDataFrame([("a",), ("bcd",), (None,)], "completion string")
        assert [r[0] for r in df.select(column(F.col("completion"))).collect()] == [2.0, 4.0, None]
        df.createOrReplaceTempView("user_completions")
        assert spark.sql("select sum(length_reward(completion)) s from user_completions").first().s == 6.0

        def first_turn(example):
            return {"first": example["messages"][0]["content"] if example["messages"] else None}

        chats = spark.createDataFrame(
            [(1, [("user", "x"), ("assistant", "y")]), (2, [])],
            "id int, messages array<struct<role:string,content:string>>",
        )
        out = map_examples(chats, first_turn, "id int, first string")
        assert tuples(out.na.fill("-"), "id", "first") == [(1, "x"), (2, "-")]
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_a_reward_of_the_wrong_length_fails(spark):
    from patchloom.functions.udfs import register_reward

    column = register_reward(spark, "short_reward", lambda completions: [])
    df = spark.createDataFrame([("a",)], "completion string")
    with pytest.raises(Exception, match="0 rewards for 1 completions"):
        df.select(column(F.col("completion"))).collect()
