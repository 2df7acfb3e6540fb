"""Streams whose rows come late, repeated or out of order give what the table forms give."""

import random
from datetime import datetime, timedelta

from patchloom.operators import trials as D
from patchloom.operators.scoring import score
from patchloom.streaming import live
from tests.helpers import tuples
from tests.test_streams import run

BASE = datetime(2024, 1, 1)
PATCH = "```diff\n--- a/s.py\n+++ b/s.py\n-a\n+b\n```"
COMPLETION = "task_id int, gen int, completion string, ts timestamp"
LOG = "task_id int, gen int, stdout string, ts timestamp"


def in_triggers(spark, tmp_path, name, schema, chunks):
    """A stream that reads one chunk of rows per trigger."""
    folder = tmp_path / name
    for rows in chunks:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").json(str(folder))
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(str(folder))


def at(seconds):
    return BASE + timedelta(seconds=seconds)


def rewards(df):
    return tuples(df, "task_id", "gen", "reward")


def test_late_logs_count(spark, tmp_path):
    completions = [
        [(1, 0, PATCH, at(0)), (1, 1, PATCH, at(1)), (2, 0, "no patch here", at(2))],
        [(3, 0, PATCH, at(200)), (3, 1, PATCH, at(201)), (4, 0, PATCH, at(202))],
        [(9, 0, "end", at(1200))],
        [(9, 1, "end", at(2400))],
        [(9, 2, "end", at(4000))],
        [(9, 3, "end", at(8000))],
    ]
    late = (1, 0, "PASS: 3 tests", at(100))  # three triggers after its completion
    logs = [
        [(3, 0, "FAIL: 1 test", at(205))],
        [(1, 1, "FAIL: 1 test", at(30)), (1, 1, "FAIL: 1 test", at(31)), (4, 0, "FAIL: 2", at(203))],
        [(4, 0, "PASS: now", at(210)), (8, 8, "FAIL", at(1200))],
        [late, (4, 0, "PASS: again", at(215))],
        [(8, 8, "FAIL", at(4000))],
        [(8, 8, "FAIL", at(8000))],
    ]
    one = in_triggers(spark, tmp_path, "completions", COMPLETION, completions)
    two = in_triggers(spark, tmp_path, "logs", LOG, logs)
    got = run(live.score_stream(one, two, delay="40 minutes"), "late_logs")
    table = score(
        spark.createDataFrame([r for c in completions for r in c], COMPLETION),
        spark.createDataFrame([r for c in logs for r in c], LOG),
    )
    want = [r for r in rewards(table) if r[0] != 9]
    assert [r for r in rewards(got) if r[0] != 9] == want
    assert got.groupBy("task_id", "gen").count().where("count > 1").count() == 0


def test_a_log_after_the_wait_is_a_timeout(spark, tmp_path):
    completions = [[(1, 0, PATCH, at(0))], [(9, 0, "end", at(5000))], [(9, 1, "end", at(9000))], [(9, 2, "end", at(19_000))]]
    logs = [[(1, 0, "PASS", at(241))], [(8, 8, "FAIL", at(5000))], [(8, 8, "FAIL", at(9000))], [(8, 8, "FAIL", at(19_000))]]
    one = in_triggers(spark, tmp_path, "completions", COMPLETION, completions)
    two = in_triggers(spark, tmp_path, "logs", LOG, logs)
    got = run(live.score_stream(one, two, "test"), "timed_out")
    assert [r for r in rewards(got) if r[0] == 1] == [(1, 0, 0.5)]


def test_a_table_of_logs_is_folded_once(spark, tmp_path):
    schema = "task_id int, gen int, completion string"
    stream = in_triggers(spark, tmp_path, "completions", schema, [[(1, 0, PATCH)], [(1, 1, PATCH)]])
    logs = spark.createDataFrame([(1, 0, "FAIL"), (1, 0, "PASS"), (1, 1, "FAIL")], "task_id int, gen int, stdout string")
    scored = live.score_stream(stream, logs, "test")
    assert "Aggregate" not in scored._jdf.queryExecution().analyzed().toString()
    assert rewards(run(scored, "folded_logs")) == [(1, 0, 1.0), (1, 1, 0.0)]


METRIC = "trial bigint, step bigint, eval_loss double, ts timestamp"


def stops(df):
    return tuples(df, "trial", "stop_step")


def test_early_stop_with_late_repeated_and_unordered_steps(spark, tmp_path):
    rnd = random.Random(11)
    rows = [
        (trial, step, None if rnd.random() < 0.1 else 10 / step + rnd.random(), at(60 * step + trial))
        for step in range(1, 60)
        for trial in range(4)
    ]
    moved = sorted(rows, key=lambda r: r[1] + rnd.random() * 8)  # up to 8 steps out of order
    repeated = sorted(moved + rnd.sample(moved, 60), key=lambda r: moved.index(r) + rnd.random() * 30)
    chunks = [repeated[i : i + 75] for i in range(0, len(repeated), 75)]
    ends = [[(99, 1, 1.0, at(20_000))], [(99, 2, 1.0, at(30_000))], [(99, 3, 1.0, at(40_000))]]
    df = spark.createDataFrame(rows, METRIC)
    stream = in_triggers(spark, tmp_path, "unordered", METRIC, [*chunks, *ends])
    got = run(live.live_early_stop(stream, 5, 0.3, ts="ts", delay="30 minutes"), "unordered")
    assert stops(got) == stops(D.early_stop(df, 5, 0.3))


def test_the_state_of_a_silent_run_goes(spark, tmp_path):
    chunks = [
        [(1, 1, 1.0, at(0)), (1, 2, 1.0, at(60)), (1, 3, 2.0, at(120))],
        [(2, 1, 1.0, at(50_000))],
        [(2, 2, 1.0, at(90_000))],
        [(2, 3, 0.5, at(99_000))],
        [(2, 4, 0.4, at(150_000))],
    ]
    stream = in_triggers(spark, tmp_path, "silent", METRIC, chunks)
    out = live.live_early_stop(stream, 2, ts="ts", delay="1 minute", timeout=3600)
    place = str(tmp_path / "checkpoint")
    query = out.writeStream.format("memory").queryName("silent").outputMode("append")
    query = query.option("checkpointLocation", place).trigger(availableNow=True).start()
    query.awaitTermination(180)
    assert query.exception() is None
    assert stops(spark.table("silent"))[0] == (1, 3)
    state = spark.read.format("statestore").option("path", place).option("stateVarName", "progress").load()
    assert {r.key[0] for r in state.select("key").collect()} == {2}
    waiting = spark.read.format("statestore").option("path", place).option("stateVarName", "waiting").load()
    assert {r.key[0] for r in waiting.select("key").collect()} <= {2}


def test_steps_without_a_time_are_taken_trigger_by_trigger(spark, tmp_path):
    schema = "trial bigint, step bigint, eval_loss double"
    chunks = [[(1, 2, 1.0), (1, 1, 1.0)], [(1, 2, 9.0), (1, 3, 1.0), (1, None, 0.1)], [(1, 4, 0.5)]]
    stream = in_triggers(spark, tmp_path, "plain", schema, chunks)
    assert stops(run(live.live_early_stop(stream, 2), "plain_steps")) == [(1, 3)]


def test_plan_of_the_log_join_keeps_texts_of_logs_out(spark, tmp_path):
    one = in_triggers(spark, tmp_path, "completions", COMPLETION, [[(1, 0, PATCH, at(0))]])
    two = in_triggers(spark, tmp_path, "logs", LOG, [[(1, 0, "PASS", at(1))]])
    joins = [x for x in live.score_stream(one, two)._jdf.queryExecution().analyzed().toString().splitlines() if "Join" in x]
    assert len(joins) == 2 and not any("stdout" in x for x in joins)
