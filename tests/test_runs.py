"""Runs of rows behind manifests: a job that dies loses nothing, one that is repeated adds nothing."""

import pytest

from patchloom.sources import files, sinks
from tests.helpers import tuples

SCHEMA = "messages array<struct<role:string,content:string>>"


def chats(spark, *texts):
    return spark.createDataFrame([([("user", t)],) for t in texts], SCHEMA)


def said(spark, folder):
    return sorted(r.messages[0].content for r in files.read_chat_jsonl(spark, folder).collect())


def test_a_job_that_dies_leaves_the_former_run(spark, tmp_path, monkeypatch):
    folder = str(tmp_path / "sets")
    sinks.write_sft(chats(spark, "old"), folder, "xml", "1")

    def dies(*_):
        raise RuntimeError("killed")

    with monkeypatch.context() as m:
        m.setattr(sinks, "_commit", dies)
        with pytest.raises(RuntimeError):
            sinks.write_sft(chats(spark, "new"), folder, "xml", "1")
    assert said(spark, folder) == ["old"]
    sinks.write_sft(chats(spark, "new", "more"), folder, "xml", "1")
    assert said(spark, folder) == ["more", "new"]


def test_sweep_deletes_what_no_manifest_names(spark, tmp_path):
    folder = str(tmp_path / "sets")
    for text in ("a", "b"):
        sinks.write_sft(chats(spark, text), folder, "xml", "1")
    sinks.write_sft(chats(spark, "c"), folder, "tool", "2")
    assert sinks.sweep(spark, folder) == 1 and sinks.sweep(spark, folder) == 0
    assert said(spark, folder) == ["b", "c"]


def test_plain_files_and_runs_are_read_together(spark, tmp_path):
    (tmp_path / "ft_hand.jsonl").write_text('{"messages": [{"role": "user", "content": "hand"}]}\n')
    assert said(spark, str(tmp_path)) == ["hand"]
    sinks.write_sft(chats(spark, "run"), str(tmp_path), "xml", "1")
    assert said(spark, str(tmp_path)) == ["hand", "run"]


def test_a_repeated_batch_adds_no_row(spark, tmp_path):
    folder, name = str(tmp_path / "out"), sinks.sft_name("xml", "live")
    write = sinks.batch_writer(folder, name)
    source = tmp_path / "in"
    for text in ("a", "b", "c"):
        chats(spark, text).coalesce(1).write.mode("append").json(str(source))
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).json(str(source))
    query = stream.writeStream.foreachBatch(write).option("checkpointLocation", str(tmp_path / "at")).trigger(availableNow=True).start()
    query.awaitTermination(120)
    assert query.exception() is None and said(spark, folder) == ["a", "b", "c"]
    write(chats(spark, "a"), 0)  # a batch that is run again after a failure
    assert len(said(spark, folder)) == 3


def test_tasks_predictions_and_preferences(spark, tmp_path):
    tasks = spark.createDataFrame([("i1", "p", ["t"]), ("i2", None, [])], "instance_id string, patch string, FAIL_TO_PASS array<string>")
    sinks.write_tasks(tasks, str(tmp_path), "repo")
    back = files.read_tasks(spark, str(tmp_path))
    assert [(r.instance_id, r.patch, r.FAIL_TO_PASS) for r in back.orderBy("instance_id").collect()] == [("i1", "p", ["t"]), ("i2", None, [])]
    preds = spark.createDataFrame([("i1", "x"), ("i2", None)], "instance_id string, model_patch string")
    sinks.write_predictions(preds, str(tmp_path))
    assert {r.instance_id: r.model_patch for r in files.read_predictions(spark, str(tmp_path)).collect()} == {"i1": "x", "i2": None}
    pairs = spark.createDataFrame([(1, "q", "good", "bad")], "task_id int, prompt string, chosen string, rejected string")
    sinks.write_preferences(pairs, str(tmp_path))
    assert tuples(files.read_preferences(spark, str(tmp_path)), "prompt", "chosen", "rejected") == [("q", "good", "bad")]


def test_a_trace_is_cut_inside_its_record(spark):
    from pyspark.sql import functions as F

    from patchloom.functions.text import MIDDLE_MARK, cut_trace

    schema = "info struct<score:double,`Generated Outputs`:struct<`Agent Trace`:string,other:string>>"
    rows = [((0.5, ("a" * 6 + "b" * 6, "x" * 50)),), ((1.0, ("short", None)),), ((2.0, (None, "y")),), ((3.0, None),), (None,)]
    df = spark.createDataFrame(rows, schema)
    out = df.select(cut_trace(F.col("info"), 10).alias("info"))
    assert out.schema["info"].dataType.simpleString() == df.schema["info"].dataType.simpleString()
    got = [r.info for r in out.collect()]
    assert got[0]["Generated Outputs"]["Agent Trace"] == "aaaaa" + MIDDLE_MARK + "bbbbb"
    assert got[0]["Generated Outputs"]["other"] == "x" * 50 and got[0].score == 0.5
    assert got[1:] == [r.info for r in df.collect()][1:]


def test_winner_with_its_parameters_and_best_on_one_split(spark):
    from patchloom.operators.reports import best_candidate
    from patchloom.operators.trials import best_trial

    trials = spark.createDataFrame([(2, 0.5, {"lr": "1"}), (1, 0.5, {"lr": "2"}), (0, None, {})], "trial int, eval_loss double, params map<string,string>")
    best = best_trial(trials, keep=["params"]).first()
    assert (best.trial, best.params) == (1, {"lr": "2"})
    evals = spark.createDataFrame([("a", "val", 0.2), ("b", "val", 0.1), ("b", "test", 1.0)], "cond string, split string, score double")
    assert best_candidate(evals, split="val").first().cond == "a" and best_candidate(evals).first().cond == "b"
