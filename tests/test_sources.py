import json

import pytest
from pyspark.sql import functions as F

from patchloom.sources import files as S
from patchloom.sources import sinks
from tests.helpers import tuples


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(text.encode())


def test_chat_jsonl(spark, tmp_path):
    line = '{"messages": [{"role": "user", "content": "%s"}]}'
    write(tmp_path / "ft_xml_a.jsonl", line % "1" + "\n\n  \n" + line % "2")  # no last newline
    write(tmp_path / "ft_xml_b.jsonl", line % "3" + "\n")
    write(tmp_path / "other.jsonl", line % "9" + "\n")
    df = S.read_chat_jsonl(spark, str(tmp_path))
    got = sorted((r.messages[0].content, r.file.rsplit("/", 1)[1]) for r in df.collect())
    assert got == [("1", "ft_xml_a.jsonl"), ("2", "ft_xml_a.jsonl"), ("3", "ft_xml_b.jsonl")]
    write(tmp_path / "ft_bad.jsonl", '{"messages": [}\n')
    with pytest.raises(Exception, match="MALFORMED"):
        S.read_chat_jsonl(spark, str(tmp_path)).collect()


def test_other_layouts(spark, tmp_path):
    write(tmp_path / "s" / "ft_1.jsonl", '{"conversations": [{"from": "human", "value": "q"}]}\n')
    write(tmp_path / "a" / "ft_1.jsonl", '{"instruction": "i", "input": "", "output": "o"}\n')
    from patchloom.functions.chat import to_messages

    s = to_messages(S.read_chat_jsonl(spark, str(tmp_path / "s"), "sharegpt"), "sharegpt").first()
    assert s.messages[0].role == "user"
    a = to_messages(S.read_chat_jsonl(spark, str(tmp_path / "a"), "alpaca"), "alpaca").first()
    assert [m.content for m in a.messages] == ["i", "o"]


def task(i):
    return {"instance_id": f"i{i}", "repo": "o/o__r.c", "patch": "p", "FAIL_TO_PASS": ["t1", "t2"], "extra": {"x": 1}}


def test_tasks_in_all_three_forms(spark, tmp_path):
    write(tmp_path / "a.jsonl", json.dumps(task(1)) + "\n\n" + json.dumps(task(2)) + "\n")
    write(tmp_path / "b.json", " \n" + json.dumps([task(3), task(4)], indent=1))
    write(tmp_path / "c.json", json.dumps({"k5": task(5), "k6": task(6)}, indent=2))
    write(tmp_path / "notes.txt", "no")
    rows = S.read_tasks(spark, str(tmp_path)).orderBy("instance_id").collect()
    assert [r.instance_id for r in rows] == [f"i{i}" for i in range(1, 7)]
    assert all(r.FAIL_TO_PASS == ["t1", "t2"] and r.problem_statement is None for r in rows)
    assert S.read_tasks(spark, str(tmp_path / "c.json")).count() == 2
    assert S.read_tasks(spark, str(tmp_path / "a.jsonl")).count() == 2
    spark.read.json(str(tmp_path / "a.jsonl")).write.json(str(tmp_path / "out"))
    assert S.read_tasks(spark, str(tmp_path / "out"), lines_only=True).count() == 2
    write(tmp_path / "d.json", "[{]")
    with pytest.raises(Exception):
        S.read_tasks(spark, str(tmp_path)).collect()


NASTY = [
    {"instance_id": 'a"}{', "repo": "}}\\", "patch": "{[", "FAIL_TO_PASS": ["}", "{", '\\"']},
    {"instance_id": "b\\\\", "extra": {"deep": {"x": [{}, {"y": "}"}]}}, "hints_text": '"'},
    {"instance_id": "c\nd", "PASS_TO_PASS": [], "problem_statement": "\u00e9 \\u007d }"},
    {},
]


@pytest.mark.parametrize("size, indent", [(7, None), (64, 2), (10**8, None)])
def test_a_single_list_or_object_is_split_between_tasks(spark, tmp_path, size, indent):
    rows = [dict(r, instance_id=f"{r.get('instance_id')}{i}") for i in range(20) for r in NASTY]
    write(tmp_path / "list.json", json.dumps(rows, indent=indent))
    write(tmp_path / "object.json", "\n" + json.dumps({f'k"{{}}\\{i}': r for i, r in enumerate(rows)}, indent=indent) + "\n")
    write(tmp_path / "none.json", "[ ]")
    write(tmp_path / "empty.json", "{}")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        read = S.read_tasks(spark, str(tmp_path))
        got = sorted((r.instance_id, r.repo, r.patch, r.hints_text, r.problem_statement, r.FAIL_TO_PASS) for r in read.collect())
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    names = ("instance_id", "repo", "patch", "hints_text", "problem_statement", "FAIL_TO_PASS")
    assert got == sorted([tuple(r.get(n) for n in names) for r in rows] * 2)


@pytest.mark.parametrize("text", ['[{"repo": "a"}, {"repo"', '[{"repo": "a"}, x]', '{"k": {"repo": "a"}', '[{"repo": tru}]', '["a", "b"]'])
def test_a_broken_list_fails_the_read(spark, tmp_path, text):
    write(tmp_path / "a.json", text)
    with pytest.raises(Exception):
        S.read_tasks(spark, str(tmp_path)).collect()


def test_corpus(spark, tmp_path):
    write(tmp_path / "one.txt", "\n\n a \n\n\n\nb\nc\n\n\n  \n\nd")
    assert tuples(S.read_corpus(spark, str(tmp_path / "one.txt")), "text") == [("a",), ("b\nc",), ("d",)]
    write(tmp_path / "two.jsonl", '{"text": "x"}\n{"other": 1}\n{"text": " "}\n')
    write(tmp_path / "three.txt", "p\r\n\r\nq\r\nr\n\ns")
    assert tuples(S.read_corpus(spark, str(tmp_path)), "text") == sorted(
        [("a",), ("b\nc",), ("d",), ("x",), ("",), (" ",), ("p",), ("q\nr",), ("s",)]
    )
    write(tmp_path / "bad.csv", "x")
    with pytest.raises(ValueError):
        S.read_corpus(spark, str(tmp_path / "bad.csv"))


def test_a_large_text_file_is_split_between_tasks(spark, tmp_path):
    body = "".join(f"para {i}\nline" + "\n" * (2 + i % 4) for i in range(3000)) + "\n \n\n x \n \ny"
    write(tmp_path / "big.txt", body)
    write(tmp_path / "crlf.txt", "p\r\n\r\nq\r\nr\n\ns" * 300)
    write(tmp_path / "small.txt", "tiny\n\none")
    texts = [body, ("p\n\nq\nr\n\ns" * 300), "tiny\n\none"]
    want = sorted(t.strip() for b in texts for t in b.split("\n\n") if t.strip())
    for size in (1000, 1001, 4099, 10**8):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        try:
            got = S.read_corpus(spark, str(tmp_path))
            assert sorted(r.text for r in got.collect()) == want
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
            spark.conf.unset("spark.sql.files.openCostInBytes")


def test_a_byte_order_mark_is_no_text(spark, tmp_path):
    (tmp_path / "a.txt").write_bytes(b"\xef\xbb\xbfhello\n\nyou")
    assert sorted(r.text for r in S.read_corpus(spark, str(tmp_path)).collect()) == ["hello", "you"]


@pytest.mark.parametrize("name, read", [("x/report.json", S.read_reports), ("iterations.jsonl", S.read_iterations)])
def test_broken_json_fails_the_read(spark, tmp_path, name, read):
    write(tmp_path / name, '{"resolved": tru')
    with pytest.raises(Exception):
        read(spark, str(tmp_path)).collect()


def test_preferences(spark, tmp_path):
    rows = [{"prompt": "p", "chosen": "a", "rejected": "b"}, {"prompt": "q", "chosen": "c", "rejected": "d"}]
    write(tmp_path / "dpo_preferences.json", json.dumps(rows, indent=1))
    for path in (tmp_path, tmp_path / "dpo_preferences.json"):
        assert tuples(S.read_preferences(spark, str(path)), "prompt", "chosen", "rejected") == [
            ("p", "a", "b"),
            ("q", "c", "d"),
        ]
    with pytest.raises(Exception):
        S.read_preferences(spark, str(tmp_path / "none")).count()


def test_reports(spark, tmp_path):
    write(tmp_path / "a__b.1" / "report.json", '{"resolved": true}')
    write(tmp_path / "b c" / "report.json", '{\n "resolved": false}')
    write(tmp_path / "c" / "report.json", '{"other": 1}')
    write(tmp_path / "d" / "deep" / "report.json", '{"resolved": true}')
    write(tmp_path / "report.json", '{"resolved": true}')
    got = tuples(S.read_reports(spark, str(tmp_path)), "instance_id", "resolved")
    assert got == [("a__b.1", True), ("b c", False), ("c", False)]


def test_predictions(spark, tmp_path):
    write(tmp_path / "a" / "preds.json", json.dumps({"i1": {"instance_id": "i1", "model_patch": "one"}}))
    write(tmp_path / "b" / "c" / "all_preds.jsonl", '{"instance_id": "i1", "model_patch": "two"}\n{"instance_id": "i2", "model_patch": null}\n')
    write(tmp_path / "b" / "preds.json", json.dumps([{"instance_id": "i3", "model_patch": "three"}]))
    write(tmp_path / "b" / "other.json", "{}")
    got = {r.instance_id: r.model_patch for r in S.read_predictions(spark, str(tmp_path)).collect()}
    assert got == {"i1": "one", "i2": None, "i3": "three"}


def test_patches(spark, tmp_path):
    write(tmp_path / "x" / "y" / "one.diff", "--- a\n+++ b\n")
    write(tmp_path / "two.diff", "z")
    write(tmp_path / "three.patch", "no")
    got = sorted((r.path.rsplit("/", 1)[1], r.patch) for r in S.collect_patches(spark, str(tmp_path)).collect())
    assert got == [("one.diff", "--- a\n+++ b\n"), ("two.diff", "z")]


def test_sft_round_trip(spark, tmp_path):
    schema = "messages array<struct<role:string,content:string>>"
    a = spark.createDataFrame([([("user", "1\n"), ("assistant", 'é "x"')],)] * 3, schema)
    out = str(tmp_path / "sft")
    sinks.write_sft(a.repartition(2), out, "xml", "run1")
    sinks.write_sft(a.limit(1), out, "tool", "run2")
    sinks.write_sft(a.repartition(2), out, "xml", "run1")  # a repeated job leaves one copy
    back = S.read_chat_jsonl(spark, out)
    assert back.count() == 4 and back.first().messages == a.first().messages
    path = sinks.write_sft(a, out, "xml", "run3", "parquet")
    assert spark.read.parquet(path).count() == 3 and S.read_chat_jsonl(spark, out).count() == 4
    with pytest.raises(ValueError):
        sinks.write_sft(a, out, "xml", "r", "csv")


def test_trials(spark, tmp_path):
    rows = [{"trial": 0, "eval_loss": 0.5, "params": {"lr": 0.1, "rank": 8}, "state": "COMPLETE"}, {"trial": 1, "eval_loss": None, "params": {}, "state": "COMPLETE"}]
    write(tmp_path / "t.json", json.dumps(rows, indent=2))
    got = S.read_trials(spark, str(tmp_path / "t.json")).orderBy("trial").collect()
    assert got[0].params == {"lr": "0.1", "rank": "8"} and got[1].eval_loss is None


def test_iterations(spark, tmp_path):
    write(tmp_path / "run_1" / "iterations.jsonl", '{"iteration": 1, "candidate": "a", "score": 0.5}\n')
    write(tmp_path / "run_2" / "iterations.jsonl", '{"iteration": 1, "candidate": "b", "score": 0.7}\n')
    assert tuples(S.read_iterations(spark, str(tmp_path)), "candidate", "score") == [("a", 0.5), ("b", 0.7)]
    stream = S.read_iterations(spark, str(tmp_path), stream=True)
    q = stream.writeStream.format("memory").queryName("its").trigger(availableNow=True).start()
    q.awaitTermination(60)
    assert spark.table("its").count() == 2


def test_the_lines_of_one_split_are_numbered_in_blocks(spark, tmp_path, monkeypatch):
    body = "".join(f"para {i}\nline" + "\n" * (1 + i % 4) for i in range(500))
    write(tmp_path / "big.txt", body)
    seen, running = [], S.running

    def watched(df, keys, order, block, values):
        seen.append(df.select(*keys, block.alias("b")).distinct().count())
        return running(df, keys, order, block, values)

    monkeypatch.setattr(S, "running", watched)
    monkeypatch.setattr(S, "BLOCK_LINES", 100, raising=False)
    got = sorted(r.text for r in S.read_corpus(spark, str(tmp_path)).collect())
    assert got == sorted(t.strip() for t in body.split("\n\n") if t.strip())
    assert max(seen) >= 15


def test_predictions_are_grouped_in_tasks_by_their_size(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(S, "GROUP_BYTES", 4000, raising=False)
    line = '{"instance_id": "i%d", "model_patch": %s}\n'
    write(tmp_path / "b" / "all_preds.jsonl", "".join(line % (i, '"late"') for i in range(1000)))
    write(tmp_path / "a" / "all_preds.jsonl", "".join(line % (i, "null" if i % 2 else '"first"') for i in range(0, 1000, 3)))
    got = S.read_predictions(spark, str(tmp_path))
    want = [(f"i{i}", "late" if i % 3 else None if i % 2 else "first") for i in range(1000)]
    assert tuples(got, "instance_id", "model_patch") == sorted(want, key=str)
    per_task = got.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n"))
    assert per_task.agg(F.max("n")).first()[0] < 300
