import random

import pytest
from pyspark.sql import functions as F

from patchloom.functions import chat as C
from patchloom.functions import text as T
from patchloom.operators import chats as H
from patchloom.operators import packing as P
from tests.helpers import plan_of, tuples

CHAT = "messages array<struct<role:string,content:string>>"


def turns(spark):
    rows = [(1, 1, "user", "hi"), (1, 2, "assistant", "yo"), (1, 0, "system", "be"), (2, 0, "user", "q")]
    rows += [(3, i, "assistant" if i % 2 else "user", "t" * i) for i in range(50)]
    return spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").repartition(3)


def rendered(conv):
    data = {
        1: [("system", "be"), ("user", "hi"), ("assistant", "yo")],
        2: [("user", "q")],
        3: [("assistant" if i % 2 else "user", "t" * i) for i in range(50)],
    }
    return "".join(f"<|im_start|>{r}\n{t}<|im_end|>\n" for r, t in data[conv])


def test_render_chat(spark):
    got = {r.conv_id: r.text for r in H.render_chat(turns(spark)).collect()}
    assert got == {c: rendered(c) for c in (1, 2, 3)}


def test_one_row_per_chat_wherever_its_turns_begin(spark):
    late = spark.range(5000, 11_000).selectExpr("9 AS conv_id", "id AS turn", "if(id % 2 = 0, 'user', 'assistant') AS role", "repeat('x', 20) AS text")
    (row,) = H.render_chat(late, reasoning_effort="high").collect()
    assert row.text.startswith("<|im_start|>system\nReasoning: high<|im_end|>\n")
    spans = H.completion_spans(late, reasoning_effort="high").collect()
    assert len(spans) == 3000 and all(row.text[s.start : s.end] == "x" * 20 for s in spans)
    (share,) = H.masked_share(late, reasoning_effort="high").collect()
    assert share.chars == len(row.text)
    pieces = H.rendered_turns(late, reasoning_effort="high").orderBy("turn").collect()
    assert len(pieces) == 6000 and all(row.text.startswith(p.text, p.start) for p in pieces[::500])


@pytest.mark.parametrize("effort", [None, "low"])
def test_spans_point_at_assistant_bodies(spark, effort):
    whole = {c: C.effort_line(effort) + rendered(c) for c in (1, 2, 3)}
    spans = H.completion_spans(turns(spark), block_turns=8, reasoning_effort=effort).collect()
    assert len(spans) == 26
    for r in spans:
        body = whole[r.conv_id][r.start : r.end]
        assert body == ("yo" if r.conv_id == 1 else "t" * r.turn)
        assert whole[r.conv_id][: r.start].endswith("<|im_start|>assistant\n")
    shares = {r.conv_id: r.masked_share for r in H.masked_share(turns(spark), reasoning_effort=effort).collect()}
    assert shares[2] == 1.0 and shares[1] == pytest.approx(1 - 2 / len(whole[1]))


def test_layouts(spark):
    df = spark.createDataFrame(
        [([("human", "q"), ("gpt", "a"), ("system", "s"), ("tool", "x")],)],
        "conversations array<struct<`from`:string,value:string>>",
    )
    row = C.to_messages(df, "sharegpt").first()
    assert [tuple(m) for m in row.messages] == [("user", "q"), ("assistant", "a"), ("system", "s"), ("tool", "x")]
    rows = [("do", "it", "ok"), ("do", " \n", "ok"), ("do", None, None)]
    df = spark.createDataFrame(rows, "instruction string, input string, output string")
    got = [[tuple(m) for m in r.messages] for r in C.to_messages(df, "alpaca").collect()]
    assert got == [
        [("user", "do\n\nit"), ("assistant", "ok")],
        [("user", "do"), ("assistant", "ok")],
        [("user", "do"), ("assistant", "")],
    ]
    with pytest.raises(ValueError):
        C.to_messages(df, "xml")


def test_render_messages(spark):
    df = spark.createDataFrame([([("user", "a"), (None, None)],), (None,)], CHAT)
    got = [r[0] for r in df.select(C.render_messages(F.col("messages"))).collect()]
    assert got == ["<|im_start|>user\na<|im_end|>\n<|im_start|>\n<|im_end|>\n", ""]


def test_actions(spark):
    df = spark.createDataFrame([("assistant", 'ls "a"\n'), ("user", "x")], "role string, text string")

    def texts(style):
        return [r.text for r in C.render_actions(df, style).collect()]

    assert texts("xml") == ['<action>ls "a"\n</action>', "x"]
    assert texts("ticks") == ['```\nls "a"\n\n```', "x"]
    assert texts("tool") == ['{"tool":"run","arguments":{"command":"ls \\"a\\"\\n"}}', "x"]
    with pytest.raises(ValueError):
        texts("yaml")


def test_limit_steps(spark):
    out = H.limit_steps(turns(spark), 3)
    assert out.count() == 3 + 1 + 3
    flags = {r.conv_id: r.truncated for r in out.collect()}
    assert flags == {1: False, 2: False, 3: True}
    assert max(r.turn for r in out.where("conv_id = 3").collect()) == 2
    assert "WindowGroupLimit" in plan_of(out)


def test_resolved_and_failed(spark):
    reports = spark.createDataFrame([(1, True), (1, True), (2, None)], "conv_id bigint, resolved boolean")
    good, bad = H.select_resolved(turns(spark), reports), H.select_failed(turns(spark), reports)
    assert {r.conv_id for r in good.collect()} == {1} and good.count() == 3
    assert {r.conv_id for r in bad.collect()} == {2, 3}
    assert {r.conv_id for r in H.answered(turns(spark)).collect()} == {1, 3}


def test_quality(spark):
    df = spark.createDataFrame([(1, "a", 0), (2, "", None), (3, "", 0), (4, "ok", 1)], "id int, t string, q int")
    rules = {"empty": F.col("t") == "", "low": F.col("q") == 0}
    assert tuples(H.quality_filter(df, rules), "id") == [(4,)]
    assert tuples(H.quality_report(df, rules), "rule", "rows", "hits", "removed") == [
        ("empty", 4, 2, 2),
        ("low", 4, 2, 1),
    ]


@pytest.mark.parametrize("n, size, low", [(0, "small", True), (99, "small", True), (100, "small", False), (299, "small", False), (300, "medium", False), (999, "medium", False), (1000, "large", False)])
def test_dataset_profile(spark, n, size, low):
    df = spark.range(n).withColumn("f", F.concat(F.lit("ft_"), (F.col("id") % 3).cast("string")))
    row = H.dataset_profile(df, F.col("f")).first()
    assert (row.examples, row.files, row.size_class, row.under_minimum) == (n, min(n, 3), size, low)


def test_text_stats(spark):
    df = spark.createDataFrame([("a b\n c",), ("",), ("x" * 9,)], "text string")
    got = [tuple(r) for r in T.length_stats(df, limits=(2,)).drop("text").collect()]
    assert got == [(6, 3, 2, False), (0, 0, 0, False), (9, 1, 3, True)]


def test_paragraphs(spark):
    df = spark.createDataFrame([(1, " a \n\n\n\nb\n c\n\n   "), (2, "")], "id int, body string")
    got = tuples(T.split_paragraphs(df), "id", "position", "text")
    assert got == [(1, 0, "a"), (1, 2, "b\n c")]


def lengths(spark, n=400):
    rnd = random.Random(4)
    rows = [(i, rnd.choice([0, 1, 3, 10, 50, 130])) for i in range(n)]
    return rows, spark.createDataFrame(rows, "doc_id bigint, est_tokens bigint")


def seeded(rows):
    import hashlib

    return sorted(rows, key=lambda r: hashlib.md5(f"42:{r[0]}".encode()).hexdigest())


@pytest.mark.parametrize("parts", [1, 4, 16])
@pytest.mark.parametrize("digits", [1, 4])
def test_pack_wrap(spark, parts, digits):
    rows, df = lengths(spark)
    want, at = [], 0
    for doc, n in seeded(rows):
        for i in range(n):
            seq = (at + i) // 64
            if want and want[-1][:2] == [seq, doc]:
                want[-1][3] = i + 1
            else:
                want.append([seq, doc, i, i + 1])
        at += n
    got = P.pack_wrap(df.repartition(parts), 64, digits=digits)
    assert tuples(got, "seq", "doc_id", "from_token", "to_token") == sorted(map(tuple, want))


@pytest.mark.parametrize("parts", [1, 4, 16])
def test_pack_greedy(spark, parts):
    import hashlib

    rows, df = lengths(spark)
    want, state = set(), {}
    for doc, n in seeded(rows):
        shard = int(hashlib.md5(f"42:{doc}".encode()).hexdigest()[:8], 16) % 5
        seq, fill = state.get(shard, (0, 0))
        if fill and fill + n > 64:
            seq, fill = seq + 1, 0
        want.add((shard, seq, doc, fill))
        state[shard] = (seq, fill + n)
    got = P.pack_greedy(df.repartition(parts), 64, shards=5)
    assert set(tuples(got, "shard", "seq", "doc_id", "offset")) == want
    # small Arrow batches: the open sequence carries over
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        again = P.pack_greedy(df.repartition(parts), 64, shards=5)
        assert set(tuples(again, "shard", "seq", "doc_id", "offset")) == want
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
