import pytest

from patchloom.functions import naming, patches, prompts
from patchloom.functions import text as T
from tests.helpers import column

EXTRACT = [
    ("no patch here", None),
    ("", None),
    ("```diff\n--- a/x\n+++ b/x\n-a\n+b\n```", "--- a/x\n+++ b/x\n-a\n+b"),
    ("```diff\n```", ""),  # an empty fence is an empty patch, not a missing one
    ("```diff\n   \n```", ""),
    ("```diff\none\n```\n```diff\ntwo\n```", "one"),
    ("see\ndiff --git a/x b/x\n+c\n", "diff --git a/x b/x\n+c\n"),  # bare text is not stripped
    ("see\n--- a/x\n+++ b/x", "--- a/x\n+++ b/x"),
    ("```diff\r\n--- a/x\n```", "--- a/x\n```"),  # CRLF fence: falls to the bare header
    ("```diff\n--- a/x\n+b", "--- a/x\n+b"),  # unclosed fence
    ("```diff\n+b only", None),
    ("```patch\n+b\n```", None),
    (" --- a/x\n", None),  # header not at the line start
    ("x\r--- a/x\n", None),  # a lone CR does not start a line
    ("x diff --git a/x b/x", None),
    ("--- c/x\n--- a/y\nrest", "--- a/y\nrest"),
    ("pre ```diff\n +b　\n``` post", "+b"),
    (None, None),
]


@pytest.mark.parametrize("i", range(len(EXTRACT)))
def test_extract_patch(spark, i):
    text, want = EXTRACT[i]
    assert column(spark, [text], patches.extract_patch) == [want]


def test_extract_patch_long_text(spark):
    text = "x " * 300_000 + "\n```diff\n" + "+y\n" * 100_000 + "```\n"
    assert column(spark, [text], patches.extract_patch) == [("+y\n" * 100_000).strip()]


@pytest.mark.parametrize(
    "patch, ok",
    [
        ("+x = 1", True),
        ("+import os", True),
        ("+import numpy as np", False),
        ("+from json import loads", True),
        ("+import os, numpy", True),  # only the first module counts
        ("+from . import x", True),  # relative imports are not seen
        ("+import random", False),  # the list is partial
        ("-import numpy", True),
        ("+\nimport numpy", False),  # white space may cross the line end
        ("+    from asyncio import run", False),
        ("+import os.path", True),
        ("+import osé", False),
        ("", True),
    ],
)
def test_imports_ok(spark, patch, ok):
    assert column(spark, [patch], patches.imports_ok) == [ok]


@pytest.mark.parametrize(
    "patch, left",
    [
        ("+MAX = 1\n+x = 2", "+x = 2"),
        ("+A == b\n ctx", " ctx"),  # comparison counts as assignment
        ("+  _X1  = 3\n+ok", "+ok"),
        ("+++ X = 1\n+exec('a')", "+++ X = 1"),
        ("+ eval(x)\n+__import__('os')\n+y", "+y"),
        ("-MAX = 1\n MAX = 1", "-MAX = 1\n MAX = 1"),
        ("+Max = 1", "+Max = 1"),
        ("+evaluate(x)", "+evaluate(x)"),
        ("", ""),
        ("+A=1", ""),
    ],
)
def test_strip_global_lines(spark, patch, left):
    assert column(spark, [patch], patches.strip_global_lines) == [left]


def test_patch_files(spark):
    text = "diff --git a/x.py b/x.py\n+1\ndiff --git a/p b/q.py b/p b/q.py\ndiff --git odd\ndiff --git a/x.py b/x.py"
    assert column(spark, [text], patches.patch_files) == [["x.py", "q.py", "diff --git odd", "x.py"]]
    assert column(spark, [""], patches.patch_files) == [[]]


def test_truncation_limits(spark):
    exact, over = "a" * 4000, "b" * 2000 + "c" + "d" * 2000
    got = column(spark, [exact, over, None], T.truncate_middle)
    assert got == [exact, "b" * 2000 + "\n... [truncated] ...\n" + "d" * 2000, None]
    got = column(spark, ["abc", "abcd"], lambda c: T.cap_text(c, 3))
    assert got == ["abc", "abc\n... [truncated]"]


def test_strip_like_python(spark):
    texts = [" \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0 x y　 ", "", "   ", "​x"]
    assert column(spark, texts, T.strip) == [t.strip() for t in texts]


def test_names(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([("me", "tool", "0123456789abcdef")], "o string, r string, c string")
    row = df.select(*[c.alias(n) for n, c in naming.task_keys(*map(F.col, "orc")).items()]).first()
    assert row.repo_key == "me__tool"
    assert row.mirror_name == "me/me__tool.01234567"
    assert row.image_name == "swesmith.x86_64.me__tool.0123456789abcdef"
    df = spark.createDataFrame([("me/me__my_tool.v1.01234567",), ("odd",)], "x string")
    rows = df.select(*[c.alias(n) for n, c in naming.parse_repo(F.col("x")).items()]).collect()
    assert tuple(rows[0]) == ("me", "my_tool.v1", "01234567")
    assert tuple(rows[1]) == (None, None, None)


def test_problem_statement(spark):
    schema = "i int, problem_statement string, patch string, FAIL_TO_PASS array<string>"
    rows = [
        (0, " keep ", "", []),
        (1, None, "diff --git a/x b/x\ndiff --git a/y b/y", ["t1", "t2"]),
        (2, " \n", None, None),
    ]
    out = prompts.fill_problem_statement(spark.createDataFrame(rows, schema)).orderBy("i").collect()
    assert out[0].problem_statement == " keep "
    assert out[1].problem_statement == (
        "There is a bug in x, y that causes the following test(s) to fail:\n- t1\n- t2\n\n"
        "Please investigate the failing tests and fix the underlying issue."
    )
    assert "unknown files that causes" in out[2].problem_statement
    assert "fail:\n- (unknown tests)\n\n" in out[2].problem_statement
    # the column may be missing altogether
    bare = spark.createDataFrame(rows, schema).drop("problem_statement")
    assert prompts.fill_problem_statement(bare).where("problem_statement is null").count() == 0


def test_repair_prompt(spark):
    schema = "repo string, problem_statement string, hints_text string"
    df = spark.createDataFrame([("a/b", "Broken", "look"), ("a/b", None, ""), ("a/b", "x", None)], schema)
    with_hint, no_hint, null_hint = [r.prompt for r in prompts.render_repair_prompt(df).collect()]
    assert with_hint.startswith(
        "You are a software engineer fixing a bug in the repository `a/b`.\n\n"
        "## Problem Description\nBroken\n\n## Hints\nlook\n\n## Instructions\n"
    )
    assert with_hint.endswith("-old line\n+new line\n context line\n```\n")
    assert "## Problem Description\n\n\n## Instructions" in no_hint
    assert "Hints" not in no_hint and "Hints" not in null_hint


def test_buggen_prompts(spark):
    from patchloom.functions import prompt_texts as W

    df = spark.range(50).selectExpr("id as func_id", "concat('def f', id, '(): pass') as src_code")
    rows = prompts.render_buggen_prompts(df, "lm_modify").collect()
    for r in rows:
        assert sum(e in r.system_prompt for e in W.BUG_EXAMPLES) == 3
        assert all(t in r.system_prompt for t in W.TIPS)
        assert r.instance_prompt.startswith(f"<INPUT>\ndef f{r.func_id}(): pass\n</INPUT>")
    assert len({r.system_prompt for r in rows}) > 40
    again = prompts.render_buggen_prompts(df.repartition(7), "lm_modify").collect()
    assert {r.func_id: r.system_prompt for r in again} == {r.func_id: r.system_prompt for r in rows}
    with pytest.raises(ValueError):
        prompts.render_buggen_prompts(df, "procedural")


def test_bug_answers(spark):
    good = "Explanation:\nwhy\n\nBugged Code:\n```python\ndef f():\n    pass\n```\n"
    got = column(spark, [good, "none", None], lambda c: prompts.parse_bug_answer(c)["bugged_code"])
    assert got == ["def f():\n    pass\n", None, None]
    got = column(spark, [good], lambda c: prompts.parse_bug_answer(c)["explanation"])
    assert got == ["why"]
