"""Prompts and their answers, built from table columns."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patchloom.functions import prompt_texts as T
from patchloom.functions.patches import patch_files
from patchloom.functions.seeds import SEED, seeded_hash
from patchloom.functions.text import is_blank, strip

# Fixed value: the answer layout a bug-writing model is asked for.
BUG_ANSWER = r"(?s)Explanation:\s*(.*?)\s*Bugged Code:\s*```\w*\n(.*?)```"

STRATEGIES = ("lm_modify", "class_basic", "func_fun", "lm_rewrite")


def _text(col: Column) -> Column:
    return F.coalesce(col, F.lit(""))


def problem_statement(patch: Column, failing_tests: Column) -> Column:
    """The statement written for a task that has none."""
    files = patch_files(_text(patch))
    named = F.when(F.size(files) > 0, F.array_join(files, ", ")).otherwise(T.UNKNOWN_FILES)
    listed = F.array_join(F.transform(failing_tests, lambda t: F.concat(F.lit("- "), t)), "\n")
    tests = F.when(F.size(failing_tests) > 0, listed).otherwise(T.UNKNOWN_TESTS)
    return F.concat(
        F.lit(T.STATEMENT_HEAD), named, F.lit(T.STATEMENT_TESTS), tests, F.lit(T.STATEMENT_TAIL)
    )


def fill_problem_statement(
    df: DataFrame,
    *,
    statement: str = "problem_statement",
    patch: str = "patch",
    tests: str = "FAIL_TO_PASS",
) -> DataFrame:
    """Write a problem statement where it is missing, null or blank."""
    old = F.col(statement) if statement in df.columns else F.lit(None).cast("string")
    return df.withColumn(
        statement, F.when(is_blank(old), problem_statement(F.col(patch), F.col(tests))).otherwise(old)
    )


def render_repair_prompt(df: DataFrame, out: str = "prompt") -> DataFrame:
    """Add the repair prompt of a task; the hints part only where there are hints."""
    hints = _text(F.col("hints_text"))
    return df.withColumn(
        out,
        F.concat(
            F.lit(T.REPAIR_HEAD),
            _text(F.col("repo")),
            F.lit(T.REPAIR_PROBLEM),
            _text(F.col("problem_statement")),
            F.lit("\n"),
            F.when(hints != "", F.concat(F.lit(T.REPAIR_HINTS), hints, F.lit("\n"))).otherwise(""),
            F.lit(T.REPAIR_TAIL),
        ),
    )


def _fill(template: str, values: dict[str, Column]) -> Column:
    """Concat of a template's literal parts and the columns named in its braces."""
    parts = re.split(r"\{(\w+)\}", template)
    return F.concat(*[_text(values[p]) if i % 2 else F.lit(p) for i, p in enumerate(parts)])


def _shuffled(items: list[str], key: Column, kind: str, seed: int) -> Column:
    tagged = F.array(
        *[
            F.struct(seeded_hash(key, F.lit(kind), F.lit(i), seed=seed).alias("h"), F.lit(x).alias("x"))
            for i, x in enumerate(items)
        ]
    )
    return F.transform(F.array_sort(tagged), lambda s: F.concat(F.lit("\n- "), s["x"]))


def render_buggen_prompts(
    df: DataFrame, strategy: str, *, seed: int = SEED, key: str = "func_id"
) -> DataFrame:
    """Add system_prompt and instance_prompt for one bug-writing strategy.

    ``lm_modify`` shows 3 of the 9 examples and all 7 tips in an order seeded per
    function. ``lm_rewrite`` needs func_signature, file_src_code and func_to_write
    columns; the others need src_code.
    """
    if strategy == "lm_modify":
        examples = F.slice(_shuffled(T.BUG_EXAMPLES, F.col(key), "example", seed), 1, T.EXAMPLES_SHOWN)
        tips = _shuffled(T.TIPS, F.col(key), "tip", seed)
        system = F.concat(
            F.lit(T.MODIFY_HEAD),
            F.array_join(examples, ""),
            F.lit(T.MODIFY_TIPS),
            F.array_join(tips, ""),
            F.lit(T.MODIFY_TAIL),
        )
        template = T.FUNCTION_INSTANCE
    elif strategy == "class_basic":
        system, template = F.lit(T.CLASS_SYSTEM), T.CLASS_INSTANCE
    elif strategy == "func_fun":
        system, template = F.lit(T.TIRED_SYSTEM), T.FUNCTION_INSTANCE
    elif strategy == "lm_rewrite":
        system, template = F.lit(T.REWRITE_SYSTEM), T.REWRITE_INSTANCE
    else:
        raise ValueError(f"strategy {strategy!r} has no prompt; known: {', '.join(STRATEGIES)}")
    values = {name: F.col(name) for name in re.findall(r"\{(\w+)\}", template)}
    return df.withColumns({"system_prompt": system, "instance_prompt": _fill(template, values)})


def parse_bug_answer(answer: Column) -> dict[str, Column]:
    """explanation and bugged_code from a model answer; null where the layout is absent."""
    hit = answer.rlike(BUG_ANSWER)
    return {
        "explanation": F.when(hit, strip(F.regexp_extract(answer, BUG_ANSWER, 1))),
        "bugged_code": F.when(hit, F.regexp_extract(answer, BUG_ANSWER, 2)),
    }
