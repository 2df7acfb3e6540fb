"""Record shapes of the domain, derived from the given tables.

``spark`` side: DataFrames. ``CTES``: the same rows as SQL for the comparison engine.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from patchloom.operators.scans import running

GENS = 4


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Spread a table that is one split over the cores. Larger tables are left alone."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() == 1 else df


def fx_tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = spread(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"))
    key, m = F.col("o_orderkey"), (F.col("o_custkey") % 7).cast("string")
    org, rep = (F.col("o_custkey") % 5).cast("string"), (F.col("o_custkey") % 25).cast("string")
    first = F.concat(
        F.format_string("diff --git a/src/m%s.py b/src/m%s.py\n", m, m),
        F.format_string("--- a/src/m%s.py\n+++ b/src/m%s.py\n@@ -1 +1 @@\n", m, m),
        F.format_string("-x = %d\n+x = %d", key, key + 1),
    )
    second = F.lit(
        "\ndiff --git a/src/n.py b/src/n.py\n--- a/src/n.py\n+++ b/src/n.py\n@@ -1 +1 @@\n-y\n+z"
    )
    return o.select(
        key.alias("task_id"),
        F.concat(
            F.lit("org"), org, F.lit("/org"), org, F.lit("__repo"), rep, F.lit("."), F.left(F.md5(rep), F.lit(8))
        ).alias("repo"),
        F.concat(F.lit("org"), org, F.lit("__repo"), rep, F.lit(".t"), key.cast("string")).alias("instance_id"),
        F.when(key % 5 == 0, "lm_modify")
        .when(key % 5 == 1, "class_basic")
        .when(key % 5 == 2, "func_fun")
        .when(key % 5 == 3, "lm_rewrite")
        .otherwise("procedural")
        .alias("strategy"),
        F.when(key % 11 == 0, "")
        .otherwise(F.concat(first, F.when(key % 4 == 0, second).otherwise("")))
        .alias("patch"),
        F.when(key % 3 == 1, "  \n ")
        .when(key % 3 == 2, F.format_string("Value %d is wrong", key))
        .alias("problem_statement"),
        F.when(key % 4 == 0, "check the sign").when(key % 4 == 1, "").alias("hints_text"),
        (F.col("o_custkey") % 700).alias("func_id"),
    )


def fx_test_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = F.col("l_linenumber").cast("string")
    return (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_orderkey", "l_linenumber")
        .agg(
            F.bool_and((F.col("l_linestatus") == "F") | (F.col("l_returnflag") != "R")).alias("base_pass"),
            F.bool_and((F.col("l_returnflag") == "N") | (F.col("l_linestatus") == "O")).alias("patched_pass"),
        )
        .select(
            F.col("l_orderkey").alias("task_id"),
            F.concat(F.lit("tests/test_m"), line, F.lit(".py::test_"), line).alias("test"),
            "base_pass",
            "patched_pass",
        )
    )


COMPLETION_SHAPES = (
    "I could not find the bug.",
    "Fix:\n```diff\n--- a/s.py\n+++ b/s.py\n-a\n+b\n```\ndone",
    "```diff\n+only added\n```",
    "see\ndiff --git a/s.py b/s.py\n--- a/s.py\n+++ b/s.py\n-a\n+c",
    "```diff\n--- a/s.py\n+++ b/s.py\n-import os\n+import numpy as np\n```",
    '```diff\n--- a/s.py\n+++ b/s.py\n-a\n+MAX_SIZE = 10\n+exec("x")\n+import json\n```',
    "```diff\n```",
    "```diff\n--- a/1.py\n+++ b/1.py\n-a\n+b\n```\n```diff\nsecond\n```",
)


def _generations(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = spread(table(spark, sf_dir, "orders").select("o_orderkey"))
    return orders.select(
        F.col("o_orderkey").alias("task_id"), F.explode(F.sequence(F.lit(0), F.lit(GENS - 1))).alias("gen")
    )


def fx_completions(spark: SparkSession, sf_dir: str) -> DataFrame:
    shape = (F.col("task_id") + 3 * F.col("gen")) % 8
    texts = F.array(*[F.lit(t) for t in COMPLETION_SHAPES])
    return (
        _generations(spark, sf_dir)
        .withColumn("shape", shape)
        .withColumn("completion", F.get(texts, F.col("shape").cast("int")))
    )


def fx_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = (F.col("task_id") + 2 * F.col("gen")) % 5
    return (
        _generations(spark, sf_dir)
        .where((F.col("task_id") + F.col("gen")) % 7 != 0)
        .withColumn(
            "stdout",
            F.when(log == 0, "PASS: 12 tests")
            .when(log == 1, "FAIL: PASS_TO_PASS broken")
            .otherwise("FAIL: 3 tests"),
        )
    )


def fx_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "conversations")
        .select("conv_id")
        .distinct()
        .where(F.col("conv_id") % 10 != 9)
        .withColumn("resolved", F.when(F.col("conv_id") % 3 == 0, True).when(F.col("conv_id") % 3 == 1, False))
    )


def fx_eval(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    return (
        table(spark, sf_dir, "orders")
        .select(key.alias("task_id"), F.explode(F.array(F.lit("baseline"), F.lit("skills"))).alias("cond"))
        .withColumn(
            "resolved",
            (F.col("task_id") % 3 == 0) | ((F.col("cond") == "skills") & (F.col("task_id") % 5 == 0)),
        )
    )


def fx_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    one = F.lit(1).cast("bigint")
    hour = F.date_trunc("hour", "ts")
    events = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "value")
    placed = running(events, ["user_id"], ["ts", "event_id"], hour, {"step": ("sum", one)})
    return placed.select(
        F.col("user_id").alias("trial"),
        "step",
        F.when(F.col("user_id") % 13 != 0, F.col("value")).alias("eval_loss"),
        "ts",
    )


def fx_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    signup = F.col("event_type") == "signup"
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("run_id"),
        (F.col("user_id") % 25).alias("repo_id"),
        "ts",
        "event_type",
        (F.col("value") * F.when(signup, 80).otherwise(20)).alias("seconds"),
        F.when(signup, "baseline").otherwise("patched").alias("kind"),
    )


def fx_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("func_id"),
        F.col("p_brand").alias("class_name"),
        F.format_string("def f%d(x):\n    return x + %d", "p_partkey", "p_size").alias("src_code"),
    )


def fx_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        "source",
        F.concat(F.lit("  "), F.replace("text", F.lit("\n"), F.lit("\n\n")), F.lit("\n\n   ")).alias("body"),
    )


CTES: dict[str, str] = {
    "fx_tasks": """
SELECT o_orderkey AS task_id,
  concat('org', o_custkey % 5, '/org', o_custkey % 5, '__repo', o_custkey % 25, '.', substr(md5(CAST(o_custkey % 25 AS VARCHAR)), 1, 8)) AS repo,
  concat('org', o_custkey % 5, '__repo', o_custkey % 25, '.t', o_orderkey) AS instance_id,
  CASE o_orderkey % 5 WHEN 0 THEN 'lm_modify' WHEN 1 THEN 'class_basic' WHEN 2 THEN 'func_fun' WHEN 3 THEN 'lm_rewrite' ELSE 'procedural' END AS strategy,
  CASE WHEN o_orderkey % 11 = 0 THEN ''
       ELSE concat('diff --git a/src/m', o_custkey % 7, '.py b/src/m', o_custkey % 7, '.py', chr(10), '--- a/src/m', o_custkey % 7, '.py', chr(10), '+++ b/src/m', o_custkey % 7, '.py', chr(10), '@@ -1 +1 @@', chr(10), '-x = ', o_orderkey, chr(10), '+x = ', o_orderkey + 1,
            CASE WHEN o_orderkey % 4 = 0 THEN concat(chr(10), 'diff --git a/src/n.py b/src/n.py', chr(10), '--- a/src/n.py', chr(10), '+++ b/src/n.py', chr(10), '@@ -1 +1 @@', chr(10), '-y', chr(10), '+z') ELSE '' END) END AS patch,
  CASE o_orderkey % 3 WHEN 0 THEN NULL WHEN 1 THEN concat('  ', chr(10), ' ') ELSE concat('Value ', o_orderkey, ' is wrong') END AS problem_statement,
  CASE WHEN o_orderkey % 4 = 0 THEN 'check the sign' WHEN o_orderkey % 4 = 1 THEN '' ELSE NULL END AS hints_text,
  o_custkey % 700 AS func_id
FROM orders""",
    "fx_test_results": """
SELECT l_orderkey AS task_id,
  concat('tests/test_m', l_linenumber, '.py::test_', l_linenumber) AS test,
  bool_and(l_linestatus = 'F' OR l_returnflag <> 'R') AS base_pass,
  bool_and(l_returnflag = 'N' OR l_linestatus = 'O') AS patched_pass
FROM lineitem GROUP BY l_orderkey, l_linenumber""",
    "fx_completions": """
SELECT task_id, gen, (task_id + 3 * gen) % 8 AS shape,
  CASE (task_id + 3 * gen) % 8
    WHEN 0 THEN 'I could not find the bug.'
    WHEN 1 THEN concat('Fix:', chr(10), '```diff', chr(10), '--- a/s.py', chr(10), '+++ b/s.py', chr(10), '-a', chr(10), '+b', chr(10), '```', chr(10), 'done')
    WHEN 2 THEN concat('```diff', chr(10), '+only added', chr(10), '```')
    WHEN 3 THEN concat('see', chr(10), 'diff --git a/s.py b/s.py', chr(10), '--- a/s.py', chr(10), '+++ b/s.py', chr(10), '-a', chr(10), '+c')
    WHEN 4 THEN concat('```diff', chr(10), '--- a/s.py', chr(10), '+++ b/s.py', chr(10), '-import os', chr(10), '+import numpy as np', chr(10), '```')
    WHEN 5 THEN concat('```diff', chr(10), '--- a/s.py', chr(10), '+++ b/s.py', chr(10), '-a', chr(10), '+MAX_SIZE = 10', chr(10), '+exec("x")', chr(10), '+import json', chr(10), '```')
    WHEN 6 THEN concat('```diff', chr(10), '```')
    ELSE concat('```diff', chr(10), '--- a/1.py', chr(10), '+++ b/1.py', chr(10), '-a', chr(10), '+b', chr(10), '```', chr(10), '```diff', chr(10), 'second', chr(10), '```') END AS completion
FROM (SELECT o_orderkey AS task_id, unnest([0, 1, 2, 3]) AS gen FROM orders)""",
    "fx_outcomes": """
SELECT task_id, gen,
  CASE (task_id + 2 * gen) % 5 WHEN 0 THEN 'PASS: 12 tests' WHEN 1 THEN 'FAIL: PASS_TO_PASS broken' ELSE 'FAIL: 3 tests' END AS stdout
FROM (SELECT o_orderkey AS task_id, unnest([0, 1, 2, 3]) AS gen FROM orders)
WHERE (task_id + gen) % 7 <> 0""",
    "fx_reports": """
SELECT conv_id, CASE conv_id % 3 WHEN 0 THEN true WHEN 1 THEN false ELSE NULL END AS resolved
FROM (SELECT DISTINCT conv_id FROM conversations) c WHERE conv_id % 10 <> 9""",
    "fx_eval": """
SELECT task_id, cond,
  CASE WHEN cond = 'baseline' THEN task_id % 3 = 0 ELSE task_id % 3 = 0 OR task_id % 5 = 0 END AS resolved
FROM (SELECT o_orderkey AS task_id, unnest(['baseline', 'skills']) AS cond FROM orders)""",
    "fx_metrics": """
SELECT user_id AS trial, CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS BIGINT) AS step,
  CASE WHEN user_id % 13 = 0 THEN NULL ELSE value END AS eval_loss, ts
FROM events""",
    "fx_runs": """
SELECT event_id AS run_id, user_id % 25 AS repo_id, ts, event_type, value * CASE WHEN event_type = 'signup' THEN 80 ELSE 20 END AS seconds,
  CASE WHEN event_type = 'signup' THEN 'baseline' ELSE 'patched' END AS kind
FROM events""",
    "fx_functions": """
SELECT p_partkey AS func_id, p_brand AS class_name, concat('def f', p_partkey, '(x):', chr(10), '    return x + ', p_size) AS src_code
FROM part""",
    "fx_corpus": """
SELECT doc_id, source, concat('  ', replace(text, chr(10), concat(chr(10), chr(10))), chr(10), chr(10), '   ') AS body FROM documents""",
}

SPARK: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        fx_tasks,
        fx_test_results,
        fx_completions,
        fx_outcomes,
        fx_reports,
        fx_eval,
        fx_metrics,
        fx_runs,
        fx_functions,
        fx_corpus,
    )
}


def with_ctes(sql: str, ctes: dict[str, str], recursive: bool = False) -> str:
    """Prefix ``sql`` with the CTEs it names, in order, and those they name in turn.

    ``sql`` may start with a comma and further CTEs of its own.
    """
    names = list(ctes)
    wanted: set[str] = set()
    todo = [n for n in names if n in sql]
    while todo:
        name = todo.pop()
        if name not in wanted:
            wanted.add(name)
            todo += [n for n in names if n in ctes[name] and n != name]
    sql, start = sql.strip(), "WITH RECURSIVE" if recursive else "WITH"
    if not wanted:
        return f"{start} {sql[1:]}" if sql.startswith(",") else sql
    head = ",\n".join(f"{n} AS ({ctes[n].strip()})" for n in names if n in wanted)
    return f"{start} {head}\n{sql}"
