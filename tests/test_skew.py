"""A third of all rows under one key: results stay right and no task takes them all."""

import pytest
from pyspark.sql import functions as F

from patchloom.operators import chats as H
from patchloom.operators import scoring as S
from patchloom.operators import tasks as K
from patchloom.operators import trials as D
from tests.helpers import plan_of

SMALL_SKEW = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20000",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20000",
}


@pytest.fixture
def skewed(spark):
    for k, v in SMALL_SKEW.items():
        spark.conf.set(k, v)
    yield spark
    for k in SMALL_SKEW:
        spark.conf.unset(k)


def scored(spark, n=60_000):
    task = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 5000)
    return spark.range(n, numPartitions=6).select(
        task.alias("task_id"), F.col("id").alias("gen"), (F.col("id") % 7 / 7).alias("reward")
    )


def test_advantages_split_the_hot_task(skewed):
    df = scored(skewed)
    out = S.group_advantage(df)
    rows = out.collect()
    assert len(rows) == 60_000
    assert "skew=true" in plan_of(out) and "Window" not in plan_of(out)
    hot = [r for r in rows if r.task_id == 0]
    assert len(hot) > 20_000 and abs(sum(r.advantage for r in hot)) < 1e-3


def test_pairs_of_a_hot_task_stay_linear(skewed):
    df = scored(skewed)
    assert S.preference_pairs(df).where("task_id = 0").count() == 1
    rest = S.preference_pairs(df, "best_vs_rest").where("task_id = 0").count()
    assert rest < df.where("task_id = 0").count()
    n = df.where("task_id = 0").groupBy("reward").count().collect()
    total = sum(r["count"] for r in n)
    pairs = S.pair_counts(df).where("task_id = 0").first().pairs
    assert pairs == (total**2 - sum(r["count"] ** 2 for r in n)) // 2


def test_semi_and_anti_joins_split_the_hot_key(skewed):
    turns = scored(skewed).withColumnRenamed("task_id", "conv_id")
    reports = skewed.range(0, 5000, 2).select(F.col("id").alias("conv_id"), F.lit(True).alias("resolved"))
    for out, side in ((H.select_resolved(turns, reports), 0), (H.select_failed(turns, reports), 1)):
        assert len(out.collect()) == turns.where(F.col("conv_id") % 2 == side).count()
    resolved = H.select_resolved(turns, reports)
    resolved.collect()  # the hot conversation is among these
    assert "skew=true" in plan_of(resolved)


def test_a_hot_trial_is_worked_on_in_blocks(skewed):
    n = 30_000
    rows = skewed.range(n).select(
        F.when(F.col("id") % 3 > 0, 1).otherwise(F.col("id") % 50 + 2).alias("trial"),
        F.col("id").alias("step"),
        F.when(F.col("id") < 20_000, 1e6 - F.col("id")).otherwise(5e6).alias("eval_loss"),
    )
    got = {r.trial: r.stop_step for r in D.early_stop(rows, 100).collect()}
    hot = [r.step for r in rows.where("trial = 1").orderBy("step").collect()]
    first_bad = next(i for i, s in enumerate(hot) if s >= 20_000)
    assert got[1] == hot[first_bad + 99]
    plan = plan_of(D.early_stop(rows, 100))
    # every window over rows is partitioned by trial and block
    windows = [line for line in plan.splitlines() if "windowspecdefinition" in line and "_loss" in line]
    assert windows and all("_block" in line for line in windows)


def test_one_long_conversation(skewed):
    turns = skewed.range(20_000).select(
        F.lit(1).alias("conv_id"), F.col("id").alias("turn"), F.lit("assistant").alias("role"), F.lit("x").alias("text")
    )
    (row,) = H.render_chat(turns).collect()
    spans = H.completion_spans(turns, block_turns=1000).agg(F.max("end")).first()[0]
    assert spans == len(row.text) - len("<|im_end|>\n")


def test_one_repository_with_most_bugs(skewed):
    tasks = skewed.range(5000).select(
        F.when(F.col("id") % 10 < 9, "hot").otherwise("cold").alias("repo"),
        F.col("id").cast("string").alias("instance_id"),
        F.format_string("diff --git a/f%d b/f%d", "id", "id").alias("patch"),
        F.array(F.lit("t")).alias("FAIL_TO_PASS"),
    )
    got = K.combine_bugs(tasks, 2).groupBy("repo").count().collect()
    assert {r.repo: r["count"] for r in got} == {"hot": 2250, "cold": 250}
