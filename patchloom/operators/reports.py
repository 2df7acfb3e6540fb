"""Counts and rates over tasks, evaluations and costs."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _resolved() -> Column:
    return F.coalesce("resolved", F.lit(False))


def resolve_rate(reports: DataFrame) -> DataFrame:
    """Resolved and total as counts and as text; a null verdict is unresolved."""
    counts = reports.agg(F.count_if(_resolved()).alias("resolved"), F.count("*").alias("total"))
    return counts.withColumn(
        "rate", F.concat(F.col("resolved").cast("string"), F.lit("/"), F.col("total").cast("string"))
    )


def stage_funnel(stages: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per stage; an empty stage counts 0. Each stage is counted where it lies."""
    out = None
    for name, df in stages.items():
        row = df.agg(F.count("*").alias("rows")).select(F.lit(name).alias("stage"), "rows")
        out = row if out is None else out.unionByName(row)
    return out


def skill_lift(
    evals: DataFrame, *, baseline: str = "baseline", skills: str = "skills", by: str = "repo"
) -> DataFrame:
    """Resolve rate per condition and the difference, per ``by`` value and in total (null)."""
    hit = _resolved().cast("double")
    return (
        evals.rollup(by)
        .agg(
            F.avg(F.when(F.col("cond") == baseline, hit)).alias("baseline_rate"),
            F.avg(F.when(F.col("cond") == skills, hit)).alias("skills_rate"),
            F.grouping(by).cast("int").alias("is_total"),
        )
        .withColumn("lift", F.col("skills_rate") - F.col("baseline_rate"))
    )


def compare_conditions(
    evals: DataFrame, *, task: str = "task_id", baseline: str = "baseline", skills: str = "skills"
) -> DataFrame:
    """Per task: fixed, regressed, both or neither; unpaired when a condition is missing.

    One aggregation instead of a join of the table with itself.
    """

    def verdict(cond: str):
        return F.bool_or(F.when(F.col("cond") == cond, _resolved()))

    old, new = F.col("_old"), F.col("_new")
    return (
        evals.groupBy(task)
        .agg(verdict(baseline).alias("_old"), verdict(skills).alias("_new"))
        .select(
            task,
            F.when(old.isNull() | new.isNull(), "unpaired")
            .when(old & new, "both")
            .when(new, "fixed")
            .when(old, "regressed")
            .otherwise("neither")
            .alias("change"),
        )
    )


def cost_summary(
    calls: DataFrame, *, stage: str = "stage", model: str = "model", cost: str = "cost"
) -> DataFrame:
    """Cost by stage and model, with stage totals and the grand total (nulls)."""
    return calls.rollup(stage, model).agg(
        F.count("*").alias("calls"),
        F.sum(cost).alias("cost"),
        F.grouping_id().cast("int").alias("level"),
    )


def best_candidate(
    evals: DataFrame,
    *,
    candidate: str = "cond",
    score: str = "score",
    split: str | None = None,
    split_col: str = "split",
) -> DataFrame:
    """Candidate with the best mean score, over one split if named; ties go to the first name."""
    rows = evals if split is None else evals.where(F.col(split_col) == split)
    means = rows.groupBy(candidate).agg(F.avg(score).alias("mean_score"), F.count("*").alias("evals"))
    return means.orderBy(F.col("mean_score").desc(), candidate).limit(1)
