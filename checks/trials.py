"""Training runs, tuning trials and reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.registry import Inputs, query, view
from patchloom.operators import reports as R
from patchloom.operators import tasks as K
from patchloom.operators import trials as D
from patchloom.operators.chats import select_resolved
from patchloom.operators.splits import split_exact

view(
    "v_trials",
    """
SELECT trial, arg_max(eval_loss, step) AS eval_loss, trial % 4 AS rank, trial % 3 AS lr FROM (
  SELECT trial, step, eval_loss FROM fx_metrics QUALIFY row_number() OVER (PARTITION BY trial ORDER BY step DESC) = 1) GROUP BY trial""",
)


def trials(t: Inputs):
    last = t.fx_metrics.groupBy("trial").agg(F.max_by("eval_loss", "step").alias("eval_loss"))
    key = F.col("trial")
    return last.withColumn(
        "params",
        F.create_map(
            F.lit("rank"), (key % 4).cast("string"), F.lit("lr"), (key % 3).cast("string")
        ),
    )


@query("SELECT trial, eval_loss FROM v_trials WHERE eval_loss IS NOT NULL ORDER BY eval_loss, trial LIMIT 1")
def best_trial(t: Inputs):
    return D.best_trial(trials(t))


@query(
    "SELECT trial, eval_loss, CAST(rank AS VARCHAR) AS rank, CAST(lr AS VARCHAR) AS lr FROM v_trials "
    "WHERE eval_loss IS NOT NULL ORDER BY eval_loss, trial LIMIT 1"
)
def best_trial_params(t: Inputs):
    best = D.best_trial(trials(t), keep=["params"])
    return best.select("trial", "eval_loss", *[F.col("params")[k].alias(k) for k in ("rank", "lr")])


@query(
    """
, long AS (SELECT 'rank' AS param, CAST(rank AS VARCHAR) AS value, eval_loss AS l FROM v_trials WHERE eval_loss IS NOT NULL
  UNION ALL SELECT 'lr', CAST(lr AS VARCHAR), eval_loss FROM v_trials WHERE eval_loss IS NOT NULL)
SELECT param, value, count(*) AS trials, min(l) AS min_loss, round(avg(l), 6) AS mean_loss, round(median(l), 6) AS median_loss
FROM long GROUP BY param, value"""
)
def param_effects(t: Inputs):
    return D.param_effects(trials(t)).select(
        "param",
        "value",
        "trials",
        "min_loss",
        F.round("mean_loss", 6).alias("mean_loss"),
        F.round("median_loss", 6).alias("median_loss"),
    )


@query(
    """SELECT trial, step, eval_loss FROM fx_metrics WHERE eval_loss IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY trial ORDER BY eval_loss, step) = 1"""
)
def best_checkpoint(t: Inputs):
    return D.best_checkpoint(t.fx_metrics)


@query(
    """SELECT trial, step FROM fx_metrics WHERE step % 10 = 0
QUALIFY row_number() OVER (PARTITION BY trial ORDER BY step DESC) <= 3"""
)
def retain_checkpoints(t: Inputs):
    return D.retain_checkpoints(t.fx_metrics, 3, 10).select("trial", "step")


@query("SELECT trial, step FROM fx_metrics WHERE step % 10 = 0")
def retain_all_checkpoints(t: Inputs):
    return D.retain_checkpoints(t.fx_metrics, None, 10).select("trial", "step")


EARLY = """
, b AS (SELECT trial, step, eval_loss, min(eval_loss) OVER (PARTITION BY trial ORDER BY step ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS best FROM fx_metrics),
i AS (SELECT *, eval_loss IS NOT NULL AND (best IS NULL OR eval_loss < best - {threshold}::DOUBLE) AS better FROM b),
g AS (SELECT *, coalesce(max(CASE WHEN better THEN step END) OVER (PARTITION BY trial ORDER BY step), 0) AS last FROM i)
SELECT trial, min(step) AS stop_step FROM g WHERE step - last >= {patience} GROUP BY trial"""


@query(EARLY.format(threshold="0.0", patience=5))
def early_stop(t: Inputs):
    return D.early_stop(t.fx_metrics, 5)


@query(EARLY.format(threshold="0.5", patience=12))
def early_stop_threshold(t: Inputs):
    return D.early_stop(t.fx_metrics, 12, 0.5)


@query(
    """
, b AS (SELECT trial, step, min(eval_loss) OVER (PARTITION BY trial ORDER BY step ROWS UNBOUNDED PRECEDING) AS best FROM fx_metrics),
m AS (SELECT step, median(best) AS med FROM b WHERE best IS NOT NULL AND step > 3 GROUP BY step)
SELECT trial, min(step) AS prune_step FROM b JOIN m USING (step) WHERE best > med GROUP BY trial"""
)
def median_prune(t: Inputs):
    return D.median_prune(t.fx_metrics, 3)


@query(
    "SELECT run_id, event_type FROM fx_runs QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY ts, run_id) <= 600"
)
def within_budget(t: Inputs):
    return D.within_budget(t.fx_runs, run="event_type").select("run_id", "event_type")


@query(
    """SELECT run_id, repo_id FROM (SELECT *, sum(CAST(ceil(seconds) AS BIGINT)) OVER (PARTITION BY repo_id ORDER BY ts, run_id ROWS UNBOUNDED PRECEDING) AS spent
FROM fx_runs) WHERE spent <= 20000"""
)
def within_cost_budget(t: Inputs):
    runs = t.fx_runs.withColumn("cost", F.ceil("seconds").cast("bigint"))
    return D.within_budget(runs, 20_000, run="repo_id", cost="cost").select("run_id", "repo_id")


@query(
    """
SELECT 'candidates' AS stage, count(*) AS rows FROM fx_tasks
UNION ALL SELECT 'valid', count(*) FROM v_valid
UNION ALL SELECT 'traces', count(DISTINCT conv_id) FROM conversations
UNION ALL SELECT 'resolved', count(*) FROM fx_reports WHERE resolved
UNION ALL SELECT 'examples', count(DISTINCT conv_id) FROM conversations WHERE conv_id IN (SELECT conv_id FROM fx_reports WHERE resolved)"""
)
def stage_funnel(t: Inputs):
    traces = t.conversations.select("conv_id").distinct()
    return R.stage_funnel(
        {
            "candidates": t.fx_tasks,
            "valid": K.valid_tasks(K.test_transitions(t.fx_test_results)),
            "traces": traces,
            "resolved": t.fx_reports.where("resolved"),
            "examples": select_resolved(traces, t.fx_reports),
        }
    )


def with_repo(t: Inputs):
    return t.fx_eval.join(t.fx_tasks.select("task_id", "repo"), "task_id")


RATE = "avg(CASE WHEN cond = '{}' THEN CASE WHEN resolved THEN 1.0::DOUBLE ELSE 0 END END)"


@query(
    f"""SELECT repo, round({RATE.format('baseline')}, 6) AS baseline_rate, round({RATE.format('skills')}, 6) AS skills_rate,
  CAST(grouping(repo) AS INTEGER) AS is_total, round({RATE.format('skills')} - {RATE.format('baseline')}, 6) + 0.0::DOUBLE AS lift
FROM fx_eval JOIN fx_tasks USING (task_id) GROUP BY ROLLUP (repo)"""
)
def skill_lift(t: Inputs):
    out = R.skill_lift(with_repo(t))
    return out.select(
        "repo",
        F.round("baseline_rate", 6).alias("baseline_rate"),
        F.round("skills_rate", 6).alias("skills_rate"),
        "is_total",
        (F.round("lift", 6) + F.lit(0.0)).alias("lift"),
    )


@query(
    """SELECT task_id, CASE WHEN b AND s THEN 'both' WHEN s THEN 'fixed' WHEN b THEN 'regressed' ELSE 'neither' END AS change FROM (
  SELECT task_id, bool_or(CASE WHEN cond = 'baseline' THEN resolved END) AS b, bool_or(CASE WHEN cond = 'skills' THEN resolved END) AS s
  FROM fx_eval GROUP BY task_id)"""
)
def compare_conditions(t: Inputs):
    return R.compare_conditions(t.fx_eval)


@query(
    """SELECT event_type AS stage, kind AS model, count(*) AS calls, round(sum(seconds), 2) AS cost, CAST(grouping(event_type, kind) AS INTEGER) AS level
FROM fx_runs GROUP BY ROLLUP (event_type, kind)"""
)
def cost_summary(t: Inputs):
    out = R.cost_summary(t.fx_runs, stage="event_type", model="kind", cost="seconds")
    return out.select(
        F.col("event_type").alias("stage"), F.col("kind").alias("model"), "calls", F.round("cost", 2).alias("cost"), "level"
    )


@query(
    """SELECT cond, round(avg(CASE WHEN resolved THEN 1.0::DOUBLE ELSE 0 END), 6) AS mean_score, count(*) AS evals
FROM fx_eval GROUP BY cond ORDER BY mean_score DESC, cond LIMIT 1"""
)
def best_candidate(t: Inputs):
    scored = t.fx_eval.withColumn("score", F.col("resolved").cast("double"))
    return R.best_candidate(scored).withColumn("mean_score", F.round("mean_score", 6))


@query(
    """SELECT cond, round(avg(CASE WHEN resolved THEN 1.0::DOUBLE ELSE 0 END), 6) AS mean_score, count(*) AS evals
FROM fx_eval JOIN v_order USING (task_id) WHERE pos > 200 AND pos <= 250 GROUP BY cond ORDER BY mean_score DESC, cond LIMIT 1"""
)
def best_candidate_val(t: Inputs):
    splits = split_exact(t.fx_tasks, ["task_id"]).select("task_id", "split")
    scored = t.fx_eval.join(splits, "task_id").withColumn("score", F.col("resolved").cast("double"))
    return R.best_candidate(scored, split="val").withColumn("mean_score", F.round("mean_score", 6))
