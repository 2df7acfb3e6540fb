"""Tuning trials and training runs: best trial, early stopping, pruning, checkpoints."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from patchloom.operators.scans import counted, exact_median, group_head, lookup_join, median_of_counts, running, same_keys_join

# Checkpoints kept, steps between them, evaluations in a skill search.
KEEP, SAVE_EVERY, MAX_CALLS = 3, 50, 600


def finite(loss: Column) -> Column:
    """A loss that may win a comparison: not null, not NaN, not infinite."""
    return F.when(F.abs(loss) < F.lit(float("inf")), loss)


def best_trial(
    trials: DataFrame, *, trial: str = "trial", loss: str = "eval_loss", keep: Sequence[str] = ()
) -> DataFrame:
    """The trial of least loss; failed trials never win, ties go to the lowest number.

    ``keep`` names columns of the winner to return as well, such as its parameters.
    """
    done = trials.withColumn("_loss", finite(F.col(loss))).where(F.col("_loss").isNotNull())
    columns = F.struct(trial, F.col("_loss").alias(loss), *keep)
    best = done.agg(F.min_by(columns, F.struct("_loss", trial)).alias("_b"))
    return best.where(F.col("_b").isNotNull()).select("_b.*")


def param_effects(trials: DataFrame, *, params: str = "params", loss: str = "eval_loss") -> DataFrame:
    """Loss per parameter value over finished trials: count, least, mean, median.

    All four come from one table of counted losses, so trials are read and spread out once.
    """
    rows = trials.withColumn("_loss", finite(F.col(loss))).where(F.col("_loss").isNotNull())
    long = rows.select(F.explode(params).alias("param", "value"), "_loss")
    keys = ["param", "value"]
    freq = counted(long, keys, "_loss")
    n = F.sum("_n")
    stats = freq.groupBy(*keys).agg(
        n.alias("trials"), F.min("_v").alias("min_loss"), (F.sum(F.col("_v") * F.col("_n")) / n).alias("mean_loss")
    )
    return same_keys_join(stats, median_of_counts(freq, keys, out="median_loss"), keys, "inner")


def best_checkpoint(
    metrics: DataFrame, *, run: str = "trial", step: str = "step", loss: str = "eval_loss"
) -> DataFrame:
    """Step of least evaluation loss per run; the earliest on ties."""
    done = metrics.withColumn("_loss", finite(F.col(loss))).where(F.col("_loss").isNotNull())
    return (
        done.groupBy(run)
        .agg(F.min(F.struct(F.col("_loss"), F.col(step))).alias("_b"))
        .select(run, F.col(f"_b.{step}").alias(step), F.col("_b._loss").alias(loss))
    )


def retain_checkpoints(
    df: DataFrame,
    keep: int | None = KEEP,
    every: int = SAVE_EVERY,
    *,
    run: str = "trial",
    step: str = "step",
) -> DataFrame:
    """Checkpoints at each ``every`` steps, the newest ``keep`` per run; None keeps all."""
    saved = df.where(F.col(step) % every == 0)
    if keep is None:
        return saved
    newest = Window.partitionBy(run).orderBy(F.col(step).desc())
    return saved.withColumn("_rn", F.row_number().over(newest)).where(F.col("_rn") <= keep).drop("_rn")


def early_stop(
    metrics: DataFrame,
    patience: int,
    threshold: float = 0.0,
    *,
    run: str = "trial",
    step: str = "step",
    loss: str = "eval_loss",
) -> DataFrame:
    """First step of each run with ``patience`` evaluations in a row without improvement.

    An evaluation improves when its loss is below the best so far minus the threshold;
    the first finite loss always does. A failed evaluation does not improve. Runs that
    never stop are not listed.
    """
    slim = metrics.select(run, step, finite(F.col(loss)).alias("_loss"))
    one = F.lit(1).cast("bigint")
    so_far = {"_best": ("min", F.col("_loss")), "_before": ("sum", one)}
    seen = running(slim, [run], [step], None, so_far, inclusive=False, keep="_block")
    better = F.col("_loss").isNotNull() & (
        F.col("_best").isNull() | (F.col("_loss") < F.col("_best") - F.lit(float(threshold)))
    )
    at = F.col("_before") + 1
    marked = seen.select(run, step, "_block", at.alias("_at"), F.when(better, at).alias("_hit"))
    waited = running(marked, [run], [step], "_block", {"_last": ("max", F.col("_hit"))}, dealt=True)
    idle = F.col("_at") - F.coalesce("_last", F.lit(0))
    return waited.where(idle >= patience).groupBy(run).agg(F.min(step).alias("stop_step"))


def median_prune(
    metrics: DataFrame,
    warmup: int = 0,
    *,
    trial: str = "trial",
    step: str = "step",
    loss: str = "eval_loss",
) -> DataFrame:
    """First step after ``warmup`` where a trial's best so far is over the median of all trials'."""
    slim = metrics.select(trial, step, finite(F.col(loss)).alias("_loss"))
    best = running(slim, [trial], [step], None, {"_best": ("min", F.col("_loss"))})
    after = best.where((F.col(step) > warmup) & F.col("_best").isNotNull()).select(trial, step, "_best")
    medians = exact_median(after, [step], "_best", out="_median")
    return (
        lookup_join(after, medians, [step], "inner")
        .where(F.col("_best") > F.col("_median"))
        .groupBy(trial)
        .agg(F.min(step).alias("prune_step"))
    )


def within_budget(
    evals: DataFrame,
    max_calls: int = MAX_CALLS,
    *,
    run: str = "run",
    order: tuple[str, ...] = ("ts", "run_id"),
    cost: str | None = None,
    block: Column | None = None,
) -> DataFrame:
    """Evaluations of each run, in order, until the budget is used.

    Without ``cost`` every evaluation costs one call: ranges of a run past the budget are
    dropped where they are read, and only the rest is ranked. With ``cost`` a running sum is kept per run, over ranges of the order
    or over the caller's blocks (a column that rises with the order).
    """
    if cost is None:
        return group_head(evals, [run], list(order), max_calls)
    spent = running(evals, [run], list(order), block, {"_spent": ("sum", F.col(cost))})
    return spent.where(F.col("_spent") <= max_calls).drop("_spent")
