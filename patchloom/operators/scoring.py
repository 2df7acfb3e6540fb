"""From completions to rewards: patch checks, harness results, advantages, best picks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patchloom.functions import rewards as R
from patchloom.functions.patches import extract_patch, imports_ok, strip_global_lines
from patchloom.functions.text import est_tokens
from patchloom.operators.scans import dense_index, lookup_join

KEY = ("task_id", "gen")
MODES = ("test", "format", "hybrid")


def attach_outcomes(completions: DataFrame, outcomes: DataFrame, on: Sequence[str] = KEY) -> DataFrame:
    """Left join of harness logs; a completion without a log keeps nulls.

    ``outcomes`` must hold at most one row per key. It is as long as ``completions``, so it is
    never broadcast, however small an estimate makes it.
    """
    return completions.join(outcomes.hint("merge"), list(on), "left")


def assign_tasks(
    completions: DataFrame,
    tasks: DataFrame,
    mode: str = "by_id",
    *,
    task_col: str = "task_id",
    completion_order: Sequence[str] = KEY,
) -> DataFrame:
    """Give each completion its task's columns.

    ``by_id`` joins on the task id. ``cyclic`` gives completion i the task i mod n by
    position (completions in ``completion_order``, tasks in id order) and returns the
    task's id as ``assigned_task_id``. Positions are counted over ranges of the order, so
    neither many completions of one task nor ids that lie close together meet in one task.
    """
    if mode == "by_id":
        return completions.join(tasks, task_col, "left")
    if mode != "cyclic":
        raise ValueError(f"unknown mode {mode!r}")
    ranked = dense_index(tasks.withColumnRenamed(task_col, "assigned_task_id"), ["assigned_task_id"], out="_slot")
    placed = dense_index(completions, completion_order, out="idx")
    n = tasks.agg(F.count("*")).scalar()
    return placed.withColumn("_slot", F.pmod(F.col("idx"), n)).join(ranked, "_slot").drop("_slot")


def with_patch(
    completions: DataFrame, *, stdlib_only: bool = False, strip_globals: bool = False
) -> DataFrame:
    """Add patch, model_patch (what the harness gets), format_reward and imports_allowed.

    Done before any join, so that only the small flags have to move: a column that is
    not asked for later is pruned from the shuffle.
    """
    found = completions.withColumn("patch", extract_patch(F.col("completion")))
    patch = F.col("patch")
    allowed = F.coalesce(imports_ok(patch), F.lit(True)) if stdlib_only else F.lit(True)
    return found.withColumns(
        {
            "has_patch": patch.isNotNull(),
            "model_patch": strip_global_lines(patch) if strip_globals else patch,
            "format_reward": R.format_reward(patch),
            "imports_allowed": allowed,
        }
    )


def fold_logs(outcomes: DataFrame, on: Sequence[str] = KEY) -> DataFrame:
    """One row (key, passed) per completion; repeated logs count as passed if any did."""
    logs = outcomes.select(*on, R.log_passed(F.col("stdout")).alias("passed"))
    return logs.groupBy(*on).agg(F.bool_or("passed").alias("passed"))


def with_test_reward(
    completions: DataFrame,
    outcomes: DataFrame,
    *,
    stdlib_only: bool = False,
    strip_globals: bool = False,
    has_task: Column | None = None,
    on: Sequence[str] = KEY,
    folded: bool = False,
) -> DataFrame:
    """Add the harness reward. Repeated logs of one completion count as passed if any did.

    Harness logs shrink to one boolean before they move. The fold of repeated logs
    shuffles by the join key, so the join adds no shuffle of its own on that side.
    ``folded`` says that ``outcomes`` is the result of ``fold_logs``.
    """
    checked = with_patch(completions, stdlib_only=stdlib_only, strip_globals=strip_globals)
    passed = outcomes.select(*on, "passed") if folded else fold_logs(outcomes, on)
    return add_test_reward(attach_outcomes(checked, passed, on), has_task)


def add_test_reward(checked: DataFrame, has_task: Column | None = None) -> DataFrame:
    """``test_reward`` from the columns of ``with_patch`` and ``passed`` (null: no log)."""
    return checked.withColumn(
        "test_reward",
        R.test_reward(
            F.col("has_patch"),
            F.col("imports_allowed"),
            F.lit(True) if has_task is None else has_task,
            F.col("passed"),
            F.col("format_reward"),
        ),
    )


def score(
    completions: DataFrame,
    outcomes: DataFrame | None = None,
    mode: str = "hybrid",
    *,
    w_f: float = R.FORMAT_WEIGHT,
    w_t: float = R.TEST_WEIGHT,
    **options,
) -> DataFrame:
    """Add ``reward``: mode "test", "format", and anything else means hybrid.

    Format scoring needs no harness results and plans no join. Without ``outcomes`` the
    other modes score every completion by its format.
    """
    if mode == "format":
        return with_patch(completions).withColumn("reward", F.col("format_reward"))
    if outcomes is None:
        nothing = completions.select(*options.get("on", KEY), F.lit(None).cast("string").alias("stdout"))
        outcomes = nothing.where(F.lit(False))
    return add_reward(with_test_reward(completions, outcomes, **options), mode, w_f=w_f, w_t=w_t)


def add_reward(
    scored: DataFrame, mode: str = "hybrid", *, w_f: float = R.FORMAT_WEIGHT, w_t: float = R.TEST_WEIGHT
) -> DataFrame:
    """``reward`` from ``format_reward`` and ``test_reward``."""
    if mode == "test":
        return scored.withColumn("reward", F.col("test_reward"))
    return scored.withColumn(
        "reward", R.hybrid_reward(F.col("format_reward"), F.col("test_reward"), w_f, w_t)
    )


def group_advantage(
    scored: DataFrame,
    scale: str = "group",
    eps: float = 1e-4,
    *,
    task: str = "task_id",
    reward: str = "reward",
    out: str = "advantage",
) -> DataFrame:
    """Reward minus the task's mean, divided by the spread of the task or of the batch.

    Means and deviations are aggregates joined back, not a window: they combine before
    the shuffle, and a task with very many completions is split at run time.
    """
    if scale not in ("group", "batch", "none"):
        raise ValueError(f"unknown scale {scale!r}")
    r = F.col(reward)
    stats = scored.groupBy(task).agg(
        F.avg(r).alias("_mean"), F.coalesce(F.stddev_samp(r), F.lit(0.0)).alias("_std")
    )
    centred = lookup_join(scored, stats, [task]).withColumn("_d", r - F.col("_mean"))
    if scale == "group":
        value = F.col("_d") / (F.col("_std") + F.lit(eps))
    elif scale == "batch":
        spread = scored.agg(F.coalesce(F.stddev_samp(r), F.lit(0.0))).scalar()
        value = F.col("_d") / (spread + F.lit(eps))
    else:
        value = F.col("_d")
    return centred.withColumn(out, value).drop("_mean", "_std", "_d")


def drop_truncated(completions: DataFrame, max_tokens: int, text: str = "completion") -> DataFrame:
    """Leave out completions that reached the length cap."""
    return completions.where(est_tokens(F.col(text)) < max_tokens)


def best_of_n(
    scored: DataFrame,
    min_reward: float,
    *,
    task: str = "task_id",
    gen: str = "gen",
    reward: str = "reward",
) -> DataFrame:
    """Best completion of each task over a floor; the lowest generation wins ties.

    The pick needs only numbers, so texts move only if the caller joins them back.
    """
    best = reward_levels(scored.where(F.col(reward) > min_reward), task, gen, reward)
    return best.groupBy(task).agg(F.max_by("_gen", "_reward").alias(gen), F.max("_reward").alias(reward))


def reward_levels(scored: DataFrame, task: str, gen: str, reward: str) -> DataFrame:
    """Per task and reward the lowest generation (_gen, _reward): what picks are made from.

    Two plain aggregates of numbers, combined before they move, take the place of one over
    structs, which Spark can only sort. A reward that is null or not a number is none.
    """
    rated = scored.where(F.col(reward).isNotNull() & ~F.isnan(F.col(reward).cast("double")))
    return rated.groupBy(task, F.col(reward).alias("_reward")).agg(F.min(gen).alias("_gen"))


def preference_pairs(
    scored: DataFrame,
    how: str = "best_worst",
    *,
    task: str = "task_id",
    gen: str = "gen",
    reward: str = "reward",
    texts: DataFrame | None = None,
    text: str = "completion",
) -> DataFrame:
    """Chosen and rejected generation per task, chosen strictly better.

    ``best_worst`` gives one pair per task; ``best_vs_rest`` pairs the best completion
    with every worse one. Both are linear in the completions; the full set of pairs
    grows with the square of a task's completions and is not produced
    (``pair_counts`` reports its size). Completions without a reward are in no pair.

    With ``texts`` (task, gen, text) the pairs carry the texts as ``chosen`` and ``rejected``.
    Each side meets its texts by the completion's key, once and before the sides meet by task.
    """
    if how not in ("best_worst", "best_vs_rest"):
        raise ValueError(f"unknown pairing {how!r}")
    scored = scored.where(F.col(reward).isNotNull())
    pick = reward_levels(scored, task, gen, reward).groupBy(task).agg(
        F.max_by("_gen", "_reward").alias("chosen_gen"),
        F.max("_reward").alias("chosen_reward"),
        F.min_by("_gen", "_reward").alias("rejected_gen"),
        F.min("_reward").alias("rejected_reward"),
    )
    better = F.col("chosen_reward") > F.col("rejected_reward")
    if texts is None and how == "best_worst":
        return pick.where(better)
    chosen = pick.select(task, "chosen_gen", "chosen_reward")
    if how == "best_worst":
        chosen = pick.where(better).select(*chosen.columns)
        rejected = pick.where(better).select(task, "rejected_gen", "rejected_reward")
    else:
        rejected = scored.select(
            task, F.col(gen).alias("rejected_gen"), F.col(reward).alias("rejected_reward")
        )
    if texts is None:
        return lookup_join(rejected, chosen, [task], "inner").where(better)
    sides = {"chosen": chosen, "rejected": rejected}
    for side, ids in sides.items():
        own = texts.select(task, F.col(gen).alias(f"{side}_gen"), F.col(text).alias(side))
        sides[side] = ids.join(own.hint("merge"), [task, f"{side}_gen"])  # as long as the completions
    return sides["rejected"].join(sides["chosen"].hint("merge"), task).where(better)


def pair_counts(scored: DataFrame, *, task: str = "task_id", reward: str = "reward") -> DataFrame:
    """How many (better, worse) pairs each task has, counted from its reward levels.

    Completions without a reward are in no pair; a task with none else is still listed.
    """
    counted = F.count(reward).alias("n")
    levels = scored.groupBy(task, reward).agg(counted)
    # pairs over different rewards = (n^2 - sum of level^2) / 2
    return levels.groupBy(task).agg(
        F.expr("(sum(n) * sum(n) - sum(n * n)) div 2").alias("pairs")
    )


def reward_summary(scored: DataFrame, *, task: str = "task_id", reward: str = "reward") -> DataFrame:
    """Per task: completions, mean and best reward, share above 0, share without a patch."""
    return scored.groupBy(task).agg(
        F.count("*").alias("completions"),
        F.avg(reward).alias("mean_reward"),
        F.max(reward).alias("best_reward"),
        F.avg((F.col(reward) > 0).cast("double")).alias("share_positive"),
        F.avg((~F.col("has_patch")).cast("double")).alias("share_no_patch"),
    )


def reward_summary_by_mode(
    completions: DataFrame,
    outcomes: DataFrame,
    *,
    task: str = "task_id",
    w_f: float = R.FORMAT_WEIGHT,
    w_t: float = R.TEST_WEIGHT,
    **options,
) -> DataFrame:
    """``reward_summary`` for the three modes, from one scoring pass and one aggregation."""
    scored = with_test_reward(completions, outcomes, **options).withColumn(
        "hybrid_reward", R.hybrid_reward(F.col("format_reward"), F.col("test_reward"), w_f, w_t)
    )
    aggs = [
        F.count("*").alias("completions"),
        F.avg((~F.col("has_patch")).cast("double")).alias("share_no_patch"),
    ]
    for mode in MODES:
        r = F.col(f"{mode}_reward")
        aggs += [
            F.avg(r).alias(f"{mode}_mean"),
            F.max(r).alias(f"{mode}_best"),
            F.avg((r > 0).cast("double")).alias(f"{mode}_share"),
        ]
    wide = scored.groupBy(task).agg(*aggs)
    rows = F.array(
        *[
            F.struct(
                F.lit(mode).alias("mode"),
                F.col(f"{mode}_mean").alias("mean_reward"),
                F.col(f"{mode}_best").alias("best_reward"),
                F.col(f"{mode}_share").alias("share_positive"),
            )
            for mode in MODES
        ]
    )
    return wide.select(task, "completions", "share_no_patch", F.inline(rows))
