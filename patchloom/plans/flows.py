"""The main jobs, each one lazy plan from input tables to a result."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patchloom.functions.chat import render_actions
from patchloom.functions.prompts import fill_problem_statement, render_repair_prompt
from patchloom.functions.text import est_tokens
from patchloom.operators.chats import answered_ids, quality_filter, render_chat, select_resolved
from patchloom.operators.scans import lookup_join
from patchloom.operators.scoring import group_advantage, preference_pairs, score
from patchloom.operators.splits import split_exact, split_fraction
from patchloom.operators.tasks import task_instances, transition_lists
from patchloom.session import materialize

__all__ = [
    "chat_training_set",
    "group_scores",
    "materialize",
    "preference_set",
    "repair_prompts",
    "skill_split",
    "synthesized_tasks",
]


def synthesized_tasks(candidates: DataFrame, results: DataFrame, **options) -> DataFrame:
    """Candidate bugs and their test results to valid tasks with a problem statement each."""
    return fill_problem_statement(task_instances(candidates, results, **options))


def chat_training_set(
    turns: DataFrame,
    reports: DataFrame,
    *,
    style: str = "xml",
    max_tokens: int = 32768,
    rules: Mapping[str, Column] | None = None,
    eval_share: float = 0.0,
    exact_share: bool = False,
    conv: str = "conv_id",
) -> DataFrame:
    """Resolved, answered traces as rendered chat text with a train or eval mark.

    Examples over ``max_tokens`` are kept and flagged, for packing to cut. By default each
    conversation decides by its own hash whether it is held out; ``exact_share`` draws the
    exact number, ranking ids alone and joining the mark back to the texts.
    """
    # both conditions are settled on ids, so that the turns move once
    wanted = select_resolved(answered_ids(turns, conv=conv), reports, conv)
    good = lookup_join(turns, wanted, [conv], "left_semi")
    text = render_chat(render_actions(good, style), conv=conv)
    text = quality_filter(text, rules or {}).withColumn("est_tokens", est_tokens(F.col("text")))
    text = text.withColumn("over_limit", F.col("est_tokens") > max_tokens)
    if not exact_share:
        return split_fraction(text, [conv], eval_share, exact=False)  # no shuffle
    ids = split_fraction(text.select(conv).distinct(), [conv], eval_share)
    return text.join(ids, conv)


def group_scores(
    completions: DataFrame,
    outcomes: DataFrame,
    *,
    mode: str = "hybrid",
    scale: str = "group",
    keep: Sequence[str] = ("task_id", "gen"),
    **options,
) -> DataFrame:
    """Completions and harness logs to rewards and advantages."""
    scored = score(completions, outcomes, mode, **options).select(*keep, "reward")
    return group_advantage(scored, scale)


def repair_prompts(tasks: DataFrame) -> DataFrame:
    """Tasks to prompt rows."""
    return render_repair_prompt(tasks).select("task_id", "prompt")


def preference_set(
    tasks: DataFrame,
    completions: DataFrame,
    scored: DataFrame,
    how: str = "best_worst",
) -> DataFrame:
    """Prompt, chosen and rejected text of every preference pair, with the task's id.

    Pairs are picked on ids and rewards alone; the texts join the picked ones. (task_id, gen)
    identifies a completion, task_id a task. A pair whose task is not given has no row. Prompts
    are rendered last, so their fixed wording is not shuffled. Every side is as long as the
    tasks at least, whatever a plan's estimate says, so none is broadcast.
    """
    slim = scored.select("task_id", "gen", "reward")
    pairs = preference_pairs(slim, how, texts=completions).select("task_id", "chosen", "rejected")
    given = tasks.select("task_id", "repo", "problem_statement", "hints_text")
    return render_repair_prompt(pairs.join(given.hint("merge"), "task_id")).select(
        "task_id", "prompt", "chosen", "rejected"
    )


def skill_split(
    tasks: DataFrame, key: Sequence[str], results: DataFrame | None = None, **sizes
) -> DataFrame:
    """Tasks with statements, cut into train, val and test.

    The split is drawn first, so test lists (from ``results``, for tasks that carry none)
    and statements are made only for the rows it takes.
    """
    picked = split_exact(tasks, key, **sizes)
    if results is not None:
        wanted = picked.select("task_id").distinct()
        lists = transition_lists(lookup_join(results, wanted, ["task_id"], "left_semi"))
        named = lists.select("task_id", F.col("fail_to_pass").alias("FAIL_TO_PASS"))
        picked = picked.join(named, "task_id", "left")
    return fill_problem_statement(picked)

