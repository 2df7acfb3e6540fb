"""Patch extraction, rewards, advantages, best picks."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.registry import Inputs, query, view
from patchloom.functions import patches as P
from patchloom.functions.rewards import combine_rewards
from patchloom.operators import scoring as S

MODULES = ", ".join(f"'{m}'" for m in P.ALLOWED_MODULES)

# Patch and its checks, from a completion.
view(
    "v_patch",
    """
SELECT task_id, gen, completion,
  CASE WHEN regexp_matches(completion, '(?s)```diff\\n(.*?)```')
         THEN regexp_replace(regexp_extract(completion, '(?s)```diff\\n(.*?)```', 1), '^\\s+|\\s+$', '', 'g')
       WHEN regexp_matches(completion, '(?m)^(?:--- a/|diff --git)')
         THEN regexp_extract(completion, '(?sm)^(?:--- a/|diff --git).*', 0)
       ELSE NULL END AS patch
FROM fx_completions""",
)
view(
    "v_checked",
    f"""
SELECT *,
  CASE WHEN patch IS NULL THEN 0.0::DOUBLE
       WHEN regexp_matches(patch, '(?m)^-') AND regexp_matches(patch, '(?m)^\\+')
            AND contains(patch, '---') AND contains(patch, '+++') THEN 0.5::DOUBLE
       ELSE 0.1::DOUBLE END AS format_reward,
  len(list_filter(regexp_extract_all(patch, '(?m)^\\+\\s*(?:import|from)\\s+(\\w+)', 1),
      lambda m: m NOT IN ({MODULES}))) = 0 AS imports_ok,
  array_to_string(list_filter(string_split(patch, chr(10)), lambda l: NOT (
      starts_with(l, '+') AND NOT starts_with(l, '+++') AND
      regexp_matches(trim(substr(l, 2)), '^(?:[A-Z_][A-Z_0-9]*\\s*=|exec\\(|eval\\(|__import__)'))), chr(10)) AS stripped
FROM v_patch""",
)
view(
    "v_scored",
    """
SELECT c.task_id, c.gen, c.patch, c.format_reward, c.imports_ok, o.stdout,
  CASE WHEN c.patch IS NULL THEN 0.0::DOUBLE WHEN NOT c.imports_ok THEN -20.0::DOUBLE
       WHEN o.stdout IS NULL THEN c.format_reward
       WHEN contains(o.stdout, 'PASS') THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS test_reward,
  CASE WHEN c.patch IS NULL THEN 0.0::DOUBLE
       WHEN o.stdout IS NULL THEN c.format_reward
       WHEN contains(o.stdout, 'PASS') THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS plain_test_reward
FROM v_checked c LEFT JOIN fx_outcomes o ON c.task_id = o.task_id AND c.gen = o.gen""",
)
view(
    "v_hybrid",
    """
SELECT *, 0.3::DOUBLE * format_reward + 0.7::DOUBLE * plain_test_reward AS reward FROM v_scored""",
)


def scored(t: Inputs):
    return S.score(t.fx_completions, t.fx_outcomes, "hybrid")


@query("SELECT task_id, gen, patch FROM v_patch")
def extract_patch(t: Inputs):
    return t.fx_completions.select("task_id", "gen", P.extract_patch(F.col("completion")).alias("patch"))


@query("SELECT task_id, gen, imports_ok FROM v_checked")
def imports_ok(t: Inputs):
    found = S.with_patch(t.fx_completions)
    return found.select("task_id", "gen", P.imports_ok(F.col("patch")).alias("imports_ok"))


@query("SELECT task_id, gen, stripped FROM v_checked")
def strip_global_lines(t: Inputs):
    return S.with_patch(t.fx_completions, strip_globals=True).select(
        "task_id", "gen", F.col("model_patch").alias("stripped")
    )


@query("SELECT task_id, gen, format_reward FROM v_checked")
def format_reward(t: Inputs):
    return S.with_patch(t.fx_completions).select("task_id", "gen", "format_reward")


@query(
    "SELECT c.task_id, c.gen, c.shape, o.stdout FROM fx_completions c "
    "LEFT JOIN fx_outcomes o ON c.task_id = o.task_id AND c.gen = o.gen"
)
def attach_outcomes(t: Inputs):
    return S.attach_outcomes(t.fx_completions, t.fx_outcomes).select("task_id", "gen", "shape", "stdout")


@query("SELECT task_id, gen, test_reward FROM v_scored")
def test_reward(t: Inputs):
    return S.with_test_reward(
        t.fx_completions, t.fx_outcomes, stdlib_only=True, strip_globals=True
    ).select("task_id", "gen", "test_reward")


@query("SELECT task_id, gen, round(reward, 6) + 0.0::DOUBLE AS reward FROM v_hybrid")
def hybrid_reward(t: Inputs):
    return scored(t).select("task_id", "gen", (F.round("reward", 6) + F.lit(0.0)).alias("reward"))


@query(
    "SELECT task_id, gen, round(2.0::DOUBLE * format_reward + 0.5::DOUBLE * test_reward, 6) + 0.0::DOUBLE AS weighted, "
    "round(format_reward + test_reward, 6) + 0.0::DOUBLE AS plain FROM v_scored"
)
def combine_reward_columns(t: Inputs):
    both = [F.col("format_reward"), F.col("test_reward")]
    rows = S.with_test_reward(t.fx_completions, t.fx_outcomes, stdlib_only=True)
    return rows.select(
        "task_id",
        "gen",
        (F.round(combine_rewards(both, [2.0, 0.5]), 6) + F.lit(0.0)).alias("weighted"),
        (F.round(combine_rewards(both), 6) + F.lit(0.0)).alias("plain"),
    )


@query("SELECT task_id, gen, test_reward AS reward FROM v_scored")
def score_test_mode(t: Inputs):
    return S.score(t.fx_completions, t.fx_outcomes, "test", stdlib_only=True).select("task_id", "gen", "reward")


@query("SELECT task_id, gen, format_reward AS reward FROM v_checked")
def score_format_mode(t: Inputs):
    return S.score(t.fx_completions, mode="format").select("task_id", "gen", "reward")


@query("SELECT task_id, gen, shape FROM fx_completions WHERE ceil(length(completion) / 4.0) < 20")
def drop_truncated(t: Inputs):
    return S.drop_truncated(t.fx_completions, 20).select("task_id", "gen", "shape")


ADVANTAGE_SQL = """
, stat AS (SELECT task_id, avg(reward) AS m, coalesce(stddev_samp(reward), 0) AS s FROM v_hybrid GROUP BY task_id)
SELECT h.task_id, h.gen, round({value}, 5) + 0.0::DOUBLE AS advantage
FROM v_hybrid h JOIN stat USING (task_id)"""


def advantage(t: Inputs, scale: str):
    out = S.group_advantage(scored(t).select("task_id", "gen", "reward"), scale)
    return out.select("task_id", "gen", (F.round("advantage", 5) + F.lit(0.0)).alias("advantage"))


@query(ADVANTAGE_SQL.format(value="(h.reward - m) / (s + 0.0001::DOUBLE)"))
def group_advantage(t: Inputs):
    return advantage(t, "group")


@query(
    ADVANTAGE_SQL.format(
        value="(h.reward - m) / ((SELECT stddev_samp(reward) FROM v_hybrid) + 0.0001::DOUBLE)"
    )
)
def batch_advantage(t: Inputs):
    return advantage(t, "batch")


@query(ADVANTAGE_SQL.format(value="h.reward - m"))
def centred_advantage(t: Inputs):
    return advantage(t, "none")


@query(
    """SELECT task_id, gen, round(reward, 6) + 0.0::DOUBLE AS reward FROM v_hybrid WHERE reward > 0.2
QUALIFY row_number() OVER (PARTITION BY task_id ORDER BY reward DESC, gen) = 1"""
)
def best_of_n(t: Inputs):
    return S.best_of_n(scored(t), 0.2).withColumn("reward", F.round("reward", 6) + F.lit(0.0))


PICKS = """
, top AS (SELECT task_id, gen AS chosen_gen, reward AS chosen_reward FROM v_hybrid
  QUALIFY row_number() OVER (PARTITION BY task_id ORDER BY reward DESC, gen) = 1)"""


@query(
    PICKS
    + """, low AS (SELECT task_id, gen AS rejected_gen, reward AS rejected_reward FROM v_hybrid
  QUALIFY row_number() OVER (PARTITION BY task_id ORDER BY reward, gen) = 1)
SELECT task_id, chosen_gen, rejected_gen FROM top JOIN low USING (task_id) WHERE chosen_reward > rejected_reward"""
)
def preference_pairs(t: Inputs):
    return S.preference_pairs(scored(t)).select("task_id", "chosen_gen", "rejected_gen")


@query(
    PICKS
    + """SELECT h.task_id, chosen_gen, h.gen AS rejected_gen FROM v_hybrid h JOIN top USING (task_id)
WHERE chosen_reward > h.reward"""
)
def preference_best_vs_rest(t: Inputs):
    return S.preference_pairs(scored(t), "best_vs_rest").select("task_id", "chosen_gen", "rejected_gen")


@query(
    """SELECT a.task_id, CAST(sum(CASE WHEN a.format_reward > b.format_reward THEN 1 ELSE 0 END) AS BIGINT) AS pairs
FROM v_checked a JOIN v_checked b ON a.task_id = b.task_id GROUP BY a.task_id"""
)
def pair_counts(t: Inputs):
    return S.pair_counts(S.score(t.fx_completions, mode="format"))


@query(
    """, long AS (
  SELECT task_id, patch, 'test' AS mode, test_reward AS r FROM v_scored
  UNION ALL SELECT task_id, patch, 'format', format_reward FROM v_scored
  UNION ALL SELECT task_id, patch, 'hybrid', 0.3::DOUBLE * format_reward + 0.7::DOUBLE * test_reward FROM v_scored)
SELECT task_id, mode, count(*) AS completions, round(avg(r), 6) + 0.0::DOUBLE AS mean_reward,
  round(max(r), 6) + 0.0::DOUBLE AS best_reward,
  round(avg(CASE WHEN r > 0 THEN 1.0::DOUBLE ELSE 0 END), 6) AS share_positive,
  round(avg(CASE WHEN patch IS NULL THEN 1.0::DOUBLE ELSE 0 END), 6) AS share_no_patch
FROM long GROUP BY task_id, mode"""
)
def reward_summary(t: Inputs):
    out = S.reward_summary_by_mode(t.fx_completions, t.fx_outcomes, stdlib_only=True)
    return out.select(
        "task_id",
        "mode",
        "completions",
        *[
            (F.round(c, 6) + F.lit(0.0)).alias(c)
            for c in ("mean_reward", "best_reward", "share_positive", "share_no_patch")
        ],
    )


@query(
    """, placed AS (SELECT task_id, gen, row_number() OVER (ORDER BY task_id, gen) - 1 AS idx FROM fx_completions),
slots AS (SELECT o_orderkey AS assigned_task_id, row_number() OVER (ORDER BY o_orderkey) - 1 AS slot FROM orders)
SELECT task_id, gen, CAST(idx AS BIGINT) AS idx, assigned_task_id
FROM placed JOIN slots ON slot = idx % (SELECT count(*) FROM orders)"""
)
def assign_tasks_cyclic(t: Inputs):
    return S.assign_tasks(
        t.fx_completions, t.fx_tasks.select("task_id"), "cyclic"
    ).select("task_id", "gen", "idx", "assigned_task_id")


@query("SELECT c.task_id, c.gen, k.instance_id, k.repo FROM fx_completions c LEFT JOIN fx_tasks k USING (task_id)")
def assign_tasks_by_id(t: Inputs):
    return S.assign_tasks(t.fx_completions, t.fx_tasks).select("task_id", "gen", "instance_id", "repo")
