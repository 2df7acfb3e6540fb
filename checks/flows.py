"""The main jobs, the table form of the live operators, and user functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.registry import Inputs, query
from checks.scoring import PICKS, scored
from checks.tasks import PROMPT_SQL
from patchloom.functions.udfs import map_examples as run_formatter
from patchloom.functions.udfs import register_reward as add_reward
from patchloom.plans import flows
from patchloom.streaming import live


@query(
    "SELECT k.task_id, k.problem_statement, array_to_string(v.f2p, '|') AS tests "
    "FROM v_filled k JOIN v_valid v ON k.task_id = v.task_id"
)
def synthesized_tasks(t: Inputs):
    out = flows.synthesized_tasks(t.fx_tasks, t.fx_test_results)
    return out.select("task_id", "problem_statement", F.array_join("FAIL_TO_PASS", "|").alias("tests"))


WRAPPED = (
    "concat('<|im_start|>', role, chr(10), CASE WHEN role = 'assistant' THEN concat('<action>', text, '</action>') "
    "ELSE text END, '<|im_end|>', chr(10))"
)


@query(
    f"""
, good AS (SELECT conv_id, string_agg({WRAPPED}, '' ORDER BY turn) AS text FROM conversations
  WHERE conv_id IN (SELECT conv_id FROM fx_reports WHERE resolved) GROUP BY conv_id HAVING bool_or(role = 'assistant'))
SELECT conv_id, text, CAST(ceil(length(text) / 4.0) AS BIGINT) AS est_tokens, ceil(length(text) / 4.0) > 500 AS over_limit,
  CASE WHEN CAST(concat('0x', substr(md5(concat('42:', conv_id)), 1, 8)) AS BIGINT) < 0.15::DOUBLE * 4294967296 THEN 'eval' ELSE 'train' END AS split
FROM good"""
)
def chat_training_set(t: Inputs):
    return flows.chat_training_set(
        t.conversations, t.fx_reports, max_tokens=500, eval_share=0.15
    )


@query(
    """
, good AS (SELECT DISTINCT conv_id FROM conversations WHERE role = 'assistant' AND conv_id IN (SELECT conv_id FROM fx_reports WHERE resolved)),
r AS (SELECT conv_id, row_number() OVER (ORDER BY md5(concat('42:', conv_id))) AS p, count(*) OVER () AS n FROM good)
SELECT conv_id, CASE WHEN p <= ceil(0.15::DOUBLE * n) THEN 'eval' ELSE 'train' END AS split FROM r"""
)
def chat_training_set_exact(t: Inputs):
    out = flows.chat_training_set(t.conversations, t.fx_reports, eval_share=0.15, exact_share=True)
    return out.select("conv_id", "split")


@query(
    """, stat AS (SELECT task_id, avg(reward) AS m, coalesce(stddev_samp(reward), 0) AS s FROM v_hybrid GROUP BY task_id)
SELECT h.task_id, count(*) AS completions, round(avg(h.reward), 6) + 0.0::DOUBLE AS mean_reward,
  round(max((h.reward - m) / (s + 0.0001::DOUBLE)), 5) + 0.0::DOUBLE AS best_advantage
FROM v_hybrid h JOIN stat USING (task_id) GROUP BY h.task_id"""
)
def group_scores(t: Inputs):
    return (
        flows.group_scores(t.fx_completions, t.fx_outcomes)
        .groupBy("task_id")
        .agg(
            F.count("*").alias("completions"),
            (F.round(F.avg("reward"), 6) + F.lit(0.0)).alias("mean_reward"),
            (F.round(F.max("advantage"), 5) + F.lit(0.0)).alias("best_advantage"),
        )
    )


@query(
    """
, picked AS (SELECT task_id, CASE WHEN pos <= 200 THEN 'train' WHEN pos <= 250 THEN 'val' ELSE 'test' END AS split FROM v_order WHERE pos <= 350)
SELECT task_id, split, problem_statement FROM picked JOIN v_filled USING (task_id)"""
)
def skill_split(t: Inputs):
    split = flows.skill_split(t.fx_tasks, ["task_id"], t.fx_test_results)
    return split.select("task_id", "split", "problem_statement")


@query(
    """SELECT strftime(date_trunc('day', ts), '%Y-%m-%d') AS day, event_type, count(*) AS total,
  count(*) FILTER (WHERE value > 10) AS hits, round(count(*) FILTER (WHERE value > 10) / count(*), 6) AS rate
FROM events GROUP BY 1, 2"""
)
def live_rates(t: Inputs):
    out = live.live_rates(t.events, F.col("value") > 10, by=["event_type"])
    return out.select(
        F.date_format("start", "yyyy-MM-dd").alias("day"),
        "event_type",
        "total",
        "hits",
        F.round("rate", 6).alias("rate"),
    )


@query("SELECT run_id, kind FROM fx_runs")
def dedupe_results(t: Inputs):
    return live.dedupe_results(t.fx_runs.union(t.fx_runs), ["run_id"]).select("run_id", "kind")


@query(
    """
, g AS (SELECT user_id, ts, CASE WHEN ts <= lag(ts) OVER w + INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS fresh FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
s AS (SELECT user_id, ts, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS n FROM g)
SELECT user_id, count(*) AS events, epoch_us(min(ts)) AS first_us, epoch_us(max(ts)) AS last_us FROM s GROUP BY user_id, n"""
)
def idle_sessions(t: Inputs):
    out = live.idle_sessions(t.events, ["user_id"])
    return out.select(
        "user_id",
        "events",
        F.unix_micros("first_event").alias("first_us"),
        F.unix_micros("last_event").alias("last_us"),
    )


@query("SELECT task_id, gen, CAST(length(completion) AS DOUBLE) / 10 AS reward FROM fx_completions")
def register_reward(t: Inputs):
    def brevity(completions, scale):
        return [len(c) / scale for c in completions]

    brevity_column = add_reward(t.spark, "brevity", brevity, scale=10)
    return t.fx_completions.select("task_id", "gen", brevity_column(F.col("completion")).alias("reward"))


@query("SELECT doc_id, lang, len(string_split(text, chr(10)))::BIGINT AS lines FROM documents")
def map_examples(t: Inputs):
    def count_lines(example):
        return {"lines": example["text"].count("\n") + 1}

    return run_formatter(
        t.documents.select("doc_id", "lang", "text"), count_lines, "doc_id bigint, lang string, lines bigint"
    )


@query(f"SELECT task_id, {PROMPT_SQL} AS prompt FROM fx_tasks")
def prompt_set(t: Inputs):
    return flows.repair_prompts(t.fx_tasks)


PAIR_TEXTS = f"""
SELECT p.task_id, k.prompt, c.completion AS chosen, r.completion AS rejected
FROM pairs p JOIN (SELECT task_id, {PROMPT_SQL} AS prompt FROM fx_tasks) k ON p.task_id = k.task_id
JOIN fx_completions c ON c.task_id = p.task_id AND c.gen = p.chosen_gen
JOIN fx_completions r ON r.task_id = p.task_id AND r.gen = p.rejected_gen"""


@query(
    PICKS
    + """, low AS (SELECT task_id, gen AS rejected_gen, reward AS rejected_reward FROM v_hybrid
  QUALIFY row_number() OVER (PARTITION BY task_id ORDER BY reward, gen) = 1),
pairs AS (SELECT task_id, chosen_gen, rejected_gen FROM top JOIN low USING (task_id) WHERE chosen_reward > rejected_reward)"""
    + PAIR_TEXTS
)
def preference_set(t: Inputs):
    return flows.preference_set(t.fx_tasks, t.fx_completions, scored(t))


@query(
    PICKS
    + """, pairs AS (SELECT h.task_id, chosen_gen, h.gen AS rejected_gen FROM v_hybrid h JOIN top USING (task_id)
  WHERE chosen_reward > h.reward)"""
    + PAIR_TEXTS
)
def preference_set_best_vs_rest(t: Inputs):
    return flows.preference_set(t.fx_tasks, t.fx_completions, scored(t), "best_vs_rest")
