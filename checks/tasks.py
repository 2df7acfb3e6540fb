"""Task validation, prompts, caps, combination, splits."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.registry import Inputs, query, view
from patchloom.functions import naming, prompt_texts as T, prompts
from patchloom.functions.patches import patch_files as files_of
from patchloom.operators import splits as X
from patchloom.operators import tasks as K
from patchloom.operators.scans import dense_index, seeded_rank as rank_of


def q(text: str) -> str:
    """A Python string as an SQL literal."""
    return "'" + text.replace("'", "''") + "'"


view(
    "v_counts",
    """
SELECT task_id,
  count(*) FILTER (WHERE base_pass AND NOT patched_pass) AS n_fail_to_pass,
  count(*) FILTER (WHERE base_pass AND patched_pass) AS n_pass_to_pass,
  count(*) FILTER (WHERE NOT base_pass AND NOT patched_pass) AS n_fail_to_fail,
  count(*) FILTER (WHERE NOT base_pass AND patched_pass) AS n_pass_to_fail
FROM fx_test_results GROUP BY task_id""",
)
view(
    "v_lists",
    """
SELECT task_id,
  coalesce(list_sort(list(test) FILTER (WHERE base_pass AND NOT patched_pass)), []) AS f2p,
  coalesce(list_sort(list(test) FILTER (WHERE base_pass AND patched_pass)), []) AS p2p,
  coalesce(list_sort(list(test) FILTER (WHERE NOT base_pass AND NOT patched_pass)), []) AS f2f,
  coalesce(list_sort(list(test) FILTER (WHERE NOT base_pass AND patched_pass)), []) AS p2f
FROM fx_test_results GROUP BY task_id""",
)
view(
    "v_valid",
    "SELECT task_id, f2p, p2p FROM v_lists WHERE len(f2p) >= 1 AND len(p2p) >= 1",
)
view("v_order", "SELECT *, row_number() OVER (ORDER BY md5(concat('42:', task_id))) AS pos FROM fx_tasks")


@query("SELECT * FROM v_counts")
def test_transitions(t: Inputs):
    return K.test_transitions(t.fx_test_results)


@query(
    "SELECT task_id, len(f2p) AS n_fail_to_pass, len(p2p) AS n_pass_to_pass, len(f2f) AS n_fail_to_fail, "
    "len(p2f) AS n_pass_to_fail, array_to_string(f2p, '|') AS fail_to_pass, array_to_string(p2p, '|') AS pass_to_pass, "
    "array_to_string(f2f, '|') AS fail_to_fail, array_to_string(p2f, '|') AS pass_to_fail FROM v_lists"
)
def transition_lists(t: Inputs):
    out = K.transition_lists(t.fx_test_results)
    return out.withColumns({c: F.array_join(c, "|") for c in K.TRANSITIONS})


@query("SELECT * FROM v_counts WHERE n_fail_to_pass >= 1 AND n_pass_to_pass >= 1")
def valid_tasks(t: Inputs):
    return K.valid_tasks(K.test_transitions(t.fx_test_results))


@query(
    "SELECT k.task_id, k.instance_id, array_to_string(f2p, '|') AS f2p, array_to_string(p2p, '|') AS p2p "
    "FROM fx_tasks k JOIN v_valid v ON k.task_id = v.task_id"
)
def task_instances(t: Inputs):
    return K.task_instances(t.fx_tasks, t.fx_test_results).select(
        "task_id",
        "instance_id",
        F.array_join("FAIL_TO_PASS", "|").alias("f2p"),
        F.array_join("PASS_TO_PASS", "|").alias("p2p"),
    )


view(
    "v_files",
    """
SELECT task_id, list_transform(list_filter(string_split(patch, chr(10)), lambda l: starts_with(l, 'diff --git')),
  lambda l: list_last(string_split(l, ' b/'))) AS files FROM fx_tasks""",
)


@query("SELECT task_id, array_to_string(files, '|') AS files, len(files)::BIGINT AS n FROM v_files")
def patch_files(t: Inputs):
    files = files_of(F.col("patch"))
    return t.fx_tasks.select(
        "task_id", F.array_join(files, "|").alias("files"), F.size(files).cast("bigint").alias("n")
    )


view(
    "v_filled",
    f"""
SELECT k.task_id, k.repo, k.hints_text,
  CASE WHEN coalesce(trim(k.problem_statement, concat(' ', chr(10), chr(9), chr(13))), '') <> '' THEN k.problem_statement
  ELSE concat({q(T.STATEMENT_HEAD)}, CASE WHEN len(files) > 0 THEN array_to_string(files, ', ') ELSE {q(T.UNKNOWN_FILES)} END,
    {q(T.STATEMENT_TESTS)},
    CASE WHEN len(coalesce(v.f2p, [])) > 0 THEN array_to_string(list_transform(v.f2p, lambda t: concat('- ', t)), chr(10))
      ELSE {q(T.UNKNOWN_TESTS)} END, {q(T.STATEMENT_TAIL)}) END AS problem_statement
FROM fx_tasks k JOIN v_files USING (task_id) LEFT JOIN v_lists v ON k.task_id = v.task_id""",
)


def filled(t: Inputs):
    lists = K.transition_lists(t.fx_test_results).select("task_id", F.col("fail_to_pass").alias("FAIL_TO_PASS"))
    return prompts.fill_problem_statement(t.fx_tasks.join(lists, "task_id", "left"))


@query("SELECT task_id, problem_statement FROM v_filled")
def fill_problem_statement(t: Inputs):
    return filled(t).select("task_id", "problem_statement")


PROMPT_SQL = f"""concat({q(T.REPAIR_HEAD)}, repo, {q(T.REPAIR_PROBLEM)}, coalesce(problem_statement, ''), chr(10),
  CASE WHEN coalesce(hints_text, '') <> '' THEN concat({q(T.REPAIR_HINTS)}, hints_text, chr(10)) ELSE '' END,
  {q(T.REPAIR_TAIL)})"""


@query(f"SELECT task_id, {PROMPT_SQL} AS prompt FROM fx_tasks")
def render_repair_prompt(t: Inputs):
    return prompts.render_repair_prompt(t.fx_tasks).select("task_id", "prompt")


NAME_PART = r"regexp_extract(repo, '^([^/]+)/(.+?)__(.+)\.([^.]+)$', {})"


@query(
    f"""
, n AS (SELECT task_id, {NAME_PART.format(1)} AS o, {NAME_PART.format(3)} AS r, {NAME_PART.format(4)} AS c FROM fx_tasks)
SELECT task_id, concat(o, '__', r) AS repo_key, concat(o, '/', o, '__', r, '.', left(concat(c, 'cafe'), 8)) AS mirror_name,
  concat('swesmith.x86_64.', o, '__', r, '.', c, 'cafe') AS image_name FROM n"""
)
def task_keys(t: Inputs):
    parts = naming.parse_repo(F.col("repo"))
    commit = F.concat(parts["commit"], F.lit("cafe"))
    return t.fx_tasks.withColumns(naming.task_keys(parts["owner"], parts["repo_name"], commit)).select(
        "task_id", "repo_key", "mirror_name", "image_name"
    )


@query(
    f"SELECT task_id, {NAME_PART.format(1)} AS owner, {NAME_PART.format(3)} AS repo_name, "
    f"{NAME_PART.format(4)} AS commit FROM fx_tasks"
)
def parse_repo(t: Inputs):
    return t.fx_tasks.withColumns(naming.parse_repo(F.col("repo"))).select(
        "task_id", "owner", "repo_name", "commit"
    )


def shuffled_sql(items: list[str], kind: str, count: int) -> str:
    rows = ", ".join(
        f"{{'h': md5(concat('42:', func_id, ':{kind}:{i}')), 'x': {q(x)}}}" for i, x in enumerate(items)
    )
    picked = f"list_sort([{rows}])[1:{count}]"
    return f"array_to_string(list_transform({picked}, lambda s: concat(chr(10), '- ', s.x)), '')"


def instance_sql(template: str) -> str:
    head, tail = template.split("{src_code}")
    return f"concat({q(head)}, src_code, {q(tail)})"


@query(
    f"""
SELECT func_id, concat({q(T.MODIFY_HEAD)}, {shuffled_sql(T.BUG_EXAMPLES, 'example', 3)}, {q(T.MODIFY_TIPS)},
  {shuffled_sql(T.TIPS, 'tip', 7)}, {q(T.MODIFY_TAIL)}) AS system_prompt,
  {instance_sql(T.FUNCTION_INSTANCE)} AS instance_prompt FROM fx_functions"""
)
def render_buggen_prompts(t: Inputs):
    return prompts.render_buggen_prompts(t.fx_functions, "lm_modify").select(
        "func_id", "system_prompt", "instance_prompt"
    )


@query(
    f"""
SELECT func_id, {q(T.CLASS_SYSTEM)} AS system_prompt, {instance_sql(T.CLASS_INSTANCE)} AS instance_prompt, 'class_basic' AS strategy FROM fx_functions
UNION ALL
SELECT func_id, {q(T.TIRED_SYSTEM)}, {instance_sql(T.FUNCTION_INSTANCE)}, 'func_fun' FROM fx_functions
UNION ALL
SELECT func_id, {q(T.REWRITE_SYSTEM)}, replace(replace(replace({q(T.REWRITE_INSTANCE)},
  '{{func_signature}}', concat('f', func_id)), '{{file_src_code}}', src_code), '{{func_to_write}}', src_code), 'lm_rewrite' FROM fx_functions"""
)
def render_fixed_buggen_prompts(t: Inputs):
    functions = t.fx_functions.withColumns(
        {
            "func_signature": F.concat(F.lit("f"), F.col("func_id").cast("string")),
            "file_src_code": F.col("src_code"),
            "func_to_write": F.col("src_code"),
        }
    )
    outs = [
        prompts.render_buggen_prompts(functions, s)
        .select("func_id", "system_prompt", "instance_prompt")
        .withColumn("strategy", F.lit(s))
        for s in ("class_basic", "func_fun", "lm_rewrite")
    ]
    return outs[0].unionByName(outs[1]).unionByName(outs[2])


ANSWERS = """
SELECT func_id, src_code, CASE func_id % 3 WHEN 0 THEN 'I cannot do that.'
  WHEN 1 THEN concat('Explanation:', chr(10), 'Sign of ', func_id, ' flipped. ', chr(10), chr(10), 'Bugged Code:', chr(10), '```', chr(10), src_code, chr(10), '```')
  ELSE concat('Sure. Explanation: off by one', chr(10), 'Bugged Code:', chr(10), '```python', chr(10), src_code, chr(10), '```', chr(10), 'bye') END AS answer
FROM fx_functions"""
view("v_answers", ANSWERS)
ANSWER = r"'(?s)Explanation:\s*(.*?)\s*Bugged Code:\s*```\w*\n(.*?)```'"


@query(
    f"""SELECT func_id,
  CASE WHEN regexp_matches(answer, {ANSWER}) THEN regexp_extract(answer, {ANSWER}, 1) END AS explanation,
  CASE WHEN regexp_matches(answer, {ANSWER}) THEN regexp_extract(answer, {ANSWER}, 2) END AS bugged_code FROM v_answers"""
)
def parse_bug_answer(t: Inputs):
    key = F.col("func_id")
    answers = t.fx_functions.withColumn(
        "answer",
        F.when(key % 3 == 0, "I cannot do that.")
        .when(
            key % 3 == 1,
            F.format_string("Explanation:\nSign of %d flipped. \n\nBugged Code:\n```\n%s\n```", key, "src_code"),
        )
        .otherwise(
            F.format_string("Sure. Explanation: off by one\nBugged Code:\n```python\n%s\n```\nbye", "src_code")
        ),
    )
    return answers.withColumns(prompts.parse_bug_answer(F.col("answer"))).select(
        "func_id", "explanation", "bugged_code"
    )


CAPS = "CASE {} WHEN 'lm_modify' THEN 400 WHEN 'class_basic' THEN 200 WHEN 'func_fun' THEN 200 WHEN 'lm_rewrite' THEN 300 WHEN 'procedural' THEN 1000 END"


@query(f"SELECT task_id, strategy, CAST({CAPS.format('strategy')} AS BIGINT) AS cap FROM fx_tasks")
def with_limits(t: Inputs):
    return K.with_limits(t.fx_tasks).select("task_id", "strategy", "cap")


@query(
    f"""
, one AS (SELECT task_id, strategy, func_id FROM fx_tasks
  QUALIFY row_number() OVER (PARTITION BY strategy, func_id ORDER BY task_id) <= CASE strategy WHEN 'lm_rewrite' THEN 1 ELSE 2 END)
SELECT task_id, strategy, func_id FROM one
QUALIFY row_number() OVER (PARTITION BY strategy ORDER BY task_id) <= {CAPS.format('strategy')}"""
)
def cap_candidates(t: Inputs):
    return K.cap_candidates(t.fx_tasks, 2).select("task_id", "strategy", "func_id")


@query(
    """SELECT run_id, kind, CASE kind WHEN 'baseline' THEN 1500.0::DOUBLE ELSE 400.0::DOUBLE END AS time_limit,
CASE WHEN seconds <= CASE kind WHEN 'baseline' THEN 1500 ELSE 400 END THEN 'completed' ELSE 'timeout' END AS status FROM fx_runs"""
)
def classify_runs(t: Inputs):
    # limits scaled to the data, whose values are far below the default limits
    return K.classify_runs(t.fx_runs, {"baseline": 1500, "patched": 400}).select(
        "run_id", "kind", "time_limit", "status"
    )


@query(
    """
, good AS (SELECT k.task_id, k.repo, k.instance_id, k.patch, f.files, v.f2p FROM fx_tasks k
  JOIN v_files f USING (task_id) JOIN v_valid v ON k.task_id = v.task_id),
placed AS (SELECT *, row_number() OVER (PARTITION BY repo ORDER BY md5(concat('42:', instance_id)), instance_id) AS p FROM good),
pairs AS (SELECT repo, (p - 1) // 2 AS combo, list(instance_id ORDER BY p) AS ids, list(patch ORDER BY p) AS patches,
    flatten(list(list_distinct(files) ORDER BY p)) AS files, list_sort(list_distinct(flatten(list(f2p)))) AS tests
  FROM placed GROUP BY ALL)
SELECT repo, array_to_string(ids, '+') AS instance_id, array_to_string(patches, chr(10)) AS patch, array_to_string(tests, '|') AS tests
FROM pairs WHERE len(ids) = 2 AND len(list_distinct(files)) = len(files)""".replace("GROUP BY ALL", "GROUP BY repo, (p - 1) // 2")
)
def combine_bugs(t: Inputs):
    out = K.combine_bugs(K.task_instances(t.fx_tasks, t.fx_test_results))
    return out.select("repo", "instance_id", "patch", F.array_join("FAIL_TO_PASS", "|").alias("tests"))


@query(
    "SELECT repo, count(*) AS bugs, 0::BIGINT AS twice, 0::BIGINT AS sharing "
    "FROM fx_tasks k JOIN v_valid v ON k.task_id = v.task_id GROUP BY repo"
)
def matched_bugs(t: Inputs):
    """Bugs of each repository, and what no pair may be: of one bug with two others, or of shared files."""
    tasks = K.task_instances(t.fx_tasks, t.fx_test_results)
    pairs = K.match_bugs(tasks)
    both = files_of(F.col("patch"))
    sharing = F.count_if(F.size(both) > F.size(F.array_distinct(both)))
    used = pairs.select("repo", F.explode("members").alias("m")).groupBy("repo", "m").agg(F.count("*").alias("n"))
    twice = used.groupBy("repo").agg(F.count_if(F.col("n") > 1).alias("twice"))
    bugs = tasks.groupBy("repo").agg(F.count("*").alias("bugs"))
    return bugs.join(twice, "repo", "left").join(pairs.groupBy("repo").agg(sharing.alias("sharing")), "repo", "left")


@query(
    "SELECT c.task_id, c.gen, c.shape FROM fx_completions c "
    "ANTI JOIN fx_outcomes o ON c.task_id = o.task_id AND c.gen = o.gen"
)
def pending(t: Inputs):
    return K.pending(t.fx_completions, t.fx_outcomes, ["task_id", "gen"]).select("task_id", "gen", "shape")


@query(
    """SELECT task_id, gen, CAST(floor(((pos - 1) * 4 + gen) / 6) AS BIGINT) AS batch
FROM (SELECT task_id, pos, unnest([0, 1, 2, 3]) AS gen FROM v_order)"""
)
def assign_batches(t: Inputs):
    return K.assign_batches(t.fx_tasks, 6, 4).select("task_id", "gen", "batch")


@query("SELECT task_id, CAST(pos AS BIGINT) AS pos FROM v_order")
def seeded_order(t: Inputs):
    ordered = X.seeded_order(t.fx_tasks.select("task_id"), ["task_id"])
    # the place of a row in the sorted output, counted over ranges
    placed = dense_index(ordered.withColumn("_at", F.monotonically_increasing_id()), ["_at"], out="pos")
    return placed.select("task_id", (F.col("pos") + 1).alias("pos"))


@query("SELECT task_id, CAST(pos AS BIGINT) AS pos FROM v_order")
def seeded_rank(t: Inputs):
    return rank_of(t.fx_tasks, ["task_id"]).select("task_id", "pos")


SPLIT = "SELECT task_id, CASE WHEN pos <= 200 THEN 'train' WHEN pos <= 250 THEN 'val' ELSE 'test' END AS split FROM v_order WHERE pos <= 350"


@query(SPLIT)
def split_exact(t: Inputs):
    return X.split_exact(t.fx_tasks, ["task_id"]).select("task_id", "split")


# more rows asked for than there are at the smaller scales
@query(
    """, n AS (SELECT count(*) AS n FROM fx_tasks),
a AS (SELECT n, n < 1000000 AS short, n / 1000000 AS ratio FROM n),
b AS (SELECT *, CASE WHEN short THEN greatest(1, floor(600000 * ratio)) ELSE 600000 END AS tr,
  CASE WHEN short THEN greatest(1, floor(150000 * ratio)) ELSE 150000 END AS va FROM a),
s AS (SELECT *, CASE WHEN short THEN greatest(1, n - tr - va) ELSE 250000 END AS te FROM b)
SELECT task_id, CASE WHEN pos <= tr THEN 'train' WHEN pos <= tr + va THEN 'val' ELSE 'test' END AS split
FROM v_order JOIN s ON true WHERE pos <= tr + va + te"""
)
def split_exact_short(t: Inputs):
    return X.split_exact(t.fx_tasks, ["task_id"], 600_000, 150_000, 250_000).select("task_id", "split")


@query(f", s AS ({SPLIT}) SELECT task_id, instance_id FROM fx_tasks WHERE task_id NOT IN (SELECT task_id FROM s)")
def unused(t: Inputs):
    return X.unused(t.fx_tasks, X.split_exact(t.fx_tasks, ["task_id"])).select("task_id", "instance_id")
