import pytest
from pyspark.sql import functions as F

from patchloom.functions.rewards import combine_rewards, format_reward
from patchloom.operators import scoring as S
from patchloom.plans import flows
from tests.helpers import column, plan_of, tuples

GOOD = "```diff\n--- a/s.py\n+++ b/s.py\n-a\n+b\n```"
NUMPY = "```diff\n--- a/s.py\n+++ b/s.py\n-a\n+import numpy\n```"


@pytest.mark.parametrize(
    "patch, want",
    [
        (None, 0.0),
        ("", 0.1),
        ("--- a/x\n+++ b/x", 0.5),  # the headers themselves count as minus and plus
        ("-a\n+b", 0.1),
        ("--- a/x\n+++ b/x\n-a\n+b", 0.5),
        ("+only", 0.1),
        ("x --- +++\n-a\n+b", 0.5),
        (" -a\n +b --- +++", 0.1),
    ],
)
def test_format_reward(spark, patch, want):
    assert column(spark, [patch], format_reward) == [want]


def completions(spark):
    rows = [(1, 0, "none"), (1, 1, GOOD), (1, 2, NUMPY), (1, 3, GOOD), (2, 0, GOOD), (2, 1, NUMPY)]
    return spark.createDataFrame(rows, "task_id bigint, gen int, completion string")


def outcomes(spark):
    rows = [
        (1, 0, "PASS"),
        (1, 1, "FAIL: PASS_TO_PASS broken"),
        (1, 2, "PASS"),
        (1, 3, "FAIL"),
        (2, 1, "FAIL"),
    ]
    return spark.createDataFrame(rows, "task_id bigint, gen int, stdout string")


def rewards(df):
    return {(r.task_id, r.gen): r.reward for r in df.collect()}


def test_every_branch_of_the_harness_reward(spark):
    plain = rewards(S.score(completions(spark), outcomes(spark), "test"))
    assert plain == {
        (1, 0): 0.0,  # no patch wins over a passing log
        (1, 1): 1.0,  # "PASS" anywhere in the log
        (1, 2): 1.0,
        (1, 3): 0.0,
        (2, 0): 0.5,  # no log: the format reward
        (2, 1): 0.0,
    }
    strict = rewards(S.score(completions(spark), outcomes(spark), "test", stdlib_only=True))
    assert strict[(1, 2)] == -20.0 and strict[(2, 1)] == -20.0 and strict[(1, 1)] == 1.0
    no_task = S.score(completions(spark), outcomes(spark), "test", has_task=F.col("task_id") == 2)
    assert rewards(no_task)[(1, 1)] == 0.5
    assert rewards(S.score(completions(spark), None, "test"))[(1, 1)] == 0.5


def test_modes(spark):
    c, o = completions(spark), outcomes(spark)
    assert rewards(S.score(c, mode="format"))[(1, 1)] == 0.5
    assert rewards(S.score(c, o, "anything"))[(1, 1)] == pytest.approx(0.3 * 0.5 + 0.7)
    assert rewards(S.score(c, o, w_f=1.0, w_t=2.0))[(1, 3)] == pytest.approx(0.5)
    assert "Join" not in plan_of(S.score(c, mode="format"))


def test_repeated_logs_do_not_repeat_completions(spark):
    twice = outcomes(spark).union(spark.createDataFrame([(1, 3, "PASS")], outcomes(spark).schema))
    got = S.score(completions(spark), twice, "test")
    assert got.count() == 6 and rewards(got)[(1, 3)] == 1.0


def test_stripped_patch_goes_to_the_harness_only(spark):
    text = "```diff\n--- a/s\n+++ b/s\n-a\n+LIMIT = 3\n```"
    df = spark.createDataFrame([(1, 0, text)], "task_id bigint, gen int, completion string")
    row = S.with_patch(df, strip_globals=True).first()
    assert row.model_patch == "--- a/s\n+++ b/s\n-a" and "LIMIT" in row.patch and row.format_reward == 0.5


def test_combine_rewards(spark):
    df = spark.createDataFrame([(1.0, 2.0), (None, 3.0)], "a double, b double")
    cols = [F.col("a"), F.col("b")]
    assert [r[0] for r in df.select(combine_rewards(cols)).collect()] == [3.0, 3.0]
    assert [r[0] for r in df.select(combine_rewards(cols, [0.5, 2.0])).collect()] == [4.5, 6.0]
    with pytest.raises(ValueError):
        combine_rewards(cols, [1.0])


def test_advantages(spark):
    rows = [(1, 0, 1.0), (1, 1, 0.0), (2, 0, 0.5), (3, 0, 0.1), (3, 1, 0.1), (3, 2, 0.1)]
    df = spark.createDataFrame(rows, "task_id bigint, gen int, reward double")
    got = {(r.task_id, r.gen): r.advantage for r in S.group_advantage(df).collect()}
    spread = 0.5**0.5  # sample deviation of 1 and 0
    assert got[(1, 0)] == pytest.approx(0.5 / (spread + 1e-4))
    assert got[(2, 0)] == 0  # a group of one
    assert got[(3, 1)] == pytest.approx(0, abs=1e-9)
    none = {(r.task_id, r.gen): r.advantage for r in S.group_advantage(df, "none").collect()}
    assert none[(1, 1)] == -0.5
    import statistics

    whole = statistics.stdev([r[2] for r in rows])
    batch = {(r.task_id, r.gen): r.advantage for r in S.group_advantage(df, "batch").collect()}
    assert batch[(1, 0)] == pytest.approx(0.5 / (whole + 1e-4))
    with pytest.raises(ValueError):
        S.group_advantage(df, "other")


def test_picks_and_pairs(spark):
    rows = [(1, 0, 0.2), (1, 1, 0.9), (1, 2, 0.9), (1, 3, 0.1), (2, 0, 0.5), (2, 1, 0.5), (3, 0, 0.0)]
    df = spark.createDataFrame(rows, "task_id bigint, gen int, reward double")
    assert tuples(S.best_of_n(df, 0.3), "task_id", "gen") == [(1, 1), (2, 0)]
    pairs = S.preference_pairs(df)
    assert tuples(pairs, "task_id", "chosen_gen", "rejected_gen") == [(1, 1, 3)]
    rest = S.preference_pairs(df, "best_vs_rest")
    assert tuples(rest, "task_id", "chosen_gen", "rejected_gen") == [(1, 1, 0), (1, 1, 3)]
    brute = {}
    for t, _, r in rows:
        brute[t] = sum(r2 < r1 for t1, _, r1 in rows for t2, _, r2 in rows if t1 == t2 == t)
    assert dict(tuples(S.pair_counts(df), "task_id", "pairs")) == brute


def test_assign_tasks(spark):
    c = spark.createDataFrame([(t, g) for t in (10, 20, 30) for g in (0, 1)], "task_id bigint, gen int")
    tasks = spark.createDataFrame([(10, "a"), (20, "b"), (70_000, "c"), (140_000, "d")], "task_id bigint, name string")
    got = S.assign_tasks(c, tasks, "cyclic")
    order = sorted(got.collect(), key=lambda r: r.idx)
    assert [r.name for r in order] == ["a", "b", "c", "d", "a", "b"]
    assert [r.idx for r in order] == list(range(6))
    by_id = S.assign_tasks(c, tasks).collect()
    assert {(r.task_id, r.name) for r in by_id} == {(10, "a"), (20, "b"), (30, None)}
    with pytest.raises(ValueError):
        S.assign_tasks(c, tasks, "random")


def test_texts_stay_out_of_the_shuffles(spark):
    slim = S.score(completions(spark), outcomes(spark)).select("task_id", "gen", "reward")
    for line in plan_of(slim).splitlines():
        if "Exchange" in line:
            assert "completion" not in line and "stdout" not in line


def test_completions_without_a_reward_are_in_no_pair(spark):
    rows = [(1, 0, 0.5), (1, 1, 1.0), (1, 2, None), (2, 0, None)]
    scored = spark.createDataFrame(rows, "task_id int, gen int, reward double")
    for how in ("best_worst", "best_vs_rest"):
        assert tuples(S.preference_pairs(scored, how), "task_id", "chosen_gen", "rejected_gen") == [(1, 1, 0)]
    assert tuples(S.pair_counts(scored), "task_id", "pairs") == [(1, 1), (2, 0)]


def preferences(spark, how):
    """``preference_set`` over tables read from files, with repeated and null rows, and what it must give."""
    tasks = spark.createDataFrame([(1, "r", "p", "h"), (1, "r", "p", "h"), (2, "s", None, None), (None, "n", "n", "n")], "task_id bigint, repo string, problem_statement string, hints_text string")
    rewards = [(1, 0, 0.5), (1, 1, 1.0), (1, 2, 1.0), (1, 3, None), (1, 4, float("nan")), (1, 5, 0.1), (2, 0, 0.3), (2, 1, 0.3), (3, 0, 1.0), (3, 1, 0.0), (None, 0, 1.0), (None, 1, 0.0)]
    scored = spark.createDataFrame([*rewards, (1, 0, 0.5)], "task_id bigint, gen int, reward double")
    rows = [(t, g, f"{t}-{g}") for t, g, _ in rewards]
    texts = spark.createDataFrame([*rows, (1, 0, "1-0 again")], "task_id bigint, gen int, completion string")
    low = {"best_worst": ["1-5"], "best_vs_rest": ["1-0", "1-0", "1-0 again", "1-0 again", "1-5"]}[how]
    return flows.preference_set(tasks, texts, scored, how), sorted(("1-1", x) for x in low * 2)


@pytest.mark.parametrize("how", ["best_worst", "best_vs_rest"])
def test_preference_sets_broadcast_no_side(spark, how):
    got, want = preferences(spark, how)
    assert tuples(got, "chosen", "rejected") == want
    assert {r.task_id for r in got.collect()} == {1}
    assert "Broadcast" not in plan_of(got)


@pytest.mark.parametrize("how", ["best_worst", "best_vs_rest"])
def test_preference_sets_shuffle_no_rendered_prompt(spark, how):
    got, _ = preferences(spark, how)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Instructions") == 1 and plan.index("Instructions") < plan.index("Join")  # above every join
