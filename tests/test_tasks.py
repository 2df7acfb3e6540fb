import pytest
from pyspark.sql import functions as F

from patchloom.operators import tasks as K
from tests.helpers import plan_of, tuples


def results(spark):
    rows = [
        (1, "t2", True, False), (1, "t1", True, False), (1, "t3", True, True),
        (2, "t1", True, True), (2, "t2", False, True),
        (3, "t1", True, False), (3, "t2", False, False),
        (4, "t1", True, None), (4, "t2", True, True), (4, "t3", None, True),
    ]
    return spark.createDataFrame(rows, "task_id int, test string, base_pass boolean, patched_pass boolean")


def test_transitions(spark):
    counts = K.test_transitions(results(spark))
    cols = [f"n_{t}" for t in K.TRANSITIONS]
    assert tuples(counts, "task_id", *cols) == [
        (1, 2, 1, 0, 0), (2, 0, 1, 0, 1), (3, 1, 0, 1, 0), (4, 1, 1, 0, 1),
    ]
    assert tuples(K.valid_tasks(counts), "task_id") == [(1,), (4,)]
    assert tuples(K.valid_tasks(counts, min_f2p=2), "task_id") == [(1,)]
    assert tuples(K.valid_tasks(counts, min_p2p=0), "task_id") == [(1,), (3,), (4,)]


def test_one_row_of_lists_per_task_at_every_size(spark):
    lists = {r.task_id: r for r in K.transition_lists(results(spark)).collect()}
    assert lists[1].fail_to_pass == ["t1", "t2"] and lists[1].pass_to_pass == ["t3"] and len(lists) == 4
    big = spark.range(25_000).selectExpr("1 AS task_id", "concat('t', id) AS test", "true AS base_pass", "id % 2 = 0 AS patched_pass")
    (row,) = K.transition_lists(big).collect()
    assert row.fail_to_pass == sorted(f"t{i}" for i in range(1, 25_000, 2)) and row.n_fail_to_pass == 12_500
    task = spark.createDataFrame([(1, "i", "r", None), (2, "j", "r", None)], "task_id int, instance_id string, repo string, patch string")
    assert K.combine_bugs(K.task_instances(task, big)).count() == 0


def test_bugs_without_a_repository_are_combined(spark):
    rows = [(f"i{i}", None, f"diff --git a/f{i} b/f{i}", ["t"]) for i in range(4)]
    tasks = spark.createDataFrame(rows, "instance_id string, repo string, patch string, FAIL_TO_PASS array<string>")
    assert K.combine_bugs(tasks, 2).count() == 2


def test_task_instances(spark):
    tasks = spark.createDataFrame([(i, f"i{i}") for i in range(1, 6)], "task_id int, instance_id string")
    got = K.task_instances(tasks, results(spark))
    assert tuples(got, "instance_id", "FAIL_TO_PASS") == [("i1", ["t1", "t2"]), ("i4", ["t1"])]


def candidates(spark):
    rows = []
    for s in ("lm_modify", "lm_rewrite", "custom"):
        for f in range(6):
            rows += [(len(rows) + v, s, f) for v in range(3)]
    return spark.createDataFrame(rows, "task_id int, strategy string, func_id int")


def test_cap_candidates(spark):
    got = K.cap_candidates(candidates(spark), 2, {"lm_modify": 5, "lm_rewrite": 4})
    ids = {}
    for r in got.collect():
        ids.setdefault(r.strategy, []).append((r.func_id, r.task_id))
    assert [f for f, _ in sorted(ids["lm_modify"])] == [0, 0, 1, 1, 2]
    assert [f for f, _ in sorted(ids["lm_rewrite"])] == [0, 1, 2, 3]  # one per function
    assert len(ids["custom"]) == 12  # no cap set: only the function limit
    assert sorted(ids["lm_modify"]) == [(0, 0), (0, 1), (1, 3), (1, 4), (2, 6)]


def test_caps_cut_rows_before_the_shuffle(spark):
    plan = plan_of(K.cap_candidates(candidates(spark)))
    assert plan.count("WindowGroupLimit") >= 2


def test_with_limits(spark):
    df = candidates(spark)
    got = {(r.strategy, r.cap) for r in K.with_limits(df, {"lm_modify": 7}).collect()}
    assert got == {("lm_modify", 7), ("lm_rewrite", None), ("custom", None)}
    table = spark.createDataFrame([("custom", 3)], "strategy string, cap bigint")
    got = {(r.strategy, r.cap) for r in K.with_limits(df, table).collect()}
    assert got == {("lm_modify", None), ("lm_rewrite", None), ("custom", 3)}


@pytest.mark.parametrize("timeout", [None, 0, 100])
def test_classify_runs(spark, timeout):
    limit = timeout or 180
    rows = [
        ("baseline", 7200.0, "completed"), ("baseline", 7200.1, "timeout"),
        ("patched", 1800.0, "completed"), ("patched", 9000.0, "timeout"),
        ("evaluation", 240.5, "timeout"), ("reward", float(limit), "completed"),
        ("reward", limit + 60.0, "timeout"), ("reward", limit + 60.5, "killed"),
        ("odd", 1.0, "unlimited"),
    ]
    df = spark.createDataFrame(rows, "kind string, seconds double, want string")
    got = K.classify_runs(df, reward_timeout=timeout).collect()
    assert [r.status for r in got] == [r.want for r in got]


def test_combine_bugs(spark):
    def patch(f):
        return f"diff --git a/{f} b/{f}\n+x"

    rows = [("r1", f"r1.{i}", patch(f"f{i}"), [f"t{i}", "t"]) for i in range(5)]
    rows += [("r2", f"r2.{i}", patch("same"), ["t"]) for i in range(4)]
    df = spark.createDataFrame(
        rows, "repo string, instance_id string, patch string, FAIL_TO_PASS array<string>"
    )
    got = K.combine_bugs(df, 2).collect()
    assert {r.repo for r in got} == {"r1"} and len(got) == 2  # r2's bugs share a file; r1 has one left over
    for r in got:
        a, b = (m.split(".")[1] for m in r.members)
        assert sorted(r.FAIL_TO_PASS) == sorted({"t", f"t{a}", f"t{b}"})
        assert r.patch == patch(f"f{a}") + "\n" + patch(f"f{b}")
    used = [m for r in got for m in r.members]
    assert len(set(used)) == 4
    again = K.combine_bugs(df.repartition(9), 2).collect()
    assert sorted(r.instance_id for r in again) == sorted(r.instance_id for r in got)
    assert {len(r.members) for r in K.combine_bugs(df, 3).collect()} == {3}


def test_pending(spark):
    tasks = spark.range(5).withColumnRenamed("id", "task_id")
    done = spark.createDataFrame([(1,), (1,), (3,)], "task_id bigint")
    assert tuples(K.pending(tasks, done), "task_id") == [(0,), (2,), (4,)]


@pytest.mark.parametrize("parts", [1, 4, 16])
def test_assign_batches(spark, parts):
    df = spark.range(10).withColumnRenamed("id", "task_id").repartition(parts)
    got = K.assign_batches(df, 8, 4).collect()
    assert len(got) == 40
    sizes = {}
    for r in got:
        sizes.setdefault(r.batch, []).append(r.task_id)
    assert {b: len(x) for b, x in sizes.items()} == {b: 8 for b in range(5)}
    assert all(len(set(x)) == 2 for x in sizes.values())
