import random
import statistics

import pytest
from pyspark.sql import functions as F

from patchloom.operators import reports as R
from patchloom.operators import trials as D
from patchloom.operators.scans import exact_median, running
from tests.helpers import plan_of, tuples

METRICS = "trial int, step bigint, eval_loss double"


def series(spark, **runs):
    rows = [(int(k[1:]), i + 1, v) for k, vs in runs.items() for i, v in enumerate(vs)]
    return spark.createDataFrame(rows, METRICS).repartition(4)


def stops(df):
    return dict(tuples(df, "trial", "stop_step"))


def test_early_stop_by_hand(spark):
    df = series(
        spark,
        t1=[5.0, 4.0, 4.0, 4.5, 3.0, 3.0],  # two idle at step 4
        t2=[5.0, 4.0, 3.0, 2.0],  # always better
        t3=[None, None, None],  # nothing ever improves
        t4=[5.0, float("inf"), float("nan"), 1.0],
        t5=[1.0],
    )
    assert stops(D.early_stop(df, 2)) == {1: 4, 3: 2, 4: 3}
    assert stops(D.early_stop(df, 3)) == {3: 3}
    assert stops(D.early_stop(df, 1, 1.5)) == {1: 2, 2: 2, 3: 1, 4: 2}


def stop_in_python(values, patience, threshold):
    best, idle = None, 0
    for i, v in enumerate(values):
        good = v is not None
        if good and (best is None or v < best - threshold):
            idle = 0
        else:
            idle += 1
        if good:
            best = v if best is None else min(best, v)
        if idle >= patience:
            return i + 1
    return None


@pytest.mark.parametrize("patience, threshold", [(3, 0.0), (6, 0.2)])
def test_early_stop_over_many_blocks(spark, patience, threshold):
    rnd = random.Random(patience)
    runs = {
        f"t{k}": [None if rnd.random() < 0.1 else round(10 / (i + 1) + rnd.random(), 3) for i in range(n)]
        for k, n in enumerate([3, 60, 17, 200])
    }
    want = {int(k[1:]): stop_in_python(v, patience, threshold) for k, v in runs.items()}
    assert stops(D.early_stop(series(spark, **runs), patience, threshold)) == {k: v for k, v in want.items() if v}


def test_best_trial(spark):
    rows = [(4, 0.5), (2, 0.5), (1, None), (0, float("inf")), (3, float("nan")), (5, 0.7)]
    df = spark.createDataFrame(rows, "trial int, eval_loss double")
    assert tuples(D.best_trial(df), "trial", "eval_loss") == [(2, 0.5)]
    assert D.best_trial(df.where("eval_loss is null")).count() == 0


def test_param_effects(spark):
    rnd = random.Random(0)
    rows = [(i, rnd.random() if i % 7 else None, {"lr": str(i % 2), "rank": str(i % 5)}) for i in range(200)]
    df = spark.createDataFrame(rows, "trial int, eval_loss double, params map<string,string>")
    for r in D.param_effects(df).collect():
        seen = [v for _, v, p in rows if v is not None and p[r.param] == r["value"]]
        assert (r.trials, r.min_loss) == (len(seen), min(seen))
        assert r.median_loss == pytest.approx(statistics.median(seen))
        assert r.mean_loss == pytest.approx(statistics.mean(seen))


def test_checkpoints(spark):
    df = series(spark, t1=[3.0, 1.0, 1.0, None], t2=[None, 2.0, 5.0, 0.5])
    assert tuples(D.best_checkpoint(df), "trial", "step") == [(1, 2), (2, 4)]
    long = series(spark, t1=[1.0] * 260, t2=[1.0] * 120)
    kept = D.retain_checkpoints(long)
    assert tuples(kept, "trial", "step") == [(1, 150), (1, 200), (1, 250), (2, 50), (2, 100)]
    assert D.retain_checkpoints(long, None).count() == 7
    assert "WindowGroupLimit" in plan_of(kept)


def test_median_prune(spark):
    rnd = random.Random(9)
    runs = {f"t{k}": [rnd.random() * 5 for _ in range(n)] for k, n in enumerate([9, 12, 12, 7, 3, 12])}
    runs["t6"] = [None] * 12
    best = {k: [min(vs[: i + 1]) for i in range(len(vs))] for k, vs in runs.items() if k != "t6"}
    want = {}
    for k, vs in best.items():
        for i, b in enumerate(vs):
            if i + 1 > 2 and b > statistics.median(o[i] for o in best.values() if len(o) > i):
                want[int(k[1:])] = i + 1
                break
    assert dict(tuples(D.median_prune(series(spark, **runs), 2), "trial", "prune_step")) == want


def test_within_budget(spark):
    rows = [("a", i, i, 1 + i % 4) for i in range(40)] + [("b", 0, 100, 7)]
    df = spark.createDataFrame(rows, "run string, ts int, run_id int, cost int").repartition(3)
    assert D.within_budget(df, 10).count() == 11
    block = F.floor(F.col("ts") / 6)
    got = tuples(D.within_budget(df, 30, cost="cost", block=block), "run", "ts")
    want, spent = [("b", 0)], 0
    for run, ts, _, cost in rows[:40]:
        spent += cost
        if spent <= 30:
            want.append((run, ts))
    assert got == sorted(want)


def test_reports(spark):
    df = spark.createDataFrame([(True,), (False,), (None,)], "resolved boolean")
    assert R.resolve_rate(df).first().rate == "1/3"
    assert R.resolve_rate(df.where("false")).first().rate == "0/0"
    funnel = R.stage_funnel({"a": df, "b": df.where("resolved"), "c": df.where("false")})
    assert tuples(funnel, "stage", "rows") == [("a", 3), ("b", 1), ("c", 0)]


def test_conditions(spark):
    rows = [
        (1, "baseline", False, "r"), (1, "skills", True, "r"), (2, "baseline", True, "r"), (2, "skills", None, "r"),
        (3, "baseline", True, "q"), (3, "skills", True, "q"), (4, "baseline", False, "q"), (4, "skills", False, "q"),
        (5, "skills", True, "q"),
    ]
    df = spark.createDataFrame(rows, "task_id int, cond string, resolved boolean, repo string")
    assert dict(tuples(R.compare_conditions(df), "task_id", "change")) == {
        1: "fixed", 2: "regressed", 3: "both", 4: "neither", 5: "unpaired",
    }
    lift = {r.repo: r for r in R.skill_lift(df).collect()}
    assert lift["r"].lift == 0 and lift["q"].skills_rate == pytest.approx(2 / 3)
    assert lift[None].is_total == 1 and lift[None].baseline_rate == 0.5
    best = R.best_candidate(df.withColumn("score", F.coalesce("resolved", F.lit(False)).cast("double"))).first()
    assert (best.cond, best.evals) == ("skills", 5)


def test_cost_summary(spark):
    rows = [("gen", "m1", 1.0), ("gen", "m2", 2.0), ("eval", "m1", 4.0)]
    df = spark.createDataFrame(rows, "stage string, model string, cost double")
    got = {(r.stage, r.model): r.cost for r in R.cost_summary(df).collect()}
    assert got == {("gen", "m1"): 1, ("gen", "m2"): 2, ("gen", None): 3, ("eval", "m1"): 4, ("eval", None): 4, (None, None): 7}


def test_a_null_key_is_a_key_like_any_other(spark):
    rows = [(run, hour, 10.0) for run in ("a", None) for hour in range(6)]
    costs = spark.createDataFrame(rows, "run string, at int, cost double")
    out = running(costs, ["run"], ["at"], F.col("at"), {"total": ("sum", F.col("cost"))})
    got = {(r.run, r.at): r.total for r in out.collect()}
    assert got == {(run, at): 10.0 * (at + 1) for run in ("a", None) for at in range(6)}
    values = spark.createDataFrame([(k, float(v)) for k in ("a", None) for v in range(5)], "k string, v double")
    assert {r.k: r.median for r in exact_median(values, ["k"], "v").collect()} == {"a": 2.0, None: 2.0}
    trials = spark.createDataFrame([(1, {"sched": None, "lr": "1"}, 0.5)], "trial int, params map<string,string>, eval_loss double")
    assert tuples(D.param_effects(trials), "param", "value", "median_loss") in ([("lr", "1", 0.5), ("sched", None, 0.5)],)
