"""Block-wise ranks, running values and medians against plain Python."""

import hashlib
import random
import statistics

import pytest
from pyspark.sql import functions as F

from patchloom.operators.scans import dense_index, exact_median, fits_broadcast, lookup_join, running, seeded_rank
from tests.helpers import plan_of


def md5(x):
    return hashlib.md5(f"42:{x}".encode()).hexdigest()


@pytest.mark.parametrize("parts", [1, 4, 16])
@pytest.mark.parametrize("digits", [1, 4])
def test_seeded_rank(spark, parts, digits):
    df = spark.range(1000).repartition(parts)
    got = {r.id: (r.pos, r.n) for r in seeded_rank(df, ["id"], total="n", digits=digits).collect()}
    want = {x: (i + 1, 1000) for i, x in enumerate(sorted(range(1000), key=md5))}
    assert got == want


def test_seeded_rank_first_and_within(spark):
    # one group holds most of the rows
    df = spark.range(900).withColumn("g", F.when(F.col("id") % 10 == 0, F.col("id") % 3).otherwise(7))
    got = seeded_rank(df, ["id"], within=["g"], first=5, digits=2).collect()
    want = {}
    for g in (0, 1, 2, 7):
        members = [r.id for r in df.where(F.col("g") == g).collect()]
        want.update({(g, x): i + 1 for i, x in enumerate(sorted(members, key=md5)[:5])})
    assert {(r.g, r.id): r.pos for r in got} == want


def test_first_filters_before_the_shuffle(spark):
    ranked = seeded_rank(spark.range(1000), ["id"], first=10)
    assert sorted(r.pos for r in ranked.collect()) == list(range(1, 11))
    plan = plan_of(ranked)
    assert "BroadcastHashJoin" in plan


@pytest.mark.parametrize("inclusive", [True, False])
def test_running(spark, inclusive):
    rnd = random.Random(5)
    rows = [(k, i, rnd.choice([None, rnd.randint(-50, 50)])) for k, n in (("hot", 400), ("b", 3), ("c", 1)) for i in range(n)]
    df = spark.createDataFrame(rows, "k string, i int, v int").repartition(5)
    out = running(
        df, ["k"], ["i"], F.floor(F.col("i") / 16),
        {"s": ("sum", F.col("v")), "lo": ("min", F.col("v")), "hi": ("max", F.col("v"))},
        inclusive=inclusive,
    )
    got = {(r.k, r.i): (r.s, r.lo, r.hi) for r in out.collect()}
    for k, i, _ in rows:
        seen = [v for kk, j, v in rows if kk == k and (j <= i if inclusive else j < i) and v is not None]
        assert got[(k, i)] == (sum(seen), min(seen, default=None), max(seen, default=None))


def test_dense_index(spark):
    ids = random.Random(1).sample(range(100_000), 300)
    df = spark.createDataFrame([(i,) for i in ids], "id bigint")
    got = {r.id: r.idx for r in dense_index(df, ["id"], F.floor(F.col("id") / 1000)).collect()}
    assert got == {x: i for i, x in enumerate(sorted(ids))}


@pytest.mark.parametrize("cuts", [4, 64])
def test_exact_median(spark, cuts):
    rnd = random.Random(3)
    groups = {
        "hot": [rnd.gauss(0, 1) for _ in range(2001)],
        "even": [rnd.gauss(5, 2) for _ in range(500)],
        "ties": [1.0] * 700 + [2.0] * 700,
        "same": [3.5] * 100,
        "one": [9.0],
        "two": [1.0, 4.0],
    }
    rows = [(k, v) for k, vs in groups.items() for v in vs] + [("hot", None), ("nulls", None)]
    df = spark.createDataFrame(rows, "k string, v double").repartition(7)
    got = {r.k: r["median"] for r in exact_median(df, ["k"], "v", cuts=cuts).collect()}
    assert got == {k: statistics.median(v) for k, v in groups.items()}


def test_broadcast_only_when_small(spark):
    df = spark.range(100)
    left = spark.range(1000)
    small = left.join(fits_broadcast(df, 100), "id", "left")
    assert "BroadcastHashJoin" in plan_of(small)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        large = left.join(fits_broadcast(df, 99), "id", "left")
        assert "BroadcastHashJoin" not in plan_of(large)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("left_type, right_type", [("int", "bigint"), ("bigint", "int"), ("bigint", "bigint"), ("string", "string")])
def test_lookup_join_types(spark, left_type, right_type):
    left = spark.range(10).select(F.col("id").cast(left_type).alias("k"))
    right = spark.range(5, 15).select(F.col("id").cast(right_type).alias("k"), F.lit(1).alias("v"))
    assert lookup_join(left, right, ["k"], "inner").count() == 5
    assert lookup_join(left, right, ["k"]).where("v is null").count() == 5
    assert lookup_join(left, right, ["k"], "left_anti").columns == ["k"]
