import hashlib
import math

import pytest

from patchloom.operators import splits as X
from tests.helpers import tuples


def order(ids):
    return sorted(ids, key=lambda x: hashlib.md5(f"42:{x}".encode()).hexdigest())


def slices(n, train, val, test):
    """The slice rule, in plain Python."""
    want = train + val + test
    if n < want:
        ratio = n / want
        train, val = max(1, int(train * ratio)), max(1, int(val * ratio))
        test = max(1, n - train - val)
    ids = order(range(n))
    return ids[:train], ids[train : train + val], ids[train + val : train + val + test]


@pytest.mark.parametrize("n", [0, 1, 2, 3, 100, 349, 350, 400])
def test_split_exact(spark, n):
    got = X.split_exact(spark.range(n), ["id"]).collect()
    parts = {s: sorted(r.id for r in got if r.split == s) for s in ("train", "val", "test")}
    want = slices(n, 200, 50, 100)
    assert list(parts.values()) == [sorted(w) for w in want]


@pytest.mark.parametrize("parts", [1, 4, 16])
def test_split_does_not_depend_on_layout(spark, parts):
    got = X.split_exact(spark.range(500).repartition(parts), ["id"], 20, 10, 10, seed=42).collect()
    want = slices(500, 20, 10, 10)
    assert sorted((r.id, r.split) for r in got) == sorted(
        (i, s) for s, ids in zip(("train", "val", "test"), want) for i in ids
    )


def test_other_seed_other_split(spark):
    a = tuples(X.split_exact(spark.range(1000), ["id"], seed=1), "id", "split")
    b = tuples(X.split_exact(spark.range(1000), ["id"], seed=2), "id", "split")
    assert a != b and len(a) == len(b) == 350


def test_seeded_order(spark):
    assert [r.id for r in X.seeded_order(spark.range(300).repartition(5), ["id"]).collect()] == order(range(300))


@pytest.mark.parametrize("f", [0, 0.15, 0.5, 0.001])
def test_split_fraction(spark, f):
    got = X.split_fraction(spark.range(333), ["id"], f).collect()
    held = {r.id for r in got if r.split == "eval"}
    assert len(got) == 333 and held == set(order(range(333))[: math.ceil(f * 333)])


def test_split_fraction_hashed(spark):
    df = X.split_fraction(spark.range(5000), ["id"], 0.2, exact=False)
    share = df.where("split = 'eval'").count() / 5000
    assert abs(share - 0.2) < 0.03
    from tests.helpers import plan_of

    assert "Exchange" not in plan_of(df)
    with pytest.raises(ValueError):
        X.split_fraction(spark.range(3), ["id"], 1.0)


def test_combine_sets(spark):
    a = spark.createDataFrame([(1, "x"), (1, "x")], "id int, t string")
    b = spark.createDataFrame([(2,)], "id int")
    got = X.combine_sets({"a": a, "b": b})
    assert tuples(got.na.fill(""), "id", "t", "source_set") == [(1, "x", "a"), (1, "x", "a"), (2, "", "b")]
    assert X.combine_sets({"a": a, "b": b}, shuffle_by=["id"]).count() == 3


@pytest.mark.parametrize(
    "d, g, share, want", [(100, 100, 0.75, (99, 34)), (10, 1000, 0.5, (10, 10)), (7, 1, 0.75, (3, 1)), (0, 9, 0.5, (0, 0))]
)
def test_mix(spark, d, g, share, want):
    total = min(math.floor(d / share), math.floor(g / (1 - share)))
    assert (math.floor(total * share), total - math.floor(total * share)) == want
    got = X.mix(spark.range(d), spark.range(1000, 1000 + g), share, ["id"]).collect()
    dom = [r.id for r in got if r.source_set == "domain"]
    gen = [r.id for r in got if r.source_set == "general"]
    assert (len(dom), len(gen)) == want
    assert set(dom) == set(order(range(d))[: want[0]])
    assert set(gen) == set(order(range(1000, 1000 + g))[: want[1]])


def test_leaks_and_unused(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y"), (3, "x")], "id int, text string")
    b = spark.createDataFrame([(9, "x")] * 5, "id int, text string")
    assert tuples(X.split_leaks(a, b), "id") == [(1,), (3,)]
    df = spark.range(400).withColumnRenamed("id", "task_id")
    split = X.split_exact(df, ["task_id"])
    assert X.unused(df, split).count() == 50
    parts = {s: split.where(f"split = '{s}'") for s in ("train", "test")}
    assert parts["train"].join(parts["test"], "task_id").count() == 0
