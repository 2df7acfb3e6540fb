"""Pairs of bugs: disjoint files, one repository, no bug twice, and nothing left that could be paired."""

import random
from itertools import combinations

import pytest

from patchloom.operators import tasks as K


def patch(files):
    return "\n".join(f"diff --git a/{f} b/{f}\n-x\n+y" for f in files)


def bugs(spark, rows):
    table = [(repo, f"i{i:04d}", patch(files) if files is not None else None, [f"t{i}"]) for i, (repo, files) in enumerate(rows)]
    return spark.createDataFrame(table, "repo string, instance_id string, patch string, FAIL_TO_PASS array<string>")


def check(rows, got):
    files = {f"i{i:04d}": (repo, set(f or ())) for i, (repo, f) in enumerate(rows)}
    used = [m for r in got for m in r.members]
    assert len(used) == len(set(used)) and set(used) <= set(files)
    for r in got:
        (repo, one), (other_repo, two) = (files[m] for m in r.members)
        assert repo == other_repo == r.repo and not one & two
        assert r.instance_id == "+".join(r.members) and r.FAIL_TO_PASS == sorted(f"t{int(m[1:])}" for m in r.members)
    left = [v for k, v in files.items() if k not in set(used)]
    for (repo, one), (other_repo, two) in combinations(left, 2):
        assert repo != other_repo or one & two


def families(kind, rng):
    if kind == "random":
        return [(rng.choice(["a", "b", None]), rng.sample("uvwxyz", rng.randint(1, 3))) for _ in range(120)]
    if kind == "star":  # one file in nearly all bugs
        return [("a", ["x", f"f{i}"]) for i in range(60)] + [("a", [f"f{i}", f"g{i}"]) for i in range(8)] + [("b", ["x"])] * 5
    if kind == "triangles":  # sets that all meet without a common file, and a few that don't
        return [("a", s) for s in (["x", "y"], ["y", "z"], ["x", "z"]) for _ in range(9)] + [("a", ["w"])] * 4
    if kind == "empty":
        return [("a", None), ("a", []), ("a", None), ("b", None), ("c", ["x"]), ("c", None), ("d", ["x"]), ("d", ["x"])]
    return [("a", [f"f{i}"]) for i in range(101)]  # all different


@pytest.mark.parametrize("kind, pivots", [("random", 64), ("random", 1), ("star", 64), ("triangles", 2), ("empty", 64), ("different", 64)])
def test_matching_is_maximal(spark, monkeypatch, kind, pivots):
    monkeypatch.setattr(K, "PIVOTS", pivots)
    rows = families(kind, random.Random(kind))
    got = K.match_bugs(bugs(spark, rows)).collect()
    check(rows, got)
    if kind == "different":
        assert len(got) == 50


def test_matching_does_not_depend_on_the_layout(spark):
    rows = families("random", random.Random(4))
    one, two = (K.match_bugs(bugs(spark, rows).repartition(n)).collect() for n in (1, 7))
    assert sorted(r.instance_id for r in one) == sorted(r.instance_id for r in two)


def test_no_bugs_and_bugs_without_an_id(spark):
    assert K.match_bugs(bugs(spark, [])).count() == 0
    df = bugs(spark, [("a", ["x"]), ("a", ["y"])])
    nameless = df.selectExpr("repo", "cast(null as string) instance_id", "patch", "FAIL_TO_PASS")
    assert K.match_bugs(df.union(nameless)).count() == 1
