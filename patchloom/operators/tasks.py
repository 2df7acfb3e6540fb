"""Bug tasks: validation by test results, caps, combination, restart, batches."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import chain

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from patchloom.functions.patches import patch_files
from patchloom.functions.seeds import SEED
from patchloom.operators.scans import fits_broadcast, lookup_join, seeded_rank
from patchloom.session import materialize

# Candidates kept per strategy, and seconds allowed per kind of run.
STRATEGY_CAPS = {
    "lm_modify": 400,
    "class_basic": 200,
    "func_fun": 200,
    "lm_rewrite": 300,
    "procedural": 1000,
}
ONE_PER_FUNCTION = ("lm_rewrite",)
RUN_LIMITS = {"baseline": 7200, "patched": 1800, "evaluation": 240, "reward": 180}
REWARD_GUARD = 60
# Classes of bugs per repository that look for a partner among all others in one round.
PIVOTS = 64


def literal_map(values: Mapping[str, float]) -> Column:
    """A dict as a map literal: a lookup without a join."""
    return F.create_map(*[F.lit(x) for x in chain.from_iterable(values.items())])


# --- validation -----------------------------------------------------------------------


def with_transition(results: DataFrame) -> DataFrame:
    """Name what a patch did to each test: pass/fail before, pass/fail after.

    fail_to_pass is a test the bug broke: it passes on the base and must pass again
    once the bug is fixed. A null outcome counts as a failure.
    """
    base = F.coalesce("base_pass", F.lit(False))
    patched = F.coalesce("patched_pass", F.lit(False))
    return results.withColumn(
        "transition",
        F.when(base & ~patched, "fail_to_pass")
        .when(base & patched, "pass_to_pass")
        .when(~base & ~patched, "fail_to_fail")
        .otherwise("pass_to_fail"),
    )


TRANSITIONS = ("fail_to_pass", "pass_to_pass", "fail_to_fail", "pass_to_fail")


def test_transitions(results: DataFrame, task: str = "task_id") -> DataFrame:
    """Per task, how many tests made each transition (n_fail_to_pass, ...)."""
    named = with_transition(results)
    return named.groupBy(task).agg(
        *[F.count_if(F.col("transition") == t).alias(f"n_{t}") for t in TRANSITIONS]
    )


test_transitions.__test__ = False  # not a pytest case


def transition_lists(results: DataFrame, *, task: str = "task_id", test: str = "test") -> DataFrame:
    """Per task, the sorted test names of each transition, with their counts: one row each.

    The lists of a task are one record, so a task with too many tests for a row fails loudly;
    ``with_transition`` gives the same facts in long form, one row per test.
    """
    named = with_transition(results).select(task, test, "transition")
    lists = named.groupBy(task).agg(
        *[
            F.sort_array(F.collect_list(F.when(F.col("transition") == t, F.col(test)))).alias(t)
            for t in TRANSITIONS
        ],
        # nulls are not collected, so tests without a name are counted by themselves
        *[F.count_if(F.col("transition") == t).alias(f"n_{t}") for t in TRANSITIONS],
    )
    return lists


def valid_tasks(transitions: DataFrame, min_f2p: int = 1, min_p2p: int = 1) -> DataFrame:
    """Tasks that break enough passing tests and leave enough passing.

    Takes the counts or the lists of the tasks.
    """
    return transitions.where(
        (F.col("n_fail_to_pass") >= min_f2p) & (F.col("n_pass_to_pass") >= min_p2p)
    )


def task_instances(
    tasks: DataFrame, results: DataFrame, *, min_f2p: int = 1, min_p2p: int = 1, **options
) -> DataFrame:
    """Valid tasks with their FAIL_TO_PASS and PASS_TO_PASS lists."""
    good = valid_tasks(transition_lists(results, **options), min_f2p, min_p2p)
    lists = good.select(
        "task_id",
        F.col("fail_to_pass").alias("FAIL_TO_PASS"),
        F.col("pass_to_pass").alias("PASS_TO_PASS"),
    )
    return tasks.join(lists, "task_id")


# --- limits and caps --------------------------------------------------------------------


def with_limits(
    df: DataFrame,
    caps: Mapping[str, int] | DataFrame = STRATEGY_CAPS,
    *,
    on: str = "strategy",
    out: str = "cap",
    max_rows: int = 100_000,
) -> DataFrame:
    """Attach each row's limit; null where none is set.

    A dict becomes a map literal. A table (columns ``on`` and ``out``) is joined, with a
    broadcast only after counting that it is small.
    """
    if isinstance(caps, DataFrame):
        return df.join(fits_broadcast(caps.select(on, out), max_rows), on, "left")
    return df.withColumn(out, F.try_element_at(literal_map(caps), F.col(on)).cast("bigint"))


def cap_candidates(
    df: DataFrame,
    per_func: int = 1,
    caps: Mapping[str, int] = STRATEGY_CAPS,
    *,
    order: Sequence[str] = ("task_id",),
    scope: Sequence[str] = (),
) -> DataFrame:
    """At most ``per_func`` candidates per function and strategy, then at most the cap per strategy.

    ``scope`` (e.g. the repository) repeats both limits per value. Both filters compare a
    row number with a literal, so each task cuts its rows before they are shuffled: a
    strategy holding most of the table sends at most its cap from every task.
    """
    scope, keys = list(scope), [F.col(c) for c in order]
    capped = df.where(F.col("strategy").isin(list(caps)))
    uncapped = df.where(~F.coalesce(F.col("strategy").isin(list(caps)), F.lit(False)))

    def per_function(rows: DataFrame) -> DataFrame:
        by_func = Window.partitionBy(*scope, "strategy", "func_id").orderBy(*keys)
        kept = rows.withColumn("_rn", F.row_number().over(by_func)).where(F.col("_rn") <= per_func)
        single = F.coalesce(F.col("strategy").isin(*ONE_PER_FUNCTION), F.lit(False))
        return kept.where(~single | (F.col("_rn") == 1)).drop("_rn")

    by_strategy = Window.partitionBy(*scope, "strategy").orderBy(*keys)
    ranked = per_function(capped).withColumn("_rn", F.row_number().over(by_strategy))
    within = ranked.where(F.col("_rn") <= max(caps.values(), default=0))
    return (
        with_limits(within, caps, out="_cap")
        .where(F.col("_rn") <= F.col("_cap"))
        .drop("_rn", "_cap")
        .unionByName(per_function(uncapped))
    )


def classify_runs(
    runs: DataFrame,
    limits: Mapping[str, float] | None = None,
    *,
    reward_timeout: float | None = None,
    guard: float = REWARD_GUARD,
) -> DataFrame:
    """Add the time limit and a status to each run.

    completed: within the limit; timeout: over it; killed: a reward run over the limit
    plus its outer guard; unlimited: no limit is set for its kind. A reward timeout of
    null or 0 means the default.
    """
    limits = {**RUN_LIMITS, **(limits or {})}
    limits["reward"] = reward_timeout or limits["reward"] or RUN_LIMITS["reward"]
    table = literal_map({k: float(v) for k, v in limits.items()})
    sec, lim = F.col("seconds"), F.col("time_limit")
    return runs.withColumn("time_limit", F.try_element_at(table, F.col("kind"))).withColumn(
        "status",
        F.when(lim.isNull(), "unlimited")
        .when(sec <= lim, "completed")
        .when((F.col("kind") == "reward") & (sec > lim + float(guard)), "killed")
        .otherwise("timeout"),
    )


# --- combination, restart, batches --------------------------------------------------------


def combine_bugs(
    tasks: DataFrame, k: int = 2, *, seed: int = SEED, id_col: str = "instance_id"
) -> DataFrame:
    """Merge k bugs of one repository into a harder task with the union of broken tests.

    Bugs are taken k at a time in seeded order within their repository, so the work is
    linear and a group never holds more than k rows. Sets whose bugs touch a common file,
    and the last short set of a repository, make no combined task.
    """
    ranked = seeded_rank(tasks, [id_col], seed=seed, within=["repo"])
    slim = ranked.select(
        "repo",
        F.floor((F.col("pos") - 1) / k).alias("combo"),
        F.struct(
            F.col("pos"),
            F.col(id_col).alias("id"),
            F.col("patch"),
            F.array_distinct(patch_files(F.coalesce("patch", F.lit("")))).alias("files"),
            F.coalesce("FAIL_TO_PASS", F.array().cast("array<string>")).alias("tests"),
        ).alias("bug"),
    )
    sets = slim.groupBy("repo", "combo").agg(F.sort_array(F.collect_list("bug")).alias("bugs"))
    files = F.flatten(F.col("bugs.files"))
    apart = F.size(F.array_distinct(files)) == F.size(files)
    return sets.where((F.size("bugs") == k) & apart).select(
        "repo",
        F.array_join("bugs.id", "+").alias(id_col),
        F.col("bugs.id").alias("members"),
        F.array_join("bugs.patch", "\n").alias("patch"),
        F.array_sort(F.array_distinct(F.flatten("bugs.tests"))).alias("FAIL_TO_PASS"),
    )


def _random_round(open_classes: DataFrame, seed: int) -> DataFrame:
    """Neighbours in a seeded order of the classes of a team, where they touch different files."""
    placed = seeded_rank(open_classes, ["cls"], seed=seed, within=["team"])
    side = F.struct("pos", "cls", "files", "n", "used")
    pairs = placed.groupBy("team", F.floor((F.col("pos") - 1) / 2).alias("slot")).agg(F.sort_array(F.collect_list(side)).alias("s"))
    one, two = F.get("s", F.lit(0)), F.get("s", F.lit(1))
    apart = pairs.where((F.size("s") == 2) & ~F.arrays_overlap(one["files"], two["files"]))
    return apart.select(
        one["cls"].alias("a"), one["used"].alias("a_from"), two["cls"].alias("b"), two["used"].alias("b_from"),
        F.least(one["n"], two["n"]).alias("m"),
    )


def _pivot_round(open_classes: DataFrame, seed: int) -> tuple[DataFrame, DataFrame]:
    """Some classes per team against all others: (matches, classes that no other can be paired with).

    Classes without their team's commonest file go first: once they are gone, all that is left
    shares that file.
    """
    in_files = open_classes.select("team", F.explode("files").alias("file")).groupBy("team", "file").agg(F.count("*").alias("c"))
    common = in_files.groupBy("team").agg(F.max_by("file", F.struct("c", "file")).alias("common"))
    marked = lookup_join(open_classes, common, ["team"])
    weight = F.xxhash64("cls", F.lit(seed))
    order = [F.coalesce(F.array_contains("files", F.col("common")), F.lit(False)), weight, F.col("cls")]
    first = marked.withColumn("_rn", F.row_number().over(Window.partitionBy("team").orderBy(*order))).where(F.col("_rn") <= PIVOTS)
    pivots = first.groupBy("team").agg(F.collect_list(F.struct("cls", "files", "n", "used")).alias("pivots"))
    met = lookup_join(open_classes, pivots, ["team"], "inner")
    apart = F.filter("pivots", lambda p: (p["cls"] != F.col("cls")) & ~F.arrays_overlap(p["files"], F.col("files")))
    edges = met.select(F.explode(apart).alias("p"), "cls", "n", "used").select(
        F.col("p.cls").alias("a"), F.col("p.used").alias("a_from"), F.col("cls").alias("b"), F.col("used").alias("b_from"),
        F.least("p.n", "n").alias("m"), F.xxhash64(F.least("p.cls", "cls"), F.greatest("p.cls", "cls"), F.lit(seed)).alias("w"),
    )
    edges = materialize(edges.withColumn("_rn", F.row_number().over(Window.partitionBy("a").orderBy("w", "b"))).where(F.col("_rn") <= PIVOTS).drop("_rn"))
    # two pivots may have found each other: one edge, seen from the lesser
    once = edges.groupBy(F.least("a", "b").alias("x"), F.greatest("a", "b").alias("y")).agg(F.min("w").alias("w"), F.first(F.struct("a", "a_from", "b", "b_from", "m")).alias("e"))
    ends = once.select("w", F.explode(F.array("x", "y")).alias("cls")).groupBy("cls").agg(F.min("w").alias("least"))
    for end in ("x", "y"):
        side = ends.select(F.col("cls").alias(end), F.col("least").alias(f"least_{end}"))
        once = lookup_join(once, side, [end], "inner")
    taken = once.where((F.col("w") == F.col("least_x")) & (F.col("w") == F.col("least_y"))).select("e.*")
    alone = lookup_join(first.select("cls"), edges.select(F.col("a").alias("cls")).distinct(), ["cls"], "left_anti")
    return taken, alone


def match_bugs(tasks: DataFrame, *, seed: int = SEED, id_col: str = "instance_id") -> DataFrame:
    """Pair bugs of a repository that touch different files until no two left over could be paired.

    One row per pair: repo, the joined id, members, patch, the union of broken tests. Which bugs
    meet is seeded and doesn't depend on the layout.

    Bugs that touch the same files are one class, so the search works on classes and counts.
    Rounds pair neighbours of a seeded order while that gets on; then some classes per
    repository look at all others, which settles each of them: it is paired, or nothing left
    can ever be. A repository is done when one file is in all its classes. Every round is
    written to the checkpoint folder; nothing of a class is held in one task but its count.
    A bug that touches no file goes with any other. ``id_col`` identifies a bug; those without are
    left out. A null repository is one like any other.
    """
    tasks = tasks.where(F.col(id_col).isNotNull())
    files = F.array_sort(F.array_distinct(patch_files(F.coalesce("patch", F.lit("")))))
    slim = tasks.select(
        F.md5(F.to_json(F.struct("repo"))).alias("team"), F.md5(F.to_json(F.struct(F.col("repo"), files.alias("f")))).alias("cls"),
        F.col(id_col).alias("id"), files.alias("files"),
    )
    members = materialize(seeded_rank(slim, ["id"], seed=seed, within=["cls"], pos="rank"))
    kept = members.where("rank = 1").select("cls", "team", "files")
    counts = members.groupBy("cls").agg(F.count("*").alias("n"))
    classes = kept.join(counts, "cls").withColumn("used", F.lit(0).cast("bigint"))
    # bugs that touch nothing go with each other first
    free = (F.size("files") == 0) & (F.col("n") > 1)
    inner = classes.where(free).select(F.col("cls"), F.floor(F.col("n") / 2).alias("m"))
    own = inner.select("cls", F.explode(F.sequence(F.lit(1).cast("bigint"), 2 * F.col("m"))).alias("rank"))
    found = [own.select("cls", "rank", F.concat(F.lit("0:"), "cls", F.lit(":"), F.floor((F.col("rank") - 1) / 2).cast("string")).alias("pair"))]
    used = F.when(free, F.col("n") - F.col("n") % 2).otherwise(F.col("used"))
    classes = classes.select("cls", "team", "files", F.when(free, F.col("n") % 2).otherwise(F.col("n")).alias("n"), used.alias("used"))
    classes = materialize(classes.where("n > 0"))
    searching, turn = False, 0
    while True:
        # a repository with one class, or with a file that all its classes share, is done
        sizes = classes.groupBy("team").agg(F.count("*").alias("c"))
        shared = classes.select("team", F.explode("files").alias("f")).groupBy("team", "f").agg(F.count("*").alias("c"))
        done = lookup_join(shared, sizes.withColumnRenamed("c", "all"), ["team"], "inner").where("c = all").select("team")
        done = done.union(sizes.where("c < 2").select("team")).distinct()
        classes = materialize(lookup_join(classes, done, ["team"], "left_anti"))
        left = classes.count()
        if not left:
            break
        turn += 1
        if searching:
            matches, alone = _pivot_round(classes, seed + turn)
            classes = lookup_join(classes, alone, ["cls"], "left_anti")
        else:
            matches = _random_round(classes, seed + turn)
        matches = materialize(matches)
        both = matches.select("a", "b", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("m"))).alias("k"), "a_from", "b_from")
        pair = F.concat(F.lit(f"{turn}:"), "a", F.lit(":"), "b", F.lit(":"), F.col("k").cast("string")).alias("pair")
        for side in "ab":
            found.append(both.select(F.col(side).alias("cls"), (F.col(f"{side}_from") + F.col("k")).alias("rank"), pair))
        spent = matches.select(F.explode(F.array("a", "b")).alias("cls"), "m")
        classes = lookup_join(classes, spent, ["cls"])
        less = F.coalesce("m", F.lit(0))
        classes = classes.select("cls", "team", "files", (F.col("n") - less).alias("n"), (F.col("used") + less).alias("used"))
        classes = materialize(classes.where("n > 0"))
        # random rounds go on while they use up a tenth of the classes
        searching = searching or classes.count() > 0.9 * left
    rows = found[0]
    for part in found[1:]:
        rows = rows.unionByName(part)
    named = lookup_join(members.select("cls", "rank", "id"), rows, ["cls", "rank"], "inner").select("id", "pair")
    broken = F.coalesce("FAIL_TO_PASS", F.array().cast("array<string>"))
    bug = F.struct(F.col(id_col).alias("id"), F.col("patch"), broken.alias("tests"))
    full = tasks.select("repo", bug.alias("bug"), F.col(id_col).alias("id")).join(named, "id")
    sets = full.groupBy("pair").agg(F.any_value("repo").alias("repo"), F.sort_array(F.collect_list("bug")).alias("bugs"))
    return sets.select(
        "repo",
        F.array_join("bugs.id", "+").alias(id_col),
        F.col("bugs.id").alias("members"),
        F.array_join("bugs.patch", "\n").alias("patch"),
        F.array_sort(F.array_distinct(F.flatten("bugs.tests"))).alias("FAIL_TO_PASS"),
    )


def pending(tasks: DataFrame, done: DataFrame, on: Sequence[str] = ("task_id",)) -> DataFrame:
    """Tasks not finished yet. Repeats in ``done`` are folded before they move."""
    return lookup_join(tasks, done.select(*on).distinct(), on, "left_anti")


def assign_batches(
    prompts: DataFrame, batch: int, gens: int, *, key: Sequence[str] = ("task_id",), seed: int = SEED
) -> DataFrame:
    """Repeat each prompt ``gens`` times in seeded order and number batches of ``batch`` rows."""
    ranked = seeded_rank(prompts, key, seed=seed)
    rows = ranked.withColumn("gen", F.explode(F.sequence(F.lit(0), F.lit(gens - 1))))
    place = (F.col("pos") - 1) * gens + F.col("gen")
    return rows.withColumn("batch", F.floor(place / batch).cast("bigint")).drop("pos")
