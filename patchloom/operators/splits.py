"""Seeded order, splits, mixes and set differences."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from fractions import Fraction

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from patchloom.functions.seeds import SEED, hash_share, seeded_hash
from patchloom.operators.scans import lookup_join, seeded_rank

# Default sizes of the train, validation and test slices.
TRAIN_SIZE, VAL_SIZE, TEST_SIZE = 200, 50, 100


# Leading hex digits of the seeded hash that each round of a search for a cut settles.
ROUNDS = (4, 8)


def seeded_cut(df: DataFrame, key: Sequence[str], take: Callable[[Column], Column], seed: int = SEED) -> Column:
    """The place (hash, keys) of the last of the first ``take(n)`` rows of the seeded order.

    A histogram of leading digits tells in which bin the cut lies, a second one splits that
    bin, and the few rows left are put in order. So only counts move (65,536 bins a round at
    most), and each row can tell by itself whether it lies before the cut. Null if no row does.
    """
    keys = [F.col(k) for k in key]
    rows = df.select(seeded_hash(*keys, seed=seed).alias("_hash"), *keys)

    def find(counts: DataFrame, order: list[str], wanted: Callable[[Column], Column]) -> Column:
        """Of counted parts of an order, the one that holds the wanted row, and its number there."""
        everything = Window.orderBy(*order)
        placed = counts.withColumns(
            {"_end": F.sum("_n").over(everything), "_all": F.sum("_n").over(Window.partitionBy())}
        ).withColumn("_want", wanted(F.col("_all")))
        hit = placed.where((F.col("_want") > F.col("_end") - F.col("_n")) & (F.col("_want") <= F.col("_end")))
        rest = (F.col("_want") - F.col("_end") + F.col("_n")).alias("rest")
        return hit.select(F.struct(*order, rest)).scalar()

    wanted, below = take, rows
    for digits in ROUNDS:
        part = F.left("_hash", F.lit(digits))
        counts = below.groupBy(part.alias("_bin")).agg(F.count("*").alias("_n"))
        found = find(counts, ["_bin"], wanted)
        below = rows.where(part == found["_bin"])
        wanted = lambda _, found=found: found["rest"]
    last = find(below.groupBy("_hash", *keys).agg(F.count("*").alias("_n")), ["_hash", *key], wanted)
    return F.when(last.isNotNull(), F.struct(last["_hash"].alias("_hash"), *[last[k].alias(k) for k in key]))


def before_cut(df: DataFrame, key: Sequence[str], take: Callable[[Column], Column], seed: int = SEED) -> Column:
    """Whether a row is among the first ``take(n)`` of the seeded order; no row is moved.

    ``key`` must identify a row: rows that share it are taken, or not, together.
    """
    keys = [F.col(k) for k in key]
    place = F.struct(seeded_hash(*keys, seed=seed).alias("_hash"), *keys)
    return F.coalesce(place <= seeded_cut(df, key, take, seed), F.lit(False))


def seeded_order(df: DataFrame, key: Sequence[str], seed: int = SEED) -> DataFrame:
    """Rows in seeded order (a distributed range sort); ``key`` must identify a row."""
    keys = [F.col(k) for k in key]
    return df.orderBy(seeded_hash(*keys, seed=seed), *keys)


def split_exact(
    df: DataFrame,
    key: Sequence[str],
    train: int = TRAIN_SIZE,
    val: int = VAL_SIZE,
    test: int = TEST_SIZE,
    *,
    seed: int = SEED,
) -> DataFrame:
    """Consecutive train, val and test slices of the seeded order; the rest is left out.

    With fewer rows than asked for, the sizes shrink in proportion, with at least one
    train and one val row. The row count comes from the block counts the ranking needs
    anyway, and only blocks reached by the slices are shuffled.
    """
    want = train + val + test
    ranked = seeded_rank(df, key, seed=seed, pos="pos", total="_n", first=want)
    n, pos = F.col("_n"), F.col("pos")
    short = n < want
    ratio = n / F.lit(float(max(want, 1)))

    def scaled(size: int) -> Column:
        small = F.greatest(F.lit(1), F.floor(F.lit(size) * ratio)).cast("bigint")
        return F.when(short, small).otherwise(F.lit(size).cast("bigint"))

    sized = ranked.withColumns({"_train": scaled(train), "_val": scaled(val)})
    rest = F.greatest(F.lit(1).cast("bigint"), n - F.col("_train") - F.col("_val"))
    sized = sized.withColumn("_test", F.when(short, rest).otherwise(F.lit(test).cast("bigint")))
    part = (
        F.when(pos <= F.col("_train"), "train")
        .when(pos <= F.col("_train") + F.col("_val"), "val")
        .when(pos <= F.col("_train") + F.col("_val") + F.col("_test"), "test")
    )
    return (
        sized.withColumn("split", part)
        .where(F.col("split").isNotNull())
        .drop("_n", "_train", "_val", "_test", "pos")
    )


def split_fraction(
    df: DataFrame, key: Sequence[str], f: float, *, seed: int = SEED, exact: bool = True
) -> DataFrame:
    """Mark an evaluation share of the rows; 0 marks none.

    Exact: the first ceil(f * n) rows of the seeded order, found by counts, so that rows stay
    where they are. Otherwise each row decides by its own hash, and the share is met in
    expectation. Neither form shuffles rows.
    """
    if not 0 <= f < 1:
        raise ValueError("the share must be in [0, 1)")
    if f == 0:
        return df.withColumn("split", F.lit("train"))
    if exact:
        chosen = before_cut(df, key, lambda n: F.ceil(F.lit(f) * n), seed)
    else:
        chosen = hash_share(seeded_hash(*[F.col(k) for k in key], seed=seed)) < F.lit(f)
    return df.withColumn("split", F.when(chosen, "eval").otherwise("train"))


def combine_sets(
    sets: dict[str, DataFrame], *, shuffle_by: Sequence[str] | None = None, seed: int = SEED
) -> DataFrame:
    """Union of sets with a ``source_set`` tag, duplicates kept; seeded order on request."""
    tagged = [df.withColumn("source_set", F.lit(name)) for name, df in sets.items()]
    out = tagged[0]
    for df in tagged[1:]:
        out = out.unionByName(df, allowMissingColumns=True)
    return seeded_order(out, ["source_set", *shuffle_by], seed) if shuffle_by else out


def mix(
    domain: DataFrame, general: DataFrame, share: float, key: Sequence[str], *, seed: int = SEED
) -> DataFrame:
    """The largest mix with the given share of domain rows, drawn in seeded order.

    total = min(floor(domain / share), floor(general / (1 - share))). Quotas are worked
    out inside the plan from two counts; each row then decides by the cut of its set whether it
    is in the mix, so rows are not shuffled.
    """
    if not 0 < share < 1:
        raise ValueError("the share must be strictly between 0 and 1")
    # exact rational: floor(n / 0.1) must not depend on how 0.1 is stored
    part = Fraction(str(share))
    num, den = part.numerator, part.denominator
    d, g = (df.agg(F.count("*")).scalar() for df in (domain, general))
    total = F.least(F.floor(d * den / num), F.floor(g * den / (den - num)))
    quota = F.floor(total * num / den)
    picked = {
        "domain": domain.where(before_cut(domain, key, lambda n: quota, seed)),
        "general": general.where(before_cut(general, key, lambda n: total - quota, seed)),
    }
    return combine_sets(picked)


def text_key(text: Column) -> list[Column]:
    return [F.sha2(text, 256), F.char_length(text)]


def split_leaks(a: DataFrame, *others: DataFrame, text: str = "text") -> DataFrame:
    """Rows of ``a`` whose text is also in one of the other sets. Texts are compared by digest and length."""

    def keyed(df: DataFrame) -> DataFrame:
        digest, size = text_key(F.col(text))
        return df.select(digest.alias("_digest"), size.alias("_size")).distinct()

    seen = keyed(others[0])
    for df in others[1:]:
        seen = seen.union(keyed(df))
    digest, size = text_key(F.col(text))
    tagged = a.withColumns({"_digest": digest, "_size": size})
    return lookup_join(tagged, seen.distinct(), ["_digest", "_size"], "left_semi").drop("_digest", "_size")


def unused(tasks: DataFrame, splits: DataFrame, on: Sequence[str] = ("task_id",)) -> DataFrame:
    """Rows no split took."""
    return lookup_join(tasks, splits.select(*on).distinct(), on, "left_anti")

