"""Ordered work without a one-task sort: ranks, running values and medians.

A plain window over a key sends all rows of that key to one task, which fails when a
key holds a large share of the table. The helpers here cut the order of keys and rows into
blocks, do the window per block, and add what came before a block from a small table
of block totals. The result is the same as the plain window's. Blocks are ranges of the
whole order, one per task and of nearly equal size, unless the caller has better ones.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from patchloom.functions.seeds import SEED, seeded_hash

# 16**4 = 65,536 block totals at most per set: small enough to broadcast.
DIGITS = 4
BROADCAST_DIGITS = 4
# Rows looked at per block to find where blocks begin.
SAMPLED = 64


def seeded_rank(
    df: DataFrame,
    key: Sequence[str],
    *,
    seed: int = SEED,
    within: Sequence[str] = (),
    pos: str = "pos",
    total: str | None = None,
    first: int | Column | None = None,
    digits: int = DIGITS,
) -> DataFrame:
    """Add each row's 1-based place in the seeded order, per ``within`` group.

    The leading hex digits of the hash are an even range partition of the order, so
    counts per leading-digit block give every block its start and only the rows of a
    block are sorted together. ``first`` keeps rows up to that place (a number, or a
    column of the ``within`` values); blocks that start later are dropped before the
    shuffle. ``key`` must identify a row.
    """
    within = list(within)
    keys = [F.col(k) for k in key]
    hashed = df.withColumn("_hash", seeded_hash(*keys, seed=seed)).withColumn(
        "_blk", F.left("_hash", F.lit(digits))
    )
    counts = hashed.groupBy(*within, "_blk").agg(F.count("*").alias("_rows"))
    by_set = Window.partitionBy(*within)
    before = by_set.orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.withColumn("_start", F.coalesce(F.sum("_rows").over(before), F.lit(0)))
    if total:
        starts = starts.withColumn(total, F.sum("_rows").over(by_set))
    starts = starts.drop("_rows")
    if first is not None:
        starts = starts.where(F.col("_start") < first)
    placed = same_keys_join(hashed, starts, [*within, "_blk"], "inner", small=not within and digits <= BROADCAST_DIGITS)
    in_block = Window.partitionBy(*within, "_blk").orderBy("_hash", *keys)
    placed = placed.withColumn(pos, (F.col("_start") + F.row_number().over(in_block)).cast("bigint"))
    if first is not None:
        placed = placed.where(F.col(pos) <= first)
    return placed.drop("_hash", "_blk", "_start")



def _fold(fn: str, col: Column) -> Column:
    return {"sum": F.sum, "min": F.min, "max": F.max}[fn](col)


def _combine(fn: str, carry: Column, local: Column) -> Column:
    if fn == "sum":
        return F.coalesce(carry, F.lit(0)) + F.coalesce(local, F.lit(0))
    return F.least(carry, local) if fn == "min" else F.greatest(carry, local)


def _range_starts(rows: DataFrame, place: Column, blocks: int) -> Column:
    """Where the second and later of ``blocks`` ranges of ``place`` begin, as one sorted array.

    A sample by hash of about ``SAMPLED`` different places per block is put in order; the plan
    counts the rows first, so the sample has a bounded size whatever the table holds.
    """
    sides = rows.select(place.alias("_place"))
    hashed = sides.withColumn("_at", F.pmod(F.xxhash64("_place"), F.lit(1 << 40)))
    share = F.ceil(F.lit(float(SAMPLED * blocks << 40)) / F.greatest(F.lit(1), rows.agg(F.count("*")).scalar()))
    seen = hashed.where(F.col("_at") < share).select("_place").distinct()
    ordered = seen.agg(F.sort_array(F.collect_list("_place")).alias("_all"))
    size = F.size("_all")
    picked = F.transform(F.sequence(F.lit(1), F.lit(blocks - 1)), lambda i: F.get("_all", F.floor(i * size / blocks).cast("int")))
    return ordered.select(F.filter(picked, lambda p: p.isNotNull())).scalar()


def range_block(df: DataFrame, keys: Sequence[str], order: Sequence[str], block: str) -> tuple[DataFrame, int]:
    """Add the number of the range of (keys, order) that a row lies in; also how many there are.

    As many ranges as the session has shuffle partitions, found from the data, so no width has
    to be known. Rows with the same keys and order share a range.
    """
    blocks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if blocks == 1:
        return df.withColumn(block, F.lit(0)), 1
    place = F.struct(*[F.col(c) for c in [*keys, *order]])
    steps = F.array(*[F.lit(1 << i) for i in reversed(range((blocks - 1).bit_length()))])
    with_starts = df.withColumns({"_starts": _range_starts(df, place, blocks), "_place": place})

    def step(at: Column, size: Column) -> Column:
        """Binary search: go on by ``size`` if the start there is not beyond the row."""
        return F.when(F.get("_starts", at + size - 1) <= F.col("_place"), at + size).otherwise(at)

    return with_starts.withColumn(block, F.aggregate(steps, F.lit(0), step)).drop("_starts", "_place"), blocks


def running(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    block: Column | str | None,
    values: Mapping[str, tuple[str, Column]],
    *,
    inclusive: bool = True,
    keep: str | None = None,
    dealt: bool = False,
) -> DataFrame:
    """Running sum, min or max per key in ``order``, added as new columns.

    ``values`` maps a new column to (function, input). With ``inclusive=False`` the current
    row is left out. The work is cut into blocks, which change no result:

    - ``block=None``: ranges of the whole order (keys and order columns), each dealt to a
      task of its own. Only the first key of a range can have rows in an earlier one, so what
      came before is at most one row per range, which is broadcast. ``keep`` names a column
      that keeps the range, for a second scan over the same order without a second shuffle.
    - a column name with ``dealt``: such a kept range.
    - a column, or the name of one, that never falls along ``order``: what came before is
      joined by key and block.
    """
    keys = list(keys)
    ranged, parts = dealt or block is None, None
    kept = isinstance(block, str) or keep is not None
    blk = block if isinstance(block, str) else keep or "_blk"
    if block is None:
        blocked, parts = range_block(df, keys, order, blk)
    else:
        blocked = df if isinstance(block, str) else df.withColumn(blk, block)
    totals = blocked.groupBy(*keys, blk).agg(
        *[_fold(fn, col).alias(name) for name, (fn, col) in values.items()]
    )
    by_block = Window.partitionBy(*keys).orderBy(blk)
    before = by_block.rowsBetween(Window.unboundedPreceding, -1)
    carry = totals.select(
        *keys,
        blk,
        *[_fold(fn, F.col(name)).over(before).alias(f"_c_{name}") for name, (fn, _) in values.items()],
        F.row_number().over(by_block).alias("_nth"),
    )
    if ranged:
        carry = carry.where("_nth > 1")
    carry = carry.drop("_nth")
    if parts is not None:
        blocked = blocked.repartitionById(parts, blk)
    local = (
        Window.partitionBy(*keys, blk)
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow if inclusive else -1)
    )
    scanned = blocked.withColumns({f"_l_{n}": _fold(fn, col).over(local) for n, (fn, col) in values.items()})
    out = same_keys_join(scanned, carry, [*keys, blk], "left", small=ranged).withColumns(
        {n: _combine(fn, F.col(f"_c_{n}"), F.col(f"_l_{n}")) for n, (fn, _) in values.items()}
    )
    helpers = [f"_{side}_{n}" for side in "cl" for n in values]
    return out.drop(*helpers) if kept else out.drop(blk, *helpers)


def counted(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """How often each value occurs per key: keys, _v, _n. Null values are left out."""
    return df.where(F.col(value).isNotNull()).groupBy(*keys, F.col(value).alias("_v")).agg(F.count("*").alias("_n"))


def exact_median(
    df: DataFrame, keys: Sequence[str], value: str, *, out: str = "median", cuts: int = 64
) -> DataFrame:
    """Exact median of ``value`` per key (nulls left out), safe for one huge key."""
    return median_of_counts(counted(df, keys, value), keys, out=out, cuts=cuts)


def median_of_counts(freq: DataFrame, keys: Sequence[str], *, out: str = "median", cuts: int = 64) -> DataFrame:
    """Exact median per key of a table of counted values (keys, _v, _n).

    Every step works on the counts, whose one shuffle Spark reuses: a quantile sketch of the
    values per key gives cut points, counts between the cuts say which pieces hold the two
    middle values, and only those pieces are looked at in detail.
    """
    keys = list(keys)
    points = F.array(*[F.lit(i / cuts) for i in range(1, cuts)])
    cut = freq.groupBy(*keys).agg(F.percentile_approx("_v", points, 10_000).alias("_cuts"))
    pieces = same_keys_join(freq, cut, keys, "inner").select(
        *keys, "_v", "_n", F.size(F.filter("_cuts", lambda c: c < F.col("_v"))).alias("_piece")
    )
    sizes = pieces.groupBy(*keys, "_piece").agg(F.sum("_n").alias("_m"))
    per_key = Window.partitionBy(*keys)
    before = per_key.orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    wanted = (
        sizes.withColumns(
            {
                "_start": F.coalesce(F.sum("_m").over(before), F.lit(0)),
                "_all": F.sum("_m").over(per_key),
            }
        )
        .withColumns({"_lo": F.floor((F.col("_all") + 1) / 2), "_hi": F.floor(F.col("_all") / 2) + 1})
        .where(
            (F.col("_start") < F.col("_hi")) & (F.col("_start") + F.col("_m") >= F.col("_lo"))
        )
        .drop("_m", "_all")
    )
    in_piece = Window.partitionBy(*keys, "_piece").orderBy("_v")
    seen = same_keys_join(pieces, wanted, [*keys, "_piece"], "inner").withColumn(
        "_end", F.col("_start") + F.sum("_n").over(in_piece)
    )

    def at(rank: str) -> Column:
        hit = (F.col("_end") >= F.col(rank)) & (F.col("_end") - F.col("_n") < F.col(rank))
        return F.max(F.when(hit, F.col("_v")))

    return seen.groupBy(*keys).agg(((at("_lo") + at("_hi")) / 2).alias(out))


def group_head(df: DataFrame, keys: Sequence[str], order: Sequence[str], limit: int) -> DataFrame:
    """The first ``limit`` rows of each key in ``order``, in two stages.

    Rows are counted per key and range of the order; ranges of a key that begin past the limit
    are dropped where they are read (only the first key of a range can be such, so a row per
    range is broadcast at most). What is ranked then is the limit and one range per key at
    most, and a row number against a literal cuts that again in every task before it moves.
    """
    keys = list(keys)
    blocked, _ = range_block(df, keys, order, "_blk")
    totals = blocked.groupBy(*keys, "_blk").agg(F.count("*").alias("_rows"))
    by_block = Window.partitionBy(*keys).orderBy("_blk")
    before = totals.withColumn("_start", F.sum("_rows").over(by_block.rowsBetween(Window.unboundedPreceding, -1)))
    past = before.where(F.col("_start") >= limit).select(*keys, "_blk")
    near = same_keys_join(blocked, past, [*keys, "_blk"], "left_anti", small=True)
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return near.withColumn("_rn", place).where(F.col("_rn") <= limit).drop("_rn", "_blk")


def dense_index(df: DataFrame, order: Sequence[str], block: Column | None = None, *, out: str = "idx") -> DataFrame:
    """0-based place of each row in ``order`` over the whole table (order must be unique)."""
    one = F.lit(1).cast("bigint")
    return running(df, [], order, block, {out: ("sum", one)}, inclusive=False)


def same_keys_join(
    left: DataFrame, right: DataFrame, on: Sequence[str], how: str, *, small: bool = False
) -> DataFrame:
    """Join derived from one table back to another, where a null key is a key like any other.

    Like ``lookup_join``, both sides get a shuffle of their own, so that a hot key is split.
    ``small`` marks a right side of a proven size, which is broadcast.
    """
    on = list(on)
    theirs = right.withColumnsRenamed({k: f"_r_{k}" for k in on})
    match = [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in on]
    if small:
        theirs = F.broadcast(theirs)  # 16**digits rows or one per range at most, whatever the input size
    else:
        left = left.withColumn("_key_hash", F.xxhash64(*on))
        theirs = theirs.withColumn("_r_key_hash", F.xxhash64(*[f"_r_{k}" for k in on]))
        match.insert(0, F.col("_key_hash") == F.col("_r_key_hash"))
    joined = left.join(theirs, reduce(and_, match), how)
    return joined.drop("_key_hash", "_r_key_hash", *[f"_r_{k}" for k in on])


def lookup_join(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "left") -> DataFrame:
    """Join rows to a table with one row per key (an aggregate), safe for a hot key on the left.

    Spark splits a skewed join partition at run time only when both sides come straight
    from a shuffle of their own. An aggregate on the same key would be joined right after
    its own shuffle and block that, so a hash of the key is joined on as well: it changes
    no result and costs one more shuffle of the small side.
    """
    on = list(on)

    def marked(df: DataFrame, other: DataFrame) -> DataFrame:
        keys = []
        for k in on:
            mine, theirs = df.schema[k].dataType, other.schema[k].dataType
            # equal values of different types (1 as int and as bigint) must hash alike
            keys.append(F.col(k) if mine == theirs else F.coalesce(k, F.lit(None).cast(theirs)))
        return df.withColumn("_key_hash", F.xxhash64(*keys))

    joined = marked(left, right).join(marked(right, left), ["_key_hash", *on], how)
    return joined.drop("_key_hash")


def fits_broadcast(df: DataFrame, max_rows: int = 100_000) -> DataFrame:
    """Hint a broadcast only after counting that the table is small; else leave the plan alone."""
    small = df.limit(max_rows + 1).count() <= max_rows
    return F.broadcast(df) if small else df
