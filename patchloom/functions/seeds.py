"""Seeded order: a hash of seed and row key, the same on every engine and layout."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SEED = 42


def seeded_hash(*keys: Column, seed: int = SEED) -> Column:
    """md5 of ``seed:key[:key...]`` as hex text; sorting by it is a seeded shuffle."""
    parts = [F.lit(str(seed)), *[F.coalesce(k.cast("string"), F.lit("")) for k in keys]]
    return F.md5(F.concat_ws(":", *parts))


def hash_share(hashed: Column) -> Column:
    """The hash as a number in [0, 1), from its first 8 hex digits."""
    return F.conv(F.left(hashed, F.lit(8)), 16, 10).cast("bigint") / F.lit(float(16**8))
