"""Packing examples into sequences of a fixed length."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from patchloom.functions.seeds import SEED, seeded_hash
from patchloom.operators.scans import DIGITS, running


def pack_wrap(
    df: DataFrame,
    max_len: int,
    *,
    key: Sequence[str] = ("doc_id",),
    length: str = "est_tokens",
    seed: int = SEED,
    digits: int = DIGITS,
) -> DataFrame:
    """Join all examples in seeded order and cut every ``max_len`` tokens.

    One row per example and sequence it reaches: sequence id, the key, and the token
    range of the example that lies in the sequence. The order is one order over the
    whole table, worked on block by block, so the result does not depend on the layout.
    """
    keys = [F.col(k) for k in key]
    slim = (
        df.select(*keys, F.col(length).cast("bigint").alias("_len"))
        .where(F.col("_len") > 0)
        .withColumns({"_hash": seeded_hash(*keys, seed=seed), "_set": F.lit(0)})
    )
    block = F.left("_hash", F.lit(digits))
    placed = running(
        slim, ["_set"], ["_hash", *key], block, {"_at": ("sum", F.col("_len"))}, inclusive=False
    )
    first = F.floor(F.col("_at") / max_len)
    last = F.floor((F.col("_at") + F.col("_len") - 1) / max_len)
    seq = F.col("seq")
    return placed.withColumn("seq", F.explode(F.sequence(first, last))).select(
        "seq",
        *keys,
        F.greatest(seq * max_len - F.col("_at"), F.lit(0).cast("bigint")).alias("from_token"),
        F.least((seq + 1) * max_len - F.col("_at"), F.col("_len")).alias("to_token"),
    )


def pack_greedy(
    df: DataFrame,
    max_len: int,
    *,
    shards: int,
    key: str = "doc_id",
    length: str = "est_tokens",
    seed: int = SEED,
) -> DataFrame:
    """Whole examples only, next-fit in seeded order within each of ``shards`` hash shards.

    An example longer than ``max_len`` stands alone. Next-fit is serial, so each shard is
    one run through sorted rows; a task streams them batch by batch and holds only the
    fill of the open sequence. Choose ``shards`` with the data: each costs at most one
    part-filled sequence.
    """
    hashed = df.select(
        key, F.col(length).cast("bigint").alias("tokens"), seeded_hash(F.col(key), seed=seed).alias("_hash")
    ).withColumn("shard", F.pmod(F.conv(F.left("_hash", F.lit(8)), 16, 10).cast("bigint"), F.lit(shards)))
    ordered = hashed.repartition("shard").sortWithinPartitions("shard", "_hash", key).drop("_hash")

    def next_fit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shard, seq, fill = None, 0, 0
        for rows in batches:
            seqs, offsets = [], []
            for this, size in zip(rows["shard"].tolist(), rows["tokens"].tolist()):
                if this != shard:
                    shard, seq, fill = this, 0, 0
                elif fill + size > max_len and fill > 0:
                    seq, fill = seq + 1, 0
                seqs.append(seq)
                offsets.append(fill)
                fill += size
            yield rows.assign(seq=seqs, offset=offsets)

    out = T.StructType(
        [*ordered.schema.fields, T.StructField("seq", T.LongType()), T.StructField("offset", T.LongType())]
    )
    return ordered.mapInPandas(next_fit, out)


class _Fit:
    """Next-fit over the lengths of one block, from any fill of the sequence it starts with.

    Where a sequence begins decides where the next one does, so a table of those jumps gives
    the sequences opened and the fill left behind for each first break; and which break comes
    first is a step function of the fill on entry.
    """

    def __init__(self, lengths: np.ndarray, max_len: int):
        full = max_len + 1  # any longer fill takes no further example either
        n, sums = len(lengths), np.concatenate([[0], np.cumsum(np.minimum(lengths, full))])
        at = np.searchsorted(sums, sums[:-1] + max_len, side="right") - 1
        # a sequence that holds nothing yet takes an example of any length
        jump = np.minimum(np.where(sums[at] > sums[:-1], at, at + 1), n).tolist()
        opened, last = [0] * (n + 1), list(range(n + 1))
        for i in range(n - 1, -1, -1):
            j = jump[i]
            opened[i] = opened[j] + 1 if j < n else 1
            last[i] = last[j] if j < n else i
        entry = np.arange(1, full + 1)
        first = np.maximum(np.searchsorted(sums, max_len - entry, side="right") - 1, 0)
        self.low, self.opened, self.fill = [], [], []
        for low, k in [(0, jump[0] if n else 0), *zip(entry.tolist(), first.tolist())]:
            whole = k >= n  # the sequence of the entry goes on to the end
            fill = int(min(sums[n] if whole else sums[n] - sums[last[k]], full))
            row = (-1 if whole else opened[k], fill)
            if low < 2 or row != (self.opened[-1], self.fill[-1]):
                self.low.append(low)
                self.opened.append(row[0])
                self.fill.append(row[1])


def pack_next_fit(
    df: DataFrame, max_len: int, *, key: str = "doc_id", length: str = "est_tokens", seed: int = SEED
) -> DataFrame:
    """Whole examples only, next-fit in one seeded order over the whole table: key, tokens, seq, offset.

    An example longer than ``max_len`` stands alone. Next-fit is serial, but a block of the
    order maps the fill it is entered with to the sequences it opens and the fill it leaves;
    that map has at most max_len + 2 steps. Blocks (equal ranges of the hash, one per task)
    make their maps at once, one pass over the maps gives every block its entry, and the blocks
    are then packed at once. So there are no shards, and the layout changes nothing. A task
    holds the lengths of its block.
    """
    spark = df.sparkSession
    blocks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    hashed = df.select(
        key, F.coalesce(F.col(length).cast("bigint"), F.lit(0).cast("bigint")).alias("tokens"), seeded_hash(F.col(key), seed=seed).alias("_hash")
    )
    share = F.conv(F.left("_hash", F.lit(8)), 16, 10).cast("bigint")
    placed = hashed.withColumn("_block", F.floor(share * blocks / 16**8).cast("int"))
    dealt = placed.repartitionById(blocks, "_block")

    def in_order(rows: DataFrame) -> DataFrame:
        return rows.sortWithinPartitions("_block", "_hash", key)

    def by_block(batches: Iterator[pa.RecordBatch]) -> tuple[int | None, np.ndarray]:
        block, lengths = None, []
        for batch in batches:
            if batch.num_rows:
                block = batch.column("_block")[0].as_py()
                lengths.append(batch.column("tokens").to_numpy())
        return block, np.concatenate(lengths) if lengths else np.zeros(0, np.int64)

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, lengths = by_block(batches)
        if block is not None:
            fit = _Fit(lengths, max_len)
            total = int(min(np.minimum(lengths, max_len + 1).sum(), max_len + 1))
            columns = [pa.array([x]) for x in (block, total, fit.low, fit.opened, fit.fill)]
            yield pa.RecordBatch.from_arrays(columns, ["_block", "total", "low", "opened", "fill"])

    def chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Entries of the blocks, in order: the fill on entry and the sequence that is open."""
        fill, seq = 0, 0
        for batch in batches:
            entries = []
            for row in batch.to_pylist():
                entries.append((row["_block"], fill, seq))
                step = int(np.searchsorted(row["low"], fill, side="right")) - 1
                if row["opened"][step] < 0:
                    fill = min(fill + row["total"], max_len + 1)
                else:
                    fill, seq = row["fill"][step], seq + row["opened"][step]
            columns = [pa.array(c, t) for c, t in zip(zip(*entries), (pa.int64(), pa.int64(), pa.int64()))]
            if entries:
                yield pa.RecordBatch.from_arrays(columns, ["_entry_block", "_fill", "_seq"])

    maps = in_order(dealt).mapInArrow(summarise, "_block long, total long, low array<long>, opened array<long>, fill array<long>")
    entries = maps.repartition(1).sortWithinPartitions("_block").mapInArrow(chain, "_entry_block long, _fill long, _seq long")
    entered = dealt.join(F.broadcast(entries), F.col("_block") == F.col("_entry_block"))  # a row per block

    def replay(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fill = None
        for batch in batches:
            if not batch.num_rows:
                continue
            if fill is None:
                fill, seq = batch.column("_fill")[0].as_py(), batch.column("_seq")[0].as_py()
            seqs, offsets = [], []
            for size in batch.column("tokens").to_pylist():
                if fill + size > max_len and fill > 0:
                    seq, fill = seq + 1, 0
                seqs.append(seq)
                offsets.append(fill)
                fill += size
            columns = [batch.column(key), batch.column("tokens"), pa.array(seqs, pa.int64()), pa.array(offsets, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, [key, "tokens", "seq", "offset"])

    kind = df.schema[key].dataType.simpleString()
    return in_order(entered).mapInArrow(replay, f"`{key}` {kind}, tokens bigint, seq bigint, offset bigint")
