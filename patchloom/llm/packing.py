"""Best-two-fit packing of tokenised documents into sequences of fixed size."""

from __future__ import annotations

import os
import re
import zlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from patchloom.llm.common import prepared, slices, written

SIZE = 4096
END_ID = 1
CACHE_WORDS = 500_000
CACHE_UNITS = 600_000
# Words of printable ASCII without an apostrophe (contractions are units of their own) or a
# bar (special tokens have one) split plainly.
_PLAIN = re.compile(r"[!-&(-{}~]+")
_UNIT = re.compile(r"[a-z]+|[0-9]|[^a-z0-9]+")


class WordEncoder:
    """Ids of words as little-endian 32-bit bytes, through bounded caches.

    The tokenizer drops white space and never joins across it, so a text's ids are those of
    its words in order; a word's ids are those of its pre-token units in order. Both are
    remembered up to a bound, beyond which they are encoded again when met.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.words: dict[str, bytes] = {}
        self.units: dict[str, bytes] = {}

    def text(self, text: str) -> bytes:
        # only plain spaces and line ends: what Python calls white space is not the tokenizer's
        words = text.replace("\n", " ").split(" ")
        ids = list(map(self.words.get, words))
        if None in ids:
            ids = [self.word(w) if i is None else i for w, i in zip(words, ids)]
        return b"".join(ids)

    def word(self, word: str) -> bytes:
        if _PLAIN.fullmatch(word):
            parts = _UNIT.findall(word.lower())
        elif "|" in word:
            ids = self.tokenizer.encode(word, add_special_tokens=False).ids
            return np.asarray(ids, dtype="<u4").tobytes()
        else:
            plain = self.tokenizer.normalizer.normalize_str(word)
            parts = [p for p, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(plain)]
        ids = b"".join([self.units[p] if p in self.units else self.unit(p) for p in parts])
        if len(self.words) < CACHE_WORDS:
            self.words[word] = ids
        return ids

    def unit(self, unit: str) -> bytes:
        ids = b"".join([t.id.to_bytes(4, "little") for t in self.tokenizer.model.tokenize(unit)])
        if len(self.units) < CACHE_UNITS:
            self.units[unit] = ids
        return ids


_ENCODERS: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """One encoder per tokenizer, kept while the worker lives."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


def token_pieces(docs: DataFrame, path: str, *, size: int = SIZE, end_id: int = END_ID) -> DataFrame:
    """Documents to pieces of at most ``size`` ids: doc_id, piece, start, length, ids_crc32.

    ``part`` and ``nth`` number the pieces of one length within the task that made them,
    which is what a global rank needs besides counts per task.
    """
    end = np.asarray([end_id], dtype="<u4").tobytes()
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seen = TaskContext.get().partitionId(), np.zeros(size + 1, dtype=np.int64)
        for batch in slices(batches, "text"):
            ids = batch.column("doc_id").to_pylist()
            texts = batch.column("text").to_pylist()
            rows: list[tuple] = []
            for doc_id, text in zip(ids, texts):
                body = encoder(path).text(text or "") + end
                for piece, at in enumerate(range(0, len(body), 4 * size)):
                    cut = body[at : at + 4 * size]
                    n = len(cut) // 4
                    rows.append((doc_id, piece, at // 4, n, zlib.crc32(cut), part, int(seen[n])))
                    seen[n] += 1
            columns = list(zip(*rows))
            types = [batch.schema.field("doc_id").type, pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "part", "nth"]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, part int, nth long"
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def best_two_fit(counts: dict[int, int], size: int = SIZE) -> list[tuple[int, list[int]]]:
    """Pack a histogram of lengths: (how many bins, the lengths in each of them).

    Fill greedily: the longest length left opens a bin, then the longest that still fits
    is added until none does. Then the bin's smallest document is given back if two
    unpacked ones fit the room it leaves more tightly. Bins that come out alike are made
    in one step, as many as the counts allow, so the work depends on the number of
    distinct lengths and not on the number of documents.
    """
    left = dict(counts)
    lengths = sorted(left)
    bins: list[tuple[int, list[int]]] = []

    def largest(limit: int, used: dict[int, int]) -> int:
        at = bisect_right(lengths, limit) - 1
        while at >= 0 and left[lengths[at]] - used.get(lengths[at], 0) <= 0:
            at -= 1
        return lengths[at] if at >= 0 else 0

    while lengths:
        used: dict[int, int] = {}
        held: list[int] = []
        room = size
        while room and (take := largest(room, used)):
            held.append(take)
            used[take] = used.get(take, 0) + 1
            room -= take
        if room and len(held) > 1:
            small = held[-1]
            used[small] -= 1
            gap = room + small
            best, pair = small, None
            for one in lengths[bisect_right(lengths, gap // 2 - 1) : bisect_right(lengths, gap - 1)]:
                if left[one] - used.get(one, 0) <= 0:
                    continue
                used[one] = used.get(one, 0) + 1
                two = largest(min(one, gap - one), used)
                used[one] -= 1
                if two and one + two > best:
                    best, pair = one + two, (one, two)
                    if best == gap:
                        break
            if pair:
                held[-1:] = pair
                for x in pair:
                    used[x] = used.get(x, 0) + 1
            else:
                used[small] += 1
        times = min(left[x] // n for x, n in used.items() if n)
        bins.append((times, held))
        for x, n in used.items():
            left[x] -= times * n
        lengths = [x for x in lengths if left[x] > 0]
    return bins


def _slots(bins: list[tuple[int, list[int]]], size: int) -> np.ndarray:
    """Where ranks of a length go: rows (length * 2**40 + first rank, bins, first bin, offset)."""
    rows, next_rank, next_bin = [], {}, 0
    for times, held in bins:
        at = 0
        for x in held:
            rank = next_rank.get(x, 0)
            rows.append((x << 40 | rank, times, next_bin, at))
            next_rank[x] = rank + times
            at += x
        next_bin += times
    return np.array(sorted(rows), dtype=np.int64).reshape(-1, 4)


def pack_best_two_fit(docs: DataFrame, path: str, *, size: int = SIZE, end_id: int = END_ID) -> DataFrame:
    """Pack all documents into sequences of at most ``size`` tokens.

    One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset. What is
    packed is the histogram of lengths: at most ``size`` entries however large the table, so
    one greedy plan covers the whole corpus and there are no shards. It comes to the driver,
    and the plan goes out to the tasks as an array of bounded size. Documents then take
    places by their rank within their length, which needs only counts per (task, length).

    Null or empty text: one piece holding the end id alone. Rows that repeat, and null ids,
    are packed like any other row. An empty table gives no rows. Other columns are ignored.
    """
    spark = prepared(docs.sparkSession)
    pieces = written(token_pieces(docs, path, size=size, end_id=end_id), "pieces")
    counts = pieces.groupBy("part", "length").agg(F.count("*").alias("n"))
    histogram = {r.length: r.n for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    slots = spark.sparkContext.broadcast(_slots(best_two_fit(histogram, size), size))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_first"))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan = slots.value
        for batch in batches:
            length = batch.column("length").to_numpy()
            rank = batch.column("nth").to_numpy() + batch.column("_first").to_numpy()
            row = plan[np.searchsorted(plan[:, 0], length << 40 | rank, side="right") - 1]
            within = rank - (row[:, 0] & ((1 << 40) - 1))
            kept = [batch.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(row[:, 2] + within), pa.array(row[:, 3])],
                ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    return pieces.join(starts, ["part", "length"]).mapInArrow(place, schema)
