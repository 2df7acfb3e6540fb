"""Substring deduplication: windows of words that an earlier document has, by super-k-mers."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patchloom.llm.common import pack, prepared, range_hash, slices, text_keys, unpack, words_of, written
from patchloom.operators.scans import lookup_join

WINDOW = 50  # words
MINIMISER = 8  # words
# Distinct super-k-mers that one task sorts for a minimiser; a minimiser with more has its
# windows spread by their own hashes.
BUCKET_ROWS = 2000


def _sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every run of ``width`` values, by doubling."""
    span = 1
    while 2 * span <= width:
        values = np.minimum(values[: len(values) - span], values[span:])
        span *= 2
    rest = width - span
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


def super_kmers(texts: pa.Array) -> tuple[np.ndarray, ...]:
    """Runs of windows with one minimiser: (minimiser, hash of the run's words, text, first window, windows).

    The minimiser of a window is the smallest hash among its runs of ``MINIMISER`` words. It
    depends on the window alone, so equal windows of any two documents have the same.
    """
    words = words_of(texts)
    gram, _ = words.grams(MINIMISER)
    width = WINDOW - MINIMISER + 1
    if len(gram) < width:
        return tuple(np.zeros(0, np.int64) for _ in range(5))
    low = _sliding_min(gram, width)
    doc = np.repeat(np.arange(len(texts)), np.diff(words.first))[: len(low)]
    at = np.flatnonzero(words.first[doc + 1] - np.arange(len(low)) >= WINDOW)
    if not len(at):
        return tuple(np.zeros(0, np.int64) for _ in range(5))
    low, doc = low[at], doc[at]
    new = np.ones(len(at), dtype=bool)
    new[1:] = (low[1:] != low[:-1]) | (doc[1:] != doc[:-1]) | (at[1:] != at[:-1] + 1)
    begin = np.flatnonzero(new)
    count = np.diff(np.append(begin, len(at)))
    start = at[begin]
    run = range_hash(words.hash, start, start + count + WINDOW - 1, 0xA0761D6478BD642F)
    return low[begin].view(np.int64), run.view(np.int64), doc[begin], start - words.first[doc[begin]], count


def _occurrences(docs: DataFrame) -> DataFrame:
    """Rows mini, run, doc_id, place (text key and first window in one number), n."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            mini, whole, doc, start, n = super_kmers(batch.column("text"))
            place = text_keys(batch.column("text"))[doc] << 32 | start
            columns = [pa.array(mini), pa.array(whole), batch.column("doc_id").take(pa.array(doc)), pa.array(place), pa.array(n.astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, ["mini", "run", "doc_id", "place", "n"])

    ids = docs.where(F.col("doc_id").isNotNull()).select("doc_id", "text")
    return ids.mapInArrow(run, f"mini long, run long, doc_id {kind}, place long, n int")


def _packed_texts(docs: DataFrame) -> DataFrame:
    """Documents as they travel: doc_id, key (of the text), packed."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            texts = batch.column("text")
            packed = pa.array([pack(t) for t in texts.to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(text_keys(texts)), packed], ["doc_id", "key", "packed"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, key long, packed binary")


def _strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The packed string of every wanted super-k-mer of a document: mini, run, first, words."""
    for batch in batches:
        rows: list[tuple] = []
        for doc_id, packed, wanted in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "packed", "wanted"))):
            words = unpack(packed).encode().split()
            for w in wanted:
                rows.append((w["mini"], w["run"], doc_id, b" ".join(words[w["start"] : w["start"] + w["n"] + WINDOW - 1])))
        kinds = [pa.int64(), pa.int64(), batch.schema.field("doc_id").type, pa.binary()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(list(zip(*rows)) or [[]] * 4, kinds)], ["mini", "run", "first", "words"])


def _windows(words: bytes) -> list[bytes]:
    """The windows of a packed string, as strings."""
    ends = [i for i, c in enumerate(words) if c == 32]
    ends.append(len(words))
    starts = [0, *(e + 1 for e in ends[:-1])]
    return [words[starts[i] : ends[i + WINDOW - 1]] for i in range(len(ends) - WINDOW + 1)]


def _sorted_buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sort the windows of each bucket: mini, run, and each window's first document.

    Rows come sorted by minimiser. One bucket is held at a time, of at most ``BUCKET_ROWS``
    strings. Runs whose windows all have the run's own first document are left out.
    """
    kind = pa.int64()

    def rows() -> Iterator[tuple]:
        for batch in batches:
            yield from zip(*(batch.column(c).to_pylist() for c in ("mini", "run", "first", "words")))

    out: list[tuple] = []
    for mini, bucket in groupby(rows(), key=lambda r: r[0]):
        held = list(bucket)
        windows = sorted((w, first, i, j) for i, (_, _, first, words) in enumerate(held) for j, w in enumerate(_windows(words)))
        firsts = [[first] * (words.count(b" ") - WINDOW + 2) for _, _, first, words in held]
        for _, same in groupby(windows, key=lambda w: w[0]):
            first = None
            for _, doc, i, j in same:
                first = doc if first is None else first
                firsts[i][j] = first
        out += [(mini, run, f) for (_, run, first, _), f in zip(held, firsts) if any(x != first for x in f)]
        if len(out) >= 1000:
            yield _firsts(out, kind)
            out = []
    yield _firsts(out, kind)


def _firsts(rows: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
    types = [pa.int64(), pa.int64(), pa.list_(kind)]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(list(zip(*rows)) or [[]] * 3, types)], ["mini", "run", "firsts"])


def _window_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Windows of hot minimisers one by one: mini, run, first, j, and the window's 128-bit digest."""
    for batch in batches:
        for mini, run, first, words in zip(*(batch.column(c).to_pylist() for c in ("mini", "run", "first", "words"))):
            windows = _windows(words)
            n = len(windows)
            digests = [hashlib.blake2b(w, digest_size=16).digest() for w in windows]
            columns = [pa.array([mini] * n, pa.int64()), pa.array([run] * n, pa.int64()), pa.array([first] * n, pa.int64()), pa.array(range(n), pa.int32()), pa.array(digests, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["mini", "run", "first", "j", "digest"])


def window_firsts(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Occurrences of super-k-mers, and for those that recur the first document of each window.

    The second table has (mini, run, first, firsts): ``first`` is the smallest id that has the
    whole run, ``firsts`` the smallest id per window where some other run has that window too.
    """
    occurrences = _occurrences(docs)
    distinct = occurrences.groupBy("mini", "run").agg(
        F.min("doc_id").alias("first"), F.max("doc_id").alias("last"), F.min_by("place", "doc_id").alias("place"), F.max("n").alias("n")
    )
    distinct = written(distinct, "super-kmers")
    # a minimiser with one run only needs no sorting: all its windows begin with that run
    several = distinct.groupBy("mini").agg(F.count("*").alias("runs")).where("runs > 1")
    contested = lookup_join(distinct, several, ["mini"], "inner")
    item = F.struct("mini", "run", F.col("place").bitwiseAND(0xFFFFFFFF).alias("start"), "n")
    wanted = contested.groupBy(F.col("first").alias("doc_id"), F.shiftright("place", 32).alias("key")).agg(F.collect_list(item).alias("wanted"))
    texts = _packed_texts(docs).join(wanted, ["doc_id", "key"])
    # rows with one id and one text would give each string twice
    kind = docs.schema["doc_id"].dataType.simpleString()
    strings = texts.mapInArrow(_strings, f"mini long, run long, first {kind}, words binary")
    strings = written(strings, "strings")
    hot = several.where(F.col("runs") > BUCKET_ROWS).select("mini")
    cool = strings.join(hot, "mini", "left_anti")
    firsts = cool.repartition("mini").sortWithinPartitions("mini").mapInArrow(_sorted_buckets, "mini long, run long, firsts array<bigint>")
    single = lookup_join(strings, hot, ["mini"], "left_semi").mapInArrow(_window_digests, "mini long, run long, first long, j int, digest binary")
    lowest = single.groupBy("digest").agg(F.min("first").alias("lowest"))
    again = lookup_join(single, lowest, ["digest"], "inner")
    spread = again.groupBy("mini", "run").agg(F.array_sort(F.collect_list(F.struct("j", "lowest"))).alias("f"), F.min("first").alias("first"))
    spread = spread.where(F.exists("f", lambda x: x["lowest"] != F.col("first"))).select("mini", "run", F.col("f.lowest").alias("firsts"))
    settled = firsts.union(spread).groupBy("mini", "run").agg(F.first("firsts").alias("firsts"))
    recurring = distinct.select("mini", "run", "first", "last").join(settled, ["mini", "run"], "left")
    return occurrences, recurring.where((F.col("last") > F.col("first")) | F.col("firsts").isNotNull()).drop("last")


def dedupe_substrings(docs: DataFrame, *, keep_text: bool = False) -> DataFrame:
    """Remove every word covered by a window of 50 words that starts in a document with a smaller id.

    Per document: doc_id, n_words, n_removed, kept_sha256 (of the kept words joined by one
    space), and with ``keep_text`` those words as ``text``. Windows are judged on the input.

    Windows travel as super-k-mers: first only their hashes, which settles runs that occur as
    a whole; then the strings of those whose minimiser several different runs share, each
    once, to the bucket of the minimiser. A minimiser with very many runs (the edge of a
    passage that very many documents quote) is spread over tasks by 128-bit window digests.

    Null, empty and blank texts: no words. Null ids: nothing is removed from such rows, and
    they are nobody's source. Rows with one id are never each other's source. An empty table
    gives no rows. Other columns are ignored.
    """
    prepared(docs.sparkSession)
    occurrences, recurring = window_firsts(docs)
    met = lookup_join(occurrences, recurring, ["mini", "run"], "inner")
    start = F.col("place").bitwiseAND(0xFFFFFFFF)
    whole = F.when(F.col("first") < F.col("doc_id"), F.array(F.struct(start.alias("a"), (start + F.col("n")).alias("b")))).otherwise(F.array())
    each = F.filter(
        F.transform("firsts", lambda f, i: F.when(f < F.col("doc_id"), F.struct((start + i).alias("a"), (start + i + 1).alias("b")))),
        lambda s: s.isNotNull(),
    )
    covers = met.select("doc_id", F.shiftright("place", 32).alias("key"), F.when(F.col("firsts").isNull(), whole).otherwise(each).alias("c"))
    covers = covers.where(F.size("c") > 0).groupBy("doc_id", "key").agg(F.flatten(F.collect_list("c")).alias("covers"))
    texts = _packed_texts(docs).join(covers, ["doc_id", "key"], "left")
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "packed"):
            n_words, n_removed, digests, kept_texts = [], [], [], []
            for packed, windows in zip(batch.column("packed").to_pylist(), batch.column("covers").to_pylist()):
                words = unpack(packed).encode().split()
                gone = np.zeros(len(words) + 1, dtype=np.int64)
                for w in windows or ():
                    gone[w["a"]] += 1
                    gone[w["b"] + WINDOW - 1] -= 1
                out = np.cumsum(gone)[: len(words)] > 0
                kept = b" ".join([w for w, g in zip(words, out) if not g]) if windows else b" ".join(words)
                n_words.append(len(words))
                n_removed.append(int(out.sum()))
                digests.append(hashlib.sha256(kept).hexdigest())
                kept_texts.append(kept.decode() if keep_text else None)
            columns = [batch.column("doc_id"), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(digests, pa.string())]
            names = ["doc_id", "n_words", "n_removed", "kept_sha256"]
            if keep_text:
                columns, names = [*columns, pa.array(kept_texts, pa.string())], [*names, "text"]
            yield pa.RecordBatch.from_arrays(columns, names)

    schema = f"doc_id {kind}, n_words long, n_removed long, kept_sha256 string" + (", text string" if keep_text else "")
    return texts.mapInArrow(run, schema)
