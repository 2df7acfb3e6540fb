"""Fuzzy line deduplication: MinHash of character shingles, banding, exact check, components."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from patchloom.llm.common import (
    min_label,
    mix,
    pack,
    prepared,
    residual_links,
    slices,
    text_keys,
    unpacked,
    utf8,
    written,
)
from patchloom.operators.scans import lookup_join

SHINGLE = 8  # UTF-8 bytes of the normalised line
PERCENT = 80
# Ten bands of three: a pair at the threshold meets in one of them with probability 0.999.
BANDS, ROWS = 10, 3
BINS = BANDS * ROWS
FULL = 8  # a band of so many lines or fewer gives all its pairs
HELD = 4096  # lines of one band that a task holds
FULL_ROWS = 4_000_000  # rows of bands after which a task gives the pairs of its longest bands
PARTS = 1024  # arrays that the bands of a slice of texts are dealt into, at least
SKETCH = 4096  # bits a line's shingles are hashed to
KEY, PACKED, GONE = "__patchloom_key", "__patchloom_packed", "__patchloom_gone"
SEEN = 1_000_000  # line hashes a task remembers, to send a repeated line's keys once
CHUNK = 1 << 16  # bytes of lines signed at once: their arrays stay in the processor's cache
_BLANK = b" \t\r\x0b\x0c"  # what a line may consist of and be blank: the white space that is joined
_RARE = (b"\t", b"\r", b"\x0b", b"\x0c")
_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def _encoded(text: str | bytes | None) -> bytes:
    return text if isinstance(text, bytes) else (text or "").encode("utf-8", "surrogatepass")


def normal(line: str | bytes) -> bytes:
    """A line as it is compared: lower case (A-Z), white space joined, ends trimmed."""
    return b" ".join(_encoded(line).translate(_LOWER).split())


def _is_joined(text: bytes) -> bool:
    """White space is joined and trimmed already."""
    data = np.frombuffer(text, dtype=np.uint8)
    space = data == 32
    edge = space | (data == 10)
    ragged = (space[1:] & edge[:-1]).any() or (edge[1:] & space[:-1]).any()
    return not (ragged or text[:1] == b" " or text[-1:] == b" " or any(x in text for x in _RARE))


def normal_lines(text: str | bytes | None) -> list[bytes]:
    """All lines of a text as they are compared; blank ones are empty."""
    whole = _encoded(text).translate(_LOWER)
    if _is_joined(whole):
        return whole.split(b"\n")
    return [b" ".join(line.split()) for line in whole.split(b"\n")]


def line_hashes(lines: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join([blake2b(x, digest_size=8).digest() for x in lines]), dtype="<i8")


def shingles(lines: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All runs of ``SHINGLE`` bytes as 64-bit values, and the line of each; short lines are one run."""
    padded = [x if len(x) >= SHINGLE else x.ljust(SHINGLE, b"\0") for x in lines]
    if not padded:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    sizes = np.array([len(x) for x in padded], dtype=np.int64)
    data = b"".join(padded)
    every = np.ndarray((len(data) - SHINGLE + 1,), dtype="<u8", buffer=data, strides=(1,))
    inside = np.ones(len(every), dtype=bool)  # runs that reach into the next line are none
    inside[(np.cumsum(sizes)[:-1, None] - np.arange(1, SHINGLE)).ravel()] = False
    return every[inside], np.repeat(np.arange(len(lines)), sizes - SHINGLE + 1)


def _mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values, in place: two rounds, enough for minima of shingles."""
    h *= np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    return h


def _chunks(lines: list[bytes]) -> Iterator[list[bytes]]:
    """Lines in order, cut where about ``CHUNK`` bytes are reached."""
    ends = np.cumsum([len(x) for x in lines])
    cuts = np.flatnonzero(np.diff(ends // CHUNK)) + 1
    for start, end in zip([0, *cuts], [*cuts, len(lines)]):
        yield lines[start:end]


def band_keys(lines: list[bytes]) -> np.ndarray:
    """(lines, BANDS) keys from a one-permutation MinHash signature.

    Every shingle is hashed once: its hash picks a bin and competes there. An empty bin takes
    the value of the next filled one, marked with how far it was borrowed.
    """
    values, owner = shingles(lines)
    h = _mix(values)
    low = h.astype(np.uint32) & np.uint32(0xFFFFFFFE)
    h >>= np.uint64(32)
    h *= np.uint64(BINS)
    h >>= np.uint64(32)
    owner *= BINS
    owner += h.view(np.int64)
    table = np.full(len(lines) * BINS, 0xFFFFFFFF, dtype=np.uint32)
    np.minimum.at(table, owner, low)
    table = table.reshape(-1, BINS)
    filled = table != 0xFFFFFFFF
    signature = table.astype(np.uint64)
    short = np.flatnonzero(~filled.all(axis=1))
    here = np.where(np.tile(filled[short], 2), np.arange(2 * BINS), 2 * BINS)
    source = np.minimum.accumulate(here[:, ::-1], axis=1)[:, : -BINS - 1 : -1]  # from each bin on, the next filled one
    step = (source - np.arange(BINS)).astype(np.uint64)
    signature[short] = table[short[:, None], source % BINS].astype(np.uint64) + (step << np.uint64(32))
    key = np.tile(np.arange(1, BANDS + 1, dtype=np.uint64), (len(lines), 1))
    for row in range(ROWS):
        key = mix(key ^ signature[:, row::ROWS])
    return key.view(np.int64)


def _keys(parts: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Texts to (part, bands): the (key, line) of every line and band, once per task.

    Keys are hashes. Those with the same remainder by ``parts`` travel as one array.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in slices(batches, "text"):
            every = [x for text in utf8(batch.column("text")) for x in normal_lines(text) if x]
            new: dict[int, bytes] = {}
            for h, plain in zip(line_hashes(every).tolist(), every):
                if h not in seen:
                    seen.add(h)
                    new[h] = plain
            if len(seen) > SEEN:
                seen.clear()
            if new:
                keys = np.concatenate([band_keys(part) for part in _chunks(list(new.values()))]).ravel()
                bands = np.stack([keys, np.repeat(np.fromiter(new, np.int64, len(new)), BANDS)], axis=1)
                part = keys % parts
                order = np.argsort(part)
                part, first = np.unique(part[order], return_index=True)
                ends = pa.array(np.append(first, len(keys)) * bands[0].nbytes, pa.int32())
                data = pa.py_buffer(bands[order])
                packed = pa.BinaryArray.from_buffers(pa.binary(), len(part), [None, ends.buffers()[1], data])
                yield pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), packed], ["part", "bands"])

    return run


def _met(keys: np.ndarray, lines: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows in the order of (key, line), each once, without keys of one row."""
    order = np.argsort(keys)
    keys = keys[order]
    same = keys[1:] == keys[:-1]
    met = np.zeros(len(keys), dtype=bool)
    met[1:] |= same
    met[:-1] |= same
    keys, lines = keys[met], lines[order[met]]
    order = np.lexsort((lines, keys))
    keys, lines = keys[order], lines[order]
    once = np.ones(len(keys), dtype=bool)
    once[1:] = (keys[1:] != keys[:-1]) | (lines[1:] != lines[:-1])
    return keys[once], lines[once]


def _sizes(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each of sorted keys: where its run begins, and how long it is."""
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])[: len(keys)])
    sizes = np.diff(np.append(first, len(keys)))
    return np.repeat(first, sizes), np.repeat(sizes, sizes)


def _pairs(keys: np.ndarray, lines: np.ndarray, long: np.ndarray) -> pa.RecordBatch:
    """Rows from ``_met`` to pairs of lines of a key, a < b.

    A band of ``FULL`` lines or fewer gives all pairs, without its key. A longer one, or that of
    a ``long`` key, gives each line with the first and the one before it, with the key: all lines
    of it are in its pairs, so they are also its membership.
    """
    first, sizes = _sizes(keys)
    nth = np.arange(len(keys)) - first
    whole = (sizes <= FULL) & ~np.isin(keys, long)
    ends = [(at - back, at) for back in range(1, FULL) for at in [np.flatnonzero(whole & (nth >= back))]]
    settled = sum(len(at) for _, at in ends)
    rest, later = np.flatnonzero(~whole & (nth >= 1)), np.flatnonzero(~whole & (nth >= 2))
    ends += [(first[rest], rest), (later - 1, later)]
    a, b = (np.concatenate(x) for x in zip(*ends))
    key = pa.array(keys[b], mask=np.arange(len(b)) < settled)
    return pa.RecordBatch.from_arrays([key, pa.array(lines[a]), pa.array(lines[b])], ["key", "a", "b"])


def _band_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All bands of some keys, in any order, to the pairs of their lines, see ``_pairs``.

    What is held grows with the number of keys, not with that of a key's lines: where more than
    ``HELD`` of them have come, their pairs are given, and two are held, which tie the later
    lines to these.
    """
    held, long, full = np.zeros((0, 2), np.int64), np.zeros(0, np.int64), FULL_ROWS
    some: list[np.ndarray] = []
    rows = 0
    for batch in batches:
        some.append(np.frombuffer(b"".join(batch.column("bands").to_pylist()), dtype=np.int64).reshape(-1, 2))
        rows += len(some[-1])
        if rows <= full:
            continue
        held = np.unique(np.concatenate([held, *some]), axis=0)
        first, sizes = _sizes(held[:, 0])
        many = sizes > HELD
        if many.any():
            long = np.union1d(long, held[many, 0])
            yield _pairs(held[many, 0], held[many, 1], long)
            nth = np.arange(len(held)) - first
            held = held[~many | (nth == 0) | (nth == sizes - 1)]
        some, rows = [], len(held)
        full = max(FULL_ROWS, 2 * rows)
    held = np.concatenate([held, *some])
    yield _pairs(*_met(held[:, 0], held[:, 1]), long)


def _occurrences(docs: DataFrame) -> DataFrame:
    """Every line that is not blank: line (hash), doc_id, key (of the text), nth."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            of_text = [normal_lines(text) for text in utf8(batch.column("text"))]
            counts = [len(x) for x in of_text]
            every = [x for lines in of_text for x in lines]
            filled = np.flatnonzero([len(x) > 0 for x in every])
            nth = np.arange(len(every)) - np.repeat(np.cumsum(counts) - counts, counts)
            doc = pa.array(np.repeat(np.arange(len(counts)), counts)[filled])
            keys = pa.array(text_keys(batch.column("text"))).take(doc)
            hashes = pa.array(line_hashes([x for x in every if x]))
            yield pa.RecordBatch.from_arrays([hashes, batch.column("doc_id").take(doc), keys, pa.array(nth[filled], pa.int32())], ["line", "doc_id", "key", "nth"])

    ids = docs.where(F.col("doc_id").isNotNull()).select("doc_id", "text")
    return ids.mapInArrow(run, f"line long, doc_id {kind}, key long, nth int")


def _pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts with wanted line numbers to rows (line, words): the normalised lines."""
    for batch in slices(batches, PACKED):
        hashes, lines = [], []
        for packed, wanted in zip(batch.column(PACKED).to_pylist(), batch.column("wanted").to_pylist()):
            own = unpacked(packed).split(b"\n")
            for w in wanted:
                hashes.append(w["line"])
                lines.append(normal(own[w["nth"]]))
        yield pa.RecordBatch.from_arrays([pa.array(hashes, pa.int64()), pa.array(lines, pa.binary())], ["line", "words"])


def shingle_array(line: bytes) -> np.ndarray:
    """The distinct shingles of a line of ``SHINGLE`` bytes or more: their bytes as numbers, sorted."""
    runs = np.sort(np.ndarray((len(line) - SHINGLE + 1,), dtype="<u8", buffer=line, strides=(1,)))
    once = np.ones(len(runs), dtype=bool)
    np.not_equal(runs[1:], runs[:-1], out=once[1:])
    return runs[once]


def shingle_set(line: bytes) -> frozenset:
    """The distinct shingles of a line: their bytes as numbers, or the whole of a short line."""
    return frozenset([line] if len(line) < SHINGLE else shingle_array(line).tolist())


def sketches(lines: list[bytes]) -> np.ndarray:
    """(lines, SKETCH / 64) words: the bits that the shingles of each line are hashed to."""
    out = [np.zeros((0, SKETCH // 8), np.uint8)]
    for part in _chunks(lines) if lines else ():
        values, owner = shingles(part)
        values *= np.uint64(0x9E3779B97F4A7C15)
        values >>= np.uint64(65 - SKETCH.bit_length())
        owner *= SKETCH
        owner += values.view(np.int64)
        bits = np.zeros(len(part) * SKETCH, dtype=bool)
        bits[owner] = True
        out.append(np.packbits(bits.reshape(-1, SKETCH), axis=1))
    return np.concatenate(out).view(np.uint64)


def _runs(lines: list[bytes]) -> np.ndarray:
    """How many shingles each line has at most."""
    return np.array([max(1, len(x) - SHINGLE + 1) for x in lines], dtype=np.int64)


def may_link(a: np.ndarray, b: np.ndarray, runs: np.ndarray, percent: int) -> np.ndarray:
    """Which pairs of sketches can be of lines that are similar enough, ``runs`` shingles together.

    A bit in one sketch alone is a shingle in one set alone, and similar sets have few of those.
    """
    apart = np.bitwise_count(a ^ b).sum(axis=-1, dtype=np.int64)
    return (100 + percent) * apart <= (100 - percent) * runs


class Similar:
    """Whether lines are similar enough, on their full sets; each line's is made once."""

    def __init__(self, percent: int):
        self.percent = percent
        self.arrays: dict[int, np.ndarray] = {}

    def __call__(self, a: int, x: bytes, b: int, y: bytes) -> bool:
        """For the lines x, named a, and y, named b."""
        if min(len(x), len(y)) < SHINGLE:  # a short line is like itself alone
            return x == y
        for name, line in ((a, x), (b, y)):
            if name not in self.arrays:
                self.arrays[name] = shingle_array(line)
        few, many = sorted((self.arrays[a], self.arrays[b]), key=len)
        if 100 * len(few) < self.percent * len(many):
            return False
        both = np.concatenate([few, many])
        both.sort()
        shared = int(np.count_nonzero(both[1:] == both[:-1]))
        return 100 * shared >= self.percent * (len(both) - shared)


def _linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs with both lines to those that are similar enough on their full sets."""
    for batch in batches:
        names = np.concatenate([batch.column(c).to_numpy() for c in ("a", "b")])
        _, where, at = np.unique(names, return_index=True, return_inverse=True)  # many pairs of a batch have one line in common
        words = pa.concat_arrays([batch.column("words"), batch.column("words_b")]).take(pa.array(where)).to_pylist()
        a, b = at[: batch.num_rows], at[batch.num_rows :]
        bits, runs = sketches(words), _runs(words)
        keep = may_link(bits[a], bits[b], runs[a] + runs[b], PERCENT)
        similar = Similar(PERCENT)
        for i in np.flatnonzero(keep):
            keep[i] = similar(a[i], words[a[i]], b[i], words[b[i]])
        good = batch.filter(pa.array(keep))
        yield pa.RecordBatch.from_arrays([good.column("a"), good.column("b")], ["a", "b"])


def _packed(docs: DataFrame) -> DataFrame:
    """``docs`` with the text packed for a shuffle, and ``_key`` of the text."""
    fields = [f for f in docs.schema.fields if f.name != "text"]
    schema = StructType([*fields]).add(KEY, "long").add(PACKED, "binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            texts = batch.column("text")
            # null stays null
            packed = pa.array([None if t is None else pack(t) for t in utf8(texts)], pa.binary())
            names = [f.name for f in fields]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), pa.array(text_keys(texts)), packed], [*names, KEY, PACKED])

    return docs.mapInArrow(run, schema)


def line_components(docs: DataFrame, occurrences: DataFrame) -> DataFrame:
    """Rows (line, label) for lines linked with others: their component's label."""
    parts = max(PARTS, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    keys = docs.select("text").mapInArrow(_keys(parts), "part int, bands binary")
    bands = written(keys.repartition("part").mapInArrow(_band_pairs, "key long, a long, b long"), "line-bands")
    pairs = written(bands.select("a", "b").distinct(), "line-pairs")
    nodes = pairs.select(F.col("a").alias("line")).union(pairs.select("b")).distinct()
    wanted = lookup_join(occurrences, nodes, ["line"], "left_semi")
    wanted = wanted.groupBy("line").agg(F.min(F.struct("doc_id", "key", "nth")).alias("place")).select("line", "place.*")
    wanted = wanted.groupBy("doc_id", F.col("key").alias(KEY)).agg(F.collect_list(F.struct("line", "nth")).alias("wanted"))
    ids = docs.where(F.col("doc_id").isNotNull()).select("doc_id", "text")
    texts = _packed(ids).join(wanted, ["doc_id", KEY]).mapInArrow(_pick, "line long, words binary")
    texts = written(texts.dropDuplicates(["line"]), "lines")
    both = lookup_join(pairs.withColumn("line", F.col("a")), texts, ["line"], "inner").drop("line")
    both = lookup_join(both.withColumn("line", F.col("b")), texts.withColumnRenamed("words", "words_b"), ["line"], "inner").drop("line")
    labels = written(min_label(both.mapInArrow(_linked, "a long, b long")), "line-labels")
    return _joined(labels, _unsettled(bands.where("key is not null")), texts)


def _unsettled(bands: DataFrame) -> DataFrame:
    """Rows (value, node) of bands with three lines or more; bands of the same lines count once."""
    members = bands.select("key", F.explode(F.array("a", "b")).alias("node")).distinct()
    marks = [F.sum(F.xxhash64("node", F.lit(i)).cast("decimal(38,0)")).alias(f"mark{i}") for i in (1, 2)]
    of_key = members.groupBy("key").agg(F.count("*").alias("m"), *marks).where("m > 2")
    one = of_key.groupBy("m", "mark1", "mark2").agg(F.min("key").alias("key"))
    return lookup_join(members, one.select("key"), ["key"], "left_semi").select(F.col("key").alias("value"), "node")


def _sketched(packed: list[bytes]) -> list[tuple]:
    """Each line with its sketch and how many shingles it has at most."""
    return list(zip(sketches(packed), _runs(packed), packed))


def _partners(asking: list[tuple], own: list[tuple], percent: int) -> pa.RecordBatch:
    """Links (a, b) of asking lines to a block's own lines of other components, one each."""
    out: dict[tuple, tuple] = {}
    similar = Similar(percent)
    if own:
        label = np.array([r[3] for r in own])
        bits, runs = np.stack([r[5][0] for r in own]), np.array([r[5][1] for r in own])
        step = max(1, HELD // len(own))
        for low in range(0, len(asking), step):
            some = asking[low : low + step]
            together = np.array([r[5][1] for r in some])[:, None] + runs
            may = may_link(np.stack([r[5][0] for r in some])[:, None], bits, together, percent)
            may &= np.array([r[3] for r in some])[:, None] != label
            for i, k in zip(*np.nonzero(may)):
                r, other = some[i], own[k]
                if (r[2], other[3]) not in out and similar(r[2], r[5][2], other[2], other[5][2]):
                    out[r[2], other[3]] = (r[2], other[2])
    columns = list(zip(*out.values())) or [[], []]
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["a", "b"])


def _joined(labels: DataFrame, members: DataFrame, texts: DataFrame) -> DataFrame:
    """Components after the lines of a band outside its main one have met all others there."""
    found = residual_links(members, labels, texts.toDF("node", "packed"), _sketched, PERCENT, _partners).distinct()
    ends = labels.withColumnRenamed("label", "root")
    for end in ("a", "b"):  # links between lines to links between their components
        known = lookup_join(found.withColumn("node", F.col(end)), ends, ["node"], "left")
        found = known.withColumn(end, F.coalesce("root", end)).drop("node", "root")
    roots = written(min_label(found.distinct()), "line-roots").toDF("label", "root")
    old = lookup_join(labels, roots, ["label"], "left").select("node", F.coalesce("root", "label").alias("label"))
    # lines without a link before are their own component
    return old.union(lookup_join(roots.toDF("node", "label"), labels.select("node").distinct(), ["node"], "left_anti")).toDF("line", "label")


def dedupe_lines(docs: DataFrame) -> DataFrame:
    """All columns of ``docs`` with the repeated lines taken out of ``text``, and ``n_lines``, ``n_removed``.

    Lines are compared in lower case (A-Z) with white space joined. Equal lines, and lines
    whose sets of character shingles are 80 % alike, are linked; of every component of links
    the line with the smallest (doc_id, place) stays, all others go, in whatever document.
    Column names that begin with ``__patchloom`` are taken. A column ``n_chars``, if there is one, is brought up to date for changed texts.

    Blank lines stay where they are and count for nothing. Null text: null, with no lines.
    Null ids: such rows are left as they are and are nobody's first line. Identical rows keep
    the same lines. An empty table gives no rows.

    Two lines meet if they share a band. In a band of more than ``FULL`` lines, first each meets
    the band's first line and the one before it there, then the lines outside the band's main
    component meet all others of it. Recall is that of the banding, and the exact check leaves no false link.
    """
    prepared(docs.sparkSession)
    docs = docs.drop("n_lines", "n_removed")
    occurrences = written(_occurrences(docs), "line-occurrences")
    labels = line_components(docs, occurrences)
    counts = occurrences.groupBy("line").agg(F.count("*").alias("n")).where("n > 1")
    # other lines are once in the table and like no other
    repeated = counts.select("line", F.lit(None).cast("long").alias("label")).union(labels)
    repeated = repeated.groupBy("line").agg(F.coalesce(F.max("label"), F.col("line")).alias("label"))
    met = written(lookup_join(occurrences, repeated, ["line"], "inner").drop("line"), "line-repeats")
    keepers = met.groupBy("label").agg(F.min(F.struct("doc_id", "key", "nth")).alias("keeper"))
    met = lookup_join(met, keepers, ["label"], "inner")
    gone = met.where(F.struct("doc_id", "key", "nth") != F.col("keeper"))
    gone = gone.groupBy("doc_id", F.col("key").alias(KEY)).agg(F.collect_set("nth").alias(GONE))
    whole = _packed(docs).join(gone, ["doc_id", KEY], "left")
    fields = docs.schema.fields
    schema = StructType([StructField(f.name, f.dataType) for f in fields]).add("n_lines", "long").add("n_removed", "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, PACKED):
            texts, n_lines, n_removed = [], [], []
            for packed, nths in zip(batch.column(PACKED).to_pylist(), batch.column(GONE).to_pylist()):
                text = None if packed is None else unpacked(packed)
                lines = (text or b"").split(b"\n")
                n_lines.append(sum(1 for x in lines if x.strip(_BLANK)))
                n_removed.append(len(nths or ()))
                if nths:
                    out = set(nths)
                    text = b"\n".join(x for i, x in enumerate(lines) if i not in out)
                texts.append(text)
            made = {"text": pa.array(texts, pa.binary()).cast(pa.string()), "n_lines": pa.array(n_lines, pa.int64()), "n_removed": pa.array(n_removed, pa.int64())}
            yield pa.RecordBatch.from_arrays([made[n] if n in made else batch.column(n) for n in schema.names], schema.names)

    out = whole.mapInArrow(run, schema)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return out


def clean_lines(docs: DataFrame) -> DataFrame:
    """Documents with repeated lines taken out; those that had nothing else go."""
    out = dedupe_lines(docs)
    left = (F.col("n_removed") == 0) | (F.col("n_removed") < F.col("n_lines"))
    return out.where(left).select(*docs.columns)
