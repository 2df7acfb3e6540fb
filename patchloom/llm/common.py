"""What the operators of this subpackage share: written tables, word arrays, components.

Python code here runs inside Spark tasks on Arrow batches. It holds one slice of a batch at
a time (about two million bytes of text, or one longer document), so memory in a task does
not grow with the table.
"""

from __future__ import annotations

import tempfile
import uuid
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cache
from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from patchloom.operators.scans import lookup_join
from patchloom.session import tune

SLICE_BYTES = 2_000_000
BLOCK = 2000  # members of one list that one task holds
ASKING = 256  # members compared with those at a time
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 9, 10, 11, 12, 13]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_BASE, _SEQ = 0x9E3779B97F4A7C15, 0xD1342543DE82EF95
_PRIME = (1 << 61) - 1


def prepared(spark: SparkSession) -> SparkSession:
    """The session with the settings these operators are written for."""
    tune(spark)
    # rows of a batch are whole documents: fewer of them than Spark's default
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    return spark


_LOCAL: dict[str, str] = {}  # folders of local sessions that name none


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share; a temporary one only in a local session without it."""
    base = spark.conf.get("spark.checkpoint.dir", None) or _LOCAL.get(spark.sparkContext.applicationId)
    if base:
        return base.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    base = tempfile.mkdtemp(prefix="patchloom-")
    _LOCAL[spark.sparkContext.applicationId] = base
    return base


def written(df: DataFrame, name: str) -> DataFrame:
    """Write a table into the shared folder and read it back: lineage ends here.

    A lost executor then costs a read. The folder is new for every call and stays until
    the cluster clears its checkpoint folder.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def slices(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that one slice holds about ``SLICE_BYTES`` of a text column."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0)
        ends = np.cumsum(sizes.to_numpy(zero_copy_only=False), dtype=np.int64)
        at = 0
        while at < batch.num_rows:
            before = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, before + SLICE_BYTES, side="right")))
            yield batch.slice(at, to - at)
            at = to


def raw_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and the offsets of its rows; null counts as empty."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    texts = pa.concat_arrays([texts])  # own buffers, offsets from the first row on
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    whole = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


_61, _29, _32 = np.uint64(61), np.uint64(29), np.uint64(32)
_MOD, _LOW29, _LOW32 = np.uint64(_PRIME), np.uint64((1 << 29) - 1), np.uint64((1 << 32) - 1)
_CHUNK = 1 << 15  # values multiplied at a time: what a step needs stays in the cache


def _reduced(x: np.ndarray) -> np.ndarray:
    """64-bit values modulo 2**61 - 1."""
    x = (x & _MOD) + (x >> _61)
    return np.where(x >= _MOD, x - _MOD, x)


def _product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a * b modulo 2**61 - 1, of reduced values, from products of halves."""
    low_a, high_a, low_b, high_b = a & _LOW32, a >> _32, b & _LOW32, b >> _32
    low, middle = low_a * low_b, low_a * high_b + high_a * low_b
    total = (high_a * high_b << np.uint64(3)) + (middle >> _29) + ((middle & _LOW29) << _32)
    return _reduced(total + (low >> _61) + (low & _MOD))


_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**61 - 1 for i < n, kept between batches."""
    have = _POWERS.get(base)
    if have is None or len(have[0]) < n:
        size = max(n, 1 << 16)
        both = []
        for b in (base % _PRIME, pow(base, -1, _PRIME)):
            col = np.ones(size, dtype=np.uint64)
            done = 1
            while done < size:
                more = min(done, size - done)
                col[done : done + more] = _product(col[:more], np.uint64(pow(b, done, _PRIME)))
                done += more
            both.append(col)
        have = _POWERS[base] = (both[0], both[1])
        if size > 1 << 23:  # a very long document: do not keep its tables
            del _POWERS[base]
    return have


def range_hash(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int) -> np.ndarray:
    """A hash of each run values[start:end] that depends on its content alone.

    A polynomial in ``base`` modulo the prime 2**61 - 1, from sums over prefixes. (Modulo a
    power of two, sequences as simple as Thue and Morse's collide for every base.)
    """
    forth, back = _powers(base, len(values) + 1)
    high, low = np.zeros(len(values) + 1, dtype=np.uint64), np.zeros(len(values) + 1, dtype=np.uint64)
    for at in range(0, len(values), _CHUNK):
        to = min(at + _CHUNK, len(values))
        terms = _product(_reduced(values[at:to]), forth[at:to])
        np.cumsum(terms >> _32, out=high[at + 1 : to + 1])
        np.cumsum(terms & _LOW32, out=low[at + 1 : to + 1])
        high[at + 1 : to + 1] += high[at]
        low[at + 1 : to + 1] += low[at]
    out = np.empty(len(starts), dtype=np.uint64)
    for at in range(0, len(starts), _CHUNK):
        s, e = starts[at : at + _CHUNK], ends[at : at + _CHUNK]
        h, rest = high[e] - high[s], low[e] - low[s]
        total = (h >> _29) + ((h & _LOW29) << _32) + (rest & _MOD) + (rest >> _61)
        out[at : at + _CHUNK] = mix(_product(_reduced(total), back[s]))
    return out


@dataclass
class Words:
    """Words of several texts: byte ranges in ``data``, the text each is in, and a hash each."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray  # of each text, the index of its first word; one more at the end
    hash: np.ndarray

    def grams(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all runs of ``n`` words by first word, and which of them are in one text."""
        count = len(self.start) - n + 1
        if count <= 0:
            return np.zeros(0, np.uint64), np.zeros(0, bool)
        at = np.arange(count)
        inside = np.ones(count, dtype=bool)
        for back in range(1, n):  # a run must not cross the first word of another text
            cut = self.first[1:-1] - back
            inside[cut[(cut >= 0) & (cut < count)]] = False
        return range_hash(self.hash, at, at + n, _SEQ), inside


def words_of(texts: pa.Array, lower: bool = False) -> Words:
    """Words ``[^\\x20\\x09-\\x0D]+`` of every text."""
    data, offsets = raw_bytes(texts)
    if lower:
        data = LOWER[data]
    if not len(data):
        none = np.zeros(0, np.int64)
        return Words(data, none, none, np.zeros(len(offsets), np.int64), np.zeros(0, np.uint64))
    word = ~_SPACE[data]
    edge = np.zeros(len(data) + 1, dtype=bool)  # a text begins or ends before this byte
    edge[offsets] = True
    before = np.empty(len(data), dtype=bool)
    before[0], before[1:] = False, word[:-1]
    after = np.empty(len(data), dtype=bool)
    after[-1], after[:-1] = False, word[1:]
    start = np.flatnonzero(word & (~before | edge[:-1]))
    end = np.flatnonzero(word & (~after | edge[1:])) + 1
    hashes = range_hash(data.astype(np.uint64) + np.uint64(1), start, end, _BASE)
    return Words(data, start, end, np.searchsorted(start, offsets), hashes)


def min_label(edges: DataFrame, rounds: int = 100) -> DataFrame:
    """Connected components of edges (a, b): rows (node, label), the smallest node reachable.

    Large-star and small-star in turn: every node's larger neighbours are hung on its
    smallest neighbour, then its smaller ones. Each step is one aggregate per node and a
    join of that back to the edges, so a node with very many edges is spread over tasks
    like any hot key. Each round is written to the shared folder; it ends when a round
    changes nothing. Self-loops are allowed, null ends are dropped.
    """
    now = edges.where("a is not null and b is not null")
    now = written(now.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    seen = None
    for _ in range(rounds):
        both = now.union(now.select("b", "a"))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        larger = lookup_join(both.where("b > a"), least, ["a"], "inner")
        star = larger.select(F.col("b").alias("a"), F.col("m").alias("b")).where("a > b").distinct()
        least = star.groupBy("a").agg(F.min("b").alias("m"))
        smaller = lookup_join(star, least, ["a"], "inner")
        star = smaller.select("b", F.col("m").alias("c")).where("b > c").toDF("a", "b")
        star = star.union(least.select("a", F.col("m").alias("b"))).distinct()
        now = written(star, "edges")
        mark = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == seen:
            break
        seen = mark
    else:
        raise RuntimeError(f"components were not settled after {rounds} rounds")
    roots = now.select(F.col("b").alias("node")).distinct().withColumn("label", F.col("node"))
    return now.toDF("node", "label").union(roots)


def shared_counts(asking: list[np.ndarray], own: list[np.ndarray]) -> np.ndarray:
    """Intersection sizes of every asking set with every own set.

    Only values of both sides matter. Each becomes a column of two 0/1 matrices whose product
    counts them, some thousand columns at a time.
    """
    ask_flat, own_flat = np.concatenate(asking), np.concatenate(own)
    values = np.intersect1d(ask_flat, own_flat)
    out = np.zeros((len(asking), len(own)), dtype=np.float32)
    ask_row, own_row = (np.repeat(np.arange(len(x)), [len(v) for v in x]) for x in (asking, own))

    def columns(flat, row):
        at = np.minimum(np.searchsorted(values, flat), max(len(values) - 1, 0))
        hit = values[at] == flat if len(values) else np.zeros(len(flat), bool)
        return at[hit], row[hit]

    (ask_at, ask_row), (own_at, own_row) = columns(ask_flat, ask_row), columns(own_flat, own_row)
    for low in range(0, len(values), 4096):
        pair = []
        for at, row, n in ((ask_at, ask_row, len(asking)), (own_at, own_row, len(own))):
            part = (at >= low) & (at < low + 4096)
            m = np.zeros((n, min(4096, len(values) - low)), dtype=np.float32)
            m[row[part], at[part] - low] = 1
            pair.append(m)
        out += pair[0] @ pair[1].T
    return out.astype(np.int64)


def _partners(asking: list[tuple], own: list[tuple], percent: int) -> pa.RecordBatch:
    """Links (a, b) of asking members to a block's own members of other components, one each."""
    out: dict[tuple, tuple] = {}
    if own:
        size = np.array([len(r[5]) for r in own])
        label = np.array([r[3] for r in own])
        both = shared_counts([r[5] for r in asking], [r[5] for r in own])
        for r, shared in zip(asking, both):
            good = (100 * shared >= percent * (size + len(r[5]) - shared)) & (label != r[3])
            for k in np.flatnonzero(good):
                out[r[2], int(label[k])] = (r[2], own[k][2])
    columns = list(zip(*out.values())) or [[], []]
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["a", "b"])


def residual_links(lists: DataFrame, labels: DataFrame, texts: DataFrame, sets_of: Callable[[list[bytes]], list], percent: int, partners: Callable[[list[tuple], list[tuple], int], pa.RecordBatch] = _partners) -> DataFrame:
    """Links (a, b) between components whose members meet in a list, on full sets.

    ``lists`` has rows (value, node), ``labels`` the components known so far, ``texts`` the
    packed text of each node. The members of a list outside its main component are compared
    with all others of the list, so no partner is left out. A list is held in blocks of
    ``BLOCK`` members; those that look for partners come to every block and stream past it,
    ``ASKING`` at a time. For each of them, one link to a component is enough. ``partners``
    finds them among members of which ``sets_of`` has made what it compares.
    """
    kind = lists.schema["node"].dataType.simpleString()
    known = lookup_join(lists, labels, ["node"], "left").withColumn("label", F.coalesce("label", "node"))
    groups = known.groupBy("value", "label").agg(F.count("*").alias("m"))
    main = groups.groupBy("value").agg(F.max_by("label", F.struct("m", F.col("label"))).alias("main"), F.count("*").alias("parts"), F.sum("m").alias("m"))
    mixed = lookup_join(known, main.where("parts > 1"), ["value"], "inner")
    mixed = lookup_join(mixed, texts, ["node"], "inner")
    n_blocks = F.ceil(F.col("m") / BLOCK).cast("int")
    row = ["value", "node", "label"]
    own = mixed.select(*row, F.pmod(F.xxhash64("node"), n_blocks).cast("int").alias("block"), F.lit(False).alias("asks"), "packed")
    asking = mixed.where(F.col("label") != F.col("main"))
    asking = asking.select(*row, F.explode(F.sequence(F.lit(0), n_blocks - 1)).alias("block"), F.lit(True).alias("asks"), "packed")
    dealt = own.unionByName(asking).repartition("value", "block").sortWithinPartitions("value", "block", "asks")

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows sorted by (value, block, asks): a block's own members first, then those that ask."""

        def rows():
            for batch in batches:
                for at in range(0, batch.num_rows, ASKING):
                    part = batch.slice(at, ASKING)
                    sets = sets_of(part.column("packed").to_pylist())
                    yield from zip(*(part.column(c).to_pylist() for c in ("value", "block", "node", "label", "asks")), sets)

        for _, group in groupby(rows(), key=lambda r: r[:2]):
            own_rows, some = [], []
            for member in group:
                (some if member[4] else own_rows).append(member)
                if len(some) == ASKING:
                    yield partners(some, own_rows, percent)
                    some = []
            if some:
                yield partners(some, own_rows, percent)

    return dealt.mapInArrow(compared, f"a {kind}, b {kind}")


@cache
def _zstd() -> tuple[zstandard.ZstdCompressor, zstandard.ZstdDecompressor]:
    """One pair of contexts per Python worker: making them costs more than a short text."""
    return zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()


def utf8(texts: pa.Array) -> list[bytes | None]:
    """The texts of a column as bytes."""
    return texts.cast(pa.large_binary() if pa.types.is_large_string(texts.type) else pa.binary()).to_pylist()


def pack(text: str | bytes | None) -> bytes:
    """A text compressed for a shuffle; null counts as empty."""
    return _zstd()[0].compress(text if isinstance(text, bytes) else (text or "").encode())


def unpacked(packed: bytes) -> bytes:
    return _zstd()[1].decompress(packed)


def unpack(packed: bytes) -> str:
    return unpacked(packed).decode()


def text_keys(texts: pa.Array) -> np.ndarray:
    """A 31-bit checksum of each text: tells rows apart that share an id."""
    return np.array([zlib.crc32(t or b"") >> 1 for t in utf8(texts)], dtype=np.int64)
