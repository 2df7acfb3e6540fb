"""Near-duplicate documents: bottom-k sketches, inverted lists, exact Jaccard, components."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patchloom.llm.common import min_label, pack, prepared, residual_links, slices, unpack, words_of, written
from patchloom.operators.scans import lookup_join

SHINGLE = 5  # words
PERCENT = 85  # 100 * intersection >= PERCENT * union, unless another percent is given
SKETCH = 64  # smallest hashes kept


def shingle_sets(texts: pa.Array) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text; a text of fewer words is one shingle."""
    words = words_of(texts, lower=True)
    gram, _ = words.grams(SHINGLE)
    out = []
    for low, high in zip(words.first[:-1].tolist(), words.first[1:].tolist()):
        if high - low >= SHINGLE:
            out.append(np.unique(gram[low : high - SHINGLE + 1]))
        elif high > low:
            whole = hashlib.blake2b(words.hash[low:high].tobytes(), digest_size=8).digest()
            out.append(np.frombuffer(whole, np.uint64))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def below(percent: int, deviations: int) -> float:
    """The part of a sketch's values that is so many standard deviations below ``percent``."""
    return percent / 100 - deviations * (percent * (100 - percent) / SKETCH) ** 0.5 / 100


def shared_part(percent: int) -> float:
    """Two sketches of a link share at least this part of their values.

    Fewest are shared where one set contains the other: each value of the larger one's sketch
    is then shared with the chance of the threshold, and this is five deviations below.
    """
    return below(percent, 5)


def least_estimate(percent: int) -> float:
    """A link's estimate from the union sketch is at least this (four deviations below)."""
    return below(percent, 4)


def linked(a: np.ndarray, b: np.ndarray, percent: int = PERCENT) -> bool:
    """Whether two full sets are similar enough."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both) > 0


def union_estimate(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard estimate from two sorted sketches: the shared part of the union's own sketch."""
    union = np.union1d(a, b)
    size = len(union) if max(len(a), len(b)) < SKETCH else SKETCH
    top = union[:size]
    both = np.intersect1d(a, b, assume_unique=True)
    return float(np.searchsorted(both, top[-1], side="right")) / len(top) if len(top) else 0.0


def sketches(docs: DataFrame) -> DataFrame:
    """Rows doc_id, n_shingles, set_id (128-bit digest of the set) and sketch (bytes of 64-bit values)."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            sets = shingle_sets(batch.column("text"))
            digests = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
            columns = [pa.array([len(s) for s in sets], pa.int64()), pa.array(digests, pa.binary()), pa.array([s[:SKETCH].tobytes() for s in sets], pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], ["doc_id", "n_shingles", "set_id", "sketch"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_shingles long, set_id binary, sketch binary")


def _values(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sketches to rows (value, node)."""
    for batch in batches:
        held = [np.frombuffer(s, np.int64) for s in batch.column("sketch").to_pylist()]
        sizes = np.array([len(h) for h in held], dtype=np.int64)
        node = batch.column("node").take(pa.array(np.repeat(np.arange(len(held)), sizes)))
        value = np.concatenate(held) if held else np.zeros(0, np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(value), node], ["value", "node"])


def inverted_lists(reps: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Rows (value, node, alone): the retained values under which a document is looked up.

    Two sketches of a link share at least ``shared_part`` of their values, so among the rarest
    of each, as many as the rest and one more, they must share one, whichever order is used if it is the same for
    all. The order here is how many documents retain a value: what is in the text of a third
    of the corpus comes last and is hardly ever a key. Values that one document alone has
    fill its rarest places without making a list. ``alone`` counts them.
    """
    kind = reps.schema["node"].dataType.simpleString()
    rows = reps.select("node", "sketch").mapInArrow(_values, f"value long, node {kind}")
    shared = rows.groupBy("value").agg(F.count("*").alias("df")).where("df > 1")
    met = lookup_join(rows, shared, ["value"], "inner")
    listed = met.groupBy("node").agg(F.array_sort(F.collect_list(F.struct("df", "value"))).alias("v"))
    size = F.least("n_shingles", F.lit(SKETCH))
    alone = (size - F.size("v")).alias("alone")
    keys = (size - F.floor(size * shared_part(percent)) + 1 - (size - F.size("v"))).cast("int")
    listed = listed.join(reps.select("node", "n_shingles"), "node").select("node", "n_shingles", alone, keys.alias("keys"), "v")
    return listed.where("keys > 0").select(F.explode(F.slice("v", 1, F.least(F.col("keys"), F.size("v")))).alias("e"), "node", "n_shingles", "alone").select("e.value", "node", "n_shingles", "alone")


def _similar_sizes(a, b, percent):
    return (F.col(a) * 100 >= F.col(b) * percent) & (F.col(b) * 100 >= F.col(a) * percent)


def _estimated(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Pairs with both sketches to those whose union sketch lets them be a link."""
    for batch in batches:
        keep = [
            union_estimate(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)) >= least_estimate(percent)
            for x, y in zip(batch.column("sketch").to_pylist(), batch.column("sketch_b").to_pylist())
        ]
        both = batch.filter(pa.array(keep, pa.bool_()))
        yield pa.RecordBatch.from_arrays([both.column("a"), both.column("b")], ["a", "b"])


def _verified(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Pairs with both texts to those that are links on their full sets."""
    for batch in batches:
        for at in range(0, batch.num_rows, 64):
            part = batch.slice(at, 64)
            texts = [unpack(p) for c in ("packed", "packed_b") for p in part.column(c).to_pylist()]
            sets = shingle_sets(pa.array(texts, pa.large_string()))
            keep = [linked(x, y, percent) for x, y in zip(sets[: part.num_rows], sets[part.num_rows :])]
            good = part.filter(pa.array(keep, pa.bool_()))
            yield pa.RecordBatch.from_arrays([good.column("a"), good.column("b")], ["a", "b"])


def links(pairs: DataFrame, texts: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Exact check of pairs (a, b) on the texts (node, packed) of both."""
    kind = pairs.schema["a"].dataType.simpleString()
    left = lookup_join(pairs.withColumn("node", F.col("a")), texts, ["node"], "inner").drop("node")
    right = lookup_join(left.withColumn("node", F.col("b")), texts.withColumnRenamed("packed", "packed_b"), ["node"], "inner").drop("node")
    return right.mapInArrow(lambda batches: _verified(batches, percent), f"a {kind}, b {kind}")


def _packed_sets(packed: list[bytes]) -> list[np.ndarray]:
    return shingle_sets(pa.array([unpack(p) for p in packed], pa.large_string()))


def near_duplicates(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Per document: doc_id, n_shingles, component_id (smallest id reachable), kept.

    Two documents are linked if their shingle sets are at least ``percent`` % alike (Jaccard).
    Documents with one set are one class, represented by its smallest id. Classes are looked
    up in inverted lists of retained values. First every list compares its members with one
    centre, the member with the fewest values of its own: union sketches filter, full sets
    decide. What that joins needs no more comparing. Then the members of a list that lie
    outside its main component are compared with all others of the list, on full sets, so no
    partner is left out, and no list emits all its pairs. Components are found by stars.

    Null, empty and blank texts have no shingles and are linked with nothing. Null ids: counted
    but linked with nothing, component_id null, kept. Rows that share an id are one document
    for linking. An empty table gives no rows. Other columns are ignored.
    """
    prepared(docs.sparkSession)
    marks = written(sketches(docs), "sketches")
    usable = marks.where(F.col("doc_id").isNotNull() & F.col("set_id").isNotNull())
    classes = usable.groupBy("set_id").agg(F.min("doc_id").alias("node"))
    first = usable.select("set_id", F.col("doc_id").alias("node"), "n_shingles", "sketch")
    reps = lookup_join(first, classes, ["set_id", "node"], "left_semi").dropDuplicates(["set_id"])
    reps = written(reps.select("node", "n_shingles", "sketch"), "representatives")
    lists = written(inverted_lists(reps, percent), "lists")

    centre = lists.groupBy("value").agg(F.min(F.struct("alone", "node", F.col("n_shingles").alias("n"))).alias("c"), F.count("*").alias("m")).where("m > 1")
    centre = centre.select("value", F.col("c.node").alias("centre"), F.col("c.n").alias("n_centre"))
    star = lookup_join(lists, centre, ["value"], "inner").where((F.col("node") != F.col("centre")) & _similar_sizes("n_shingles", "n_centre", percent))
    star = star.select(F.least("node", "centre").alias("a"), F.greatest("node", "centre").alias("b")).distinct()
    sketch = reps.select("node", "sketch")
    both = lookup_join(star.withColumn("node", F.col("a")), sketch, ["node"], "inner").drop("node")
    both = lookup_join(both.withColumn("node", F.col("b")), sketch.withColumnRenamed("sketch", "sketch_b"), ["node"], "inner").drop("node")
    kind = docs.schema["doc_id"].dataType.simpleString()
    candidates = written(both.mapInArrow(lambda batches: _estimated(batches, percent), f"a {kind}, b {kind}"), "candidates")

    texts = written(_texts(docs, lists.select("node").distinct()), "texts")
    found = written(links(candidates, texts, percent), "links")
    labels = written(min_label(found), "labels")
    residual = written(residual_links(lists, labels, texts, _packed_sets, percent).distinct(), "residual")
    found = found.union(residual)
    labels = min_label(found)

    own = lookup_join(usable.select("doc_id", "set_id"), classes, ["set_id"], "inner")
    # a row stands for its class; the edge also ties rows that share an id
    settled = own.select("doc_id", "node").distinct()
    settled = lookup_join(settled, labels.select("node", "label"), ["node"], "left")
    settled = settled.groupBy("doc_id").agg(F.min(F.coalesce("label", "node")).alias("_component"))
    whole = lookup_join(marks.select("doc_id", "n_shingles"), settled, ["doc_id"], "left")
    component = F.coalesce("_component", "doc_id")
    kept = F.coalesce(component == F.col("doc_id"), F.lit(True))
    return whole.select("doc_id", "n_shingles", component.alias("component_id"), kept.alias("kept"))


def _texts(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Packed texts of some documents: rows (node, packed), one per node."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            packed = pa.array([pack(t) for t in batch.column("text").to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), packed], ["node", "packed"])

    blobs = docs.select("doc_id", "text").mapInArrow(run, f"node {kind}, packed binary")
    return lookup_join(blobs, nodes, ["node"], "left_semi").dropDuplicates(["node"])


def drop_near_duplicates(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """One document of each component stays, with all its columns; rows without an id stay."""
    gone = near_duplicates(docs, percent).where(~F.col("kept")).select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)
