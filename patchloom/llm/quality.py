"""A quality classifier: histogram gradient-boosted trees over document statistics."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from patchloom.llm.common import prepared, range_hash, raw_bytes, slices, words_of

CUT = 0.7
# Labelled rows the trees are fitted on, at most: those with the smallest hash of their id.
TRAIN_ROWS = 20_000

STATISTICS = (
    "log_bytes log_words word_bytes long_words upper digit space other high exclaim symbol bar "
    "stop comma repeat_word distinct_words top_word distinct_lines top_line line_bytes end_mark distinct_grams"
).split()


def statistics(texts: pa.Array) -> np.ndarray:
    """One row of ``STATISTICS`` per text; all zero for a null, empty or blank one."""
    data, offsets = raw_bytes(texts)
    n_docs = len(offsets) - 1
    out = np.zeros((n_docs, len(STATISTICS)), dtype=np.float32)
    words = words_of(texts)
    sizes = np.diff(offsets)
    n_words = np.diff(words.first)
    some = n_words > 0
    if not some.any():
        return out
    doc = np.repeat(np.arange(n_docs), n_words)
    length = words.end - words.start
    per_byte, per_word = 1.0 / np.maximum(sizes, 1), 1.0 / np.maximum(n_words, 1)

    def share(table: str | list[int]) -> np.ndarray:
        wanted = np.zeros(256, dtype=np.int64)
        wanted[[ord(c) for c in table] if isinstance(table, str) else table] = 1
        sums = np.concatenate([[0], np.cumsum(wanted[data])])
        return (sums[offsets[1:]] - sums[offsets[:-1]]) * per_byte

    def mean(values: np.ndarray) -> np.ndarray:
        return np.bincount(doc, weights=values, minlength=n_docs) * per_word

    def distinct(owner: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distinct values, and rows of the most frequent one, per text, as shares."""
        if not len(owner):
            return np.zeros(n_docs), np.zeros(n_docs)
        order = np.lexsort((hashes, owner))
        o, h = owner[order], hashes[order]
        new = np.ones(len(o), dtype=bool)
        new[1:] = (o[1:] != o[:-1]) | (h[1:] != h[:-1])
        begin = np.flatnonzero(new)
        run = np.diff(np.append(begin, len(o)))
        top = np.zeros(n_docs)
        np.maximum.at(top, o[begin], run)
        each = np.maximum(np.bincount(owner, minlength=n_docs), 1)
        return np.bincount(o[begin], minlength=n_docs) / each, top / each

    same = np.zeros(len(doc))
    same[1:] = (words.hash[1:] == words.hash[:-1]) & (doc[1:] == doc[:-1])
    gram, inside = words.grams(3)
    line = np.flatnonzero(data == 10)
    begin = np.unique(np.concatenate([offsets[:-1][sizes > 0], line + 1]))
    begin = begin[begin < len(data)]
    end = np.append(begin[1:], len(data))
    line_hash = range_hash(data.astype(np.uint64) + np.uint64(1), begin, end, 0x9E3779B97F4A7C15)
    owner = np.searchsorted(offsets, begin, side="right") - 1
    n_lines = np.maximum(np.bincount(owner, minlength=n_docs), 1)
    last = np.maximum(end - 1 - (data[end - 1] == 10), begin)
    marks = np.isin(data[last], np.frombuffer(b".?!", np.uint8))
    final = data[words.end - 1]
    columns = [
        np.log1p(sizes),
        np.log1p(n_words),
        mean(length),
        mean(length > 14),
        share(list(range(65, 91))),
        share(list(range(48, 58))),
        share(" \t\n\r"),
        share("/\\<>{}[]=_+~^@"),
        share(list(range(128, 256))),
        share("!"),
        share("#$%&*"),
        share("|"),
        mean(length <= 3),
        mean((final == ord(",")) | (final == ord("."))),
        mean(same),
        *distinct(doc, words.hash),
        *distinct(owner, line_hash),
        np.log1p(np.bincount(owner, weights=end - begin, minlength=n_docs) / n_lines),
        np.bincount(owner, weights=marks, minlength=n_docs) / n_lines,
        distinct(doc[: len(gram)][inside], gram[inside])[0],
    ]
    out[:] = np.stack(columns, axis=1)
    out[~some] = 0
    return out


@dataclass
class Trees:
    """Boosted trees as flat arrays: tree t's node i is at t * width + i, children at 2i+1, 2i+2."""

    feature: np.ndarray
    cut: np.ndarray
    value: np.ndarray
    width: int
    depth: int
    base: float

    def score(self, rows: np.ndarray) -> np.ndarray:
        """Probabilities: all rows walk all trees at once, one level a step."""
        n_trees = len(self.feature) // self.width
        total = np.full(len(rows), self.base)
        at = np.arange(len(rows))
        for tree in range(n_trees):
            node = np.zeros(len(rows), dtype=np.int64)
            shift = tree * self.width
            for _ in range(self.depth):
                right = rows[at, self.feature[shift + node]] > self.cut[shift + node]
                node = 2 * node + 1 + right
            total += self.value[shift + node]
        return 1.0 / (1.0 + np.exp(-total))


def fit_trees(
    rows: np.ndarray,
    labels: np.ndarray,
    *,
    n_trees: int = 60,
    depth: int = 4,
    bins: int = 64,
    rate: float = 0.15,
    l2: float = 1.0,
    least: int = 8,
) -> Trees:
    """Second-order boosting of logistic loss on binned columns.

    A node's gradient and weight sums per bin are one ``bincount``; the split is the best
    cut between bins. Without rows, or with one class only, the base rate alone is learnt.
    """
    width = 2 ** (depth + 1) - 1
    share = (labels.sum() + 0.5) / (len(labels) + 1.0)
    base = float(np.log(share / (1 - share)))
    empty = Trees(np.zeros(0, np.int64), np.zeros(0, np.float32), np.zeros(0), width, depth, base)
    if not len(labels) or labels.min() == labels.max():
        return empty
    n_cols = rows.shape[1]
    cuts = [np.unique(np.quantile(rows[:, c], np.linspace(0, 1, bins + 1)[1:-1], method="lower")) for c in range(n_cols)]
    codes = np.stack([np.searchsorted(cuts[c], rows[:, c], side="left") for c in range(n_cols)], axis=1)
    margin = np.full(len(labels), base)
    parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for _ in range(n_trees):
        p = 1.0 / (1.0 + np.exp(-margin))
        grad, weight = labels - p, p * (1 - p)
        feature = np.zeros(width, dtype=np.int64)
        cut = np.full(width, np.inf, dtype=np.float32)
        value = np.zeros(width)
        members = {0: np.arange(len(labels))}
        for node in range(2**depth - 1):
            own = members.pop(node)
            left, right = own, own[:0]
            if len(own) >= 2 * least:
                best, at = 1e-6, None
                g_all, w_all = grad[own].sum(), weight[own].sum()
                for c in range(n_cols):
                    code = codes[own, c]
                    g = np.cumsum(np.bincount(code, grad[own], bins))[:-1]
                    w = np.cumsum(np.bincount(code, weight[own], bins))[:-1]
                    n = np.cumsum(np.bincount(code, minlength=bins))[:-1]
                    gain = g**2 / (w + l2) + (g_all - g) ** 2 / (w_all - w + l2) - g_all**2 / (w_all + l2)
                    gain[(n < least) | (len(own) - n < least)] = 0
                    k = int(gain.argmax())
                    if gain[k] > best:
                        best, at = gain[k], (c, k)
                if at:
                    feature[node], cut[node] = at[0], cuts[at[0]][at[1]]
                    goes = codes[own, at[0]] > at[1]
                    left, right = own[~goes], own[goes]
            members[2 * node + 1], members[2 * node + 2] = left, right
        for node, own in members.items():
            value[node] = rate * grad[own].sum() / (weight[own].sum() + l2) if len(own) else 0.0
            margin[own] += value[node]
        parts.append((feature, cut, value))
    joined = [np.concatenate(p) for p in zip(*parts)]
    return Trees(*joined, width, depth, base)


def held_out(doc_id: str = "doc_id"):
    """Rows whose labels are never learnt from."""
    return F.crc32(F.col(doc_id).cast("string")) % 4 == 2


def train(docs: DataFrame, labels: DataFrame, *, rows: int = TRAIN_ROWS) -> Trees:
    """Fit on at most ``rows`` labelled documents that are not held out.

    The bound makes the training set small enough for one process whatever the corpus: the
    labelled ids with the smallest hashes are sent to the documents, and statistics alone
    come back. Null ids or labels are not learnt from; an id labelled twice counts once, with
    its larger label.
    """
    usable = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & ~held_out())
    usable = usable.groupBy("doc_id").agg(F.max("quality").alias("_label"))
    chosen = F.broadcast(usable.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows))
    texts = docs.select("doc_id", "text").join(chosen, "doc_id").select("doc_id", "text", "_label")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            stats = statistics(batch.column("text"))
            flat = pa.array(stats.ravel())
            lists = pa.FixedSizeListArray.from_arrays(flat, len(STATISTICS)).cast(pa.list_(pa.float32()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("_label").cast(pa.int32()), lists], ["doc_id", "label", "stats"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    found = texts.mapInArrow(run, f"doc_id {kind}, label int, stats array<float>")
    found = found.orderBy("doc_id").limit(rows).toPandas()
    stats = np.array(found["stats"].tolist(), dtype=np.float32).reshape(-1, len(STATISTICS))
    return fit_trees(stats, found["label"].to_numpy(dtype=np.float64))


def score_quality(docs: DataFrame, labels: DataFrame, *, cut: float = CUT, rows: int = TRAIN_ROWS) -> DataFrame:
    """All columns of ``docs`` plus held_out, score (0 to 1) and predicted (1 from ``cut`` on).

    A score depends on the text alone. Null and empty texts are scored like any other, from
    statistics that are all zero. Columns of ``docs`` called held_out, score or predicted are
    replaced. Repeated rows get equal scores. An empty table gives no rows, and without usable
    labels every score is one half.
    """
    spark = prepared(docs.sparkSession)
    trees = spark.sparkContext.broadcast(train(docs, labels, rows=rows))
    docs = docs.drop("held_out", "score", "predicted")
    schema = StructType([*docs.schema.fields, StructField("score", DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            score = trees.value.score(statistics(batch.column("text")))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(score)], [*batch.schema.names, "score"])

    scored = docs.mapInArrow(run, schema)
    return scored.withColumns({"held_out": held_out(), "predicted": (F.col("score") >= cut).cast("int")})
