"""Benchmark decontamination: CGK embedding, bit-sampling LSH and exact edit verification."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patchloom.llm.common import mix, prepared, slices, words_of

SIMILARITY = 0.8  # one less the edits per word of the item
WALKS = 6  # random walks
SAMPLES = 8  # bit samples of each walk
BITS = 2  # positions in a sample
# Items of more words are sampled at one position: walks of long items with all their edits
# agree in too few places for two, and a window with a seed is seldom there by chance.
LONG_ITEM = 40
# Items in one pass, at most: what goes to the tasks is bounded, a larger benchmark takes more passes.
PASS_ITEMS = 20_000

_PAD = np.uint64(0)


def allowed(n_words: int) -> int:
    """Edits an item of so many words may have."""
    return int(n_words * (1 - SIMILARITY) + 1e-9)


def embed(rows: np.ndarray, steps: int, walk: int) -> np.ndarray:
    """CGK embedding of rows of word hashes (padded with 0), ``steps`` long.

    The walk writes the word it stands on and moves on when a random bit, drawn per step and
    word, says so. Where two sequences differ by k edits, their walks fall into step again
    soon after each, so edit distance becomes Hamming distance. Rows past their end stay there.
    """
    n, width = rows.shape
    padded = np.concatenate([rows, np.full((n, 1), _PAD)], axis=1)
    at, line = np.zeros(n, dtype=np.int64), np.arange(n)
    out = np.empty((n, steps), dtype=np.uint64)
    keys = mix(np.arange(1, steps + 1, dtype=np.uint64) + np.uint64((walk + 1) << 32))
    for step in range(steps):
        word = padded[line, at]
        out[:, step] = word
        at = np.minimum(at + (mix(word ^ keys[step]) & np.uint64(1)).astype(np.int64), width)
    return out


def sampled(embedded: np.ndarray, lengths: np.ndarray, walk: int) -> np.ndarray:
    """LSH values of embedded rows: (rows, SAMPLES), each from ``BITS`` places of the walk, or one.

    Places are drawn within the three steps a word that a walk of that length takes at most,
    leaning to the front, where walks are still in step.
    """
    draw = np.random.default_rng(walk + 1).random((SAMPLES, BITS))
    value = np.zeros((len(embedded), SAMPLES), dtype=np.uint64)
    line = np.arange(len(embedded))[:, None]
    short = (lengths <= LONG_ITEM)[:, None]
    for bit in range(BITS):
        place = (draw[None, :, bit] * 2 * lengths[:, None]).astype(np.int64)
        drawn = mix(value ^ embedded[line, place]) + place.astype(np.uint64)
        value = drawn if bit == 0 else np.where(short, drawn, value)
    return value


@dataclass
class Items:
    """A bounded part of the benchmark: word hashes, seeds and LSH values."""

    ids: list
    words: np.ndarray  # (items, width), padded
    lengths: np.ndarray
    seeds: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]  # q -> sorted hashes, item, place
    keys: list[np.ndarray]  # per walk (items, SAMPLES)

    @staticmethod
    def of(ids: list, texts: list[str]) -> Items:
        found = words_of(pa.array(texts, pa.string()), lower=True)
        lengths = np.diff(found.first)
        width = int(lengths.max(initial=0))
        words = np.zeros((len(ids), width), dtype=np.uint64)
        for i, n in enumerate(lengths):
            words[i, :n] = found.hash[found.first[i] : found.first[i] + n]
        grams: dict[int, list[tuple[int, int, int]]] = {}
        hashed = {q: found.grams(q) for q in {seed_words(int(n)) for n in lengths if n}}
        for i, n in enumerate(lengths):
            if n:
                q = seed_words(int(n))
                for j in range(n - q + 1):
                    grams.setdefault(q, []).append((int(hashed[q][0][found.first[i] + j]), i, j))
        seeds = {}
        for q, rows in grams.items():
            rows.sort()
            seeds[q] = (np.array([r[0] for r in rows], np.uint64), np.array([r[1] for r in rows]), np.array([r[2] for r in rows]))
        keys = [sampled(embed(words, 3 * max(width, 1), w), lengths, w) for w in range(WALKS)]
        return Items(ids, words, lengths, seeds, keys)


def seed_words(n_words: int) -> int:
    """Words in a row that any allowed set of edits must leave untouched somewhere."""
    edits = allowed(n_words)
    return -(-(n_words - edits) // (edits + 1))


def align(item: np.ndarray, text: np.ndarray) -> tuple[int, int, int]:
    """Fewest word edits from the item to any run of the text: (edits, start, end)."""
    cost = np.zeros(len(text) + 1, dtype=np.int64)
    begin = np.arange(len(text) + 1)
    ramp = np.arange(len(text) + 1)
    for i, word in enumerate(item):
        step = np.empty_like(cost)
        origin = np.empty_like(begin)
        step[0], origin[0] = i + 1, 0
        swap, drop = cost[:-1] + (text != word), cost[1:] + 1
        step[1:] = np.minimum(swap, drop)
        origin[1:] = np.where(swap <= drop, begin[:-1], begin[1:])
        # words added between: the running minimum of step - place, plus place
        low = np.minimum.accumulate(step - ramp)
        source = np.maximum.accumulate(np.where(step - ramp == low, ramp, 0))
        cost, begin = low + ramp, origin[source]
    end = int(cost.argmin())
    return int(cost[end]), int(begin[end]), end


def matches(texts: pa.Array, items: Items) -> Iterator[tuple[int, int, int, int, int]]:
    """(text, item, first word, words, edits) of every pair within the allowed edits, the best place of each.

    A window as long as the item is looked at wherever the text has ``seed_words`` of its words
    in a row: no allowed occurrence can be without such a place. Windows that share an LSH
    value with the item are verified exactly over the window and its margins.
    """
    words = words_of(texts, lower=True)
    places: list[np.ndarray] = []
    for q, (seeds, item_of, offset) in items.seeds.items():
        gram, inside = words.grams(q)
        low = np.searchsorted(seeds, gram, side="left")
        hit = np.flatnonzero(inside & (low < len(seeds)))
        hit = hit[seeds[low[hit]] == gram[hit]]
        if not len(hit):
            continue
        n = np.searchsorted(seeds, gram[hit], side="right") - low[hit]
        at = np.repeat(hit, n)
        row = np.repeat(low[hit], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        places.append(np.stack([at - offset[row], item_of[row], at]))
    if not places:
        return
    start, item, seed = np.concatenate(places, axis=1)
    doc = np.searchsorted(words.first, seed, side="right") - 1
    _, keep = np.unique(np.stack([start, item, doc]), axis=1, return_index=True)
    start, item, doc = start[keep], item[keep], doc[keep]
    low, high = words.first[doc], words.first[doc + 1]
    for part in np.array_split(np.arange(len(start)), -(-len(start) // 4096)):
        near = _candidates(words.hash, start[part], item[part], low[part], high[part], items)
        best: dict[tuple[int, int], tuple[int, int, int]] = {}
        for k in part[near]:
            length = int(items.lengths[item[k]])
            edits = allowed(length)
            a, b = max(int(low[k]), int(start[k]) - edits), min(int(high[k]), int(start[k]) + length + edits)
            cost, first, end = align(items.words[item[k], :length], words.hash[a:b])
            if cost <= edits:
                found = (cost, a + first - int(low[k]), end - first)
                pair = int(doc[k]), int(item[k])
                best[pair] = min(best.get(pair, found), found)
        for (d, i), (cost, first, n) in best.items():
            yield d, i, first, n, cost


def _candidates(hashes, start, item, low, high, items: Items) -> np.ndarray:
    """Which item-sized windows share an LSH value with their item, in any walk and sample."""
    width = items.words.shape[1]
    at = start[:, None] + np.arange(width)[None, :]
    inside = (at >= low[:, None]) & (at < high[:, None]) & (np.arange(width)[None, :] < items.lengths[item][:, None])
    rows = np.where(inside, hashes[np.clip(at, 0, len(hashes) - 1)], _PAD)
    # a window that begins before the text begins with it
    short = np.clip(low - start, 0, width)
    for k in np.flatnonzero(short):
        rows[k] = np.concatenate([rows[k, short[k] :], np.full(short[k], _PAD)])
    near = np.zeros(len(start), dtype=bool)
    for walk in range(WALKS):
        keys = sampled(embed(rows, 3 * max(width, 1), walk), items.lengths[item], walk)
        near |= (keys == items.keys[walk][item]).any(axis=1)
    return near


def find_contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Benchmark items found in documents: doc_id, item_id, start_word, n_words, edits, similarity.

    Words are compared in lower case (A-Z). An item is found where a run of the document's
    words is at most 20 % edits (words put in, left out or exchanged) away from it; the row
    tells the best place. Documents without a find give no row.

    The benchmark goes to the tasks in passes of a bounded number of items, so the documents
    stay where they are read and nothing is shuffled. Null, empty and blank texts and items
    match nothing, items with a null id are reported with it, repeated rows are reported each.
    A pair may come twice only if it is in the tables twice.
    """
    spark = prepared(docs.sparkSession)
    texts = docs.select("doc_id", "text")
    items = benchmark.select("item_id", "text").where(F.col("text").isNotNull())
    passes = max(1, -(-items.count() // PASS_ITEMS))
    doc_kind, item_kind = (d.schema[c].dataType.simpleString() for d, c in ((docs, "doc_id"), (benchmark, "item_id")))
    schema = f"doc_id {doc_kind}, item_id {item_kind}, start_word long, n_words long, edits long, similarity double"
    out = None
    for i in range(passes):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(passes)) == i).orderBy("item_id", "text").collect()
        held = spark.sparkContext.broadcast(Items.of([r.item_id for r in rows], [r.text for r in rows]))
        found = texts.mapInArrow(_search(held), schema)
        out = found if out is None else out.unionByName(found)
    return out


def _search(held):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = held.value
        item_ids = pa.array(items.ids) if items.ids else pa.array([], pa.int64())
        for batch in slices(batches, "text"):
            best: dict[tuple[int, int], tuple] = {}
            for d, i, first, n, cost in matches(batch.column("text"), items):
                best[d, i] = min(best.get((d, i), (cost, first, n)), (cost, first, n))
            if best:
                pairs, found = list(best), list(best.values())
                doc = batch.column("doc_id").take(pa.array([d for d, _ in pairs]))
                item = item_ids.take(pa.array([i for _, i in pairs]))
                likeness = [1 - f[0] / int(items.lengths[i]) for (_, i), f in zip(pairs, found)]
                numbers = [pa.array([f[k] for f in found], pa.int64()) for k in (1, 2, 0)]
                yield pa.RecordBatch.from_arrays([doc, item, *numbers, pa.array(likeness, pa.float64())], ["doc_id", "item_id", "start_word", "n_words", "edits", "similarity"])

    return run


def clean_documents(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Documents in which no benchmark item is found, all columns.

    The finds are a few ids; documents are compared with them by id. Rows that share the id of
    a contaminated row go with it; rows with a null id are kept only if no such row was found.
    """
    bad = find_contamination(docs, benchmark).select(F.col("doc_id").alias("_bad")).distinct()
    return docs.join(bad, docs["doc_id"].eqNullSafe(bad["_bad"]), "left_anti")
