"""Alignment of two tokenizers over the same bytes, by products of sparse incidence matrices.

A token's row of an incidence matrix marks the bytes it covers, or the group it is in. With
both tokenizers over one axis of bytes, the product A * B' has an entry for every pair of
tokens that overlap. Matrices are compressed by rows and multiplied row by row (Gustavson):
a row of the product is the sum of the right side's rows that the left row marks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patchloom.llm import bytepair
from patchloom.llm.common import prepared, slices, written
from patchloom.operators.scans import lookup_join

BLOCK_LINKS = 1_500_000  # distinct (document, pair) entries that a block of documents holds
PRODUCT_TERMS = 500_000  # terms of a product worked on at a time
TOGETHER = 64  # texts whose new words are worked out together
COUNTS = ("n_a", "n_b", "n_groups", "n_links", "n_group_links")


@dataclass
class Csr:
    """A sparse matrix by rows: row i has columns ``indices[indptr[i]:indptr[i + 1]]``."""

    indptr: np.ndarray
    indices: np.ndarray
    data: np.ndarray
    width: int

    @property
    def height(self) -> int:
        return len(self.indptr) - 1

    def transpose(self) -> Csr:
        order = np.argsort(self.indices, kind="stable")
        rows = np.repeat(np.arange(self.height), np.diff(self.indptr))
        ends = np.cumsum(np.bincount(self.indices, minlength=self.width))
        return Csr(np.concatenate([[0], ends]), rows[order], self.data[order], self.height)

    def terms(self, other: Csr) -> np.ndarray:
        """How many terms each row of the product with ``other`` sums: the symbolic phase.

        Where no two terms fall on one column, that is the number of entries of the row.
        """
        before = np.concatenate([[0], np.cumsum(np.diff(other.indptr)[self.indices])])
        return before[self.indptr[1:]] - before[self.indptr[:-1]]

    def times(self, other: Csr) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Entries (row, column, value) of the product, some rows at a time, in order."""
        upto = np.cumsum(self.terms(other))
        low = 0
        while low < self.height:
            done = upto[low - 1] if low else 0
            high = max(low + 1, int(np.searchsorted(upto, done + PRODUCT_TERMS, side="right")))
            own = slice(self.indptr[low], self.indptr[high])
            marked = self.indices[own]
            size = other.indptr[marked + 1] - other.indptr[marked]
            row = np.repeat(np.repeat(np.arange(low, high), np.diff(self.indptr[low : high + 1])), size)
            at = np.repeat(other.indptr[marked] - (np.cumsum(size) - size), size) + np.arange(len(row))
            column, value = other.indices[at], np.repeat(self.data[own], size) * other.data[at]
            key = row * np.int64(other.width) + column
            if np.any(key[1:] < key[:-1]):
                order = np.argsort(key, kind="stable")
                key, row, column, value = key[order], row[order], column[order], value[order]
            if len(key):
                first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
                yield row[first], column[first], np.add.reduceat(value, first)
            low = high


def byte_incidence(sizes: np.ndarray) -> Csr:
    """Tokens by bytes, for tokens that follow one another without a gap."""
    ends = np.concatenate([[0], np.cumsum(sizes)])
    return Csr(ends, np.arange(ends[-1]), np.ones(ends[-1], np.int64), int(ends[-1]))


def group_incidence(sizes: np.ndarray, cuts: np.ndarray) -> Csr:
    """Tokens by groups; ``cuts`` are the offsets where groups end, the last token's end included."""
    group = np.searchsorted(cuts, np.cumsum(sizes))
    return Csr(np.arange(len(sizes) + 1), group, np.ones(len(sizes), np.int64), len(cuts))


class PieceEncoder:
    """Ids of a sentencepiece model, with the bytes of each piece."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = map(self.model.id_to_piece, range(self.model.get_piece_size()))
        self.tokens = [
            bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else b"" if self.model.is_control(i) else p.replace("▁", " ").encode()
            for i, p in enumerate(pieces)
        ]

    def encode(self, texts: list[str]) -> list[bytes | None]:
        """Ids as little-endian 32-bit values; None where their bytes are not space + text."""
        out = []
        for text, ids in zip(texts, self.model.encode(texts, num_threads=1)):
            exact = b"".join(map(self.tokens.__getitem__, ids)) == b" " + text.encode()
            out.append(np.array(ids, dtype="<u4").tobytes() if exact else None)
        return out


@dataclass
class Aligned:
    """Texts of a batch over one axis of bytes: both token rows, where each text's begin, links."""

    ids: tuple[np.ndarray, np.ndarray]
    first: tuple[np.ndarray, np.ndarray]  # per text, its first token; one more at the end
    incidence: tuple[Csr, Csr]
    groups: tuple[Csr, Csr]
    cuts: np.ndarray
    text_ends: np.ndarray

    def links(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(A token, B token, bytes shared) of every overlap: the product A * B'."""
        return self.incidence[0].times(self.incidence[1].transpose())

    def group_links(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(A token, B token, 1) of every pair in one group. Quadratic where tokens never meet."""
        return self.groups[0].times(self.groups[1].transpose())


class Aligner:
    """Encodes texts by both tokenizers: space + text by A, text by B, which adds the space."""

    def __init__(self, path_a: str, path_b: str):
        self.a = bytepair.encoder(path_a, special=False)
        self.b = PieceEncoder(path_b)
        self.sizes = tuple(np.array([len(t) for t in e.tokens], dtype=np.int64) for e in (self.a, self.b))
        most = max(map(len, self.sizes))
        self.decimals = pa.array(map(str, range(most)), pa.string())

    def align(self, texts: list[str | None]) -> Aligned:
        ids_b = [ids if text and ids else b"" for text, ids in zip(texts, self.b.encode([t or "" for t in texts]))]
        plain = [" " + text if b else "" for text, b in zip(texts, ids_b)]
        ids_a = [ids for at in range(0, len(plain), TOGETHER) for ids in self.a.plain(plain[at : at + TOGETHER])]
        ids = tuple(np.frombuffer(b"".join(x), dtype="<u4").astype(np.int64) for x in (ids_a, ids_b))
        first = tuple(np.cumsum([0, *map(len, x)]) // 4 for x in (ids_a, ids_b))
        size_a, size_b = (s[i] for s, i in zip(self.sizes, ids))
        ends = np.concatenate([[0], np.cumsum(size_a)])
        cuts = np.intersect1d(ends[1:], np.cumsum(size_b), assume_unique=True)
        groups = group_incidence(size_a, cuts), group_incidence(size_b, cuts)
        return Aligned(ids, first, (byte_incidence(size_a), byte_incidence(size_b)), groups, cuts, ends[first[0]])

    def group_texts(self, found: Aligned) -> tuple[np.ndarray, list[str]]:
        """Per text, how many groups it has and their ids as ``a1,a2|b1;a3|b2,b3``."""
        sides = []
        for ids, groups in zip(found.ids, found.groups):
            by_group = groups.transpose()
            lists = pa.ListArray.from_arrays(pa.array(by_group.indptr, pa.int32()), self.decimals.take(pa.array(ids[by_group.indices])))
            sides.append(pc.binary_join(lists, ","))
        ends = np.searchsorted(found.cuts, found.text_ends, side="right")
        ends[0] = 0
        whole = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pc.binary_join_element_wise(*sides, "|"))
        return np.diff(ends), pc.binary_join(whole, ";").to_pylist()


_ALIGNERS: dict[tuple[str, str], Aligner] = {}


def aligner(path_a: str, path_b: str) -> Aligner:
    """One aligner per pair of files, kept while the worker lives."""
    key = (path_a, path_b)
    if key not in _ALIGNERS:
        _ALIGNERS[key] = Aligner(path_a, path_b)
    return _ALIGNERS[key]


def link_rows(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """One row per overlap: doc_id, a_place, a_id, b_place, b_id, bytes shared.

    Places count a text's tokens from 0. Texts without tokens (see ``align_documents``) have no row.
    """
    prepared(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "a_place", "a_id", "b_place", "b_id", "shared"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            found = aligner(path_a, path_b).align(batch.column("text").to_pylist())
            (ids_a, ids_b), (first_a, first_b) = found.ids, found.first
            for a, b, shared in found.links():
                doc = np.searchsorted(first_a, a, side="right") - 1
                columns = [a - first_a[doc], ids_a[a], b - first_b[doc], ids_b[b], shared]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(pa.array(doc)), *map(pa.array, columns)], names)

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, a_place long, a_id long, b_place long, b_id long, shared long")


class _Block:
    """Documents gathered to a block, their link entries as numbers of the block's own pairs."""

    def __init__(self):
        self.rows: list[pa.StructArray] = []
        self.keys: list[np.ndarray] = []
        self.times: list[np.ndarray] = []
        self.held: list[np.ndarray] = []

    def __len__(self) -> int:
        return sum(map(len, self.keys))

    def add(self, rows: pa.StructArray, doc: np.ndarray, pair: np.ndarray) -> None:
        """``rows`` are documents, (doc, pair) their links, a pair as often as it is linked."""
        order = np.lexsort((pair, doc))
        doc, pair = doc[order], pair[order]
        new = np.ones(len(doc), dtype=bool)
        new[1:] = (doc[1:] != doc[:-1]) | (pair[1:] != pair[:-1])
        first = np.flatnonzero(new)
        self.rows.append(rows)
        self.keys.append(pair[first])
        self.times.append(np.diff(np.append(first, len(doc))).astype(np.int32))
        self.held.append(np.bincount(doc[first], minlength=len(rows)))

    def batch(self, number: int) -> pa.RecordBatch:
        pairs, at, docs = np.unique(np.concatenate(self.keys), return_inverse=True, return_counts=True)
        held = np.concatenate(self.held).astype(np.int32)
        step = np.diff(at, prepend=0).astype(np.int32)  # near numbers: small steps pack well
        packed = zstandard.ZstdCompressor(level=1).compress(held.tobytes() + step.tobytes() + np.concatenate(self.times).tobytes())
        rows = pa.concat_arrays(self.rows)
        whole = pa.ListArray.from_arrays(pa.array([0, len(rows)], pa.int32()), rows)
        values = [pa.array([number]), whole, pa.array([packed], pa.binary()), pa.array([pairs], pa.list_(pa.int64())), pa.array([docs], pa.list_(pa.int64()))]
        return pa.RecordBatch.from_arrays(values, ["block", "rows", "entries", "pairs", "docs"])


def unpacked(entries: bytes, n_rows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Entries per row, the pair of each entry by its number in the block, how often it is linked."""
    values = np.frombuffer(zstandard.ZstdDecompressor().decompress(entries), dtype=np.int32)
    held, rest = values[:n_rows].astype(np.int64), values[n_rows:]
    return held, np.cumsum(rest[: len(rest) // 2], dtype=np.int64), rest[len(rest) // 2 :].astype(np.int64)


def link_blocks(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Documents in blocks: (block, rows, entries, pairs, docs), one row per block.

    ``rows`` holds the columns of the documents, ``pairs`` the block's distinct id pairs
    (a * 2**32 + b) with the number of its documents that hold each, ``entries`` the links of
    the documents by pair. A block ends at ``BLOCK_LINKS`` entries, so its size is bounded by
    that and one slice of text.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, block = TaskContext.get().partitionId() << 32, _Block()
        for batch in slices(batches, "text"):
            align = aligner(path_a, path_b)
            found = align.align(batch.column("text").to_pylist())
            links = [(a, b) for a, b, _ in found.links()]
            a, b = (np.concatenate([x[i] for x in links] or [np.zeros(0, np.int64)]) for i in (0, 1))
            doc = np.searchsorted(found.first[0], a, side="right") - 1
            n_groups, texts = align.group_texts(found)
            in_group = np.concatenate([[0], np.cumsum(found.groups[0].terms(found.groups[1].transpose()))])
            n_group_links = in_group[found.first[0][1:]] - in_group[found.first[0][:-1]]
            n_links = np.bincount(doc, minlength=batch.num_rows)
            counts = [*(np.diff(f) for f in found.first), n_groups, n_links, n_group_links]
            digests = [hashlib.sha256(t.encode()).hexdigest() if t else "" for t in texts]
            columns = [batch.column("doc_id"), *(pa.array(c.astype(np.int64)) for c in counts), pa.array(digests, pa.string())]
            block.add(pa.StructArray.from_arrays(columns, ["doc_id", *COUNTS, "groups_sha256"]), doc, found.ids[0][a] << 32 | found.ids[1][b])
            if len(block) >= BLOCK_LINKS:
                yield block.batch(number)
                number, block = number + 1, _Block()
        if block.rows:
            yield block.batch(number)

    fields = "".join(f"{c}:bigint," for c in COUNTS)
    schema = f"block long, rows array<struct<doc_id:{kind},{fields}groups_sha256:string>>, entries binary, pairs array<bigint>, docs array<bigint>"
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def _pair_totals(in_blocks: DataFrame) -> DataFrame:
    totals = in_blocks.groupBy("pair").agg(F.sum("n").alias("n_docs")).withColumn("a_id", F.shiftright("pair", 32))
    best = totals.groupBy("a_id").agg(F.max("n_docs").alias("most"))
    return lookup_join(totals, best, ["a_id"], "inner").select("pair", "n_docs", (F.col("n_docs") == F.col("most")).alias("best"))


def _in_blocks(blocks: DataFrame) -> DataFrame:
    each = blocks.select("block", F.explode(F.arrays_zip("pairs", "docs")).alias("p"))
    return each.select("block", F.col("p.pairs").alias("pair"), F.col("p.docs").alias("n"))


def pair_counts(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Id pairs linked anywhere: a_id, b_id, n_docs that hold the pair linked, best of its A id."""
    prepared(docs.sparkSession)
    totals = _pair_totals(_in_blocks(written(link_blocks(docs, path_a, path_b), "links")))
    return totals.select(F.shiftright("pair", 32).alias("a_id"), F.col("pair").bitwiseAND((1 << 32) - 1).alias("b_id"), "n_docs", "best")


def align_documents(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256, n_group_links.

    Links are overlaps of an A and a B token; a pair's count is the number of documents that
    hold it linked; ``n_best`` counts links whose count is the highest of their A id. Groups
    end where both tokenizers have a token's end. ``n_group_links`` counts the pairs that
    share a group without making them: where tokens hardly ever meet they are quadratic.

    Texts go to tasks once. A task counts the pairs of a block of documents; only those
    counts are shuffled, summed, and sent back to the blocks that hold the pair, so what moves
    grows with the distinct pairs of blocks, not with links, and a pair that all documents
    hold is one row per block.

    Null or empty texts, and texts that a tokenizer doesn't give back byte by byte (a literal
    U+2581), have no tokens: zeros, and an empty ``groups_sha256``. Every row counts as a
    document, repeated and null ids included. Other columns are ignored.
    """
    prepared(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    blocks = written(link_blocks(docs, path_a, path_b), "links")
    in_blocks = _in_blocks(blocks)
    back = lookup_join(in_blocks.select("block", "pair"), _pair_totals(in_blocks), ["pair"], "inner")

    def summed(block: pa.Table, totals: pa.Table) -> pa.Table:
        totals = totals.sort_by("pair")
        n_docs, best = (totals.column(c).to_numpy().astype(np.int64) for c in ("n_docs", "best"))
        rows = pa.concat_arrays([c.flatten() for c in block.column("rows").chunks])
        held, at, times = unpacked(block.column("entries")[0].as_py(), len(rows))
        ends = np.concatenate([[0], np.cumsum(held)])
        sums = []
        for weight in (best, n_docs):
            before = np.concatenate([[0], np.cumsum(times * weight[at])])
            sums.append(pa.array(before[ends[1:]] - before[ends[:-1]]))
        field = dict(zip([f.name for f in rows.type], rows.flatten())) | dict(zip(("n_best", "count_sum"), sums))
        return pa.table({n: field[n] for n in names})

    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "n_group_links"]
    schema = f"doc_id {kind}, " + ", ".join(f"{n} {'string' if n == 'groups_sha256' else 'long'}" for n in names[1:])
    own = blocks.select(F.col("block").alias("number"), "rows", "entries")
    return own.groupBy("number").cogroup(back.groupBy("block")).applyInArrow(summed, schema)
