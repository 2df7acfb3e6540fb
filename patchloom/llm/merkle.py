"""Document fingerprints: Merkle trees over sections, paragraphs and pieces of paragraphs."""

from __future__ import annotations

import hashlib
import zlib
from bisect import bisect_left
from collections import Counter, defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patchloom.llm.common import pack, prepared, slices, unpack

# A piece ends after a word whose checksum is 0 modulo the first, or with so many words.
PIECE_ENDS, PIECE_WORDS = 4, 12
SECTION_ENDS = 8  # a paragraph ends its section when its hash is 0 modulo this


def _hash(data: bytes, size: int = 8) -> str:
    return hashlib.blake2b(data, digest_size=size).hexdigest()


def _pieces(words: list[bytes]) -> list[str]:
    """Short hashes of the runs of words of a paragraph."""
    out, start = [], 0
    for i, word in enumerate(words, 1):
        if zlib.crc32(word) % PIECE_ENDS == 0 or i - start == PIECE_WORDS or i == len(words):
            out.append(hashlib.blake2b(b" ".join(words[start:i]), digest_size=4).hexdigest())
            start = i
    return out


def fingerprint(text: str | None) -> str:
    """A text's tree as one string: ``root|section[paragraph(pieces)...]...``.

    A paragraph is a line; a section ends after a paragraph whose own hash says so, so an
    insertion moves no later border. Paragraphs hash their exact text, sections the hashes
    of their paragraphs, the root those of its sections: two texts have one root when they
    are equal. Below a paragraph, runs of a few words have short hashes, so that long
    paragraphs can be compared in part; words say where a run ends, so a word put in changes
    the run it is in and seldom another. Null counts as empty.
    """
    sections, paragraphs, hashes = [], [], b""

    def close() -> None:
        nonlocal paragraphs, hashes
        if paragraphs:
            sections.append((_hash(hashes), paragraphs))
            paragraphs, hashes = [], b""

    for line in (text or "").encode("utf-8", "surrogatepass").split(b"\n"):
        own = hashlib.blake2b(line, digest_size=8)
        paragraphs.append(f"{own.hexdigest()}({''.join(_pieces(line.split()))})")
        hashes += own.digest()
        if own.digest()[-1] % SECTION_ENDS == 0:
            close()
    close()
    root = _hash("".join(s for s, _ in sections).encode(), 16)
    return root + "|" + "".join(f"{s}[{''.join(p)}]" for s, p in sections)


def parse(mark: str) -> tuple[str, list[tuple[str, list[tuple[str, list[str]]]]]]:
    """Root and sections; a section is its hash and paragraphs, a paragraph its hash and pieces."""
    root, _, rest = mark.partition("|")
    sections = []
    for part in rest.split("]")[:-1]:
        head, _, body = part.partition("[")
        paragraphs = []
        for one in body.split(")")[:-1]:
            own, _, pieces = one.partition("(")
            paragraphs.append((own, [pieces[i : i + 8] for i in range(0, len(pieces), 8)]))
        sections.append((head, paragraphs))
    return root, sections


def _ranks(values: list[int]) -> list[int]:
    """Length of the longest rising sequence that ends at each value."""
    tails: list[int] = []
    out = []
    for v in values:
        at = bisect_left(tails, v)
        tails[at : at + 1] = [v]
        out.append(at + 1)
    return out


def _settled(one: list[str], other: list[str]) -> set[int]:
    """Places of ``one`` that every longest common order with ``other`` keeps.

    Equal entries are matched in turn. What is moved is in no longest order, and of entries that
    changed places neither is in all of them, so both count as moved.
    """
    where = defaultdict(list)
    for j in reversed(range(len(other))):
        where[other[j]].append(j)
    pairs = [(i, where[x].pop()) for i, x in enumerate(one) if where[x]]
    ahead = _ranks([j for _, j in pairs])
    behind = _ranks([-j for _, j in reversed(pairs)])[::-1]
    longest = max(ahead, default=0)
    kept = [k for k in range(len(pairs)) if ahead[k] + behind[k] - 1 == longest]
    alone = Counter(ahead[k] for k in kept)
    return {pairs[k][0] for k in kept if alone[ahead[k]] == 1}


def differing_paragraphs(one: str, other: str) -> list[int]:
    """Places of paragraphs of ``one`` that ``other`` lacks or has in another place.

    Goes down only into sections that differ or were moved.
    """
    (root, sections), (other_root, other_sections) = parse(one), parse(other)
    if root == other_root:
        return []
    heads, other_heads = [s for s, _ in sections], [s for s, _ in other_sections]
    closed, other_closed = _settled(heads, other_heads), _settled(other_heads, heads)
    places, own, at = [], [], 0
    for k, (_, paragraphs) in enumerate(sections):
        if k not in closed:
            places += range(at, at + len(paragraphs))
            own += [p for p, _ in paragraphs]
        at += len(paragraphs)
    rest = [p for k, (_, ps) in enumerate(other_sections) if k not in other_closed for p, _ in ps]
    same = _settled(own, rest)
    return [place for k, place in enumerate(places) if k not in same]


def likeness(one: str, other: str) -> float:
    """Twice the shared pieces over all pieces (0 to 1), from the fingerprints alone."""
    (root, sections), (other_root, other_sections) = parse(one), parse(other)
    if root == other_root:
        return 1.0
    a, b = (Counter(x for _, ps in part for _, pieces in ps for x in pieces) for part in (sections, other_sections))
    total = sum(a.values()) + sum(b.values())
    return 2.0 * sum((a & b).values()) / total if total else 0.0


def fingerprint_documents(docs: DataFrame) -> DataFrame:
    """All columns of ``docs`` plus ``fingerprint``, of the whole text; a column so called is replaced."""
    prepared(docs.sparkSession)
    docs = docs.drop("fingerprint")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            marks = pa.array([fingerprint(t) for t in batch.column("text").to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, marks], [*batch.schema.names, "fingerprint"])

    return docs.mapInArrow(run, docs.select("*", F.lit("").alias("fingerprint")).schema)


def edit_report(docs: DataFrame, *, blocks: int | None = None) -> DataFrame:
    """Fingerprints of every document and of its text with the second half exchanged.

    The edited text keeps all but the last floor(n/2) code points and takes as many of the
    beginning of the next document, in descending order of doc_id; the first follows the
    last. Columns: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next.

    Neighbours meet without a sort of the whole table in one task: actual ids at even
    quantiles cut the order into ranges, and the document that begins a range (its largest
    id) is also sent to the range before it, which ends by looking at it. Texts move once.
    ``blocks`` is the number of ranges (shuffle partitions by default); each is a partition.
    Ids are numbers.

    Null text: empty. Rows with one id are ordered by text. Rows with null ids come last in
    the descending order. A single document is its own next. An empty table gives no rows.
    """
    spark = prepared(docs.sparkSession)
    blocks = blocks or int(spark.conf.get("spark.sql.shuffle.partitions"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    schema = f"doc_id {kind}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    shares = [i / blocks for i in range(1, blocks)]
    ends = docs.agg(F.percentile_approx("doc_id", F.array(*map(F.lit, [*shares, 1.0])), 10_000).alias("q"), F.count(F.when(F.col("doc_id").isNull(), 1)).alias("nulls")).first()
    cuts = sorted(set(ends.q or []))
    # place 0 holds null ids, place j ids in (cuts[j-2], cuts[j-1]]; a larger place comes first
    id_column = F.col("doc_id")
    place = F.when(id_column.isNull(), 0)
    bounds = F.array(*map(F.lit, cuts)) if cuts else F.array().cast(f"array<{kind}>")
    # the number of cuts below an id, by binary search
    steps = F.array(*[F.lit(1 << i) for i in reversed(range(max(1, len(cuts).bit_length())))])
    below = F.aggregate(steps, F.lit(0), lambda at, n: F.when(F.get(bounds, at + n - 1) < id_column, at + n).otherwise(at))
    place = place.otherwise(below + 1)
    lowest, highest = (0 if ends.nulls or not cuts else 1), len(cuts)
    own = docs.select("doc_id", "text").withColumns({"_place": place.cast("int"), "_ahead": F.lit(False)})
    # the largest of a range (one id, any rows that share it) is looked at by the range above it
    above = F.when(F.col("_place") == highest, lowest).otherwise(F.col("_place") + 1)
    is_head = F.coalesce(F.get(bounds, F.col("_place") - 1) == id_column, F.lit(False))
    heads = own.where(is_head).withColumns({"_place": above.cast("int"), "_ahead": F.lit(True)})
    if ends.nulls and cuts:  # range 1 is followed by the null ids
        none = own.where("_place = 0").groupBy().agg(F.min("text").alias("text"), F.max(F.when(F.col("text").isNull(), 1)).alias("_null"))
        none = none.select(F.lit(None).cast(kind).alias("doc_id"), F.when(F.col("_null").isNull(), F.col("text")).alias("text"), F.lit(1).alias("_place"), F.lit(True).alias("_ahead"))
        heads = heads.union(none)
    elif not cuts:
        none = own.groupBy().agg(F.min("text").alias("text"), F.max(F.when(F.col("text").isNull(), 1)).alias("_null"), F.count("*").alias("_n")).where("_n > 0")
        none = none.select(F.lit(None).cast(kind).alias("doc_id"), F.when(F.col("_null").isNull(), F.col("text")).alias("text"), F.lit(0).alias("_place"), F.lit(True).alias("_ahead"))
        heads = heads.union(none)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None  # (place, id, text, fingerprint) waiting for its next document
        out: list[tuple] = []
        for batch in slices(batches, "packed"):
            rows = zip(*(batch.column(c).to_pylist() for c in ("_place", "_ahead", "doc_id", "packed")))
            for where, ahead, doc_id, packed in rows:
                text = unpack(packed)
                mark = fingerprint(text)
                if last is not None and last[0] == where:
                    out.append(_edited(*last[1:], text, mark))
                    last = None
                if not ahead:
                    last = (where, doc_id, text, mark)
            yield _table(out, names, batch.schema.field("doc_id").type)
            out = []

    def pack_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            packed = pa.array([pack(t) for t in batch.column("text").to_pylist()], pa.binary())
            first = pa.array([(t or "")[:64] for t in batch.column("text").to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("_place"), batch.column("_ahead"), packed, first], ["doc_id", "_place", "_ahead", "packed", "_first"])

    small = own.union(heads).mapInArrow(pack_all, f"doc_id {kind}, _place int, _ahead boolean, packed binary, _first string")
    ordered = small.repartitionById(blocks + 1, "_place").sortWithinPartitions(F.desc("_place"), F.asc("_ahead"), F.desc_nulls_last("doc_id"), "_first", "packed")
    return ordered.mapInArrow(run, schema)


def _edited(doc_id: object, text: str, mark: str, following: str, following_mark: str) -> tuple:
    keep = len(text) - len(text) // 2
    edited = text[:keep] + following[: len(text) // 2]
    edited_mark = fingerprint(edited)
    digest = hashlib.sha256(edited.encode()).hexdigest()
    return (doc_id, len(text), digest, mark, edited_mark, likeness(mark, edited_mark), likeness(mark, following_mark))


def _table(rows: list[tuple], names: list[str], key: pa.DataType) -> pa.RecordBatch:
    types = [key, pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
    columns = list(zip(*rows)) or [[] for _ in names]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)
