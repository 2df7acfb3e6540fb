"""Personal data: fixed kinds by pattern, and terms that disclose them by co-occurrence."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patchloom.llm.common import LOWER, prepared, range_hash, raw_bytes, slices, words_of, written
from patchloom.operators.scans import lookup_join

KINDS = ("email", "ip", "card", "phone")
TERM_KINDS = ("remove", "generalise")
WINDOW = 4  # words on either side of a mention
REMOVE_AT, GENERALISE_AT = 0.95, 0.80  # share of an entity's information a term discloses
HELD_COUNTS = 500_000  # counts of slices a task holds before it merges and sends them

_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]+\Z")
# A match begins where a run of digits begins: from within a run nothing else can be found.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGITS = re.compile(r"[0-9]")
_WORD = re.compile(r"[^\x20\x09-\x0D]+")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Valid matches by kind, then start; ends exclusive, code points."""
    spans = []
    floor = 0
    for m in _DOMAIN.finditer(text) if "@" in text else ():
        low = m.start()
        while low > floor and (text[low - 1].isascii() and (text[low - 1].isalnum() or text[low - 1] in "._%+-")):
            low -= 1
        if low < m.start():
            spans.append(("email", low, m.end()))
            floor = m.end()
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            spans.append(("ip", *m.span()))
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 16 <= len(digits) <= 19 and luhn(digits):
            spans.append(("card", *m.span()))
    for m in _PHONE.finditer(text) if "+" in text else ():
        if 8 <= len(_DIGITS.findall(m[0])) <= 15:
            spans.append(("phone", *m.span()))
    return spans


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


_TERM_BYTE = np.zeros(256, dtype=bool)
_TERM_BYTE[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


def term_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Of each word, a hash of its letters and digits in lower case, and which text it is in.

    Words without any are left out. The same function serves words of a context and words of
    whole texts, so a term is one thing everywhere.
    """
    words = words_of(texts)
    doc = np.repeat(np.arange(len(texts)), np.diff(words.first))
    kept = _TERM_BYTE[words.data]
    place = np.concatenate([[0], np.cumsum(kept)])
    start, end = place[words.start], place[words.end]
    hashes = range_hash(LOWER[words.data[kept]].astype(np.uint64) + np.uint64(1), start, end, 0x9E3779B97F4A7C15)
    some = end > start
    return hashes[some].view(np.int64), doc[some]


def _contexts(text: str, spans: list[tuple[str, int, int]]) -> list[tuple[int, str, int, int]]:
    """(entity, word, start, end) of words near mentions and outside all spans.

    The word is whole, as in ``term_hashes`` of the text; its place is without marks at the ends.
    """
    words = [m.span() for m in _WORD.finditer(text)]
    starts = [a for a, _ in words]
    taken = sorted((a, b) for _, a, b in spans)
    found = {}
    for kind, low, high in spans:
        value = re.sub(r"[ ().-]", "", text[low:high]) if kind in ("card", "phone") else text[low:high].lower()
        entity = int.from_bytes(hashlib.blake2b(f"{kind}:{value}".encode(), digest_size=8).digest(), "little", signed=True)
        first = int(np.searchsorted(starts, low, side="right")) - 1
        last = int(np.searchsorted(starts, high, side="left"))
        for i in [*range(max(0, first - WINDOW), first + 1), *range(last, min(len(words), last + WINDOW))]:
            low_word, high_word = a, b = words[i]
            while a < b and not text[a].isalnum():
                a += 1
            while b > a and not text[b - 1].isalnum():
                b -= 1
            if a < b and not any(x < b and a < y for x, y in taken):
                found[entity, a] = (entity, text[low_word:high_word], a, b)
    return list(found.values())


def find_entities(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, row (a number of its own), base spans and words near them."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    near = pa.list_(pa.struct([("entity", pa.int64()), ("term", pa.int64()), ("start", pa.int64()), ("end", pa.int64())]))
    span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 40
        for batch in slices(batches, "text"):
            bases, contexts = [], []
            for text in batch.column("text").to_pylist():
                spans = base_spans(text or "")
                bases.append([{"kind": k, "start": a, "end": b} for k, a, b in spans])
                found = _contexts(text, spans) if spans else []
                entries = []
                hashes = term_hashes(pa.array([w for _, w, _, _ in found], pa.string())) if found else ((), ())
                for h, i in zip(*hashes):
                    entity, _, a, b = found[i]
                    entries.append({"entity": entity, "term": int(h), "start": a, "end": b})
                contexts.append(entries)
            rows = pa.array(range(row, row + batch.num_rows), pa.int64())
            row += batch.num_rows
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), rows, pa.array(bases, span), pa.array(contexts, near)], ["doc_id", "row", "base", "near"])

    schema = (
        f"doc_id {kind}, row long, base array<struct<kind:string,start:bigint,end:bigint>>, "
        "near array<struct<entity:bigint,term:bigint,start:bigint,end:bigint>>"
    )
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def _merged(held: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Counts per term of several slices as one."""
    values, at = np.unique(np.concatenate([v for v, _ in held]), return_inverse=True)
    return values, np.bincount(at, np.concatenate([n for _, n in held]), len(values)).astype(np.int64)


def _counts(held: tuple[np.ndarray, np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x) for x in held], ["term", "n"])


def term_counts(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """How often each of ``terms`` occurs in all texts: rows (term, n).

    Tasks count all terms they meet, in bounded tables, and send each once with its count, so
    what moves are the vocabularies of tasks at any size; the terms wanted are picked from
    the sums. Nothing is broadcast.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        for batch in slices(batches, "text"):
            hashes, _ = term_hashes(batch.column("text"))
            held.append(np.unique(hashes, return_counts=True))
            if sum(len(v) for v, _ in held) > 2 * HELD_COUNTS:
                held = [_merged(held)]
                if len(held[0][0]) > HELD_COUNTS:
                    yield _counts(held.pop())
        if held:
            yield _counts(_merged(held))

    counts = docs.select("text").mapInArrow(run, "term long, n long")
    return lookup_join(counts.groupBy("term").agg(F.sum("n").alias("n")), terms, ["term"], "left_semi")


def disclosing_terms(found: DataFrame, docs: DataFrame) -> DataFrame:
    """Pairs (entity, term) with the share of the entity's information the term discloses.

    p(e) is the share of an entity's contexts among all words near entities, p(e|t) the share
    of a term's occurrences in the whole corpus that lie in those contexts. The term discloses
    log p(e|t)/p(e) of the log 1/p(e) that naming the entity would: 1 when it occurs nowhere
    else, be it near the entity once.
    """
    near = found.select(F.explode("near").alias("c")).select("c.*")
    pairs = near.groupBy("entity", "term").agg(F.count("*").alias("both"))
    pairs = written(pairs, "pairs")
    entities = pairs.groupBy("entity").agg(F.sum("both").alias("n_entity"))
    all_words = F.broadcast(pairs.agg(F.sum("both").alias("n_all")))  # one row
    counts = term_counts(docs, pairs.select("term").distinct())
    both = lookup_join(lookup_join(pairs, counts, ["term"], "inner"), entities, ["entity"], "inner").join(all_words)
    information = F.log2(F.col("n_all") / F.col("n_entity"))
    gained = F.log2(F.least(F.col("both") / F.col("n"), F.lit(1.0)))
    share = F.when(gained == 0, 1.0).when(information > 0, 1 + gained / information).otherwise(0.0)
    return both.select("entity", "term", share.alias("share")).where(F.col("share") >= GENERALISE_AT)


def find_personal_data(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans.

    ``spans`` lists base spans by kind and start, then the method's own: ``remove`` for terms
    that disclose an entity almost fully, ``generalise`` for those that disclose much of it. A
    word near several entities takes the strongest. Offsets are code points, ends exclusive.

    Null or empty text: no spans, and the digest of the empty string. Every row gives one row,
    null and repeated ids included. Other columns are ignored. Texts are never shuffled.
    """
    prepared(docs.sparkSession)
    found = written(find_entities(docs), "entities")
    terms = disclosing_terms(found, docs)
    near = found.select("row", F.explode("near").alias("c")).select("row", "c.entity", "c.term", "c.start", "c.end")
    marked = lookup_join(near, terms, ["entity", "term"], "inner")
    marked = marked.groupBy("row", "start", "end").agg(F.max("share").alias("share"))
    label = F.when(F.col("share") >= REMOVE_AT, "remove").otherwise("generalise")
    marked = marked.groupBy("row").agg(F.array_sort(F.collect_list(F.struct(F.when(F.col("share") >= REMOVE_AT, 0).otherwise(1).alias("k"), "start", "end", label.alias("kind")))).alias("own"))

    def text_of(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(kind):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    whole = found.select("doc_id", "row", "base").join(marked, "row", "left")
    own = F.coalesce(text_of(F.col("own")), F.lit(""))
    base = text_of(F.col("base"))
    spans = F.concat(base, F.when((base != "") & (own != ""), ",").otherwise(""), own)
    return whole.select("doc_id", *(count(k) for k in KINDS), F.sha2(base, 256).alias("base_sha256"), spans.alias("spans"))


def sanitise(text: str | None, spans: str) -> str:
    """A text with its spans applied: entities and generalised terms named by kind, others removed.

    Overlapping spans are merged, the earlier one naming the kind.
    """
    text, out, at = text or "", [], 0
    parts = sorted((int(a), int(b), k) for k, a, b in (s.split(":") for s in spans.split(",") if s))
    for low, high, kind in parts:
        if high <= at:
            continue
        if low >= at:
            out.append(text[at:low])
            out.append({"remove": "", "generalise": "[TERM]"}.get(kind, f"[{kind.upper()}]"))
        at = high
    return "".join(out) + text[at:]
