"""Byte-level BPE by a trie of words: prefixes that words share are encoded once.

The encoding of a text by merges is determined from the left: the last token of a prefix is
the only one that stands next to the last token of what it leaves over. So a trie of words
holds one state per prefix, its last token and the node where that token begins; a word's
ids are read by going back from its node. Each node is worked out once, in depth-first order
of the words, however many words run through it.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from patchloom.llm.common import prepared, slices

TRIE_NODES = 400_000  # states a worker keeps before it starts a new trie
CACHE_WORDS = 400_000  # words whose ids a worker keeps before it starts anew
LONG_WORD = 200  # longer words get a trie of their own and are not kept

# Letters, and signs that are neither letters, digits nor white space, that the
# plain pattern below treats as the tokenizer does. Texts with other characters are split by
# the tokenizer library itself.
_LETTERS = "A-Za-zÀ-ÖØ-öø-ɏЀ-ҁҊ-ԯ一-龥ぁ-ゖァ-ヺ가-힣"
_SIGNS = "!-/:-@[-`{-~«»¡¿‐-‧‰-›、。，"
_PLAIN_TEXT = re.compile(f"[\\t-\\r 0-9{_LETTERS}{_SIGNS}]*")
_PLAIN_WORD = re.compile(
    f"'(?:[stmd]|re|ve|ll)| ?[{_LETTERS}]+| ?[0-9]+| ?[^\\t-\\r {_LETTERS}0-9]+|[\\t-\\r ]+(?![^\\t-\\r ])|[\\t-\\r ]+"
)


@cache
def byte_signs() -> dict[str, int]:
    """The byte behind each character of a byte-level vocabulary.

    Printable bytes of Latin-1 stand for themselves, all others in turn for 256 and up.
    """
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


class Merges:
    """A vocabulary of byte strings and the pairs that make them, by rank."""

    def __init__(self, ids: dict[bytes, int], ranks: dict[tuple[int, int], int]):
        self.ids = ids
        self.ranks = ranks
        self.token = {i: t for t, i in ids.items()}
        made: dict[int, tuple[int, int, int]] = {}
        for (left, right), rank in ranks.items():
            whole = ids[self.token[left] + self.token[right]]
            if whole in made:
                raise ValueError(f"token {whole} is made by two merges")
            made[whole] = (rank, left, right)
        for rank, left, right in made.values():
            if max(made.get(left, (-1,))[0], made.get(right, (-1,))[0]) > rank:
                raise ValueError("a merge comes before one of its parts is made")
        self.made = made
        self.spines: tuple[dict[int, list], dict[int, list]] = ({}, {})
        self.beside: dict[int, bool] = {}
        self.whole: dict[int, bool] = {}
        # only tokens that their own bytes give can be the last of a prefix
        self.final = {t: i for t, i in ids.items() if self.is_whole(i)}
        ends: dict[bytes, set[int]] = {}
        for t in self.final:
            ends.setdefault(t[-4:], set()).add(len(t))
        for end, n in ends.items():  # shorter tokens end there as well
            n |= {k for k in range(1, len(end)) if end[-k:] in self.final}
        self.lengths = {end: sorted(n, reverse=True) for end, n in ends.items()}

    def spine(self, token: int, side: int) -> list[tuple[int, int, float]]:
        """Tokens that stand at one end of ``token`` while it is built: (token, made, merged away).

        ``side`` 1 is its right end, 0 its left.
        """
        known = self.spines[side]
        if token not in known:
            out, until = [], float("inf")
            at = token
            while True:
                rank, *parts = self.made.get(at, (-1,))
                out.append((at, rank, until))
                if not parts:
                    break
                until, at = rank, parts[side]
            known[token] = out
        return known[token]

    def seam_holds(self, left: int, right: int, but: tuple[int, int] | None = None) -> bool:
        """Whether no merge, other than ``but``, crosses from ``left`` into ``right``.

        A pair at the seam merges if its rank comes while both are there. Of equal ranks the
        leftmost pair goes first: a merge inside ``left`` before the seam, the seam before one
        inside ``right``.
        """
        for a, made_a, gone_a in self.spine(left, 1):
            for b, made_b, gone_b in self.spine(right, 0):
                rank = self.ranks.get((a, b))
                if rank is not None and (a, b) != but and made_a < rank < gone_a and made_b < rank <= gone_b:
                    return False
        return True

    def is_whole(self, token: int) -> bool:
        """Whether encoding the bytes of a token gives the token."""
        if token not in self.whole:
            made = self.made.get(token)
            self.whole[token] = made is None and len(self.token[token]) == 1 or made is not None and (
                self.is_whole(made[1]) and self.is_whole(made[2]) and self.seam_holds(made[1], made[2], made[1:])
            )
        return self.whole[token]

    def follows(self, left: int, right: int) -> bool:
        """Whether ``right`` stands next to ``left`` when the bytes of both are encoded."""
        key = left << 32 | right
        if key not in self.beside:
            self.beside[key] = self.seam_holds(left, right)
        return self.beside[key]


class PrefixTrie:
    """Words of bytes; every node knows the last token of its prefix and where that begins."""

    def __init__(self, merges: Merges):
        self.merges = merges
        self.child: dict[int, int] = {}
        self.last, self.origin = [-1], [0]

    def insert(self, word: bytes) -> int:
        """The node of a word. Nodes that are new get their state on the way down."""
        child, node, path = self.child, 0, [0]
        for byte in word:
            known = child.get(node << 8 | byte)
            if known is None:
                return self._grown(word, path)
            node = known
            path.append(node)
        return node

    def _grown(self, word: bytes, path: list[int]) -> int:
        """Nodes for the rest of a word: each has the token that fits behind what it leaves over."""
        merges, child, last, origin = self.merges, self.child, self.last, self.origin
        final, beside, lengths = merges.final.get, merges.beside.get, merges.lengths.get
        node = path[-1]
        for end in range(len(path), len(word) + 1):
            # a token that ends with the last bytes, or that is no longer than these
            low = end - 4 if end > 4 else 0
            some = lengths(word[low:end]) or lengths(word[max(0, end - 3) : end]) or lengths(word[max(0, end - 2) : end], (1,))
            for n in some:
                if n > end or (token := final(word[end - n : end])) is None:
                    continue
                start = path[end - n]
                if not start:
                    break
                fits = beside(last[start] << 32 | token)
                if merges.follows(last[start], token) if fits is None else fits:
                    break
            else:
                raise ValueError(f"no token ends {word[:end]!r}")
            child[node << 8 | word[end - 1]] = node = len(last)
            last.append(token)
            origin.append(start)
            path.append(node)
        return node

    def encoding(self, node: int) -> list[int]:
        """Ids of the prefix that ends at a node."""
        out = []
        while node:
            out.append(self.last[node])
            node = self.origin[node]
        return out[::-1]


class ByteEncoder:
    """Encodes texts as a byte-level BPE file of the tokenizers library says, and back.

    With ``special`` the file's special tokens are found inside texts, else they are plain text.
    """

    def __init__(self, path: str, special: bool = True):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, pre, added = spec["model"], spec["pre_tokenizer"] or {}, spec["added_tokens"]
        odd = [k for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges") if model.get(k)]
        if model["type"] != "BPE" or pre.get("type") != "ByteLevel" or pre["add_prefix_space"] or not pre["use_regex"] or spec["normalizer"] or odd:
            raise ValueError("not a plain byte-level BPE file")
        if any(a["lstrip"] or a["rstrip"] or a["single_word"] for a in added):
            raise ValueError("added tokens that take in their surroundings are not supported")
        signs = byte_signs()
        names = {a["content"]: a["id"] for a in added}
        vocabulary = {t: i for t, i in model["vocab"].items() if t not in names}
        ids = {bytes(signs[c] for c in t): i for t, i in vocabulary.items()}
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.merges = Merges(ids, {(vocabulary[a], vocabulary[b]): r for r, (a, b) in enumerate(pairs)})
        self.tokens = [b""] * (1 + max([*ids.values(), *names.values()]))
        for token, i in [*ids.items(), *((name.encode(), i) for name, i in names.items())]:
            self.tokens[i] = token
        self.coded = [i.to_bytes(4, "little") for i in range(len(self.tokens))]
        self.names = {name: i.to_bytes(4, "little") for name, i in names.items()} if special else {}
        self.name_pattern = re.compile("(" + "|".join(re.escape(n) for n in sorted(self.names, key=len, reverse=True)) + ")") if self.names else None
        self.path = path
        self.trie = PrefixTrie(self.merges)
        self.words: dict[str, bytes] = {}
        self._library = None

    def split(self, text: str) -> list[str]:
        """The words that merges never cross."""
        if _PLAIN_TEXT.fullmatch(text):
            return _PLAIN_WORD.findall(text)
        if self._library is None:
            os.environ["TOKENIZERS_PARALLELISM"] = "false"
            from tokenizers import Tokenizer

            self._library = Tokenizer.from_file(self.path).pre_tokenizer
        return [text[a:b] for _, (a, b) in self._library.pre_tokenize_str(text)]

    def word(self, word: bytes) -> bytes:
        """Ids of one word as little-endian 32-bit values."""
        if len(word) > LONG_WORD:
            own = PrefixTrie(self.merges)
            return np.array(own.encoding(own.insert(word)), dtype="<u4").tobytes()
        if len(self.trie.last) > TRIE_NODES:
            self.trie = PrefixTrie(self.merges)
        return b"".join(map(self.coded.__getitem__, self.trie.encoding(self.trie.insert(word))))

    def plain(self, texts: list[str]) -> list[bytes]:
        """Ids of texts without special tokens; words new in them are worked out in order, for near ones share their way."""
        split, known = [self.split(t) for t in texts], self.words
        if len(known) > CACHE_WORDS:
            known.clear()
        found = {w: self.word(w.encode()) for w in sorted(set().union(*split).difference(known))}
        known.update(found)
        out = [b"".join(map(known.__getitem__, words)) for words in split]
        for w in found:
            if len(w) > LONG_WORD:
                del known[w]
        return out

    def encode(self, text: str) -> bytes:
        """Ids of a whole text as little-endian 32-bit values."""
        if self.name_pattern is None or not self.name_pattern.search(text):
            return self.plain([text])[0]
        return b"".join([self.names[p] if p in self.names else self.plain([p])[0] for p in self.name_pattern.split(text) if p])

    def decode(self, ids: bytes) -> str:
        """The text of ids; bytes that are no UTF-8 become replacement characters."""
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist())).decode("utf-8", "replace")


_ENCODERS: dict[tuple[str, bool], ByteEncoder] = {}


def encoder(path: str, special: bool = True) -> ByteEncoder:
    """One encoder per file, kept while the worker lives."""
    key = (path, special)
    if key not in _ENCODERS:
        _ENCODERS[key] = ByteEncoder(path, special)
    return _ENCODERS[key]


def encode_documents(docs: DataFrame, path: str, *, special: bool = True) -> DataFrame:
    """Token ids of every text: rows (doc_id, ids array<int>).

    Null or empty text: no ids. Every row gives one row, null and repeated ids included; other
    columns are ignored. ``path`` is a byte-level BPE file that all executors can read. Nothing
    is shuffled; a task keeps bounded tables of words and prefixes, and a very long word is
    encoded in time that grows with its length.
    """
    prepared(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            ids = [encoder(path, special).encode(t or "") for t in batch.column("text").to_pylist()]
            offsets = np.cumsum([0, *map(len, ids)]) // 4
            flat = np.frombuffer(b"".join(ids), dtype="<i4")
            lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat, pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), lists], ["doc_id", "ids"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, ids array<int>")


def decode_documents(encoded: DataFrame, path: str) -> DataFrame:
    """Texts of rows (doc_id, ids array<int>): rows (doc_id, text). Null ids: empty text."""
    prepared(encoded.sparkSession)
    kind = encoded.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [encoder(path).decode(np.array(i or [], dtype="<u4").tobytes()) for i in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, f"doc_id {kind}, text string")


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """Every text encoded and decoded again: rows (doc_id, n_tokens, ids_sha256, decoded_sha256).

    The digests are those of ``encode_documents``' ids as little-endian 32-bit values and of
    ``decode_documents``' text, taken where they are made, so ids need not be written. Edge
    cases are those of ``encode_documents``.
    """
    prepared(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            bpe, rows = encoder(path), []
            for text in batch.column("text").to_pylist():
                ids = bpe.encode(text or "")
                back = bpe.decode(ids).encode()
                rows.append((len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(back).hexdigest()))
            columns = [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.string(), pa.string()))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    schema = f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return docs.select("doc_id", "text").mapInArrow(run, schema)
