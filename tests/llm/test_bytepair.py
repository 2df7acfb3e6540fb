"""Byte-level BPE by trie against the tokenizers library."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from patchloom.llm import bytepair, queries
from patchloom.llm.common import table
from tests.llm.helpers import EDGE, docs

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def ours():
    return bytepair.ByteEncoder(PATH)


def same(library, ours, text):
    ids = library.encode(text, add_special_tokens=False).ids
    got = ours.encode(text)
    assert np.frombuffer(got, "<u4").tolist() == ids, text
    assert ours.decode(got) == library.decode(ids, skip_special_tokens=False), text


def test_texts_of_many_kinds(library, ours):
    for text in ["", " ", "  a\tb\n\n c ", "it's we're I'll 'tis 'S", "<|endoftext|>", "a <|endoftext|>b<|endoftext|>", "<|endoftext", "\x00\x1c\x85　é́ ﬁ 日本語 😀 ½²", "a" * 5000, "=" * 700 + " " * 300, "x�"]:
        same(library, ours, text)


def test_runs_where_merges_overlap(library, ours):
    rng = random.Random(1)
    for _ in range(1500):
        same(library, ours, "".join(rng.choice("ab") for _ in range(rng.randint(0, 40))))
        same(library, ours, rng.choice("a=- hx") * rng.randint(1, 200))


def test_random_characters_and_classes(library, ours):
    rng = random.Random(2)
    spans = [(32, 0x250), (0x250, 0xD800), (0xE000, 0x30000), (97, 123)]
    for _ in range(4000):
        same(library, ours, "".join(chr(rng.randrange(*rng.choice(spans))) for _ in range(rng.randint(0, 12))))


def test_plain_pattern_equals_the_library_on_every_character_it_takes(library):
    pre = library.pre_tokenizer
    for code in range(0x110000):
        c = chr(code) if not 0xD800 <= code < 0xE000 else ""
        if c and bytepair._PLAIN_TEXT.fullmatch(c) and (code < 0x3000 or code % 97 == 0):
            text = f"a{c}a1{c}1!{c}! {c} "
            assert bytepair._PLAIN_WORD.findall(text) == [text[a:b] for _, (a, b) in pre.pre_tokenize_str(text)], hex(code)


def test_small_tables_change_nothing(library, monkeypatch):
    monkeypatch.setattr(bytepair, "TRIE_NODES", 50)
    monkeypatch.setattr(bytepair, "CACHE_WORDS", 5)
    monkeypatch.setattr(bytepair, "LONG_WORD", 4)
    small, rng = bytepair.ByteEncoder(PATH), random.Random(3)
    for _ in range(50):
        same(library, small, " ".join("".join(rng.choice("theing s") for _ in range(9)) for _ in range(20)))


def test_plain_special_tokens(library):
    plain, text = bytepair.ByteEncoder(PATH, special=False), "a<|endoftext|> b"
    own = Tokenizer.from_file(PATH)
    own.encode_special_tokens = True
    assert np.frombuffer(plain.encode(text), "<u4").tolist() == own.encode(text, add_special_tokens=False).ids
    assert plain.decode(plain.encode(text)) == text


def test_a_prefix_is_worked_out_once(ours):
    trie = bytepair.PrefixTrie(ours.merges)
    trie.insert(b"abcdef")
    before = len(trie.last)
    trie.insert(b"abcdxy")
    assert len(trie.last) == before + 2 and trie.insert(b"abc") < before


def test_merges_out_of_order_are_refused():
    ids = {b"a": 0, b"b": 1, b"ab": 2, b"abb": 3}
    with pytest.raises(ValueError):
        bytepair.Merges(ids, {(2, 1): 0, (0, 1): 1})


def test_edge_rows_and_round_trip(spark, library):
    given = docs(spark, EDGE).coalesce(2)
    encoded = bytepair.encode_documents(given, PATH)
    want = sorted((str(i), library.encode(t or "", add_special_tokens=False).ids) for i, t in EDGE)
    assert sorted((str(r.doc_id), r.ids) for r in encoded.collect()) == want
    back = bytepair.decode_documents(encoded, PATH).collect()
    assert sorted((str(r.doc_id), r.text) for r in back) == sorted((str(i), t or "") for i, t in EDGE)
    assert bytepair.encode_documents(docs(spark, []), PATH).count() == 0
    assert bytepair.round_trip(docs(spark, []), PATH).count() == 0


def test_query_equals_the_library(spark, small, library):
    want = []
    for r in table(spark, small, "documents").select("doc_id", "text").collect():
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        back = library.decode(ids, skip_special_tokens=False)
        want.append((r.doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(back.encode()).hexdigest()))
    got = queries.op11_bpe_coding(spark, small).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect()
    assert sorted(map(tuple, got)) == sorted(want)


def test_the_rest_of_a_word_is_grown_at_once_and_only_where_it_is_new(monkeypatch):
    plain = bytepair.ByteEncoder(PATH, special=False)
    calls, grown = [], bytepair.PrefixTrie._grown
    monkeypatch.setattr(bytepair.PrefixTrie, "_grown", lambda *a: calls.append(a[1]) or grown(*a))
    texts = ["zanquorith zanquorithel " + "x" * 300, "", "zanquorithel zanquo</s>\n\n ünï"]
    library = Tokenizer.from_file(PATH)
    want = [np.array(library.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in (texts[0], "")]
    assert plain.plain(texts)[:2] == want
    assert calls.count(b" zanquorithel") == calls.count(b"zanquorith") == 1
    assert len(calls) <= 12 and "x" * 300 not in plain.words
    before = len(calls)
    assert plain.plain(texts[:1]) == want[:1] and len(calls) == before + 1  # the long word alone is not kept
