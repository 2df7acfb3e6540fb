import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from patchloom.llm import packing
from tests.llm.helpers import EDGE, docs

PATH = public_tokenizers.path("word_bpe_49k.json")


def reference_ids(text):
    return [*Tokenizer.from_file(PATH).encode(text or "", add_special_tokens=False).ids, 1]


TEXTS = [
    "",
    "a b\t\tc\x0bd",
    "it's o'clock <|endoftext|> x<|startoftext|>y ÉÈ ﬁ é ́x İ ΑΣ 12ab\x1c3 a b\x85c || <|x|>",
    "THE!! über, naïve—dash 3.14 'll 've don't #tag$%",
]


@pytest.mark.parametrize("text", TEXTS)
def test_word_encoder_equals_the_tokenizer(text):
    got = np.frombuffer(packing.WordEncoder(PATH).text(text), dtype="<u4").tolist()
    assert [*got, 1] == reference_ids(text)


def test_pieces_and_places(spark):
    table = docs(spark, [*EDGE, (8, "w " * 4095), (9, "w " * 4096)])
    out = packing.pack_best_two_fit(table, PATH).collect()
    by_doc = defaultdict(list)
    for r in out:
        by_doc[r.doc_id].append(r)
    assert len(by_doc[5]) == 2 and len(by_doc[None]) == 1
    for doc_id, text in table.select("doc_id", "text").collect():
        if doc_id in (5, None):
            continue
        ids = reference_ids(text)
        pieces = sorted(by_doc[doc_id], key=lambda r: r.piece)
        assert [(r.piece, r.start, r.length) for r in pieces] == [(i, s, len(ids[s : s + 4096])) for i, s in enumerate(range(0, len(ids), 4096))]
        assert [r.ids_crc32 for r in pieces] == [zlib.crc32(np.array(ids[r.start : r.start + r.length], "<u4").tobytes()) for r in pieces]
    bins = defaultdict(list)
    for r in out:
        bins[r.sequence_id].append((r.offset, r.length))
    for held in bins.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= 4096


def test_empty_table(spark):
    assert packing.pack_best_two_fit(docs(spark, []), PATH).count() == 0


def test_two_for_one():
    # 60 and 35 leave 5; with 35 given back, 21 and 19 fill the 40 left
    assert packing.best_two_fit({60: 1, 35: 1, 21: 1, 19: 1}, 100) == [(1, [60, 21, 19]), (1, [35])]


def test_every_length_is_packed_once_and_tightly():
    rng = random.Random(5)
    counts = Counter(min(4096, int(rng.lognormvariate(6, 1.2)) + 1) for _ in range(20_000))
    bins = packing.best_two_fit(dict(counts), 4096)
    packed = Counter()
    for n, held in bins:
        assert sum(held) <= 4096
        for x in held:
            packed[x] += n
    assert packed == counts
    least = -(-sum(x * n for x, n in counts.items()) // 4096)
    assert sum(n for n, _ in bins) <= least * 1.01 + 1
