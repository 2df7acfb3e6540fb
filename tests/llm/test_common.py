"""Hashes of runs: equal content alone gives equal values, for strings of every kind."""

import random

import numpy as np
import pyarrow as pa

from patchloom.llm import common, neardup, substrings
from tests.llm.helpers import docs

PRIME = (1 << 61) - 1


def thue_morse(n, a, b):
    return [(a, b)[bin(i).count("1") % 2] for i in range(n)]


def test_products_and_powers():
    rng = random.Random(1)
    a = [0, 1, PRIME - 1, *(rng.randrange(PRIME) for _ in range(500))]
    b = [PRIME - 1, PRIME - 1, PRIME - 1, *(rng.randrange(PRIME) for _ in range(500))]
    got = common._product(np.array(a, np.uint64), np.array(b, np.uint64)).tolist()
    assert got == [x * y % PRIME for x, y in zip(a, b)]
    forth, back = common._powers(common._BASE, 1000)
    assert forth[999] == pow(common._BASE, 999, PRIME) and int(forth[999]) * int(back[999]) % PRIME == 1
    wide = [0, PRIME, PRIME + 1, 2**64 - 1]
    assert common._reduced(np.array(wide, np.uint64)).tolist() == [x % PRIME for x in wide]


def test_runs_hash_by_content_across_chunks(monkeypatch):
    monkeypatch.setattr(common, "_CHUNK", 7)
    rng = np.random.default_rng(2)
    values = rng.integers(0, 3, 300).astype(np.uint64)
    starts = rng.integers(0, 290, 400)
    ends = starts + rng.integers(0, 10, 400)
    plain = common.range_hash(values + np.uint64(1), starts, ends, common._SEQ).tolist()
    by_content = {}
    for s, e, h in zip(starts, ends, plain):
        by_content.setdefault(tuple(values[s:e].tolist()), set()).add(h)
    assert all(len(h) == 1 for h in by_content.values())
    assert len({h for hs in by_content.values() for h in hs}) == len(by_content)


def test_words_that_defeat_a_power_of_two(spark):
    one, two = "".join(thue_morse(1024, "a", "b")), "".join(thue_morse(1024, "b", "a"))
    hashes = common.words_of(pa.array([one, two])).hash
    assert hashes[0] != hashes[1]
    texts = [(i, " ".join([word] + [f"w{j}" for j in range(60)])) for i, word in ((1, one), (2, two))]
    window = [(i, " ".join(f"{word}{j}" for j in range(60))) for i, word in ((1, one), (2, two))]
    assert {r.n_removed for r in substrings.dedupe_substrings(docs(spark, window)).collect()} == {0}
    assert [r.n_removed for r in substrings.dedupe_substrings(docs(spark, texts)).orderBy("doc_id").collect()] == [0, 60]
    repeated = [(i, " ".join([word] * 4)) for i, word in ((1, one), (2, two))]
    assert all(r.kept for r in neardup.near_duplicates(docs(spark, repeated), percent=85).collect())


def test_runs_of_words_in_that_order(spark):
    one, two = " ".join(thue_morse(4096, "ab", "cd")), " ".join(thue_morse(4096, "cd", "ab"))
    got = {r.doc_id: r.n_removed for r in substrings.dedupe_substrings(docs(spark, [(1, one), (2, two)])).collect()}
    first, second = one.split(), two.split()
    seen = {tuple(first[i : i + 50]) for i in range(len(first) - 49)}
    gone = {p for i in range(len(second) - 49) if tuple(second[i : i + 50]) in seen for p in range(i, i + 50)}
    assert got == {1: 0, 2: len(gone)}
