"""The cost of comparing lines: what travels, what is compared in full, what a task holds."""

import random
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest

from patchloom.llm import lines


def some_lines(n, seed):
    rng = random.Random(seed)
    return [bytes(rng.choice(b"abcdefgh ij") for _ in range(rng.choice([1, 7, 8, 9, 30, 100, 300, 1500]))) for _ in range(n)]


def edited(line, rng):
    out = bytearray(line)
    for _ in range(rng.randrange(8)):
        out[rng.randrange(len(out))] = rng.choice(b"xyz")
    return bytes(out)


def test_unlike_lines_need_no_shingle_sets(monkeypatch):
    made = []
    for name in ("shingle_set", "shingle_array"):
        made_by = getattr(lines, name, None)
        monkeypatch.setattr(lines, name, lambda x, f=made_by: made.append(x) or f(x), raising=False)
    rng = random.Random(1)
    own = [bytes(rng.choice(b"abcdefgh ij") for _ in range(300)) for _ in range(40)]
    own.append(own[0][:-1] + b"!")
    a, b = zip(*combinations(range(len(own)), 2))
    batch = pa.RecordBatch.from_pydict({"a": a, "b": b, "words": [own[i] for i in a], "words_b": [own[i] for i in b]})
    got = [r for out in lines._linked(iter([batch])) for r in out.to_pylist()]
    assert got == [{"a": 0, "b": 40}]
    assert len(made) == 2


def test_no_like_lines_are_told_apart_by_sketches():
    rng = random.Random(2)
    own = some_lines(60, 3)
    own = list(dict.fromkeys(own + [edited(x, rng) for x in own for _ in range(2)]))
    sets, bits, runs = [lines.shingle_set(x) for x in own], lines.sketches(own), lines._runs(own)
    similar = lines.Similar(80)
    links = 0
    for i, j in combinations(range(len(own)), 2):
        like = 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])
        links += like
        assert similar(i, own[i], j, own[j]) == like
        assert not like or lines.may_link(bits[i], bits[j], runs[i] + runs[j], 80)
    assert links > 10


def test_band_keys_travel_in_arrays():
    texts = ["\n".join(x.decode() for x in some_lines(200, seed)) for seed in range(20)]
    parts = 16
    out = list(lines._keys(parts)(iter([pa.RecordBatch.from_pydict({"text": texts})])))
    assert sum(b.num_rows for b in out) <= parts
    dealt = {p: np.frombuffer(x, np.int64).reshape(-1, 2) for b in out for p, x in zip(*(c.to_pylist() for c in b.columns))}
    assert all((rows[:, 0] % parts == p).all() for p, rows in dealt.items())
    plain = list({x for t in texts for x in lines.normal_lines(t) if x})
    want = {(k, h) for h, keys in zip(lines.line_hashes(plain).tolist(), lines.band_keys(plain).tolist()) for k in keys}
    assert {tuple(r) for rows in dealt.values() for r in rows.tolist()} == want


@pytest.mark.parametrize("full_rows, held", [(20, 9), (100, 12), (4_000_000, 4096)])
def test_pairs_of_bands_in_any_order(monkeypatch, full_rows, held):
    monkeypatch.setattr(lines, "FULL_ROWS", full_rows)
    monkeypatch.setattr(lines, "HELD", held)
    rng = random.Random(4)
    for _ in range(40):
        keys = [rng.randrange(-(10**18), 10**18) for _ in range(6)]
        rows = [(rng.choice(keys[: 1 + rng.randrange(6)]), rng.randrange(60)) for _ in range(rng.randrange(150))]
        arrays = [np.array(rows[i : i + 10], np.int64).tobytes() for i in range(0, len(rows), 10)]
        batches = [pa.RecordBatch.from_pydict({"bands": pa.array([x], pa.binary())}) for x in arrays]
        pairs = [tuple(r.values()) for out in lines._band_pairs(iter(batches)) for r in out.to_pylist()]
        bands = {k: {x for key, x in rows if key == k} for k, _ in rows}
        small = {p for band in bands.values() if len(band) <= lines.FULL for p in combinations(sorted(band), 2)}
        assert {(a, b) for k, a, b in pairs if k is None} == small
        for k, band in bands.items():
            if len(band) > lines.FULL:  # all its lines, and tied together
                reached, more = {min(band)}, True
                while more:
                    new = {x for key, a, b in pairs if key == k and {a, b} & reached for x in (a, b)}
                    more = not new <= reached
                    reached |= new
                assert reached == band


def test_white_space_is_joined_alike():
    rng = random.Random(5)
    for _ in range(3000):
        text = "".join(rng.choice("ab \n\t\x0bÉ ") for _ in range(rng.randrange(12)))
        assert lines.normal_lines(text) == lines.normal_lines(text.encode()) == [lines.normal(x) for x in text.split("\n")]
