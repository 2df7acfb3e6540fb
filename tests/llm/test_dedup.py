"""Substring, line and document deduplication against brute force."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa

import corpus_pipeline
from patchloom.llm import common, lines, neardup, substrings
from patchloom.llm.common import min_label
from tests.llm.helpers import EDGE, docs, rows


def make_texts(n=160, seed=3):
    """Texts with exact and edited copies, shared passages and repeated lines."""
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(400)]
    passage = " ".join(rng.choices(vocab, k=70))
    shared = " ".join(rng.choices(vocab, k=14))
    out = []
    for i in range(n):
        kind = rng.random()
        if out and kind < 0.35:
            words = (rng.choice(out)[1]).split(" ")
            for _ in range(rng.choice([0, 1, 2, 4, 9])):
                words[rng.randrange(len(words))] = rng.choice(vocab)
            text = " ".join(words)
        else:
            parts = [" ".join(rng.choices(vocab, k=rng.randint(3, 60))) for _ in range(rng.randint(1, 5))]
            if kind > 0.8:
                parts.insert(rng.randrange(len(parts) + 1), passage)
            if kind > 0.6:
                parts.insert(0, shared)
            text = "\n".join(parts)
        out.append((i * 3 + 1, text))
    return out


def test_substrings_against_brute_force(spark, monkeypatch):
    for limit in (2000, 1):  # the second sends every contested minimiser the other way
        monkeypatch.setattr(substrings, "BUCKET_ROWS", limit)
        texts = make_texts()
        first, want = {}, {}
        for doc_id, text in sorted(texts):
            words = text.split()
            gone = [False] * len(words)
            for i in range(len(words) - 49):
                if first.setdefault(tuple(words[i : i + 50]), doc_id) < doc_id:
                    gone[i : i + 50] = [True] * 50
            kept = " ".join(w for w, g in zip(words, gone) if not g)
            want[doc_id] = (len(words), sum(gone), hashlib.sha256(kept.encode()).hexdigest())
        assert sum(w[1] for w in want.values()) > 500
        got = substrings.dedupe_substrings(docs(spark, texts)).collect()
        assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in got} == want


def test_substring_edges(spark):
    got = rows(substrings.dedupe_substrings(docs(spark, EDGE)), "doc_id", "n_words", "n_removed")
    assert got == sorted([(1, 0, 0), (2, 0, 0), (3, 0, 0), (4, 2, 0), (5, 2, 0), (5, 2, 0), (None, 2, 0), (6, 30_000, 0), (7, 200, 0)], key=repr)
    assert substrings.dedupe_substrings(docs(spark, [])).count() == 0


def components(items, similar):
    parent = list(range(len(items)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(items)):
        for j in range(i):
            if find(i) != find(j) and similar(items[i], items[j]):
                parent[find(i)] = find(j)
    return [find(i) for i in range(len(items))]


def test_near_duplicates_against_brute_force(spark):
    texts = make_texts(200, 8)

    def shingle(text):
        w = text.lower().split()
        return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()

    sets = [shingle(t) for _, t in texts]
    roots = components(sets, lambda a, b: bool(a) and 100 * len(a & b) >= 85 * len(a | b))
    least = defaultdict(lambda: 1 << 60)
    for (doc_id, _), r in zip(texts, roots):
        least[r] = min(least[r], doc_id)
    want = {d: (len(s), least[r], least[r] == d) for (d, _), s, r in zip(texts, sets, roots)}
    assert sum(not w[2] for w in want.values()) > 20
    got = neardup.near_duplicates(docs(spark, texts)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in got} == want
    kept = neardup.drop_near_duplicates(docs(spark, texts))
    assert {r.doc_id for r in kept.collect()} == {d for d, w in want.items() if w[2]}
    assert kept.columns == docs(spark, []).columns


def contained_copies(percent, pairs, seed):
    """Texts of which each second one is the one before with text appended or cut, and the sketch values they share."""
    rng = random.Random(seed)
    out = []
    for n in range(pairs):
        words = [f"w{rng.randrange(1 << 40)}" for _ in range(rng.choice([404, 704, 1004]))]
        few = -(-(percent + n % 3) * (len(words) - 4) // 100) + 4
        part = words[:few] if n % 2 else words[-few:]
        both = [" ".join(x) for x in ((words, part) if n % 4 < 2 else (part, words))]
        a, b = (s[: neardup.SKETCH] for s in neardup.shingle_sets(pa.array(both)))
        out.append((len(np.intersect1d(a, b)), both))
    return sorted(out)


def test_contained_copies_are_found_with_few_shared_values(spark):
    found = contained_copies(85, 2400, 5)[:12]
    assert found[0][0] <= 46  # the former bound found 47 or more
    texts = [(10 * i + k, t) for i, (_, both) in enumerate(found, 1) for k, t in enumerate(both)]
    got = {r.doc_id: r.component_id for r in neardup.near_duplicates(docs(spark, texts)).collect()}
    assert got == {d: d - d % 10 for d, _ in texts}


def test_pairs_between_80_and_85_percent_at_either_threshold(spark):
    pairs = [both for _, both in contained_copies(80, 40, 9)]
    texts = [(10 * i + k, t) for i, both in enumerate(pairs, 1) for k, t in enumerate(both)]
    apart = neardup.near_duplicates(docs(spark, texts)).where("kept").count()
    got = {r.doc_id for r in corpus_pipeline.drop_near_duplicates(spark, docs(spark, texts), "").collect()}
    assert apart == len(texts) and got == {d for d, _ in texts if d % 10 == 0}


def test_near_duplicate_edges(spark):
    got = rows(neardup.near_duplicates(docs(spark, EDGE)), "doc_id", "n_shingles", "component_id", "kept")
    assert (5, 1, 4, False) in got and (4, 1, 4, True) in got and (None, 1, None, True) in got
    assert (1, 0, 1, True) in got and (3, 0, 3, True) in got and (6, 1, 6, True) in got
    assert len(got) == len(EDGE)
    assert neardup.near_duplicates(docs(spark, [])).count() == 0


def test_lines_against_brute_force(spark):
    texts = make_texts(120, 21)
    places = {}
    for doc_id, text in texts:
        for i, line in enumerate(text.split("\n")):
            places.setdefault(lines.normal(line), []).append((doc_id, i))
    plain = [x for x in places if x]
    sets = [lines.shingle_set(x) for x in plain]
    roots = components(sets, lambda a, b: 100 * len(a & b) >= 80 * len(a | b))
    groups = defaultdict(list)
    for x, r in zip(plain, roots):
        groups[r] += places[x]
    gone = Counter(d for g in groups.values() for d, _ in sorted(g)[1:])
    got = {r.doc_id: r.n_removed for r in lines.dedupe_lines(docs(spark, texts)).collect()}
    assert sum(gone.values()) > 20
    assert got == {d: gone[d] for d, _ in texts}


def test_line_edges(spark):
    out = lines.dedupe_lines(docs(spark, EDGE))
    got = rows(out, "doc_id", "text", "n_lines", "n_removed", "n_chars")
    assert (1, None, 0, 0, 0) in got and (2, "", 0, 0, 0) in got and (None, "one two", 1, 0, 7) in got
    assert (4, "one two", 1, 0, 7) in got and (5, "", 1, 1, 0) in got
    assert [r[2:4] for r in got if r[0] == 7] == [(50, 49)]
    assert rows(lines.clean_lines(docs(spark, EDGE)), "doc_id") == sorted([(1,), (2,), (3,), (4,), (None,), (6,), (7,)], key=repr)
    assert lines.dedupe_lines(docs(spark, [])).count() == 0


def test_lines_of_other_white_space_count_as_lines(spark):
    space = ["\u00a0", "\u2003", "\u3000", "\u0085", "\x1c", " \u00a0\t"]
    texts = [(1, "\n".join(space)), (2, "a unique line\n\u00a0"), (3, "\u3000"), (4, " \t\r\x0b\x0c\nlast line of it")]
    got = {r.doc_id: (r.n_lines, r.n_removed) for r in lines.dedupe_lines(docs(spark, texts)).collect()}
    assert got == {1: (6, 1), 2: (2, 1), 3: (1, 1), 4: (1, 0)}
    assert all(n == sum(bool(x) for x in lines.normal_lines(t)) for (i, t) in texts for n in [got[i][0]])
    assert rows(lines.clean_lines(docs(spark, texts)), "doc_id", "text") == [(1, "\n".join(space[:5])), (2, "a unique line"), (4, texts[3][1])]


def test_components(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(1000 + i, 1001 + i) for i in range(40)] + [(5, 5), (None, 3)]
    got = {r.node: r.label for r in min_label(spark.createDataFrame(edges, "a long, b long")).collect()}
    label = {x: x for e in edges if None not in e for x in e}
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            if a is not None and label[a] != label[b]:
                label[a] = label[b] = min(label[a], label[b])
                changed = True
    assert {n: l for n, l in got.items()} == {n: l for n, l in label.items() if n in got}
    assert {x for e in edges if None not in e and e[0] != e[1] for x in e} <= set(got)


def test_asking_members_stream_past_blocks(spark, monkeypatch):
    monkeypatch.setattr(common, "BLOCK", 4)
    monkeypatch.setattr(common, "ASKING", 3)
    same, other = (" ".join(f"{x}{i}" for i in range(60)) for x in "wx")
    members = [(n, same if n % 3 else other) for n in range(1, 24)]
    lists = spark.createDataFrame([(7, n) for n, _ in members] + [(8, 1)], "value long, node long")
    texts = spark.createDataFrame([(n, common.pack(t)) for n, t in members], "node long, packed binary")
    labels = spark.createDataFrame([(1, 1), (2, 1), (4, 1)], "node long, label long")
    found = common.residual_links(lists, labels, texts, neardup._packed_sets, 85)
    got = {r.node: r.label for r in min_label(found.union(spark.createDataFrame([(1, 2), (1, 4)], "a long, b long"))).collect()}
    assert got == {n: (1 if n % 3 else 3) for n, _ in members}


def test_like_lines_between_unlike_ones_meet(spark):
    """In the order of the band, b is next to x and y alone, which are unlike it."""
    like = [b"the quick brown fox jumps over the lazy dog again", b"the quick brown fox jumps over the lazy dog again!"]
    words = {1: b"some wholly different line of text", 2: like[0], 3: b"and one more that is like no other", 4: like[1], 5: b"short"}
    bands = [(key, a, b) for key in (70, 71) for a, b in ((1, 2), (1, 3), (2, 3), (1, 4), (3, 4), (1, 5), (4, 5))] + [(72, 2, 5)]
    bands = spark.createDataFrame(bands, "key long, a long, b long")
    texts = spark.createDataFrame(list(words.items()), "line long, words binary")
    members = lines._unsettled(bands)
    assert members.count() == 5  # two bands of the same lines are one, one of two lines is settled
    none = spark.createDataFrame([], "node long, label long")
    assert rows(lines._joined(none, members, texts), "line", "label") == [(2, 2), (4, 2)]
    before = spark.createDataFrame([(4, 4), (9, 4)], "node long, label long")
    assert rows(lines._joined(before, members, texts), "line", "label") == [(2, 2), (4, 2), (9, 2)]
