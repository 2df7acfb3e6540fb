"""Cross-tokenizer alignment against plain loops over bytes."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from patchloom.llm import alignment, queries
from patchloom.llm.bytepair import byte_signs
from patchloom.llm.common import table
from tests.llm.helpers import EDGE, docs

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
TEXTS = [
    "",
    " ",
    "  two  spaces ",
    "ein Wörterbuch über naïve Straße",
    "日本語 and ＡＢＣ ﬁ é <s> </s> <0x41> <|endoftext|>",
    "a ▁ mark that is a space elsewhere",
    "tab\tand\nline\r\n\x00 ",
    "x" * 500 + " " * 40 + "y",
    "😀😀 ½",
]


@pytest.fixture(scope="module")
def by_hand():
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=B)
    signs = byte_signs()

    def bytes_a(i):
        return bytes(signs[c] for c in a.id_to_token(i))

    def bytes_b(i):
        return bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()

    def tokens(text):
        if not text:
            return [], []
        ia, ib = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
        whole = (" " + text).encode()
        if b"".join(map(bytes_a, ia)) != whole or b"".join(map(bytes_b, ib)) != whole:
            return [], []
        return [(i, len(bytes_a(i))) for i in ia], [(i, len(bytes_b(i))) for i in ib]

    def report(rows):
        """Rows (doc_id, text) to the columns of the contract."""
        out, linked, count = [], [], Counter()
        for doc_id, text in rows:
            ta, tb = tokens(text)
            spans = []
            for side in (ta, tb):
                at, own = 0, []
                for i, n in side:
                    own.append((i, at, at + n))
                    at += n
                spans.append(own)
            links, low = [], 0
            for i, x, y in spans[0]:
                while low < len(spans[1]) and spans[1][low][2] <= x:
                    low += 1
                k = low
                while k < len(spans[1]) and spans[1][k][1] < y:
                    links.append((i, spans[1][k][0]))
                    k += 1
            cuts = sorted({y for _, _, y in spans[0]} & {y for _, _, y in spans[1]})
            groups, before = [], 0
            for cut in cuts:
                groups.append("|".join(",".join(str(i) for i, _, y in side if before < y <= cut) for side in spans))
                before = cut
            digest = hashlib.sha256(";".join(groups).encode()).hexdigest() if ta else ""
            linked.append(links)
            count.update(set(links))
            out.append([doc_id, len(ta), len(tb), len(cuts), len(links), digest])
        best = defaultdict(int)
        for (x, _), c in count.items():
            best[x] = max(best[x], c)
        return [(*o[:5], sum(count[p] == best[p[0]] for p in links), sum(count[p] for p in links), o[5]) for o, links in zip(out, linked)]

    return report


def ours(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=repr)


def test_gustavson_equals_dense_products(monkeypatch):
    rng = np.random.default_rng(4)
    for limit in (1, 7, 10_000):
        monkeypatch.setattr(alignment, "PRODUCT_TERMS", limit)
        for _ in range(30):
            left, right = rng.integers(0, 3, (7, 5)) * rng.integers(0, 2, (7, 5)), rng.integers(0, 3, (5, 9)) * rng.integers(0, 2, (5, 9))

            def sparse(m):
                rows, columns = np.nonzero(m)
                return alignment.Csr(np.searchsorted(rows, np.arange(len(m) + 1)), columns, m[rows, columns], m.shape[1])

            got = np.zeros((7, 9), dtype=int)
            for row, column, value in sparse(left).times(sparse(right)):
                got[row, column] = value
            assert (got == left @ right).all()
            turned = sparse(left).transpose()
            back = np.zeros((5, 7), dtype=int)
            back[np.repeat(np.arange(5), np.diff(turned.indptr)), turned.indices] = turned.data
            assert (back == left.T).all()
            assert (sparse(left).terms(sparse(right)) == (left != 0).astype(int) @ (right != 0).sum(axis=1)).all()


def test_pieces_that_are_not_the_text():
    encoder, model = alignment.PieceEncoder(B), sentencepiece.SentencePieceProcessor(model_file=B)
    for text, ids in zip(TEXTS, encoder.encode(TEXTS)):
        if text and "▁" not in text:
            assert np.frombuffer(ids, "<u4").tolist() == model.encode(text)
    assert encoder.encode(["a ▁ b"]) == [None]


def test_edge_rows_equal_loops(spark, by_hand):
    given = [*EDGE, *((100 + i, t) for i, t in enumerate(TEXTS))]
    assert ours(alignment.align_documents(docs(spark, given).coalesce(2), A, B)) == sorted(by_hand(given), key=repr)
    assert alignment.align_documents(docs(spark, []).coalesce(1), A, B).count() == 0


def test_blocks_change_nothing(spark, small, by_hand, monkeypatch):
    rows = [tuple(r) for r in table(spark, small, "documents").select("doc_id", "text").collect()]
    want = sorted(by_hand(rows), key=repr)
    assert ours(queries.op13_token_alignment(spark, small)) == want
    monkeypatch.setattr(alignment, "BLOCK_LINKS", 2_000)
    many = table(spark, small, "documents").repartition(2)
    assert ours(alignment.align_documents(many, A, B)) == want


def test_links_and_pair_counts(spark):
    given = [(1, "naïve Straße"), (2, "naïve Straße"), (3, "Straße")]
    rows = alignment.link_rows(docs(spark, given).coalesce(1), A, B).collect()
    by_doc = defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append((r.a_place, r.b_place, r.a_id, r.b_id, r.shared))
    assert sorted(by_doc[1]) == sorted(by_doc[2])
    for doc_id, text in given:
        assert sum(x[4] for x in by_doc[doc_id]) == len((" " + text).encode())
    counts = Counter(p for links in by_doc.values() for p in {(x[2], x[3]) for x in links})
    got = alignment.pair_counts(docs(spark, given).coalesce(1), A, B).collect()
    assert {(r.a_id, r.b_id): r.n_docs for r in got} == dict(counts)
    for r in got:
        assert r.best == (r.n_docs == max(c for (a, _), c in counts.items() if a == r.a_id))


def test_group_links_are_counted_without_being_made():
    align = alignment.aligner(A, B)
    found = align.align(["naïve Straße über", "日本語"])
    made = sum(len(a) for a, _, _ in found.group_links())
    assert made == int(found.groups[0].terms(found.groups[1].transpose()).sum())
