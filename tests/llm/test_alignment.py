"""op12's links against a plain version that compares byte ranges of whole texts' tokens."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from terracat.llm import queries as Q
from terracat.llm.token_alignment import ByteLevelTokens, Csr, PieceTokens, align_tokens, byte_spelling, shared_group_links


def plain(docs):
    """{doc_id: digest row} from whole texts."""
    a, b = Tokenizer.from_file(Q.BYTE_BPE), sentencepiece.SentencePieceProcessor(model_file=Q.PIECE_BPE)
    a.encode_special_tokens = True
    spelt = byte_spelling()
    found = {}
    for doc, text in docs:
        body, links, groups = (" " + (text or "")).encode(), [], []
        e = a.encode(" " + text, add_special_tokens=False) if text else None
        bytes_a = [bytes(spelt[c] for c in t) for t in e.tokens] if text else []
        ids_b = b.encode(text) if text else []
        bytes_b = [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode() for i, p in ((i, b.id_to_piece(i)) for i in ids_b)]
        if not text or b"".join(bytes_a) != body or b"".join(bytes_b) != body:
            found[doc] = ([], [], [], [], 0)
            continue
        i = j = at_a = at_b = 0
        g_a, g_b, shared = [], [], 0
        while i < len(bytes_a) or j < len(bytes_b):
            end_a = at_a + len(bytes_a[i])
            end_b = at_b + len(bytes_b[j])
            links.append((e.ids[i], ids_b[j]))
            if end_a <= end_b:
                g_a.append(e.ids[i])
                i, at_a = i + 1, end_a
            if end_b <= end_a:
                g_b.append(ids_b[j])
                j, at_b = j + 1, end_b
            if end_a == end_b:
                groups.append((g_a, g_b))
                shared += len(g_a) * len(g_b)
                g_a, g_b = [], []
        found[doc] = (e.ids, ids_b, groups, links, shared)
    total = Counter(x for f in found.values() for x in f[3])
    most = Counter()
    for (_, y), n in total.items():
        most[y] = max(most[y], n)
    out = {}
    for doc, (x, y, groups, links, shared) in found.items():
        spelling = ";".join(",".join(map(str, p)) + "|" + ",".join(map(str, q)) for p, q in groups)
        out[doc] = (len(x), len(y), len(groups), len(links), shared, hashlib.sha256(spelling.encode()).hexdigest() if groups else "", sum(total[p] == most[p[1]] for p in links), sum(total[p] for p in links))
    return out, total


def row(r):
    return (r.n_a, r.n_b, r.n_groups, r.n_links, r.n_group_links, r.groups_sha256, r.n_best, r.count_sum)


def test_whole_tables(spark):
    sf = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    want, _ = plain(docs)
    got = {r.doc_id: row(r) for r in Q.op12_token_alignment(spark, sf).collect()}
    assert got == want


@pytest.fixture(scope="module")
def odd_texts():
    rng = random.Random(8)
    parts = [" ", "  ", "\n", "\n\n", "\t", "\r\n", " ", " ", " ", "\x1c", "\x85", "word", "Über", "don't", "'s", "123", "日本語", "😀", "é", "<|endoftext|>", "<s>", "</s>", "<0x0A>", "...", "=" * 40, "a" * 300, "﻿", "\x00", "ß", "ǅ", "​"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(1, 40))) for _ in range(400)]
    return [*texts, " ", "\n", "x ", " x", "x\n", "▁", "a ▁ b", "", None, "a  b   c    d ", "\n \n x"]


def test_odd_texts(spark, odd_texts):
    want, total = plain(list(enumerate(odd_texts)))
    docs = spark.createDataFrame(list(enumerate(odd_texts)), "doc_id long, text string").repartition(3)
    found, pairs = align_tokens(docs, Q.BYTE_BPE, Q.PIECE_BPE)
    assert {r.doc_id: row(r) for r in found.collect()} == want
    assert {(r.a_id, r.b_id): r.total for r in pairs.collect()} == dict(total)
    assert sum(v[0] > 0 for v in want.values()) > 350


def test_small_chunks(spark, odd_texts, monkeypatch):
    from terracat.llm import token_alignment as T

    monkeypatch.setattr(T, "BLOCK", 64)
    known = T.Segments(ByteLevelTokens(Q.BYTE_BPE), PieceTokens(Q.PIECE_BPE))
    batch = T.align_chunk(5, list(range(len(odd_texts))), [t or "" for t in odd_texts], known)
    want, _ = plain(list(enumerate(odd_texts)))
    rows = [r for r in batch.to_pylist() if r["is_doc"]]
    assert [(r["n_a"], r["n_links"], r["groups_sha256"]) for r in rows] == [(want[k][0], want[k][3], want[k][5]) for k in range(len(odd_texts))]


def test_products():
    rng = np.random.default_rng(1)
    def sparse(n, m):
        dense = (rng.random((n, m)) < 0.2) * rng.integers(1, 5, (n, m))
        rows, cols = np.nonzero(dense)
        return dense, Csr(np.concatenate(([0], np.cumsum(np.bincount(rows, minlength=n)))), cols, dense[rows, cols], m)
    def dense_of(c):
        out = np.zeros((c.height, c.width), dtype=np.int64)
        out[c.rows(), c.indices] = c.data
        return out
    for _ in range(20):
        (x, a), (y, b) = sparse(rng.integers(1, 12), 9), sparse(9, rng.integers(1, 12))
        assert (dense_of(a.times(b)) == x @ y).all() and (dense_of(a.transpose()) == x.T).all()
    blocks = list(shared_group_links(np.array([2, 3, 1]), np.array([5, 1])))
    assert [(int(r), int(c)) for rows, cols, _ in blocks for r, c in zip(rows, cols, strict=True)] == [(0, 0), (1, 0), (2, 1)]


def test_odd_rows(spark):
    rows = [(None, "some text"), (1, None), (1, "some text"), (1, "some text")]
    got = sorted((r.doc_id or 0, r.n_a, r.count_sum) for r in align_tokens(spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 chunk", "2 pairs"), Q.BYTE_BPE, Q.PIECE_BPE)[0].collect())
    assert got == [(0, 2, 6), (1, 0, 0), (1, 2, 6), (1, 2, 6)]
    assert align_tokens(spark.createDataFrame([], "doc_id long, text string"), Q.BYTE_BPE, Q.PIECE_BPE)[0].collect() == []


def test_both_products_are_taken(monkeypatch):
    """Overlap links and shared-group links both come from products of matrices."""
    import public_tokenizers

    from terracat.llm import token_alignment as T

    taken, inner = [], T.Csr.blocks
    monkeypatch.setattr(T.Csr, "blocks", lambda self, other: taken.append((self.height, other.width)) or inner(self, other))
    known = T.Segments(T.ByteLevelTokens(public_tokenizers.path("byte_bpe_50k.json")), T.PieceTokens(public_tokenizers.path("piece_bpe_32k.model")))
    rows = T.align_chunk(0, [1], ["unbelievable alignments of tokens"], known).to_pylist()
    assert taken == [(rows[0]["n_a"], rows[0]["n_b"])] * 2
