"""Ties and very long texts, for operators whose other tests have none."""

import random

import pytest

from terracat.llm import queries as Q
from terracat.llm.decontaminate import find_contamination
from terracat.llm.near_dup import near_duplicates
from terracat.llm.neighbor_quality import fit_neighbors, score_quality
from terracat.llm.packing import pack_documents
from terracat.llm.periodic_runs import periodic_runs
from terracat.llm.token_alignment import align_tokens
from terracat.llm.tokens import token_index
from terracat.llm.toxicity import fit_toxicity, score_toxicity
from terracat.llm.warc import archive_pages


def test_equal_largest_pages(spark):
    """Rows that share the largest page_id and the payload are all the response; smaller ids revisit it."""
    rows = [(7, "http://a/1", "<p>x"), (7, "http://a/2", "<p>x"), (5, "http://a/3", "<p>x"), (7, "http://a/4", "<p>y")]
    got = [(r.page_id, r.record_type, r.refers_to) for r in archive_pages(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()]
    assert sorted(got, key=str) == [(5, "revisit", 7), (7, "response", None), (7, "response", None), (7, "response", None)]


def test_equal_sizes_pack(spark):
    docs = spark.createDataFrame([(k, "one two three") for k in range(1000)], "doc_id long, text string").repartition(4)
    rows = pack_documents(docs, Q.BYTE_BPE, "kept", 0, 2048).collect()
    size = {r.length for r in rows}
    assert len(size) == 1 and len(rows) == 1000
    per = 2048 // size.pop()
    assert len({r.sequence_id for r in rows}) == -(-1000 // per)
    assert len({(r.sequence_id, r.offset) for r in rows}) == 1000


@pytest.fixture(scope="module")
def long_docs(spark):
    rng = random.Random(3)
    words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 9))) for _ in range(3000)]
    prose = " ".join(rng.choice(words) for _ in range(250_000))
    return prose, spark.createDataFrame([(1, prose), (2, prose + " end"), (3, "x" * 1_000_000), (4, "short text of some words")], "doc_id long, text string").repartition(2)


def test_megabytes(spark, long_docs):
    prose, docs = long_docs
    n = len(prose.split())
    alike = {r.doc_id: (r.n_shingles > 0, r.component_id) for r in near_duplicates(docs).collect()}
    assert alike == {1: (True, 1), 2: (True, 1), 3: (True, 3), 4: (True, 4)}
    items = spark.createDataFrame([("a", " ".join(prose.split()[n - 12 : n]))], "item_id string, text string")
    hit = {r.doc_id: r.n_hit for r in find_contamination(docs, items, window=10).collect()}
    assert hit == {1: 12, 2: 12, 3: 0, 4: 0}
    runs = {r.doc_id: (r.n_words, len(r.runs)) for r in periodic_runs(docs).collect()}
    assert runs == {1: (n, 0), 2: (n + 1, 0), 3: (1, 0), 4: (5, 0)}
    aligned = {r.doc_id: r for r in align_tokens(docs, Q.BYTE_BPE, Q.PIECE_BPE)[0].collect()}
    assert aligned[2].n_links > aligned[1].n_links > n and aligned[3].n_groups > 0 and aligned[1].n_a > n / 2
    tokens = {r.doc_id: r.n_tokens for r in token_index(docs, Q.WORD_BPE, "dropped", 1).collect()}
    assert tokens[2] == tokens[1] + 1 and tokens[1] > n
    packed = [(r.doc_id, r.length) for r in pack_documents(docs, Q.BYTE_BPE, "kept", 0, 2048).collect()]
    assert sum(k for d, k in packed if d == 1) > n and max(k for _, k in packed) <= 2048
    labels = spark.createDataFrame([(1, 1, 0), (4, 0, 1), (3, 1, 1)], "doc_id long, quality int, toxic int")
    assert {r.doc_id for r in score_toxicity(docs, fit_toxicity(docs, labels)).collect()} == {1, 2, 3, 4}
    assert {r.doc_id for r in score_quality(docs, fit_neighbors(docs, labels)).where("score between 0 and 1").collect()} == {1, 2, 3, 4}
