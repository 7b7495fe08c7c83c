"""Nulls, empty tables, repeated rows and clashing extra columns, for each operator as its docstring defines them."""

import pytest

from terracat.llm import queries as Q
from terracat.llm.decontaminate import find_contamination
from terracat.llm.html_text import extract_pages
from terracat.llm.near_dup import near_duplicates
from terracat.llm.neighbor_quality import fit_neighbors, score_quality
from terracat.llm.packing import pack_documents
from terracat.llm.periodic_runs import periodic_runs
from terracat.llm.quality import judge_quality
from terracat.llm.substring_dedup import dedup_substrings
from terracat.llm.suffix_dedup import dedup_bytes
from terracat.llm.token_alignment import align_tokens
from terracat.llm.tokens import token_index
from terracat.llm.toxicity import fit_toxicity, score_toxicity
from terracat.llm.warc import archive_pages

LONG = " ".join(f"word{k}" for k in range(70))
#: Names that operators use for columns of their own.
CLASH = ("uid", "body", "n", "key", "rep", "ids", "size", "item", "bin", "kept", "score", "n_words", "start", "piece", "pattern", "same", "window_id")
DOCS = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in CLASH)
PAGES = "page_id long, url string, html string, text string, payload string, n_chars string, digest string"
ITEMS = "item_id string, text string, window_id string, shingle string"


def rows():
    texts = [(1, LONG), (2, LONG), (3, None), (None, LONG), (None, None), (4, ""), (2, LONG), (5, "one")]
    return [(i, t, None, None, None, *[c for c in CLASH]) for i, t in texts]


def page_rows():
    return [(1, None, None, *"abcd"), (2, "http://a.b/c", "<p>" + LONG + "</p>", *"abcd"), (None, None, "<p>x", *"abcd"), (3, "http://a.b/c", "<p>" + LONG + "</p>", *"abcd"), (3, "", "", *"abcd")]


def toxicity(docs):
    labels = docs.sparkSession.createDataFrame([(1, 1, None), (2, 0, 1), (None, 1, 1), (5, None, 0)], "doc_id long, toxic int, quality int")
    return score_toxicity(docs, fit_toxicity(docs, labels))


def neighbors(docs):
    labels = docs.sparkSession.createDataFrame([(1, 1, None), (2, 0, 0), (None, 1, 1), (5, None, 1)], "doc_id long, toxic int, quality int")
    return score_quality(docs, fit_neighbors(docs, labels))


def contamination(docs):
    items = docs.sparkSession.createDataFrame([("a", " ".join(LONG.split()[5:20]), "x", "y"), ("b", None, "x", "y"), (None, LONG, "x", "y"), ("c", "", None, None)], ITEMS)
    return find_contamination(docs, items, window=10)


DOCUMENT_OPS = {
    "near_dup": near_duplicates,
    "contamination": contamination,
    "quality": judge_quality,
    "tokens": lambda d: token_index(d, Q.WORD_BPE, "dropped", 1),
    "toxicity": toxicity,
    "substring": dedup_substrings,
    "packing": lambda d: pack_documents(d, Q.BYTE_BPE, "kept", 0, 2048),
    "suffix": dedup_bytes,
    "neighbors": neighbors,
    "alignment": lambda d: align_tokens(d, Q.BYTE_BPE, Q.PIECE_BPE)[0],
    "runs": periodic_runs,
}


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows(), DOCS).repartition(3)


@pytest.mark.parametrize("name", DOCUMENT_OPS)
def test_document_rows_stay(docs, name):
    got = DOCUMENT_OPS[name](docs).collect()
    order = lambda ids: sorted(ids, key=lambda i: (i is None, i))
    assert order(r["doc_id"] for r in got) == order(r[0] for r in rows())


@pytest.mark.parametrize("name", DOCUMENT_OPS)
def test_empty_documents(spark, name):
    assert DOCUMENT_OPS[name](spark.createDataFrame([], DOCS)).collect() == []


def test_null_and_repeated_ids(docs):
    component = {(r["doc_id"], r["n_shingles"]): (r["component_id"], r["kept"]) for r in near_duplicates(docs).collect()}
    assert component[2, 69] == (1, False) and component[1, 69] == (1, True) and component[3, 0] == (3, True)
    removed = sorted((r["doc_id"] or 0, r["n_removed"]) for r in dedup_substrings(docs).collect())
    assert removed == [(0, 0), (0, 0), (1, 0), (2, 70), (2, 70), (3, 0), (4, 0), (5, 0)]
    removed = sorted((r["doc_id"] or 0, r["n_removed"]) for r in dedup_bytes(docs).collect())
    assert removed == [(0, 0), (0, 0), (1, 0), (2, len(LONG)), (2, len(LONG)), (3, 0), (4, 0), (5, 0)]
    hit = sorted((r["doc_id"] or 0, r["n_hit"]) for r in contamination(docs).collect())
    assert hit == [(0, 0), (0, 0), (1, 15), (2, 15), (2, 15), (3, 0), (4, 0), (5, 0)]


def test_no_items(spark, docs):
    assert not find_contamination(docs, spark.createDataFrame([], ITEMS), window=10).where("n_hit > 0 or contaminated").count()


@pytest.mark.parametrize("op", [extract_pages, archive_pages])
def test_page_rows(spark, op):
    got = op(spark.createDataFrame(page_rows(), PAGES)).collect()
    assert sorted((r["page_id"] or 0) for r in got) == [0, 1, 2, 3, 3]
    assert op(spark.createDataFrame([], PAGES)).collect() == []
