"""Repeated ids too large to be numbered below, very long texts, and the pipeline as a whole."""

import random

import corpus_pipeline as P
import pytest

from terracat.llm.decontaminate import find_contamination
from terracat.llm.html_text import main_text
from terracat.llm.near_dup import near_duplicates
from terracat.llm.quality import judge_quality
from terracat.llm.substring_dedup import dedup_substrings
from terracat.llm.suffix_dedup import dedup_bytes
from test_stages import prose

WIDE = "doc_id long, text string, uid string, real_id string"
LOW, HIGH = -(1 << 63), (1 << 62) + 5


def test_wide_ids(spark):
    a, b = prose(1), prose(2)
    docs = spark.createDataFrame([(HIGH, a, "", ""), (HIGH, b, "", ""), (LOW, b, "", ""), (None, a, "", ""), (3, "one", "", "")], WIDE)
    key = lambda r: (r["doc_id"] is None, r["doc_id"] or 0)
    near = sorted(near_duplicates(docs).collect(), key=key)
    assert [(r["doc_id"], r["component_id"]) for r in near if r["doc_id"] != HIGH] == [(LOW, LOW), (3, 3), (None, None)]
    assert {r["component_id"] for r in near if r["doc_id"] == HIGH} <= {LOW, HIGH}
    assert sorted((r["doc_id"] or 0, r["n_removed"] > 0) for r in dedup_substrings(docs).collect()) == [(LOW, False), (0, False), (3, False), (HIGH, False), (HIGH, True)]
    assert sorted((r["doc_id"] or 0, r["n_removed"] > 0) for r in dedup_bytes(docs).collect()) == [(LOW, False), (0, False), (3, False), (HIGH, False), (HIGH, True)]
    items = spark.createDataFrame([(1, " ".join(b.split()[5:20]))], "item_id long, text string")
    assert sorted((r["doc_id"] or 0, r["n_hit"]) for r in find_contamination(docs, items).collect()) == [(LOW, 15), (0, 0), (3, 0), (HIGH, 0), (HIGH, 15)]


def test_very_long_text(spark):
    """One text of megabytes, of which another document holds a part."""
    rng = random.Random(5)
    words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(3, 9))) for _ in range(400_000)]
    long, part = " ".join(words), " ".join(words[200_000:200_500])
    docs = spark.createDataFrame([(1, long), (2, "start " + part + " end")], "doc_id long, text string")
    assert {r["doc_id"]: r["n_removed"] for r in dedup_substrings(docs).collect()} == {1: 0, 2: 500}
    removed = {r["doc_id"]: r["n_removed"] for r in dedup_bytes(docs).collect()}
    assert removed[1] == 0 and removed[2] >= len(part)
    assert {r["doc_id"]: r["n_words"] for r in judge_quality(docs).collect()} == {1: 400_000, 2: 502}


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.001"])
def test_pipeline(spark, sf):
    """Every stage keeps rows of its input alone, and the last packs all that the fourth kept."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for _, stage in P.STAGES[:-1]:
        out = stage(spark, docs, sf).cache()
        assert out.columns == docs.columns
        ids, were = [r["doc_id"] for r in out.select("doc_id").collect()], {r["doc_id"] for r in docs.select("doc_id").collect()}
        assert len(ids) == len(set(ids)) and set(ids) <= were and ids
        docs = out
    packed = P.pack(spark, docs, sf).collect()
    assert {r["doc_id"] for r in packed} == set(ids)
    fill = {}
    for r in packed:
        fill[r["sequence_id"]] = fill.get(r["sequence_id"], 0) + r["length"]
    assert max(fill.values()) <= 2048


def test_comment_paragraphs():
    text = "A sentence, of some length, that reads like an article and goes on for a while. " * 3
    assert "first!" not in main_text(f"<article><p>{text}</p><p>{text}</p><p class='comment'>first!</p></article>")
