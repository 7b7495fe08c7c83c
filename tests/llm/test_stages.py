"""Stages of the pipeline on rows of null and repeated ids: each row is a document."""

import random

import corpus_pipeline as P
import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
SF = "/root/testdata/sf0.001"


def prose(seed, n=150):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(3, 8))) for _ in range(n))


def table(spark, rows):
    return spark.createDataFrame([(i, t, "xx", s, len(t or "")) for i, t, s in rows], SCHEMA).repartition(3)


def told(df):
    assert df.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    return sorted((r["source"] for r in df.collect()), key=str)


def test_quality_rows(spark):
    rows = [(1, prose(1), "good"), (1, "#$ %% && " * 30, "bad"), (None, prose(2), "nameless"), (None, "!! #", "bad"), (2, None, "bad"), (3, prose(3), "own"), (3, prose(3), "own")]
    assert told(P.quality(spark, table(spark, rows), SF)) == ["good", "nameless", "own", "own"]


def test_near_dedup_rows(spark):
    a, b, c = prose(1), prose(2), prose(3)
    rows = [(1, a, "a"), (1, a, "a"), (2, a, "later"), (2, b, "b"), (None, a, "later"), (None, c, "c"), (None, c, "c"), (4, "", "empty"), (4, "", "empty"), (None, None, "none")]
    assert told(P.near_dedup(spark, table(spark, rows), SF)) == ["a", "b", "c", "empty", "empty", "none"]


def test_byte_dedup_rows(spark):
    a, b = prose(1), prose(2)
    rows = [(1, a, "a"), (2, a + b, "b"), (2, b + a, "cut"), (2, "short", "short"), (None, a, "gone"), (None, "x" * 30 + a, "tail"), (None, None, "none"), (3, a, "gone")]
    got = sorted(((r["source"], r["text"], r["n_chars"]) for r in P.byte_dedup(spark, table(spark, rows), SF).collect()), key=str)
    text = {s: t for s, t, _ in got}
    assert len(got) == len(text) == 5
    assert text["a"] == a and text["short"] == "short" and text["none"] is None and text["tail"] == "x" * 30
    assert sorted(t for s, t in text.items() if s in ("b", "cut")) == [b]  # whichever comes first keeps b
    assert all(n == (None if t is None else len(t)) for _, t, n in got)


def test_decontaminate_rows(spark):
    item = next(r["text"] for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect() if len((r["text"] or "").split()) >= 15)
    rows = [(1, item, "hit"), (1, prose(1), "clean"), (None, item, "hit"), (None, prose(2), "nameless"), (2, prose(3), "own"), (2, prose(3), "own")]
    assert told(P.decontaminate(spark, table(spark, rows), SF)) == ["clean", "nameless", "own", "own"]


@pytest.mark.parametrize("stage", [P.quality, P.near_dedup, P.byte_dedup, P.decontaminate])
def test_no_rows(spark, stage):
    assert stage(spark, spark.createDataFrame([], SCHEMA), SF).collect() == []
