"""op11: votes against plain cosines, held-out accuracy, and what the fit may see."""

from zlib import crc32

import numpy as np

from terracat.llm import neighbor_quality as N
from terracat.llm import queries as Q

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    rows = Q.op11_quality_neighbors(spark, SF).collect()
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
    for r in rows:
        assert r.held_out == (crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7)
    held = [(r.predicted, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    bad, good = [p for p, y in held if y == 0], [p for p, y in held if y == 1]
    assert len(bad) > 10 and sum(bad) <= 0.1 * len(bad) and sum(good) >= 0.97 * len(good)


def bodies(spark, n):
    return [(r.text or "").encode() for r in spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").limit(n).collect()]


def test_votes_are_those_of_all_vectors(spark):
    texts = bodies(spark, 150) + [b"", b"one"]
    labels = [int(b"%%%" not in t and b"!!" not in t) for t in texts]
    counts = np.concatenate([N.term_counts([t], N.Terms()) for t in texts])
    rarity = np.log((1 + len(texts)) / (1 + (counts > 0).sum(axis=0)))
    model = N.train(texts, labels, rarity, {0: 0.2, 1: 0.8})
    assert model["axes"].shape == (N.BUCKETS, N.DIM) and len(model["vectors"]) == len(texts)
    got = N.vote(model, texts, N.Terms())
    for k, row in enumerate(counts):
        x = np.log1p(row) * rarity
        x = (x / max(np.linalg.norm(x), 1e-300)) @ model["axes"]
        cos = model["vectors"] @ (x / max(np.linalg.norm(x), 1e-300))
        at = np.argsort(-cos)[: N.NEAREST]
        w = np.maximum(cos[at], 1e-3) ** N.SHARP * model["votes"][at]
        assert abs(got[k] - (w * model["labels"][at]).sum() / w.sum()) < 1e-3


def test_directions_are_the_leading_ones(spark):
    texts = bodies(spark, 120)
    rarity = np.ones(N.BUCKETS)
    model = N.train(texts, [k % 2 for k in range(120)], rarity, {0: 0.5, 1: 0.5})
    x = N.weighed(np.concatenate([N.term_counts([t], N.Terms()) for t in texts]), rarity.astype(np.float32))
    whole = (np.linalg.svd(x, compute_uv=False)[: N.DIM] ** 2).sum()
    assert ((x @ model["axes"]) ** 2).sum() > 0.995 * whole


def test_untrained_and_held_out_labels(spark):
    docs = spark.createDataFrame([(k, f"some words of text {k}") for k in range(60)], "doc_id long, text string")
    held = [k for k in range(60) if crc32(str(k).encode()) % 4 == 2]
    labels = spark.createDataFrame([(k, int(k in held)) for k in range(60)], "doc_id long, quality int")
    assert {r.score for r in N.score_quality(docs, N.fit_neighbors(docs, labels)).collect()} == {0.5}  # label 1 stands only where it may not be seen


def test_repeated_words_count(spark):
    plain, twice = b"a bee sea dee", b"bee bee bee sea"
    assert (N.term_counts([plain], N.Terms()) != N.term_counts([twice], N.Terms())).any()
    both = N.term_counts([plain, twice], N.Terms())
    assert (both[0] == N.term_counts([plain], N.Terms())[0]).all() and (both[1] == N.term_counts([twice], N.Terms())[0]).all()
