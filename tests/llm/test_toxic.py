"""op7: recall on rows that training never sees, and scores that do not grow with length."""

import random
from zlib import crc32

import numpy as np
import pytest

from terracat.llm import queries as Q
from terracat.llm import toxicity as T


def read(spark, sf):
    docs, labels = (Q.table(spark, f"/root/testdata/{sf}", t) for t in ("documents", "labels"))
    return docs, labels


@pytest.fixture(scope="module")
def larger(spark):
    docs, labels = read(spark, "sf0.1")
    return docs, labels, T.fit_toxicity(docs, labels)


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_held_out(spark, larger, sf):
    docs, labels = read(spark, sf)
    model = larger[2] if sf == "sf0.1" else T.fit_toxicity(docs, labels)
    rows = T.score_toxicity(docs, model).join(labels, "doc_id").where("held_out").collect()
    toxic = [r["predicted"] for r in rows if r["toxic"] == 1]
    clean = [r["predicted"] for r in rows if r["toxic"] == 0]
    assert len(toxic) > 5 and sum(toxic) >= 0.9 * len(toxic) and sum(clean) <= 0.02 * len(clean), (sum(toxic), len(toxic), sum(clean), len(clean))
    assert all(r["held_out"] == (crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)


def test_length_alone_is_not_toxic(spark, larger):
    docs, labels, model = larger
    held = docs.join(labels.where("toxic = 0"), "doc_id").where(T.held_out(docs["doc_id"])).orderBy("doc_id").limit(300).collect()
    words = [w for r in held for w in r["text"].split()]
    scorer, rng = T.Scorer(model), random.Random(3)
    scores = [[scorer.score(" ".join(rng.choice(words) for _ in range(n))) for _ in range(4)] for n in (200, 1000, 5000, 20_000)]
    assert max(map(max, scores)) < 0.5
    rude = [t for t in ("idiot moron scum", "idiott moronn scumm") for _ in range(1)]
    assert all(scorer.score(t) > 0.5 for t in rude)


def test_pool_of_many_is_pool_of_each():
    rng = np.random.default_rng(2)
    sizes = np.array([1, 2, 3, 50, 400, 1])
    shares = rng.standard_normal(sizes.sum())
    edge = np.cumsum(sizes) - sizes
    gap, counts = T.pooled(shares, edge, sizes, 0.5)
    for k, (e, n) in enumerate(zip(edge, sizes, strict=True)):
        own = shares[e : e + n]
        runs = sorted((own[:-1] + own[1:]) / 2 if n > 1 else own)
        most = min(len(runs), max(T.LEAST, -(-len(runs) // 100)))
        assert abs(gap[k] - (np.mean(runs[-most:]) + 0.5)) < 1e-12
        assert abs(counts[e : e + n].sum() - 1) < 1e-12 and abs(counts[e : e + n] @ own + 0.5 - gap[k]) < 1e-12


def test_even_score_is_toxic(spark):
    """A score of exactly 0.5 is predicted 1; the untrained model gives every text that."""
    docs = spark.createDataFrame([(1, "a"), (2, None), (3, "long " * 40_000)], "doc_id long, text string")
    assert {(r["score"], r["predicted"]) for r in T.score_toxicity(docs, T.train([], [])).collect()} == {(0.5, 1)}
