"""op1 on many texts that meet in buckets without being near copies."""

import random
import time

from terracat.llm.near_dup import near_duplicates


def test_many_strangers(spark):
    """Texts that share 120 of 160 shingles stay apart, and those of them that are copies with a word changed do not."""
    rng = random.Random(5)
    common = [f"c{k}" for k in range(121)]
    rows = [(k, " ".join(common + [f"w{rng.randrange(10**9)}" for _ in range(40)])) for k in range(6000)]
    rows += [(10_000 + k, rows[k][1] + " more") for k in range(0, 6000, 60)]
    began = time.time()
    got = {r.doc_id: r.component_id for r in near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(8)).collect()}
    assert all(got[k] == k for k in range(6000)) and all(got[10_000 + k] == k for k in range(0, 6000, 60))
    assert time.time() - began < 240


def test_close_pairs_among_strangers(spark):
    """A cloud around a common text: links are those of all pairs by the definition."""
    rng = random.Random(6)
    common = [f"c{k}" for k in range(130)]
    texts = []
    for _ in range(60):
        own = [f"w{rng.randrange(40)}" for _ in range(28)]
        texts += [" ".join(common + own), " ".join(common + own[: rng.randrange(20, 28)] + [f"x{rng.randrange(30)}" for _ in range(rng.randrange(12))])]
    shingles = [{(a, b) for a, b in zip(t.split(), t.split()[1:], strict=False)} for t in texts]
    parent = list(range(len(texts)))

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for i in range(len(texts)):
        for j in range(i):
            if 100 * len(shingles[i] & shingles[j]) >= 80 * len(shingles[i] | shingles[j]):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    got = {r.doc_id: r.component_id for r in near_duplicates(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)).collect()}
    assert got == {k: root(k) for k in range(len(texts))}
