"""Byte-level dedup of long runs of one byte, of texts of one repeated line, and of seeds in very many surroundings."""

import hashlib
import random

import pytest

from terracat.llm import suffix_dedup as S
from test_digests import SCHEMA, covered


def check(spark, texts, heavy, ids=None):
    ids = ids or list(range(len(texts)))
    docs = spark.createDataFrame([(d, t, "", "", len(t)) for d, t in zip(ids, texts, strict=True)], SCHEMA).repartition(3)
    got = {r["doc_id"]: tuple(r)[1:5] for r in S.dedup_bytes(docs, heavy=heavy).collect()}
    gone = covered([t.encode() for t in texts], ids, 50)
    for d, t in zip(ids, texts, strict=True):
        kept = bytes(x for i, x in enumerate(t.encode()) if i not in gone[d])
        runs = sum(1 for i in gone[d] if i - 1 not in gone[d])
        assert got[d] == (len(t.encode()), len(gone[d]), runs, hashlib.sha256(kept).hexdigest()), d
    return sum(map(len, gone.values()))


@pytest.mark.parametrize("heavy", [3, S.HEAVY])
def test_runs_of_one_byte(spark, heavy):
    rng = random.Random(7)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(40))
    line = "=" * 40 + "\n"
    texts = [word() + " " * 6000 + word(), word() + " " * 90 + word(), word() + " " * 3000 + word(), " " * 7000, word() + line * 3000 + word(), word() + line * 4, "x" + line * 200 + word(), "0" * 500]
    assert check(spark, texts, heavy)


@pytest.mark.parametrize("heavy", [3, S.HEAVY])
def test_seed_in_many_surroundings(spark, heavy):
    """One phrase after and before many others, some of which repeat; every byte value of two-byte letters."""
    rng = random.Random(8)
    ends = ["".join(rng.choice("abcdéüß€") for _ in range(rng.randint(10, 60))) for _ in range(30)]
    texts = [rng.choice(ends) + "the phrase that all of these texts hold" + rng.choice(ends) for _ in range(150)]
    ids = rng.sample(range(10_000), len(texts))
    assert check(spark, texts, heavy, ids)
