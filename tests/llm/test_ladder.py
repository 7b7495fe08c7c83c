"""Rungs of op8: windows drop out rung by rung, hot keys are joined apart, results stay those of brute force."""

import random

import numpy as np
from test_digests import covered

from terracat.llm import repeats, substring_dedup
from terracat.llm.common import Ranges


def corpus():
    """Documents that share a long passage, one run of 30 words only, a line met in all, and short ones."""
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    some = lambda n: [word() for _ in range(n)]
    passage, run, line = some(90), some(30), ["one", "line"] * 40
    docs = [some(60) + passage + some(40), some(20) + passage[5:] + some(60), some(70) + run + some(70), some(40) + run + some(90), some(30), []]
    docs += [some(rng.randint(0, 20)) + line + some(30) for _ in range(25)]
    return [(k + 1, " ".join(d)) for k, d in enumerate(docs)]


def removed(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    return {r["doc_id"]: r["n_removed"] for r in substring_dedup.dedup_substrings(docs).collect()}


def expected(rows, window=50):
    gone = covered([tuple(t.split()) for _, t in rows], [d for d, _ in rows], window)
    return {d: len(gone[d]) for d, _ in rows}


def test_lengths():
    assert repeats.ladder(50) == [13, 25]
    assert repeats.ladder(100) == [13, 25, 50]
    assert repeats.ladder(6) == [3]


def test_dead_windows_drop_out():
    """A rung looks only at windows whose seed below was repeated."""
    rng = np.random.default_rng(3)
    ranges = Ranges(rng.integers(1, 1 << 62, 400).astype(np.uint64))
    places, every = repeats.seed_places(ranges, 400, 50, 13)
    none, _ = repeats.seed_places(ranges, 400, 50, 25, (13, np.zeros(0, dtype=np.uint64)))
    whole, _ = repeats.seed_places(ranges, 400, 50, 25, (13, every[places]))
    some, _ = repeats.seed_places(ranges, 400, 50, 25, (13, every[places[:1]]))
    plain, _ = repeats.seed_places(ranges, 400, 50, 25)
    assert not len(none) and list(whole) == list(plain) and 0 < len(some) < len(whole)


def test_rungs(spark, monkeypatch):
    rows, seen = corpus(), []
    inner = substring_dedup.repeated_seeds
    monkeypatch.setattr(substring_dedup, "repeated_seeds", lambda seeds, bits, label: seen.append(seeds.count()) or inner(seeds, bits, label))
    assert removed(spark, rows) == expected(rows)
    assert len(seen) == 2 and 0 < seen[1]


def test_no_candidates(spark, monkeypatch):
    """Without a repeated run the ladder ends at its first rung."""
    rows, seen = [(k, " ".join(f"w{k}_{i}" for i in range(80))) for k in range(5)], []
    inner = substring_dedup.repeated_seeds
    monkeypatch.setattr(substring_dedup, "repeated_seeds", lambda seeds, bits, label: seen.append(label) or inner(seeds, bits, label))
    assert removed(spark, rows) == dict.fromkeys(range(5), 0) and len(seen) == 1


def test_hot_keys(spark, monkeypatch):
    monkeypatch.setattr(repeats, "LEAST_HOT", 3)
    monkeypatch.setattr(repeats, "HOT_SHARE", 10)
    rows = corpus()
    assert removed(spark, rows) == expected(rows)
