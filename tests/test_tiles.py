"""Tile merging in rounds of blocks against a single pass in order."""

import random

import pandas as pd
import pytest

from terracat.operators import upkeep as U


def one_pass(tiles, threshold):
    cells = {(c, r): n for n, _, c, r in tiles}
    size = {n: s for n, s, _, _ in tiles}
    first = dict(size)
    members = {n: [n] for n in size}
    beside = {n: {cells[p] for p in ((c + 1, r), (c - 1, r), (c, r + 1), (c, r - 1)) if p in cells} for n, _, c, r in tiles}
    while runts := [n for n in members if size[n] < threshold and beside[n]]:
        small = min(runts, key=lambda n: (size[n], n))
        into = min(beside[small], key=lambda n: (size[n], n))
        members[into] += members.pop(small)
        size[into] += size[small]
        for other in beside.pop(small):
            beside[other].discard(small)
            if other != into:
                beside[other].add(into)
                beside[into].add(other)
    return {m: min((-first[x], x) for x in group)[1] for group in members.values() for m in group}


@pytest.mark.parametrize("side", [8, 48])
def test_blocks(spark, monkeypatch, side):
    monkeypatch.setattr(U, "BLOCK", side)
    rng = random.Random(side)
    sets = {"even": lambda c, r: 7, "mixed": lambda c, r: rng.randint(1, 30), None: lambda c, r: rng.choice([1, 1, 2, 90])}
    rows, want = [], {}
    for name, size in sets.items():
        tiles = [(f"t_{c:03d}_{r:03d}", size(c, r), c, r) for c in range(30) for r in range(20) if rng.random() < 0.8]
        want |= {(name, n): m for n, m in one_pass(tiles, 50).items()}
        rows += [(name, *t) for t in tiles]
    seen = []
    inner = U._written
    monkeypatch.setattr(U, "_written", lambda df, label: seen.append(label) or inner(df, label))
    df = spark.createDataFrame(rows, "dataset string, name string, size long, col long, row long")
    got = {(r.dataset, r.name): r.merged_into for r in U.tile_runt_merge(df, 50).collect()}
    assert got == want
    assert seen.count("groups") > 1  # rounds over written tables


def test_each_group_waits_once(monkeypatch):
    """Within a block a group that waits is not put into the queue again at the same size."""
    side, pushed, inner = 40, [], U.heapq.heappush
    monkeypatch.setattr(U.heapq, "heappush", lambda heap, entry: pushed.append(entry) or inner(heap, entry))
    at = [(c, r) for c in range(side) for r in range(side)]
    near = lambda c, r: sorted(f"t_{x:03d}_{y:03d}" for x, y in ((c + 1, r), (c - 1, r), (c, r + 1), (c, r - 1)) if 0 <= x < side and 0 <= y < side)
    frame = pd.DataFrame({"dataset": "d", "id": [f"t_{c:03d}_{r:03d}" for c, r in at], "size": [1 + (7 * c + 3 * r) % 19 for c, r in at], "col": [c for c, _ in at], "row": [r for _, r in at], "beside": [near(c, r) for c, r in at], "gone_to": None})
    done = U._merge_block(50)(frame)
    assert done[done["gone_to"].isna()]["size"].min() >= 50 and done[done["gone_to"].isna()]["size"].sum() == frame["size"].sum()
    assert len(pushed) < 8 * len(frame)


SCHEMA = "dataset string, name string, size long, col long, row long"


def merged(spark, rows, threshold):
    got = U.tile_runt_merge(spark.createDataFrame(rows, SCHEMA), threshold).collect()
    assert len(got) == len(rows)
    return {(r.dataset, r.name): r.merged_into for r in got}


@pytest.fixture
def written(monkeypatch):
    """Rows of the groups written in each round."""
    seen, inner = [], U._written

    def count(df, label):
        out = inner(df, label)
        if label == "groups":
            seen.append(out.count())
        return out

    monkeypatch.setattr(U, "_written", count)
    return seen


@pytest.mark.parametrize("most, share", [(5, 1.0), (2, 0.25)])
def test_few_rounds_hold_what_is_open(spark, written, most, share):
    """Tiles of few points, where orders of merging run far: neither do rounds grow with the area nor are settled tiles written again."""
    rng = random.Random(most)
    rows = [("d", f"t_{c:03d}_{r:03d}", rng.randint(1, most), c, r) for c in range(600) for r in range(30) if rng.random() < share]
    got = merged(spark, rows, 50)
    assert len(written) <= 3 and written[0] == len(rows) and sum(written) < 1.3 * len(rows)
    size = {("d", t[1]): t[2] for t in rows}
    for group in set(got.values()):
        own = [(-size["d", n], n) for (_, n), m in got.items() if m == group]
        assert min(own)[1] == group  # the largest tile names it, the least name of several
        assert share == 1 and -sum(s for s, _ in own) >= 50 or share < 1


def test_small_blocks_of_sparse_tiles(spark, monkeypatch, written):
    """Groups of all kinds over many small blocks, at columns and rows below zero too."""
    monkeypatch.setattr(U, "BLOCK", 6)
    rng, rows, want = random.Random(6), [], {}
    for name, share, size in (("a", 0.3, (1, 1)), ("b", 0.45, (0, 3)), ("c", 0.6, (1, 4)), (None, 0.5, (1, 15)), ("", 0.5, (5, 12))):
        tiles = [(f"t_{c}_{r}", rng.randint(*size), c - 9, r - 7) for c in range(18) for r in range(14) if rng.random() < share]
        want |= {(name, n): m for n, m in one_pass(tiles, 12).items()}
        rows += [(name, *t) for t in tiles]
    assert merged(spark, rows, 12) == want
    assert len(written) > 2 and written == sorted(written, reverse=True)


def test_one_place_and_none(spark):
    """Tiles at one place are not beside each other; a tile without a size or a place has no neighbour."""
    rows = [("d", "a", 3, 0, 0), ("d", "b", 2, 0, 0), ("d", "c", 60, 1, 0), ("d", "e", None, 0, 1), ("d", "f", 1, None, 0), ("d", "g", 2, 0, None), ("e", "a", 1, 0, 0), ("e", "b", 1, 0, 0)]
    assert merged(spark, rows, 50) == {("d", k): v for k, v in zip("abcefg", "cccefg", strict=True)} | {("e", "a"): "a", ("e", "b"): "b"}
