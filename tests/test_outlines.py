"""Outlines of many parts at once, against a walk along each part's edges."""

import random
from collections import defaultdict

import pytest

from terracat.operators import footprints as P


def walked(cells):
    """Rings of one part: from the smallest place left, edges with the part on their right, right turns first."""
    ahead = defaultdict(list)
    for x, y in cells:
        for beside, a, b in (((x, y - 1), (x, y), (x + 1, y)), ((x + 1, y), (x + 1, y), (x + 1, y + 1)), ((x, y + 1), (x + 1, y + 1), (x, y + 1)), ((x - 1, y), (x, y + 1), (x, y))):
            if beside not in cells:
                ahead[a].append(b)
    rings = []
    for start in sorted(ahead):
        while ahead[start]:
            ring, at = [start], ahead[start].pop()
            while at != start:
                (px, py), (x, y) = ring[-1], at
                ring.append(at)
                right = (x - (y - py), y + (x - px))
                at = right if right in ahead[at] else ahead[at][0]
                ahead[x, y].remove(at)
            n = len(ring)
            corners = [p for k, p in enumerate(ring) if not any(ring[k - 1][c] == p[c] == ring[(k + 1) % n][c] for c in (0, 1))]
            area = sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(corners, corners[1:] + corners[:1], strict=True)) // 2
            rings.append((area < 0, " ".join(f"{x},{y}" for x, y in corners), abs(area)))
    return sorted(rings)


@pytest.mark.parametrize("chunk", [1, 40, 100_000])
def test_outlines(spark, chunk):
    rng = random.Random(chunk)
    at = {(i, x, y) for i, share in (("a", 0.5), ("b", 0.65), ("c", 0.8), ("d", 0.35)) for x in range(30) for y in range(30) if rng.random() < share}
    mask = spark.createDataFrame([(i, x, y, True) for i, x, y in at], "item string, gx long, gy long, valid boolean")
    parts = P.regions(mask).selectExpr("item", "gx", "gy", "region as part")
    own = defaultdict(set)
    for r in parts.collect():
        own[r.item, r.part].add((r.gx, r.gy))
    want = {(*k, n, *ring) for k, cells in own.items() for n, ring in enumerate(walked(cells))}
    got = P.footprint_rings(parts, chunk=chunk).collect()
    assert {(r.item, r.part, r.ring, r.hole, r.corners, r.cells) for r in got} == want and len(got) == len(want)


def test_no_group_of_its_own_for_each_part(spark):
    """What a pandas group costs is not paid for each of very many small parts, and a grid's parts are dealt over tasks."""
    parts = spark.range(400).selectExpr("'a' as item", "id % 20 * 2 as gx", "id div 20 * 2 as gy", "id as part")
    plan = P.footprint_rings(parts)._jdf.queryExecution().executedPlan().toString()
    assert "InPandas" not in plan and "hashpartitioning(item" in plan and "REPARTITION_BY_COL" in plan
