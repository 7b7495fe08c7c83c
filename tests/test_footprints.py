"""Footprints of written masks: known values, and plain versions."""

import random

import pytest
from pyspark.sql import functions as F

from terracat.operators import footprints as P

SCHEMA = "item string, gx int, gy int, valid boolean"


def grid(spark, rows, item="a"):
    return spark.createDataFrame([(item, x, y, c == "#") for y, row in enumerate(rows) for x, c in enumerate(row)], SCHEMA).repartition(3)


def cells(df):
    return {(r.gx, r.gy): r.part for r in df.collect()}


def plain_regions(at):
    seen = {}
    for start in sorted(at, key=lambda c: (c[1], c[0])):
        if start not in seen:
            stack = [start]
            seen[start] = (start[1] << 20) + start[0]
            while stack:
                x, y = stack.pop()
                for n in ((x + 1, y), (x - 1, y), (x, y + 1), (x, y - 1)):
                    if n in at and n not in seen and at[n] == at[start]:
                        seen[n] = seen[start]
                        stack.append(n)
    return seen


def test_regions(spark):
    rng = random.Random(5)
    at = {(x, y): rng.random() < 0.55 for x in range(30) for y in range(25)}
    mask = spark.createDataFrame([("a", x, y, v) for (x, y), v in at.items()] + [(None, 0, 0, True), ("b", 0, 0, None)], SCHEMA)
    got = P.regions(mask).collect()
    assert {(r.gx, r.gy): r.region for r in got if r.item == "a"} == plain_regions(at)
    assert [(r.item, r.valid) for r in got if r.item != "a"] == [("b", False)]


def test_specks(spark):
    """A lone hole is filled, a lone cell goes; a hole of two stays."""
    rows = ["......#", ".####..", ".#.##..", ".####..", ".#..#..", ".####.."]
    got = {(r.gx, r.gy) for r in P.absorb_specks(grid(spark, rows), 2).where("valid").collect()}
    want = {(x, y) for y, row in enumerate(rows) for x, c in enumerate(row) if c == "#"} - {(6, 0)} | {(2, 2)}
    assert got == want


def test_two_specks(spark):
    """A grid of two specks has nobody to ask."""
    got = sorted((r.gx, r.valid) for r in P.absorb_specks(grid(spark, ["##.."]), 5).collect())
    assert got == [(0, True), (1, True), (2, False), (3, False)]


def test_parts_and_holes(spark):
    """At 500 m2 a cell: parts of 8 cells, holes of 2; specks are single cells."""
    rows = ["............", ".#####..###.", ".#...#..###.", ".#.#.#......", ".#...#......", ".#####......", "............"]
    got = cells(P.footprint_regions(grid(spark, rows), 500.0))
    ring = {(x, y) for y in range(1, 6) for x in range(1, 6)} - {(x, y) for y in range(2, 5) for x in range(2, 5)}
    assert set(got) == ring and set(got.values()) == {(1 << 20) + 1}
    out = {(r.hole, r.cells, r.corners) for r in P.footprint_rings(P.footprint_regions(grid(spark, rows), 500.0)).collect()}
    assert out == {(False, 25, "1,1 6,1 6,6 1,6"), (True, 9, "2,2 2,5 5,5 5,2")}
    whole = {(x, y) for y in range(1, 6) for x in range(1, 6)}
    specks = cells(P.footprint_regions(grid(spark, rows), 100.0, part_m2=1500.0, hole_m2=1000.0))
    assert set(specks) == whole  # the hole is a speck, and the cell in it follows
    filled = cells(P.footprint_regions(grid(spark, rows), 100.0, part_m2=400.0, hole_m2=1000.0))
    assert {c for c, part in filled.items() if part == (1 << 20) + 1} == whole and len(filled) == 25 + 6


def test_rings(spark):
    """Rings close, turn at every corner and enclose what their part holds."""
    rng = random.Random(9)
    mask = spark.createDataFrame([(i, x, y, rng.random() < 0.6) for i in "ab" for x in range(25) for y in range(25)], SCHEMA)
    parts = P.regions(mask).where("valid").selectExpr("item", "gx", "gy", "region as part")
    size = {}
    for r in parts.collect():
        size[r.item, r.part] = size.get((r.item, r.part), 0) + 1
    area = dict.fromkeys(size, 0)
    for r in P.footprint_rings(parts).collect():
        at = [tuple(map(int, p.split(","))) for p in r.corners.split()]
        for (ax, ay), (bx, by), (cx, cy) in zip(at, at[1:] + at[:1], at[2:] + at[:2], strict=True):
            assert (ax == bx) != (ay == by) and (ax == bx) != (bx == cx)
        area[r.item, r.part] += -r.cells if r.hole else r.cells
    assert area == size


def test_edges(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert P.footprint_rings(P.footprint_regions(empty, 500.0)).collect() == []
    wide = spark.createDataFrame([("a", 0, 0, 1), ("a", 3000, 0, 1)], "item string, gx long, gy long, part long")
    with pytest.raises(Exception, match="cells on a side"):
        P.footprint_rings(wide).collect()


def test_blocks_meet(spark):
    """Regions over many small blocks are those of the whole grid."""
    rng = random.Random(8)
    at = {(x, y): rng.random() < 0.6 for x in range(40) for y in range(33)}
    mask = spark.createDataFrame([("a", x, y, v) for (x, y), v in at.items()], SCHEMA)
    assert {(r.gx, r.gy): r.region for r in P.regions(mask, block=8).collect()} == plain_regions(at)


def crossing(a, b, c, d):
    turn = lambda p, q, r: (q[0] - p[0]) * (r[1] - p[1]) - (q[1] - p[1]) * (r[0] - p[0])
    return turn(a, b, c) * turn(a, b, d) < 0 and turn(c, d, a) * turn(c, d, b) < 0


def test_simplified(spark):
    """Fewer corners; nothing crosses; parts that touch still do; areas move by less than a cell a corner."""
    rng = random.Random(11)
    noisy = lambda x, y: (x - 20) ** 2 + (y - 20) ** 2 < (14 + rng.random() * 2) ** 2 and (x - 20) ** 2 + (y - 20) ** 2 > 16
    mask = spark.createDataFrame([("a", x, y, noisy(x, y) or (x > 34 and y > 34)) for x in range(41) for y in range(41)] + [("b", x, y, rng.random() < 0.6) for x in range(25) for y in range(25)], SCHEMA)
    parts = P.regions(mask).where("valid").selectExpr("item", "gx", "gy", "region as part")
    before, after = P.footprint_rings(parts).collect(), P.simplify_rings(P.footprint_rings(parts), 1.5).collect()
    points = lambda r: [tuple(map(int, p.split(","))) for p in r.corners.split()]
    old, new = ({(r.item, r.part, r.ring): points(r) for r in rows} for rows in (before, after))
    assert old.keys() == new.keys() and sum(map(len, new.values())) < 0.8 * sum(map(len, old.values()))
    area = {(r.item, r.part, r.ring): r.cells for r in before}
    for r in after:
        k = (r.item, r.part, r.ring)
        assert set(new[k]) <= set(old[k]) and abs(r.cells - area[k]) <= 1.5 * (len(old[k]) - len(new[k])) and r.cells > 0
    for item in "ab":
        edges = [e for k, ring in new.items() if k[0] == item for e in zip(ring, ring[1:] + ring[:1], strict=True)]
        assert not any(crossing(*e, *f) for n, e in enumerate(edges) for f in edges[:n])
        times = lambda rings: {p for k, ring in rings.items() if k[0] == item for p in ring if sum(q == p for o, s in rings.items() if o[0] == item for q in s) > 1}  # noqa: B023, E731
        assert times(old) == times(new)


def test_accept(spark):
    counts = spark.createDataFrame([("all", 4, 4), ("none", 0, 4), ("few", 100, 400), ("good", 100, 400), ("lost", 9, 400)], "item string, n_valid long, n_cells long")
    rings = spark.createDataFrame([("all", 1, 0, False, 4.0, ""), ("few", 1, 0, False, 60.0, ""), ("few", 1, 1, True, 11.0, ""), ("good", 1, 0, False, 50.0, "")], "item string, part long, ring long, hole boolean, cells double, corners string")
    assert {r.item: r["shape"] for r in P.footprint_accept(counts, rings).collect()} == {"all": "bbox", "none": "bbox", "few": "bbox", "good": "rings", "lost": "bbox"}


def test_degrees(spark):
    rings = spark.createDataFrame([("a", 1, 0, False, 16.0, "0,0 4,0 4,4 0,4"), ("u", 1, 0, False, 1.0, "0,0 1,0 1,1 0,1")], "item string, part long, ring long, hole boolean, cells double, corners string")
    grids = spark.createDataFrame([(i, e, -53000.0, 25.0, 0.0, 340000.0, 0.0, -25.0) for i, e in (("a", 31256), ("u", 1))], "item string, epsg int, gt0 double, gt1 double, gt2 double, gt3 double, gt4 double, gt5 double")
    got = {r["item"]: r.points for r in P.rings_to_degrees(rings, grids).collect()}
    assert len(got["a"]) == 4 and all(15.6 < p.lon < 15.7 and 48.1 < p.lat < 48.3 for p in got["a"]) and got["a"][0].lon < got["a"][1].lon and got["a"][1].lat > got["a"][2].lat
    assert got["u"][0].lon is None


def test_no_mask_goes_to_the_driver(spark):
    """Tables that grow with the masks are not broadcast, however small their files."""
    mask = spark.range(400).selectExpr("cast(id div 100 as string) as item", "id % 10 as gx", "id div 10 % 10 as gy", "id % 7 <> 0 as valid")
    rings = P.footprint_rings(P.footprint_regions(mask, cell_m2=500.0))
    counts = mask.groupBy("item").agg(F.count_if("valid").alias("n_valid"), F.count("*").alias("n_cells"))
    assert "Broadcast" not in P.footprint_accept(counts, rings)._jdf.queryExecution().executedPlan().toString()
