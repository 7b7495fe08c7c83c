"""Operators that SQL cannot express, against plain versions."""

import random

from pyspark.sql import functions as F

from terracat.operators import footprints as G
from terracat.operators import records as R
from terracat.operators import upkeep as U
from terracat.plans import discovery, records  # noqa: F401
from terracat.plans.catalog import QUERIES


def test_components(spark):
    rng = random.Random(3)
    cells = {(x, y) for x in range(40) for y in range(40) if rng.random() < 0.55}
    seen, want = set(), {}
    for start in cells:
        if start in seen:
            continue
        stack, part = [start], []
        seen.add(start)
        while stack:
            x, y = stack.pop()
            part.append((x, y))
            for n in ((x + 1, y), (x - 1, y), (x, y + 1), (x, y - 1)):
                if n in cells and n not in seen:
                    seen.add(n)
                    stack.append(n)
        key = min((y << 20) + x for x, y in part)
        if len(part) >= 3:
            want |= {c: (key, len(part)) for c in part}
    mask = spark.createDataFrame([("a", x, y) for x, y in cells] + [("b", 0, 0), ("b", 1, 1)], "item string, gx long, gy long")
    got = {(r.gx, r.gy): (r.part, r.cells) for r in G.footprint_components(mask, 3).collect()}
    assert got == want


def test_runts(spark):
    rows = [("d", "a", 10, 0, 0), ("d", "b", 2, 1, 0), ("d", "c", 3, 2, 0), ("d", "e", 1, 9, 9), ("f", "a", 1, 0, 0)]
    got = {(r.dataset, r.name): r.merged_into for r in U.tile_runt_merge(spark.createDataFrame(rows, "dataset string, name string, size long, col long, row long"), 5).collect()}
    # b joins c (the smaller neighbour), which is then large enough; e has no neighbour
    assert got == {("d", "a"): "a", ("d", "b"): "c", ("d", "c"): "c", ("d", "e"): "e", ("f", "a"): "a"}


def test_paths_globs_and_empty(spark):
    one = spark.range(1)
    got = one.select(R.relative_path(F.lit("r/a/b"), F.lit("r/a/c/x.png")), R.relative_path(F.lit("r"), F.lit("x.png")), R.relative_path(F.lit("r/a"), F.lit("r/a/x.png"))).first()
    assert tuple(got) == ("../c/x.png", "../x.png", "x.png")
    assert one.select(F.lit("P_dtm_17").rlike(R.glob_regex("*_DTM_1[5-9]"))).first()[0]
    assert G.footprint_components(spark.createDataFrame([], "item string, gx long, gy long"), 1).count() == 0
    assert U.tile_runt_merge(spark.createDataFrame([], "dataset string, name string, size long, col long, row long"), 5).count() == 0


def test_rows_only_queries(spark):
    for key in ("scan_inventory", "footprint_components", "footprint_rings", "tile_runt_merge"):
        assert QUERIES[key](spark, "/root/testdata/sf0.001").count() > 0
