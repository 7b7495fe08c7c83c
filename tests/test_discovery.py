"""Classification, settings, side files and geometry on literal cases."""

import pytest
from pyspark.sql import functions as F

from terracat.operators import classify as C
from terracat.operators import discovery as D
from terracat.operators import records as R
from terracat.operators import upkeep as U

FILES = "parent string, name string, length long"


def prods(spark, *paths):
    rows = [(p.rpartition("/")[0], p.rpartition("/")[2], 1) for p in paths]
    return C.products(spark.createDataFrame(rows, FILES), spark)


def test_groups_of_any_directory(spark):
    got = C.tile_group_assign(prods(spark, "r/camp 2020-01-01/east/a_dtm.tif", "r/camp 2020-01-01/east/b_dtm.tif", "r/camp 2020-01-01/x/y/c.laz", "r/camp 2020-01-01/x/y/d.laz", "r/camp 2020-01-01/e_dtm.tif", "r/camp 2020-01-01/f_dtm.tif", "r/camp 2020-01-01/z/g_dtm.tif"))
    assert {r["name"]: r["group"] for r in got.collect()} == {"a_dtm.tif": "east", "b_dtm.tif": "east", "c.laz": "x_y", "d.laz": "x_y", "e_dtm.tif": None, "f_dtm.tif": None, "g_dtm.tif": None}


def test_twins_prefer_cloud_native(spark):
    rows = [("r", "a_dtm.tif", 1, "COG"), ("r", "a_cog_dtm.tif", 1, None), ("r", "p.laz", 1, None), ("r", "p.copc.laz", 1, None), ("r", "q.las", 1, None), ("r", "q.laz", 1, None)]
    files = spark.createDataFrame(rows, FILES + ", layout string")
    assert {r["name"] for r in C.twin_dedupe(C.products(files, spark)).collect()} == {"a_dtm.tif", "p.copc.laz", "q.laz"}
    # Without a layout the name tells; `cog` counts between underscores alone.
    assert {r["name"] for r in C.twin_dedupe(prods(spark, "r/a_dtm.tif", "r/a_COG_dtm.tif")).collect()} == {"a_COG_dtm.tif"}
    assert not prods(spark, "r/a.cog_dtm.tif").first()["cog"]


def test_side_files(spark):
    p = prods(spark, "r/x_dtm.tif", "r/y_dtm.tif")
    sides = spark.createDataFrame([("r", s) for s in ("x_dtm.tif.aux.xml", "x_dtm.prj", "x_dtm.TFW", "y_dtm.txt", "z.prj")], "parent string, side string")
    assert [tuple(r) for r in R.join_sidecar_files(p, sides).collect()] == [("r", "x_dtm.tif", 3, "x_dtm.TFW,x_dtm.prj,x_dtm.tif.aux.xml")]


def test_policies(spark):
    files = spark.createDataFrame([("r", "what.bin", 1), ("r", "a.laz", 1), ("r", "campaign.YAML", 1), ("r", "a.PRJ", 1)], FILES)
    assert [r["name"] for r in D.unknown_files(files, "warn").collect()] == ["what.bin"]
    assert D.unknown_files(files, "skip").collect() == []
    with pytest.raises(ValueError, match="no registry match"):
        D.unknown_files(files, "raise")
    with pytest.raises(ValueError, match="unknown policy"):
        D.unknown_files(files, "other")
    assert [(r["name"], r["kept"]) for r in D.non_native(prods(spark, "r/a.laz", "r/b.copc.laz"), "skip").collect()] == [("a.laz", False)]
    with pytest.raises(ValueError, match="non-cloud-native"):
        D.non_native(prods(spark, "r/a.laz"), "raise")


def test_campaign_names(spark):
    dirs = spark.createDataFrame([("2020-02-30 no date",), ("a_2020-02-28",), ("plain",), ("out_2020-01-01",)], "dir string")
    assert [r["dir"] for r in D.campaigns(dirs, "out_2020-01-01").collect()] == ["a_2020-02-28"]


def test_registry_order(spark):
    defaults = spark.createDataFrame([(0, "a", ["x"], [], [".t"]), (1, "b", [], [], [".t"])], "ord int, label string, require array<string>, forbid array<string>, extensions array<string>")
    own = spark.createDataFrame([("c", 0, "new", ["N"], None, [".T"]), ("c", 1, "a", None, None, [".U"])], "campaign string, turn int, label string, require array<string>, forbid array<string>, extensions array<string>")
    every = spark.createDataFrame([("c",), ("d",)], "campaign string")
    got = {(r["campaign"], r["label"]): (r["ord"], r["require"], r["extensions"]) for r in R.registry_merge(defaults, own, every).collect()}
    assert got == {("c", "a"): (0, [], [".u"]), ("c", "b"): (1, [], [".t"]), ("c", "new"): (2, ["n"], [".t"]), ("d", "a"): (0, ["x"], [".t"]), ("d", "b"): (1, [], [".t"])}


def test_settings(spark):
    dirs = spark.createDataFrame([(c,) for c in "abcde"], "campaign string")
    files = spark.createDataFrame([("a", "Campaign.Yaml", '{"crs": "EPSG:1", "other": 3}'), ("b", "campaign.yaml", "[]"), ("c", "campaign.yaml", " "), ("d", "campaign.yaml", "{broken"), ("e", "notes.txt", "[]")], "campaign string, name string, text string")
    got = {r["campaign"]: (r["crs"], r["failed"]) for r in D.config_blocks(dirs, files).collect()}
    assert got == {"a": ("EPSG:1", False), "b": (None, True), "c": (None, False), "d": (None, True), "e": (None, False)}


def test_polygons(spark):
    ring = lambda *p: F.array(*[F.struct(F.lit(float(x)).alias("x"), F.lit(float(y)).alias("y")) for x, y in p])
    square, hole = ring((0, 0), (10, 0), (10, 10), (0, 10), (0, 0)), ring((2, 2), (8, 2), (8, 8), (2, 8), (2, 2))
    cases = {(3, 3, 4, 4): (True, False), (9, 9, 20, 20): (True, True), (10, 5, 12, 6): (True, True), (11, 11, 12, 12): (False, False), (-5, -5, 20, 20): (True, True), (4, -5, 5, 20): (True, True), (1, 1, 3, 3): (True, True)}
    for box, want in cases.items():
        got = spark.range(1).select(R.polygon_intersects_box(F.array(square), box), R.polygon_intersects_box(F.array(square, hole), box)).first()
        assert tuple(got) == want, box


def test_directories(spark):
    names = spark.createDataFrame([("d", f"{k}.a") for k in range(3)] + [("e", "x.b"), ("e", "y.b")], "dir string, name string")
    shares = spark.createDataFrame([("d", ".a 100%"), ("e", ".b 100%")], "dir string, shares string")
    assert {r["dir"]: (r["names"], r["shares"]) for r in U.summarize_dirs(names, shares, 3).collect()} == {"d": (None, ".a 100%"), "e": ("x.b, y.b", None)}


def test_stale_collections(spark):
    old, new = spark.createDataFrame([("a",), ("b",)], "collection string"), spark.createDataFrame([("b",)], "collection string")
    assert [tuple(r) for r in U.stale_collections(old, new, failed=True).collect()] == [("a", False)]
    assert U.stale_collections(old, new, filtered=True).collect() == []


def test_readable_sizes(spark):
    from terracat.functions.names import readable_size

    got = spark.createDataFrame([(n,) for n in (0, 1023, 1024, 1536, 5 * 1024**2, 3 * 1024**4)], "n long").select(readable_size(F.col("n"))).collect()
    assert [r[0] for r in got] == ["0 B", "1023 B", "1.0 KB", "1.5 KB", "5.0 MB", "3.0 TB"]
