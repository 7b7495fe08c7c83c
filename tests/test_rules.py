"""Rules of publication and settings on literal cases."""

import json

import pytest
from pyspark.sql import functions as F

from terracat.operators import rules as U
from terracat.operators import settings as T


def test_invalid_cogs(spark):
    rows = [("a.tif", "raster", ".tif", "COG", []), ("b.tif", "raster", ".tif", "COG", ["bad", "worse"]), ("c.tif", "raster", ".tif", None, ["bad"]), ("d.laz", "pcl", ".copc.laz", None, None), ("e.laz", "pcl", ".laz", "COG", None), ("f.log", "", ".log", "COG", None)]
    files = spark.createDataFrame(rows, "name string, kind string, ext string, layout string, errors array<string>")
    got = {r["name"]: (r.native, r.warning) for r in U.flag_cloud_native(files).collect()}
    assert [got[k][0] for k in sorted(got)] == [True, False, False, True, False, False]
    assert {k: w for k, (_, w) in got.items() if w} == {"b.tif": "invalid COG (b.tif): bad; worse; demoted to plain GeoTIFF"}
    assert {r["name"]: r.native for r in U.flag_cloud_native(files, "warn").collect()}["b.tif"]
    with pytest.raises(ValueError, match="invalid COG \\(b.tif\\): bad; worse$"):
        U.flag_cloud_native(files, "raise")
    with pytest.raises(ValueError, match="unknown policy"):
        U.flag_cloud_native(files, "skip")


def test_few_points(spark):
    now = spark.createDataFrame([("a", "pcl", 5), ("b", "pcl", 2000), ("c", "pcl", None), ("d", "raster", 5), ("e", None, 5)], "item string, kind string, points long")
    kept, old = U.filter_min_points(now, spark.createDataFrame([("a",), ("b",), ("gone",)], "item string"))
    assert sorted(r["item"] for r in kept.collect()) == ["b", "c", "d", "e"] and sorted(r["item"] for r in old.collect()) == ["b", "gone"]


def test_names_of_dimensions(spark):
    recorded = spark.createDataFrame([("i", n) for n in ("Amplitude", "_Echo Width", "Red", "None")], "item string, name string")
    actual = spark.createDataFrame([("i", n) for n in ("Intensity", "amplitude", "echowidth", "RED", "red")] + [("j", "None")], "item string, name string")
    assert {r["name"]: r.actual for r in U.map_dim_names(recorded, actual).collect()} == {"Amplitude": "Intensity", "_Echo Width": "echowidth", "Red": "RED", "None": None}


def test_report(spark):
    rows = [("a", "new", 1.5, None, None), ("a", "same", 0.25, "w", None), ("a", "new", None, "w", "broken"), ("b", "new", 1.0, None, "broken")]
    got = {r.campaign: json.loads(r.report) for r in U.run_report(spark.createDataFrame(rows, "campaign string, status string, seconds double, warning string, error string")).collect()}
    assert got["a"] == {"campaign": "a", "new": 1, "changed": 0, "same": 1, "stale": 0, "failed": 1, "seconds": 1.75, "untouched": False, "warnings": {"w": 2}}
    assert got["b"]["untouched"] and got["b"]["failed"] == 1 and "warnings" not in got["b"]


def test_refresh(spark):
    rows = [({"a": "1"}, {"a": "1", "title": "T"}, "T", False), ({"a": "2"}, {"a": "1", "title": "T"}, "T", True), ({}, {"title": "old"}, "T", True), ({"title": "own"}, {"title": "own"}, "T", False), ({"title": "own"}, {"title": "T"}, "T", True), ({}, {}, "T", True)]
    df = spark.createDataFrame(rows, "o map<string,string>, p map<string,string>, t string, want boolean")
    assert [r.got for r in df.select(U.needs_refresh(*map(F.col, "opt")).alias("got")).collect()] == [r[3] for r in rows]


def test_leftovers(spark):
    existing = spark.createDataFrame([("t1",), ("t2",), ("t3",), ("t3",)], "tile string")
    owners = spark.createDataFrame([("t1", "t1"), ("t2", "t1")], "tile string, owner string")
    assert sorted(tuple(r) for r in U.stale_outputs(existing, owners).collect()) == [("t2", "t1"), ("t3", None)]


def settings(spark, **texts):
    rows = [(c, "Campaign.YAML", t) for c, t in texts.items() if t is not None]
    return T.settings_blocks(spark.createDataFrame([(c,) for c in texts], "campaign string"), spark.createDataFrame(rows, "campaign string, name string, text string"))


def test_blocks(spark):
    text = json.dumps({"collection": {"title": "T", "providers": [{"name": "P", "roles": ["host"]}]}, "properties": {"a": 1, "byLabel": {"x": {"a": None}}}, "hierarchy": {"placement": {"*b*": "g", "a": None}}, "patterns": {"x": {"extensions": [".x"]}}})
    got = {r.campaign: r for r in settings(spark, full=text, empty=" ", none=None, words="just words", listed="[1]", broken="{").collect()}
    f = got["full"]
    assert f.collection.title == "T" and [tuple(p) for p in f.collection.providers] == [("P", ["host"], None)] and f.properties == {"a": "1"} and f.by_label == {"x": {"a": None}}
    assert [tuple(p) for p in f.placement] == [(0, "*b*", "g"), (1, "a", None)] and f.patterns["x"].extensions == [".x"]
    assert {k: r.failed for k, r in got.items()} == {"full": False, "empty": False, "none": False, "words": True, "listed": True, "broken": True}
    assert got["none"].collection.license == "other" and got["none"].exclude == [] and got["none"].by_id == {}


def test_settings_act(spark):
    text = json.dumps({"exclude": ["*.TMP", "x?"], "properties": {"a": "1", "b": "2", "byLabel": {"l": {"a": None}}, "byId": {"i": {"b": "3"}}}, "hierarchy": {"placement": {"?[12]": "p", "i*": "q", "i": None}, "groups": {"q": {"title": "Q"}}}})
    items = [("s", "f", "l", "i", "auto"), ("s", "f", "m", "i2", "auto"), ("s", "f", "m", "iz", None), ("s", "f", "m", "other", "auto"), ("s", "a.tmp", "m", "y", None), ("s", "xy", "m", "y", None), ("n", "a.tmp", "m", "i", "auto"), ("w", "f", "m", "i", None)]
    df = spark.createDataFrame(items, "campaign string, name string, label string, item string, group string")
    got = sorted((r.campaign, r["item"], r.group or "", r.group_title or "", tuple(sorted(r.properties.items()))) for r in T.apply_settings(df, settings(spark, s=text, w="words")).collect())
    base = (("a", "1"), ("b", "2"))
    assert got == [("n", "i", "auto", "", ()), ("s", "i", "", "", (("b", "3"),)), ("s", "i2", "p", "", base), ("s", "iz", "q", "Q", base), ("s", "other", "auto", "", base)]
