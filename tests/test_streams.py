"""Arrivals in several runs against one batch over all of them."""

import pytest
from pyspark.sql import functions as F

from terracat.operators import upkeep as U
from terracat.streaming.arrivals import RunningSummary
from terracat.streaming.catalog import ENTRY, IncrementalCatalog
from terracat.streaming.state import KeyedTable

FILES = "campaign string, parent string, name string, length long, checksum string, seen long"


def files(spark, *rows):
    return spark.createDataFrame([(c, f"r/{c}", n, None if s is None else len(s), s, t) for c, n, s, t in rows], FILES)


def state(df):
    return {(r.parent, r.name): (r.category, r.checksum, r.created, r.updated) for r in df.collect()}


FIRST = [("a", "x_dtm.tif", "11", 1), ("a", "y_dsm.tif", "12", 1), ("a", "what.bin", "13", 1), ("b", "p.laz", "14", 1), ("b", "q.laz", None, 1)]
SECOND = [("a", "x_dtm.tif", "11", 2), ("a", "y_dsm.tif", "99", 2), ("b", "p.laz", None, 2), ("b", "q.laz", "15", 2), ("b", "r.laz", "16", 2), ("b", "r.laz", "17", 3)]


def test_two_runs(spark, tmp_path):
    at = str(tmp_path / "arrivals")
    files(spark, *FIRST).write.parquet(at)
    catalog = IncrementalCatalog(spark, str(tmp_path / "state"))
    assert state(catalog.run(at)) == {("r/a", "x_dtm.tif"): ("dtm", "11", 0, 0), ("r/a", "y_dsm.tif"): ("dsm", "12", 0, 0), ("r/b", "p.laz"): ("pointcloud", "14", 0, 0)}
    assert [(r.name, r.error) for r in catalog.failures.read().collect()] == [("q.laz", "unreadable")]
    files(spark, *SECOND).write.mode("append").parquet(at)
    again = IncrementalCatalog(spark, str(tmp_path / "state"))  # as after a restart
    want = {("r/a", "x_dtm.tif"): ("dtm", "11", 0, 0), ("r/a", "y_dsm.tif"): ("dsm", "99", 0, 1), ("r/b", "p.laz"): ("pointcloud", "14", 0, 0), ("r/b", "q.laz"): ("pointcloud", "15", 1, 1), ("r/b", "r.laz"): ("pointcloud", "17", 1, 1)}
    assert state(again.run(at)) == want
    assert {r.name for r in again.entries.changes(1).collect()} == {"y_dsm.tif", "q.laz", "r.laz"}  # what did not change is not written
    assert [(r.name, r.error) for r in again.failures.read().collect()] == [("p.laz", "unreadable")]
    assert state(again.run(at)) == want  # nothing new
    # A batch that is run again, as after a failure, has the same outcome.
    again.step(files(spark, *SECOND), 1)
    assert state(again.entries.read()) == want
    again.entries.fold()
    assert state(again.entries.read()) == want
    # One batch over all: the same but for the numbers of batches.
    whole = IncrementalCatalog(spark, str(tmp_path / "whole"))
    whole.step(files(spark, *[r for r in FIRST + SECOND if r[2] is not None]), 0)
    assert {k: v[:2] for k, v in state(whole.entries.read()).items()} == {k: v[:2] for k, v in want.items()}


def test_settings_change(spark, tmp_path):
    settings = spark.createDataFrame([("a", "EPSG:1", {"dtm": "x"}), ("b", None, {})], "campaign string, crs string, labels map<string,string>")
    rows = files(spark, *FIRST[:4])
    one = IncrementalCatalog(spark, str(tmp_path), digests=U.config_digest(settings))
    one.step(rows, 0)
    one.step(rows, 1)
    assert one.entries.changes(1).count() == 0
    moved = settings.withColumn("crs", F.when(F.col("campaign") == "a", "EPSG:2"))
    IncrementalCatalog(spark, str(tmp_path), digests=U.config_digest(moved)).step(rows, 2)
    assert {r.campaign for r in one.entries.changes(2).collect()} == {"a"}


def test_keyed_table(spark, tmp_path):
    t = KeyedTable(spark, str(tmp_path / "t"), "k string, v long", ["k"])
    rows = lambda *r: spark.createDataFrame(r, "k string, v long")
    got = lambda **a: {r.k: r.v for r in t.read(**a).collect()}
    assert got() == {}
    t.merge(rows(("a", 1), ("b", 1)), 0)
    t.merge(rows(("b", 2)), 1, gone=rows(("a", 0)).select("k"))
    assert got() == {"b": 2} and got(before=1) == {"a": 1, "b": 1}
    t.fold()
    t.merge(rows(("a", 3)), 2)
    assert got() == {"a": 3, "b": 2} and t.fields.names == ["k", "v"]
    assert len(ENTRY.split(",")) == 11


def test_running_summary(spark, tmp_path):
    at, rows = str(tmp_path / "in"), lambda *r: spark.createDataFrame(r, "k string, v double")
    rows(("a", 1.0), ("b", 2.0), (None, 9.0)).write.parquet(at)
    s = RunningSummary(spark, at, "k", "v", str(tmp_path / "out"))
    s.run()
    rows(("b", 5.0), ("c", 0.0)).write.mode("append").parquet(at)
    again = RunningSummary(spark, at, "k", "v", str(tmp_path / "out"))
    assert {tuple(r) for r in again.run().collect()} == {("a", 1, 1.0, 1.0), ("b", 2, 2.0, 5.0), ("c", 1, 0.0, 0.0)}
    assert {r.k for r in again.table.changes(1).collect()} == {"b", "c"}


def test_gates(spark):
    now = spark.createDataFrame([("p1", "c", "1"), ("p2", "c", "1"), ("p3", "c", "1"), ("p4", "d", "1"), ("p5", "c", None), ("p6", "c", "1")], "path string, campaign string, checksum string")
    before = spark.createDataFrame([("p1", "1", True), ("p2", "2", True), ("p3", "1", False), ("p4", "1", True), ("p5", None, True), ("gone", "1", True)], "path string, checksum string, shape_ok boolean")
    same = spark.createDataFrame([("c", True), ("d", False)], "campaign string, same boolean")
    gates = {r.path: r.gate for r in U.gate_status(now, before, same).collect()}
    assert gates == {"p1": "reuse", "p2": "rebuild", "p3": "rebuild", "p4": "rebuild", "p5": "reuse", "p6": "rebuild", "gone": "stale"}
    assert {r.gate for r in U.gate_status(now, before, same, forced=True).collect()} == {"rebuild", "stale"}
    shape = spark.createDataFrame([("pcl", ["data"], "m", {"pc:count": "1"}), ("raster", ["data"], "m", {"pc:count": "1"}), ("raster", None, "m", {"proj:shape": "1"}), ("raster", ["data"], None, {"proj:shape": "1"}), ("raster", ["data", "x"], "m", {"proj:shape": "1"})], "kind string, roles array<string>, media string, properties map<string,string>")
    assert [r.ok for r in shape.select(U.shape_ok(*map(F.col, ("kind", "roles", "media", "properties"))).alias("ok")).collect()] == [True, False, False, False, True]


def test_digests(spark):
    settings = spark.createDataFrame([("a", "E", {"x": "1", "y": "2"}), ("b", "E", {"y": "2", "x": "1"}), ("c", "E", {"x": "1"}), ("d", None, None), ("e", None, {})], "campaign string, crs string, labels map<string,string>")
    d = {r.campaign: r.digest for r in U.config_digest(settings).collect()}
    assert d["a"] == d["b"] != d["c"] and d["d"] == d["e"]
    stored = spark.createDataFrame([("a", d["a"]), ("b", "old")], "campaign string, digest string")
    assert {r.campaign: r.same for r in U.gate_digest_change(settings, stored).collect()} == {"a": True, "b": False, "c": False, "d": False, "e": False}


def test_files_of_other_sizes_stay_closed(spark, tmp_path):
    import hashlib

    for name, text in (("same", b"abc"), ("content", b"abd")):
        (tmp_path / name).write_bytes(text)
    listed = spark.createDataFrame([("same", 3), ("content", 3), ("size", 4), ("new", 1)], "path string, length long")  # `size` is not there to be opened
    stored = spark.createDataFrame([(n, 3, "1220" + hashlib.sha256(b"abc").hexdigest()) for n in ("same", "content", "size")], "path string, length long, checksum string")
    assert {r.path: r.gate for r in U.hash_files(listed, stored, f"file://{tmp_path}").collect()} == {"same": "same", "content": "content", "size": "size"}


def test_stale_and_failed(spark):
    now = spark.createDataFrame([("a", "p")], "path string, parent string")
    before = spark.createDataFrame([("a", "old"), ("b", "p"), ("c", "q")], "path string, parent string")
    kept = U.set_stale_keep(now, before)
    assert sorted(tuple(r) for r in kept.collect()) == [("a", "p", False), ("b", "p", True), ("c", "q", True)]
    assert [tuple(r) for r in U.orphan_parents(kept).collect()] == [("q", 1)]
    rows = spark.createDataFrame([("a", 1, None), ("a", 2, "bad"), ("b", 3, "bad")], "campaign string, v int, error string")
    good, bad, counts = U.failure_isolation(rows)
    assert [tuple(r) for r in good.collect()] == [("a", 1)] and {r.v for r in bad.collect()} == {2, 3}
    assert {r.campaign: r.touched for r in counts.collect()} == {"a": True, "b": False}


def test_ids_of_all_kinds(spark):
    items = spark.createDataFrame([("c", "g", "c_g"), ("c", None, "i"), ("root", None, "j"), ("d", None, "i")], "collection string, grp string, item string")
    got = sorted(tuple(r) for r in U.id_collision_global(U.id_register("root", items)).collect())
    assert got == [("c_g", "item c/g/c_g", "group c/g"), ("i", "item d/i", "item c/i"), ("root", "root", "collection root")]
    with pytest.raises(ValueError, match="id c_g of item c/g/c_g is taken by group c/g"):
        U.id_collision_global(U.id_register("root", items), "raise")
