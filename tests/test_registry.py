"""Registries of campaigns: overrides that act on what their files become."""

import pytest
from pyspark.sql import functions as F

from terracat.operators import classify as C
from terracat.operators import registry as G
from terracat.operators.records import registry_merge

FILES = "campaign string, parent string, name string, length long"
SETTINGS = "campaign string, patterns map<string, struct<require:array<string>, forbid:array<string>, extensions:array<string>>>, labels map<string, struct<category:string, kind:string>>"


def files(spark, **names):
    return spark.createDataFrame([(c, f"r/{c}", n, 1) for c, ns in names.items() for n in ns], FILES)


def products(spark, rows, settings):
    got = G.products_by_settings(rows, spark.createDataFrame(settings, SETTINGS))
    return sorted((r.campaign, r.name, r.label, r.category, r.kind, r.item, r.ext) for r in got.collect())


def test_defaults_agree(spark):
    """Without overrides the registry of every campaign matches as the default table does."""
    names = ["a_dtm.tif", "a_DTM_filled.tiff", "a_dtm_shd.tif", "x.copc.laz", "x.laz", "x.las", "x.log", "dtm_filled_masked_dsm.tif", "transparent_mosaic_1.tif", "none.bin", "a_transparent.tif", "q_cog_dsm.tif"]
    rows = files(spark, a=names, b=names)
    want = sorted((r.name, r.label, r.category, r.kind, r.item, r.ext, r.cog, r.native) for r in C.products(rows, spark).collect())
    got = G.products_by_settings(rows, spark.createDataFrame([], SETTINGS)).collect()
    assert sorted((r.name, r.label, r.category, r.kind, r.item, r.ext, r.cog, r.native) for r in got) == want


def test_one_name_two_campaigns(spark):
    settings = [
        ("b", {"dtm": (["DGM"], None, [".TIF"])}, {}),
        ("c", {"intensity": (["int"], None, [".tif"])}, {"intensity": ("intensity", "raster"), "dtm": ("ignore", "raster")}),
        ("d", {"dtm": (["dtm"], ["old"], [".tif", ".img"])}, {}),
    ]
    names = ["p_dtm.tif", "p_dgm.tif", "p_int.tif", "p_dtm_old.tif", "p_dtm.img"]
    got = products(spark, files(spark, a=names, b=names, c=names, d=names), settings)
    assert [(c, n, label) for c, n, label, *_ in got] == [
        ("a", "p_dtm.tif", "dtm"), ("a", "p_dtm_old.tif", "dtm"), ("b", "p_dgm.tif", "dtm"), ("c", "p_int.tif", "intensity"), ("d", "p_dtm.img", "dtm"), ("d", "p_dtm.tif", "dtm"),
    ]


def test_new_product_type(spark):
    """A label that only settings know: pattern and label together make a product; a pattern alone does not."""
    settings = [("a", {"echo": (None, None, [".wav"])}, {"echo": ("sound", None)}), ("b", {"echo": (None, None, [".wav"])}, {})]
    assert products(spark, files(spark, a=["x_1.wav"], b=["x_1.wav"], c=["x_1.wav"]), settings) == [("a", "x_1.wav", "echo", "sound", "", "x_1", ".wav")]


def test_digests_are_shared(spark):
    rows = files(spark, a=["x.laz"], b=["x.laz"], c=["x.laz"])
    campaigns = rows.select("campaign").distinct()
    own, labels = G.settings_overrides(spark.createDataFrame([("c", {"dtm": (["q"], None, [".tif"])}, {})], SETTINGS))
    digests, rules = G.campaign_rules(registry_merge(C.pattern_table(spark), own, campaigns), G.label_merge(C.label_table(spark), labels, campaigns))
    assert rules.count() == 2 and len({r.digest for r in digests.where("campaign <> 'c'").collect()}) == 1
    plan = G.match_registry(rows, digests, rules)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BroadcastHashJoin") == 2 and "SortMergeJoin" not in plan


@pytest.mark.parametrize(("name", "label"), [("a_b.t", "two"), ("a.t", "one"), ("a_b_c.t", "two"), ("b.t", "zero"), ("a_b.u.t", "long"), ("x.v", None)])
def test_order(spark, name, label):
    """Most required tokens, then the longest extension, then the first."""
    rules = [(0, "zero", [], [], [".t"]), (1, "one", ["a"], [], [".t"]), (2, "two", ["b", "a"], [], [".t"]), (3, "three", ["a", "b"], [], [".t"]), (4, "long", ["a", "b"], [], [".u.t"]), (5, "never", ["a"], ["a"], [".t", ".v"])]
    kinds = "array<struct<ord:int,label:string,require:array<string>,forbid:array<string>,extensions:array<string>,category:string,kind:string>>"
    df = spark.createDataFrame([(name, [(*r, "c", "k") for r in rules])], f"name string, rules {kinds}")
    got = df.select(G.best_rule(F.col("name"), F.col("rules")).alias("r")).first().r
    assert (got and got.label) == label


def test_odd_rows(spark):
    rows = spark.createDataFrame([(None, "r", "x.laz", 1), ("a", "r", None, 1), ("a", "r", "x.laz", None), ("a", "r", "x.laz", None)], FILES)
    assert products(spark, rows, []) == [("a", "x.laz", "pointcloud", "pointcloud", "pcl", "x", ".laz")] * 2
    assert products(spark, spark.createDataFrame([], FILES), []) == []


def test_rules_are_tried_once(spark):
    """The fields of the best rule come from one trial of the rules, not one for each field."""
    files = spark.createDataFrame([("a", "x", "p_dtm_1.tif", 5)], "campaign string, parent string, name string, length long")
    settings = spark.createDataFrame([], "campaign string, patterns map<string, struct<require:array<string>, forbid:array<string>, extensions:array<string>>>, labels map<string, struct<category:string, kind:string>>")
    found = G.products_by_settings(files, settings)
    assert found._jdf.queryExecution().optimizedPlan().toString().count("array_max(") == 1
    assert [(r.label, r.category, r.ext) for r in found.collect()] == [("dtm", "dtm", ".tif")]
