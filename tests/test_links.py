"""A written tree whose links hold, and one where each rule is broken once; searches that leave files closed."""

import glob

from pyspark.sql import functions as F

from terracat.operators import links as L
from terracat.sources import folders
from terracat.sources.items import search_stored, store_items

ITEMS = "collection string, grp string, item string"


def test_whole_tree_holds(spark, tmp_path):
    items = spark.createDataFrame([("a", None, "i1"), ("a", "g", "i2"), ("b", "g", "i3"), ("b", "h", "i4"), (None, None, "x"), ("a", None, None)], ITEMS)
    folders.tree_json(*L.catalog_tree(items, "all"), str(tmp_path))
    documents, links = folders.read_tree(spark, str(tmp_path))
    assert sorted(r.path for r in documents.collect()) == ["/a/collection.json", "/a/g/collection.json", "/a/g/i2/i2.json", "/a/i1/i1.json", "/b/collection.json", "/b/g/collection.json", "/b/g/i3/i3.json", "/b/h/collection.json", "/b/h/i4/i4.json", "/catalog.json"]
    assert links.count() == 3 * 9
    hrefs = {(r.source, r.rel): r.href for r in links.where("source like '%i2.json'").collect()}
    assert hrefs == {("/a/g/i2/i2.json", "root"): "../../../catalog.json", ("/a/g/i2/i2.json", "parent"): "../collection.json"}
    assert L.rules_check(documents, links, ["id", "title"]).collect() == []


def test_items_are_made_once(spark):
    """Items that come from a join are joined once, not for each level of the tree; names of two lines have their links too."""
    items = spark.createDataFrame([("a", "g", "i\n1"), ("a", None, "i2"), ("b", "h/k", "i3")], ITEMS).join(spark.range(1), F.col("id") == 0)
    documents, links = L.catalog_tree(items, "all")
    assert "Join" not in documents._jdf.queryExecution().analyzed().toString() + links._jdf.queryExecution().analyzed().toString()
    assert [tuple(r) for r in L.rules_check(documents, links, ["title"]).collect()] == []


def test_stored_documents_are_read_once(spark, tmp_path):
    folders.tree_json(*L.catalog_tree(spark.createDataFrame([("a", None, "i1")], ITEMS), "all"), str(tmp_path))
    found = L.rules_check(*folders.read_tree(spark, str(tmp_path)), ["title"])
    assert "Relation" in (plan := found._jdf.queryExecution().analyzed().toString()) and " json" not in plan


def test_resolve_as_by_parts(spark):
    """The short way to a target gives what a walk by parts gives."""
    sources = ["/a/b/c.json", "/c.json", "/a/./c.json", "/a//c.json", "a/c.json", "/a/../b/c.json", "c.json", "/a/b/"]
    hrefs = ["x.json", "./x.json", "../x.json", "../../x.json", "../../../x", "x/../y", "", "..", "../", "./", "./../x", ".././x", "/x", "a..b/.c", "x/", "...", None]

    def walk(source, href):
        done = []
        for part in href.split("/") if href.startswith("/") else source.split("/")[:-1] + href.split("/"):
            if part == ".." and not done:
                return None
            done = done[:-1] if part == ".." else done if part in (".", "") else [*done, part]
        return "/" + "/".join(done)

    rows = [(s, h, None if h is None else walk(s, h)) for s in sources for h in hrefs]
    got = spark.createDataFrame(rows, "source string, href string, want string").select("source", "href", "want", L.resolve(F.col("source"), F.col("href")).alias("got")).collect()
    assert [tuple(r) for r in got if r.want != r.got] == []


def test_resolve(spark):
    rows = [("/a/b/c.json", "../d.json", "/a/d.json"), ("/a/b/c.json", "./e/./f.json", "/a/b/e/f.json"), ("/a/b/c.json", "/x.json", "/x.json"), ("/a/c.json", "../../x", None), ("/c.json", "x//y", "/x/y"), ("/c.json", None, None)]
    got = spark.createDataFrame(rows, "source string, href string, want string").select(L.resolve(F.col("source"), F.col("href")).alias("got"), "want").collect()
    assert [r.got for r in got] == [r.want for r in got]


def test_each_rule(spark):
    documents = spark.createDataFrame([("/catalog.json", "root", "r", "t"), ("/a/collection.json", "collection", "a", "t"), ("/b/collection.json", "collection", "a", None), ("/c/collection.json", "collection", "c", "t")], L.DOCUMENT)
    links = spark.createDataFrame(
        [
            ("/catalog.json", "child", "a/collection.json"), ("/catalog.json", "child", "./a/collection.json"), ("/catalog.json", "child", "b/collection.json"), ("/catalog.json", "child", "gone.json"),
            ("/catalog.json", "license", "https://x.org/l"), ("/a/collection.json", "parent", "../catalog.json"), ("/c/collection.json", "parent", "../catalog.json"), ("/nowhere.json", "root", "catalog.json"),
        ],
        L.LINK,
    )
    got = sorted(tuple(r) for r in L.rules_check(documents, links, ["title"]).collect())
    assert got == [
        ("/b/collection.json", "duplicate id", "a"), ("/b/collection.json", "missing", "title"), ("/c/collection.json", "dangling", "collection"), ("/c/collection.json", "one-way", "/catalog.json"),
        ("/catalog.json", "broken", "child gone.json"), ("/catalog.json", "doubled", "child /a/collection.json"), ("/nowhere.json", "stray", "root catalog.json"),
    ]


def test_closed_files_stay_closed(spark, tmp_path):
    """Collections outside the box or the dates are pruned while the query runs: their files may be broken."""
    rows = [(c, f"{c}{k}", x, 0.0, x + 1, 1.0, d, 2000.0) for c, x, d in (("far", 500.0, "2020-01-01"), ("late", 0.0, "2024-01-01"), ("near", 0.0, "2020-01-01")) for k in range(3)]
    items = spark.createDataFrame(rows, "collection string, item string, x0 double, y0 double, x1 double, y1 double, start string, points double").withColumn("start", F.to_date("start"))
    store_items(items, str(tmp_path))
    for c in ("far", "late"):
        for f in glob.glob(f"{tmp_path}/items/collection={c}/*.parquet"):
            with open(f, "wb") as out:
                out.write(b"no table")
    found = search_stored(spark, str(tmp_path), items.schema, (0.0, 0.0, 10.0, 10.0), "2019-01-01", "2021-01-01", 1000.0)
    assert "dynamicpruning" in found._jdf.queryExecution().executedPlan().toString()
    assert [tuple(r) for r in found.collect()] == [("near0", "near"), ("near1", "near"), ("near2", "near")]
