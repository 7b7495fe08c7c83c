"""The tree of a catalog (root, collections, groups, items) as documents and links, and whether the links hold."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terracat.operators.upkeep import _written

DOCUMENT, LINK = "path string, kind string, id string, title string", "source string, rel string, href string"


def catalog_tree(items: DataFrame, root: str) -> tuple[DataFrame, DataFrame]:
    """(documents, links) of items (collection, grp or null, item).

    documents: path, kind, id, title. links: source (path of the document that holds it), rel (root, parent, child, item),
    href relative to the source. Links are rows of their own: a collection's list of items is never gathered in one place.
    """
    at = _written(items.select("collection", "grp", "item").where("collection is not null and item is not null"), "tree_items")  # read for each level
    home = F.when(F.col("grp").isNull(), F.col("collection")).otherwise(F.concat_ws("/", "collection", "grp"))
    top = items.sparkSession.createDataFrame([("/catalog.json", "root", root, root)], DOCUMENT)
    own = at.select(F.concat(F.lit("/"), home, F.lit("/"), "item", F.lit("/"), "item", F.lit(".json")).alias("path"), F.lit("item").alias("kind"), F.col("item").alias("id"), F.col("item").alias("title"), F.concat(F.lit("/"), home, F.lit("/collection.json")).alias("up"))
    groups = at.where("grp is not null").select("collection", "grp").distinct().select(
        F.concat(F.lit("/"), F.concat_ws("/", "collection", "grp"), F.lit("/collection.json")).alias("path"), F.lit("group").alias("kind"), F.concat_ws("_", "collection", "grp").alias("id"), F.concat("grp", F.lit(" tiles")).alias("title"),
        F.concat(F.lit("/"), "collection", F.lit("/collection.json")).alias("up"),
    )
    collections = at.select("collection").distinct().select(F.concat(F.lit("/"), "collection", F.lit("/collection.json")).alias("path"), F.lit("collection").alias("kind"), F.col("collection").alias("id"), F.col("collection").alias("title"), F.lit("/catalog.json").alias("up"))
    below = collections.unionByName(groups).unionByName(own)
    link = lambda source, rel, href: F.struct(F.col(source).alias("source"), rel.alias("rel"), href.alias("href"))
    down = F.when(F.col("kind") == "item", "item").otherwise("child")
    # A parent's folder is on the way to the root, so hrefs need no comparison of paths: steps up, or what is left below it.
    name = F.substring_index("up", "/", -1)
    root_href = F.concat(F.repeat(F.lit("../"), _slashes("path") - 1), F.lit("catalog.json"))
    up_href, down_href = F.concat(F.repeat(F.lit("../"), _slashes("path") - _slashes("up")), name), F.substring("path", F.length("up") - F.length(name) + 1, F.length("path"))
    each = F.array(link("path", F.lit("root"), root_href), link("path", F.lit("parent"), up_href), link("up", down, down_href))
    return top.unionByName(below.drop("up")), below.select(F.inline(each))


def _slashes(path: str | Column) -> Column:
    return F.length(path) - F.length(F.replace(path if isinstance(path, Column) else F.col(path), F.lit("/"), F.lit("")))


def resolve(source: Column, href: Column) -> Column:
    """The path that a link leads to: `.` and `..` are followed from the source's folder, an absolute href counts as it is;
    null where it leads above the root."""
    parts = F.when(F.startswith(href, F.lit("/")), F.split(href, "/")).otherwise(F.concat(F.slice(F.split(source, "/"), 1, F.size(F.split(source, "/")) - 1), F.split(href, "/")))
    start = F.array().cast("array<string>")

    def step(done: Column, part: Column) -> Column:
        return F.when(part == "..", F.when(F.size(done) > 0, F.slice(done, F.lit(1), F.size(done) - 1))).when((part == ".") | (part == ""), done).otherwise(F.concat(done, F.array(part)))

    walked = F.aggregate(parts, start, step)
    # Most links go some steps up, then down by plain names, from a plain path: no need to walk by parts.
    rest = F.regexp_replace(href, r"^(\./)?(\.\./)*", "")
    ups = _slashes(href) - _slashes(rest) - F.startswith(href, F.lit("./")).cast("int")
    depth = _slashes(source)
    plain = F.startswith(source, F.lit("/")) & ~source.rlike(r"/\.{0,2}/") & ~rest.rlike(r"(^|/)\.{0,2}(/|$)")
    near = F.when(ups < depth, F.concat(F.call_function("substring_index", source, F.lit("/"), depth - ups), F.lit("/"), rest))
    return F.when(plain, near).when(walked.isNotNull(), F.concat(F.lit("/"), F.array_join(walked, "/")))


def link_check(documents: DataFrame, links: DataFrame) -> DataFrame:
    """Violations as path, rule, detail, of documents (path, kind) and links (source, rel, href).

    broken: a link whose target is no document; doubled: a document links the same target by one rel twice or more;
    stray: the source of a link is no document; dangling: a document other than the root that no child or item link
    leads to; one-way: a document whose parent link leads to one that has no child or item link to it. Links outside the
    catalog (with a scheme) are left alone. Links are resolved once and written; all paths are told apart in one
    aggregation, so a document that many link to is one row there; only the paths at fault are joined.
    """
    inner = links.where(~F.coalesce(F.col("href").rlike("^[A-Za-z][A-Za-z0-9+.-]*:"), F.lit(False)))
    at = _written(inner.select("source", "rel", "href", resolve(F.col("source"), F.col("href")).alias("target")), "targets")
    row = lambda df, path, rule, detail: df.select(F.col(path).alias("path"), F.lit(rule).alias("rule"), detail.alias("detail"))
    shown = F.concat_ws(" ", "rel", F.coalesce("href", F.lit("null")))
    down, parent = F.coalesce(F.col("rel").isin("child", "item"), F.lit(False)), F.coalesce(F.col("rel") == "parent", F.lit(False))
    marks = ("doc", "source", "target", "down")
    seen = lambda path, *which: F.struct(path.alias("path"), *[(w if isinstance(w, Column) else F.lit(w)).alias(m) for m, w in zip(marks, which, strict=True)])
    ends = at.select(F.inline(F.array(seen(F.col("source"), False, True, False, False), seen(F.col("target"), False, False, True, down))))
    facts = documents.select(F.inline(F.array(seen(F.col("path"), True, False, False, False)))).unionByName(ends).where("path is not null")
    faults = _written(facts.groupBy("path").agg(*[F.max(m).alias(m) for m in marks]).where("not doc or not down"), "faults")
    gone, lost = faults.where("target and not doc").select(F.col("path").alias("target")), faults.where("source and not doc").select(F.col("path").alias("source"))
    broken = row(at.where("target is null").unionByName(at.join(gone, "target", "left_semi")), "source", "broken", shown)
    stray = row(at.where("source is null").unionByName(at.join(lost, "source", "left_semi")), "source", "stray", shown)
    unled = documents.where("kind <> 'root'")
    dangling = row(unled.where("path is null").unionByName(unled.join(faults.where("doc and not down").select("path"), "path", "left_semi")), "path", "dangling", F.col("kind"))
    # A pair of documents, whichever of them holds the link.
    pairs = at.where("target is not null").select(F.when(parent, F.col("target")).otherwise(F.col("source")).alias("holder"), F.when(parent, F.col("source")).otherwise(F.col("target")).alias("held"), "rel")
    each = pairs.repartition("holder", "held").groupBy("holder", "held", "rel").agg(F.count("*").alias("n"))
    twice = each.where("n > 1").select(F.when(parent, F.col("held")).otherwise(F.col("holder")).alias("source"), F.concat_ws(" ", "rel", F.when(parent, F.col("holder")).otherwise(F.col("held"))).alias("detail"))
    doubled = row(twice, "source", "doubled", F.col("detail"))
    alone = each.groupBy("holder", "held").agg(F.max(parent).alias("up"), F.max(down).alias("down")).where("up and not down")
    one_way = row(alone.join(gone.select(F.col("target").alias("holder")), "holder", "left_anti"), "held", "one-way", F.col("holder"))
    return broken.unionByName(doubled).unionByName(stray).unionByName(dangling).unionByName(one_way)


def rules_check(documents: DataFrame, links: DataFrame, required: list[str]) -> DataFrame:
    """All violations of a written catalog: path, rule, detail. Required columns must be filled, ids be unique over the whole
    tree, links resolve (link_check)."""
    documents = _written(documents, "documents")  # read once, whatever it is stored as
    missing = documents.select("path", F.explode(F.array_compact(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in required]))).alias("detail")).select("path", F.lit("missing").alias("rule"), "detail")
    twice = documents.groupBy("id").agg(F.count("*").alias("n"), F.min("path").alias("first")).where("n > 1 and id is not null").select("id", "first")
    same = documents.join(twice, "id").where("path <> first").select("path", F.lit("duplicate id").alias("rule"), F.col("id").alias("detail"))
    return missing.unionByName(same).unionByName(link_check(documents, links))
