"""File classification: names to labels, products, format twins and tile groups. Every operator is DataFrame -> DataFrame."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

DATE = r"\d{4}-\d{2}-\d{2}"
# The default pattern table (label, required tokens, forbidden tokens, extensions) and categories of labels.
PATTERNS = [
    ("pointcloud_copc", [], [], [".copc.laz"]), ("pointcloud", [], [], [".laz"]), ("pointcloud_las", [], [], [".las"]),
    ("orthophoto", ["transparent", "mosaic"], [], [".tif", ".tiff"]), ("dtm", ["dtm"], ["shd"], [".tif", ".tiff"]),
    ("dtm_filled", ["dtm", "filled"], ["shd"], [".tif", ".tiff"]), ("dtm_masked", ["dtm", "masked"], ["shd"], [".tif", ".tiff"]),
    ("dsm", ["dsm"], ["shd"], [".tif", ".tiff"]), ("dsm_filled", ["dsm", "filled"], ["shd"], [".tif", ".tiff"]),
    ("dsm_masked", ["dsm", "masked"], ["shd"], [".tif", ".tiff"]), ("shade", ["shd"], [], [".tif", ".tiff"]), ("log", [], [], [".log"]),
]
CATEGORIES = [
    ("pointcloud_copc", "pointcloud", "pcl"), ("pointcloud", "pointcloud", "pcl"), ("pointcloud_las", "pointcloud", "pcl"), ("orthophoto", "orthophoto", "raster"),
    ("dtm", "dtm", "raster"), ("dtm_filled", "dtm", "raster"), ("dtm_masked", "dtm", "raster"), ("dsm", "dsm", "raster"), ("dsm_filled", "dsm", "raster"), ("dsm_masked", "dsm", "raster"),
    ("shade", "ignore", "raster"), ("log", "ignore", ""),
]


def pattern_table(spark: SparkSession) -> DataFrame:
    rows = [(i, *p) for i, p in enumerate(PATTERNS)]
    return spark.createDataFrame(rows, "ord int, label string, require array<string>, forbid array<string>, extensions array<string>")


def label_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(CATEGORIES, "label string, category string, kind string")


def match_longest_ext(files: DataFrame, patterns: DataFrame) -> DataFrame:
    """files + ext: the longest known extension that ends the name; null if none."""
    known = [r["e"] for r in patterns.select(F.explode("extensions").alias("e")).distinct().collect()]  # of the pattern table, a few rows
    tried = [F.when(F.endswith(F.lower("name"), F.lit(e)), F.lit(e)) for e in sorted(known, key=lambda e: (-len(e), e))]
    return files.withColumn("ext", F.coalesce(*tried))


def name_tokens(files: DataFrame) -> DataFrame:
    """files with ext + stem and tokens: the name less the extension, lower case, cut at underscores."""
    stem = F.when(F.col("ext").isNotNull(), F.expr("left(name, length(name) - length(ext))")).otherwise(F.col("name"))
    return files.withColumn("stem", stem).withColumn("tokens", F.split(F.lower("stem"), "_"))


def match_pattern(files: DataFrame, patterns: DataFrame) -> DataFrame:
    """files + label, matched_ext: of the patterns whose tokens and extension fit, most required tokens, longest extension, first.

    patterns is a table of a few rows; it becomes one expression over each file's name, so files stay where they are.
    """
    rules = patterns.collect()
    known = sorted({e for r in rules for e in r["extensions"]})
    # Tokens of the name under each extension that it has; they are shared by all patterns of that extension.
    tokens = {f"tokens_{k}": F.when(F.endswith(F.lower("name"), F.lit(e)), F.split(F.expr(f"left(lower(name), length(name) - {len(e)})"), "_")) for k, e in enumerate(known)}
    fits = []
    for rule in rules:
        for ext in rule["extensions"]:
            own = F.col(f"tokens_{known.index(ext)}")
            ok = own.isNotNull()
            if rule["require"]:
                ok &= F.size(F.array_except(F.array(*map(F.lit, rule["require"])), own)) == 0
            if rule["forbid"]:
                ok &= ~F.arrays_overlap(F.array(*map(F.lit, rule["forbid"])), own)
            # One number to compare: most required tokens, then the longest extension, then the first in the table.
            order = (len(rule["require"]) * 1_000 + len(ext)) * 1_000_000 - rule["ord"]
            fits.append(F.when(ok, F.struct(F.lit(order).cast("long").alias("order"), F.lit(rule["label"]).alias("label"), F.lit(ext).alias("ext"))))
    none = F.lit(None).cast("struct<order:bigint,label:string,ext:string>")
    best = F.greatest(none, none, *fits)
    # As a generator of one row, the choice is made once, wherever its columns are used.
    own = [files[c] for c in files.columns]
    return files.withColumns(tokens).select(*own, F.inline(F.array(best)).alias("order_", "label", "matched_ext")).drop("order_")


def match_label_join(matched: DataFrame, labels: DataFrame) -> DataFrame:
    """matched (label, ...) + category, kind of labels (a few rows); files of no label or of one in no registry are `unknown`."""
    return matched.join(F.broadcast(labels), "label", "left").withColumn("category", F.coalesce("category", F.lit("unknown")))


def point_encoding(ext: Column) -> Column:
    """How a point cloud is stored: `copc`, or its last extension."""
    return F.when(ext == ".copc.laz", "copc").otherwise(F.substring_index(ext, ".", -1))


def item_id(stem: Column) -> Column:
    """Tokens of the stem without the marker `cog` of any case; order and case stay."""
    return F.array_join(F.filter(F.split(stem, "_"), lambda t: F.lower(t) != "cog"), "_")


def qualify_id(item: Column, campaign: Column) -> Column:
    """Prefix with the campaign unless the id has an ISO date."""
    return F.when(item.rlike(DATE), item).otherwise(F.concat_ws("_", campaign, item))


def cloud_native(kind: Column, ext: Column, layout: Column) -> Column:
    """Point clouds by their extension, rasters by their layout."""
    return F.when(kind == "pcl", ext == ".copc.laz").otherwise(F.coalesce(layout == "COG", F.lit(False)))


def products(files: DataFrame, spark: SparkSession) -> DataFrame:
    """Classified, non-ignored files with their item ids: parent, name, length, label, category, kind, item, ext, cog
    (the name says so), native. The layout of rasters is the column `layout`, or what the name says where there is none."""
    matched = match_pattern(files, pattern_table(spark)).where("label is not null")
    labelled = matched.join(F.broadcast(label_table(spark)), "label").where("category <> 'ignore'")
    stem = F.expr("left(name, length(name) - length(matched_ext))")
    cog = F.array_contains(F.split(F.lower(stem), "_"), "cog")
    layout = F.col("layout") if "layout" in files.columns else F.when(cog, "COG")
    native = cloud_native(F.col("kind"), F.col("matched_ext"), layout)
    return labelled.select("parent", "name", "length", "label", "category", "kind", item_id(stem).alias("item"), F.col("matched_ext").alias("ext"), cog.alias("cog"), native.alias("native"))


def _twins() -> Window:
    rank = F.when(F.col("ext") == ".copc.laz", 2).when(F.col("ext") == ".laz", 1).otherwise(0)
    return Window.partitionBy("parent", "category", F.lower("item")).orderBy(F.desc("native"), F.desc("cog"), rank.desc(), "name")


def twin_dedupe(prods: DataFrame) -> DataFrame:
    """One file for each (parent, category, item of any case)."""
    return prods.withColumn("rn", F.row_number().over(_twins())).where("rn = 1").drop("rn")


def twin_superseded(prods: DataFrame) -> DataFrame:
    """The files that lost, and the file that took their place."""
    w = _twins()
    return prods.withColumn("rn", F.row_number().over(w)).withColumn("winner", F.first("name").over(w)).where("rn > 1").select("parent", "name", "winner")


def twin_ext_mix(prods: DataFrame) -> DataFrame:
    """Items whose files in one directory have several extensions that are not cloud native: parent, category, item, n_ext."""
    plain = F.countDistinct(F.when(F.col("ext") != ".copc.laz", F.col("ext")))
    return prods.groupBy("parent", "category", F.lower("item").alias("item")).agg(plain.alias("n_ext")).where("n_ext > 1")


def tile_group_assign(winners: DataFrame, root: Column | None = None) -> DataFrame:
    """Several products of one category in one directory below the campaign's root form a group, named after the way
    from the root. root: that of each row; by default the path up to the first directory with a date."""
    if root is None:
        root = F.regexp_extract("parent", rf"^((?:[^/]*/)*?[^/]*{DATE}[^/]*)", 1)
    below = F.substring(F.col("parent"), F.length(root) + 2, F.length("parent"))
    n = F.count("*").over(Window.partitionBy("parent", "category"))
    return winners.withColumn("group", F.when((n > 1) & (below != ""), F.replace(below, F.lit("/"), F.lit("_"))))


def id_collision_local(winners: DataFrame) -> DataFrame:
    """Items that stand twice or more in one campaign (the directory below the root)."""
    campaign = F.regexp_extract("parent", DATE, 0)
    return winners.groupBy(campaign.alias("campaign"), "item").agg(F.count("*").alias("n")).where("n > 1")
