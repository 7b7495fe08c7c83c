"""Published collections: rows from settings, extents and parents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terracat.operators.snapshot import collection_extent

PROVIDERS = "array<struct<name:string,role:string,url:string>>"


def build_collection_row(meta: DataFrame, items: DataFrame, groups: DataFrame | None = None) -> DataFrame:
    """One row per collection of meta: what is published of it, or why it can't be.

    meta (collection, title, description, license, license_link: string; providers map<string,struct<role,url>>;
    keywords array<string>); items as collection_extent takes them, with grp naming a group. The description falls back
    on the title, then on the id, the license on `other`; providers become a list in order of their names. groups
    (collection, grp, title) adds a row for each, which inherits providers and keywords of its collection. A collection
    without items has an error and no extent; a license `other` that is given without a link has a warning.
    """
    listed = F.transform(F.array_sort(F.map_entries("providers")), lambda e: F.struct(e["key"].alias("name"), e["value"]["role"].alias("role"), e["value"]["url"].alias("url")))
    top = meta.select(
        F.col("collection").alias("id"), F.lit(None).cast("string").alias("parent"), "title", F.coalesce(F.nullif("description", F.lit("")), F.nullif("title", F.lit("")), "collection").alias("description"),
        F.col("license").alias("given"), "license_link", F.coalesce(listed, F.array().cast(PROVIDERS)).alias("providers"), F.coalesce("keywords", F.array().cast("array<string>")).alias("keywords"),
    )
    rows = top
    if groups is not None:
        none = F.lit(None).cast("string")
        of = groups.withColumnRenamed("title", "own").join(top.select(F.col("id").alias("collection"), "providers", "keywords"), "collection")
        name = F.concat_ws("/", "collection", "grp")
        below = of.select(name.alias("id"), F.col("collection").alias("parent"), F.col("own").alias("title"), F.concat(F.lit("Tiled products of "), "collection", F.lit(".")).alias("description"), none.alias("given"), none.alias("license_link"), "providers", "keywords")
        rows = top.unionByName(below)
        items = items.unionByName(items.withColumn("collection", F.concat_ws("/", "collection", "grp")))
    extents = collection_extent(items).withColumnRenamed("collection", "id")
    out = rows.join(extents, "id", "left")
    empty = F.when(F.col("n_items").isNull(), F.concat(F.lit("collection "), "id", F.lit(" would be empty")))
    loose = F.when((F.col("given") == "other") & F.coalesce(F.col("license_link") == "", F.lit(True)), "license other without a link")
    return out.withColumns({"license": F.coalesce(F.nullif("given", F.lit("")), F.lit("other")), "error": empty, "warning": loose}).drop("given")
