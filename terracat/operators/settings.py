"""Settings of campaigns: every block of their files, and items as those settings make them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terracat.operators.discovery import SETTINGS
from terracat.operators.records import properties_overlay

_LISTS = "require:array<string>,forbid:array<string>,extensions:array<string>"
_BLOCKS = f"""collection struct<id:string,title:string,description:string,license:string,license_link:string,keywords:array<string>,providers:string>, crs string, exclude array<string>,
  properties map<string,string>, hierarchy struct<placement:map<string,string>,groups:map<string,struct<title:string,description:string>>>,
  patterns map<string,struct<{_LISTS}>>, labels map<string,struct<category:string,kind:string>>"""
_PROVIDER = "struct<name:string,roles:array<string>,url:string>"
#: Keys of the block of properties that hold blocks of their own.
BY_LABEL, BY_ID = "byLabel", "byId"


def glob_pattern(glob: Column) -> Column:
    """A regular expression, for any case, of a glob in a column (* ? [ ])."""
    plain = F.regexp_replace(glob, r"([.^$+(){}|\\])", r"\\$1")
    sets = F.regexp_replace(plain, r"\[!", "[^")
    return F.concat(F.lit("(?is)^"), F.regexp_replace(F.regexp_replace(sets, r"\*", ".*"), r"\?", "."), F.lit("$"))


def settings_blocks(campaigns: DataFrame, files: DataFrame) -> DataFrame:
    """A row for each of campaigns (campaign) with every block of its settings file, out of files (campaign, name, text; JSON, which is YAML too).

    campaign, collection (id, title, description, license, license_link, keywords, providers), crs, exclude, properties,
    by_label, by_id, placement array<struct<ord, key, group>> in the order of the file (a null group: flat), groups,
    patterns, labels, failed. The file is found in any letter case. No file, or an empty one, means defaults; what is no
    mapping fails its campaign alone. Providers may be a list or go by their names.
    """
    own = files.where(F.lower("name") == SETTINGS).groupBy("campaign").agg(F.min(F.struct("name", "text")).alias("f"))
    text = F.nullif(F.trim(F.col("f.text")), F.lit(""))
    read = campaigns.select("campaign").distinct().join(own, "campaign", "left").select("campaign", text.alias("text"))
    failed = F.col("text").isNotNull() & (~F.startswith("text", F.lit("{")) | F.try_parse_json("text").isNull())
    c = read.withColumn("failed", failed).withColumn("c", F.from_json(F.when(~F.col("failed"), F.col("text")), _BLOCKS))
    some = F.coalesce("c.properties", F.create_map().cast("map<string,string>"))
    nested = "map<string,map<string,string>>"
    block = lambda key: F.coalesce(F.from_json(F.try_element_at(some, F.lit(key)), nested), F.create_map().cast(nested))
    named = F.transform(F.map_entries(F.from_json("c.collection.providers", "map<string,struct<roles:array<string>,url:string>>")), lambda e: F.struct(e["key"].alias("name"), e["value"]["roles"].alias("roles"), e["value"]["url"].alias("url")))
    listed = F.from_json("c.collection.providers", f"array<{_PROVIDER}>")
    providers = F.when(F.startswith("c.collection.providers", F.lit("[")), listed).when(F.col("c.collection.providers").isNotNull(), named)
    keys = F.map_entries("c.hierarchy.placement")
    placement = F.coalesce(F.transform(keys, lambda e, k: F.struct(k.alias("ord"), e["key"].alias("key"), e["value"].alias("group"))), F.array().cast("array<struct<ord:int,key:string,group:string>>"))
    collection = F.struct(*[F.col(f"c.collection.{n}").alias(n) for n in ("id", "title", "description")], F.coalesce("c.collection.license", F.lit("other")).alias("license"), F.col("c.collection.license_link").alias("license_link"), F.col("c.collection.keywords").alias("keywords"), providers.alias("providers"))
    return c.select(
        "campaign", collection.alias("collection"), F.col("c.crs").alias("crs"), F.coalesce("c.exclude", F.array().cast("array<string>")).alias("exclude"), F.map_filter(some, lambda k, v: ~k.isin(BY_LABEL, BY_ID)).alias("properties"),
        block(BY_LABEL).alias("by_label"), block(BY_ID).alias("by_id"), placement.alias("placement"), F.col("c.hierarchy.groups").alias("groups"), F.col("c.patterns").alias("patterns"), F.col("c.labels").alias("labels"), "failed",
    )


def placed(item: Column, group: Column, placement: Column) -> Column:
    """The group of an item: that of its exact key, else of the first glob that fits, else the automatic one; null is flat."""
    exact = F.filter(placement, lambda p: p["key"] == item)
    globs = F.filter(placement, lambda p: p["key"].rlike(r"[*?\[]") & F.rlike(item, glob_pattern(p["key"])))
    hit = F.concat(exact, F.array_sort(globs))
    return F.when(F.size(hit) > 0, F.try_element_at(hit, F.lit(1))["group"]).otherwise(group)


def apply_settings(products: DataFrame, settings: DataFrame) -> DataFrame:
    """products (campaign, name, label, item, group, ...) as their campaigns' settings (settings_blocks) make them.

    Excluded names go, and so do all files of a campaign whose settings failed. group is the placed one, group_title what
    the settings call it; properties are the campaign's, its label's and its own laid over each other, nulls taking keys
    off; crs is the campaign's fallback. Campaigns without settings keep what they have. The settings come to the
    products by a join on the campaign: a few rows are broadcast by their size.
    """
    none = F.array().cast("array<string>")
    joined = products.join(settings.select("campaign", "exclude", F.col("properties").alias("base"), "by_label", "by_id", "placement", "groups", "crs", "failed"), "campaign", "left")
    out = joined.where(~F.coalesce("failed", F.lit(False)) & ~F.exists(F.coalesce("exclude", none), lambda g: F.rlike(F.col("name"), glob_pattern(g))))
    group = F.when(F.col("placement").isNull(), F.col("group")).otherwise(placed(F.col("item"), F.col("group"), F.col("placement")))
    out = out.withColumn("group", group)
    laid = properties_overlay(F.col("base"), F.try_element_at("by_label", F.col("label")), F.try_element_at("by_id", F.col("item")))
    title = F.try_element_at("groups", F.col("group"))["title"]
    return out.withColumns({"properties": laid, "group_title": title}).select(*products.columns, "properties", "group_title", "crs")
