"""Matching of files by the registry of their own campaign.

A registry is a table of rules (campaign, label, ord, require, forbid, extensions) with, for each label, its category
and kind. Campaigns of equal rules share one digest, so rules are kept once for each digest; a file's rules come to it
as an array, and which of them fits best is one expression over that array and the file's name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terracat.operators import classify as C
from terracat.operators.records import registry_merge
from terracat.operators.upkeep import _written


def label_merge(defaults: DataFrame, overrides: DataFrame, campaigns: DataFrame) -> DataFrame:
    """Labels of each campaign (campaign, label, category, kind): an override replaces a default whole; what it omits is the
    label itself as category, and no kind. Of several overrides the one of the least category counts."""
    own = overrides.groupBy("campaign", "label").agg(F.min(F.struct(F.coalesce("category", "label").alias("category"), F.coalesce("kind", F.lit("")).alias("kind"))).alias("o"))
    base = campaigns.select("campaign").distinct().join(F.broadcast(defaults), F.lit(True))  # the defaults are a few rows
    both = base.join(own, ["campaign", "label"], "full_outer")
    return both.select("campaign", "label", F.coalesce("o.category", "category").alias("category"), F.coalesce("o.kind", "kind").alias("kind"))


def campaign_rules(patterns: DataFrame, labels: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(campaign, digest) and (digest, rules): the patterns of each campaign in order, with the category and kind of their labels.

    Both are written, so that their sizes are known when files are joined with them: small ones are broadcast by size.
    """
    rule = F.struct("ord", "label", "require", "forbid", "extensions", "category", "kind")
    rules = patterns.join(labels, ["campaign", "label"], "left").groupBy("campaign").agg(F.sort_array(F.collect_list(rule)).alias("rules"))
    told = _written(rules.withColumn("digest", F.sha2(F.to_json("rules"), 256)), "rules")
    return _written(told.select("campaign", "digest"), "digests"), _written(told.groupBy("digest").agg(F.first("rules").alias("rules")), "rules_by_digest")


def best_rule(name: Column, rules: Column) -> Column:
    """Of an array of rules the one that fits a name: most required tokens, the longest extension, the first; null if none.
    struct<n, long, first, label, category, kind, ext>, ordered by its first three."""
    low = F.lower(name)

    def under(rule: Column, ext: Column) -> Column:
        tokens = F.split(F.substring(low, F.lit(1), F.length(low) - F.length(ext)), "_")
        fits = (F.size(F.array_except(rule["require"], tokens)) == 0) & ~F.arrays_overlap(rule["forbid"], tokens)
        own = F.struct(F.size(F.array_distinct(rule["require"])).alias("n"), F.length(ext).alias("long"), (-rule["ord"]).alias("first"), rule["label"].alias("label"), rule["category"].alias("category"), rule["kind"].alias("kind"), ext.alias("ext"))
        return F.when(fits, own)

    every = F.flatten(F.transform(rules, lambda r: F.transform(F.filter(r["extensions"], lambda e: F.endswith(low, e)), lambda e: under(r, e))))
    return F.array_max(every)  # nulls don't count


def match_registry(files: DataFrame, digests: DataFrame, rules: DataFrame) -> DataFrame:
    """files (campaign, name, ...) + label, category, kind, matched_ext by their own campaign's rules; null where none fits or the campaign has none."""
    own = [F.col(c) for c in files.columns]
    # The fields of one struct, as a generator gives them: were they picked one by one, the rules would be tried for each.
    best = F.inline_outer(F.array(best_rule(F.col("name"), F.col("rules")))).alias("n_", "long_", "first_", "label", "category", "kind", "matched_ext")
    return files.join(digests, "campaign", "left").join(rules, "digest", "left").select(*own, best).drop("n_", "long_", "first_")


def campaign_products(files: DataFrame, patterns: DataFrame, labels: DataFrame) -> DataFrame:
    """Products of files (campaign, parent, name, length) by their campaigns' registries, as classify.products makes them of
    the default one. Labels without a category are in no registry and give no product, those of category `ignore` neither."""
    matched = match_registry(files, *campaign_rules(patterns, labels)).where("label is not null and category <> 'ignore'")
    stem = F.expr("left(name, length(name) - length(matched_ext))")
    cog = F.array_contains(F.split(F.lower(stem), "_"), "cog")
    layout = F.col("layout") if "layout" in files.columns else F.when(cog, "COG")
    native = C.cloud_native(F.col("kind"), F.col("matched_ext"), layout)
    return matched.select("campaign", "parent", "name", "length", "label", "category", "kind", C.item_id(stem).alias("item"), F.col("matched_ext").alias("ext"), cog.alias("cog"), native.alias("native"))


def settings_overrides(settings: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Overrides of patterns (campaign, turn, label, require, forbid, extensions) and labels (campaign, label, category, kind)
    out of settings (campaign, patterns map<label, struct>, labels map<label, struct>); a scalar in place of a list counts as one entry."""
    rows = settings.select("campaign", F.posexplode("patterns").alias("turn", "label", "p"))
    patterns = rows.select("campaign", "turn", "label", "p.require", "p.forbid", "p.extensions")
    labels = settings.select("campaign", F.explode("labels").alias("label", "l")).select("campaign", "label", "l.category", "l.kind")
    return patterns, labels


def products_by_settings(files: DataFrame, settings: DataFrame) -> DataFrame:
    """Products of files (campaign, parent, name, length) where settings (see settings_overrides) override the default registry
    of their campaign. Campaigns without settings use the defaults."""
    spark = files.sparkSession
    campaigns = files.select("campaign").distinct()
    patterns, labels = settings_overrides(settings)
    return campaign_products(files, registry_merge(C.pattern_table(spark), patterns, campaigns), label_merge(C.label_table(spark), labels, campaigns))
