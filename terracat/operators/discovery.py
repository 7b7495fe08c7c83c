"""What belongs to a run: campaigns, settings, files that are looked at, and what happens to files that do not fit."""

from __future__ import annotations

import functools
import operator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terracat.operators.classify import DATE, label_table, match_pattern, pattern_table
from terracat.operators.records import SIDE_END, glob_regex

#: Fixed value: the settings file of a campaign, of any letter case.
SETTINGS = "campaign.yaml"
POLICIES = ("warn", "skip", "raise")


def campaigns(dirs: DataFrame, output: str | None = None) -> DataFrame:
    """dirs (dir: names right below the root) -> dir, date of those whose name holds a valid ISO date, the output directory left out."""
    date = F.try_to_date(F.nullif(F.regexp_extract("dir", DATE, 0), F.lit("")), "yyyy-MM-dd")
    found = dirs.select("dir", date.alias("date")).where("date is not null").distinct()
    return found if output is None else found.where(F.col("dir") != output)


def only_campaigns(files: DataFrame, campaign: Column, glob: str) -> DataFrame:
    """Files of the campaigns whose directory name matches a glob; on a partition column it prunes partitions."""
    return files.where(campaign.rlike(glob_regex(glob)))


def exclude_globs(files: DataFrame, globs: list[str]) -> DataFrame:
    """Files whose name matches none of the globs, in any letter case."""
    hit = [F.col("name").rlike(glob_regex(g)) for g in globs]
    return files.where(~functools.reduce(operator.or_, hit)) if hit else files


def candidates(files: DataFrame) -> DataFrame:
    """Files that can be products: neither the campaign's settings nor side files."""
    return files.where((F.lower("name") != SETTINGS) & ~F.col("name").rlike(SIDE_END))


def with_policy(rows: DataFrame, reason: Column, policy: str) -> DataFrame:
    """rows + reason (null: nothing wrong), kept. warn keeps what is wrong, skip does not, raise fails on the first."""
    if policy not in POLICIES:
        raise ValueError(f"unknown policy {policy!r}")
    told = rows.withColumn("reason", reason)
    if policy == "raise":
        first = told.where("reason is not null").first()
        if first is not None:
            raise ValueError(f"{first['reason']}: {first['name']}")
    return told.withColumn("kept", F.col("reason").isNull() | F.lit(policy == "warn"))


def unknown_files(files: DataFrame, policy: str = "warn") -> DataFrame:
    """Candidates that no pattern matches or whose label is in no registry: parent, name, reason. skip tells nothing, raise fails."""
    matched = match_pattern(candidates(files), pattern_table(files.sparkSession))
    listed = matched.join(F.broadcast(label_table(files.sparkSession)), "label", "left")
    reason = F.when(F.col("label").isNull(), "no registry match").when(F.col("category").isNull(), "label not in registry")
    told = with_policy(listed, reason, policy).where("reason is not null").select("parent", "name", "reason")
    return told.where(F.lit(policy != "skip"))


def non_native(winners: DataFrame, policy: str = "warn") -> DataFrame:
    """Winners that are not cloud native, with the reason and whether they stay: parent, name, reason, kept."""
    reason = F.when(F.col("native"), None).when(F.col("cog"), "named cog, not a COG").otherwise("non-cloud-native")
    return with_policy(winners, reason, policy).where("reason is not null").select("parent", "name", "reason", "kept")


#: Settings that are known; others in the file are ignored.
BLOCKS = "collection struct<title:string,description:string,license:string>, crs string, exclude array<string>, properties map<string,string>"


def config_blocks(campaign_dirs: DataFrame, files: DataFrame) -> DataFrame:
    """Settings of each campaign (campaign) from its file (campaign, name, text; JSON, which is YAML too).

    The file is found in any letter case. No file, or an empty one, means defaults; what is no mapping fails the campaign.
    campaign, title, license, crs, exclude, properties, failed.
    """
    own = files.where(F.lower("name") == SETTINGS).groupBy("campaign").agg(F.min(F.struct("name", "text")).alias("f"))
    text = F.nullif(F.trim(F.col("f.text")), F.lit(""))
    parsed = campaign_dirs.join(own, "campaign", "left").select("campaign", text.alias("text"), F.from_json(text, BLOCKS).alias("c"))
    # from_json gives a struct of nulls for what is no object.
    failed = F.col("text").isNotNull() & (~F.startswith("text", F.lit("{")) | F.try_parse_json("text").isNull())
    fine = lambda c: F.when(~F.col("failed"), F.col(c))
    out = parsed.withColumn("failed", failed)
    none = F.array().cast("array<string>")
    return out.select("campaign", fine("c.collection.title").alias("title"), F.coalesce(fine("c.collection.license"), F.lit("other")).alias("license"), fine("c.crs").alias("crs"), F.coalesce(fine("c.exclude"), none).alias("exclude"), fine("c.properties").alias("properties"), "failed")
