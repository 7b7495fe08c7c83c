"""Rules on what is published: cloud-native checks, point counts, stored shapes, dimension names, samples, reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terracat.operators.records import dim_key
from terracat.operators.snapshot import collection_extent

#: What may happen to a raster of cloud-native layout whose structure has errors.
INVALID = ("warn", "demote", "raise")


def flag_cloud_native(files: DataFrame, policy: str = "demote") -> DataFrame:
    """files (name, kind, ext, layout, errors array<string> of a structure check) + native boolean, warning.

    Point clouds go by their extension, rasters by their layout; other kinds are not native. A raster of that layout with
    errors stays native and warns, is demoted, or is an error of the least name. Null errors count as none.
    """
    if policy not in INVALID:
        raise ValueError(f"unknown policy {policy!r}")
    bad = F.coalesce(F.size("errors"), F.lit(0)) > 0
    cog = F.coalesce((F.col("kind") == "raster") & (F.col("layout") == "COG"), F.lit(False))
    text = F.concat(F.lit("invalid COG ("), "name", F.lit("): "), F.array_join("errors", "; "))
    native = F.when(F.col("kind") == "pcl", F.col("ext") == ".copc.laz").otherwise(cog & (~bad | F.lit(policy == "warn")))
    told = F.when(cog & bad, F.concat(text, F.lit("; demoted to plain GeoTIFF" if policy == "demote" else "")))
    out = files.withColumns({"native": F.coalesce(native, F.lit(False)), "warning": told})
    if policy == "raise":
        least = out.where("warning is not null").agg(F.min("warning").alias("w")).first()["w"]
        if least is not None:
            raise ValueError(least)
    return out


def filter_min_points(now: DataFrame, before: DataFrame, least: int = 1000) -> tuple[DataFrame, DataFrame]:
    """(now, before) without the point items of too few points: now has item, kind, points (null: unreadable, stays), before item.

    An item that falls out now is no stale item: it goes from the last run's rows too.
    """
    few = (F.col("kind") == "pcl") & (F.col("points") < least)
    keep = ~F.coalesce(few, F.lit(False))
    return now.where(keep), before.join(now.where(~keep).select("item").distinct(), "item", "left_anti")


# Keys of statistics that are published.
STATISTICS = ("minimum", "maximum", "mean", "stddev", "valid_percent")


def band_field_prune(bands: DataFrame) -> DataFrame:
    """bands (item, band, scale, off, unit, statistics map<string,double>) -> item, band, fields (JSON), dropped.

    A scale of 1 and an offset of 0 say nothing and go, like nulls. Of the statistics the published keys stay; others are
    told in dropped, but for the count, which is known elsewhere.
    """
    own = F.map_filter("statistics", lambda k, v: k.isin(*STATISTICS) & v.isNotNull())
    values = F.struct(*[F.try_element_at(own, F.lit(k)).alias(k) for k in STATISTICS])
    unknown = F.array_sort(F.filter(F.map_keys("statistics"), lambda k: ~k.isin(*STATISTICS, "count")))
    fields = F.to_json(F.struct(F.col("unit"), F.when(F.size(own) > 0, values).alias("statistics"), F.nullif("scale", F.lit(1.0)).alias("raster:scale"), F.nullif("off", F.lit(0.0)).alias("raster:offset")))
    return bands.select("item", "band", fields.alias("fields"), F.array_join(unknown, ",").alias("dropped"))


def join_shape_check(stored: DataFrame, listed: DataFrame) -> DataFrame:
    """path, roles_differ, media_differ of items whose stored roles (array) or media type is not what the registry lists.

    stored and listed: path, roles, media. The order of roles counts, nulls equal nulls; items of one side have no shape to check.
    """
    a, b = stored.select("path", F.col("roles").alias("roles_is"), F.col("media").alias("media_is")), listed.select("path", "roles", "media")
    both = a.join(b, "path")
    roles, media = ~F.col("roles_is").eqNullSafe(F.col("roles")), ~F.col("media_is").eqNullSafe(F.col("media"))
    return both.where(roles | media).select("path", roles.alias("roles_differ"), media.alias("media_differ"))


# Names of dimensions in the catalog, and in the files where they are others.
ALIASES = {
    "Amplitude": "Intensity", "EchoNumber": "ReturnNumber", "NrOfEchos": "NumberOfReturns", "ClassificationFlags": "ClassFlags", "ScanDirection": "ScanDirectionFlag",
    "ScanAngle": "ScanAngleRank", "GPSTime": "GpsTime", "ChannelDesc": "ScanChannel",
}


def map_dim_names(recorded: DataFrame, actual: DataFrame, aliases: dict[str, str] = ALIASES) -> DataFrame:
    """recorded (item, name) -> item, name, actual: the dimension of the file (actual: item, name) that a recorded one is.

    A fixed alias comes first; else names are alike when they agree without leading underscores, blanks and case (of
    several the least). Null where the file has none.
    """
    alias = F.coalesce(*[F.when(F.col("name") == k, v) for k, v in aliases.items()])
    wanted = recorded.select("item", "name", F.coalesce(alias, dim_key(F.col("name"))).alias("key"), alias.isNotNull().alias("fixed"))
    by_name = actual.select("item", F.col("name").alias("actual"), F.explode(F.array(F.struct(F.col("name").alias("key"), F.lit(True).alias("fixed")), F.struct(dim_key(F.col("name")).alias("key"), F.lit(False).alias("fixed")))).alias("k"))
    found = by_name.select("item", "actual", "k.key", "k.fixed").groupBy("item", "key", "fixed").agg(F.min("actual").alias("actual"))
    return wanted.join(found, ["item", "key", "fixed"], "left").select("item", "name", "actual")


def sample_stratified(products: DataFrame, seed: int) -> DataFrame:
    """One tile (an item of a group), one orthophoto and one other raster of each campaign: campaign, stratum, parent, name.

    Drawn by the least hash of the seed and the file, so it stays the same for a seed; strata without files have no row.
    """
    stratum = F.when(F.col("group").isNotNull(), "tile").when(F.col("label") == "orthophoto", "orthophoto").when(F.col("kind") == "raster", "raster")
    order = F.md5(F.concat_ws("|", F.lit(str(seed)), "parent", "name"))
    drawn = products.withColumn("stratum", stratum).where("stratum is not null").groupBy("campaign", "stratum").agg(F.min(F.struct(order.alias("h"), "parent", "name")).alias("m"))
    return drawn.select("campaign", "stratum", "m.parent", "m.name")


def needs_refresh(overlay: Column, properties: Column, title: Column) -> Column:
    """Whether an unchanged file's item is patched: the overlay says something the item does not, or, where the overlay has no
    title of its own, the generated title is another."""
    differs = F.exists(F.map_entries(overlay), lambda e: ~F.try_element_at(properties, e["key"]).eqNullSafe(e["value"]))
    return differs | (~F.map_contains_key(overlay, F.lit("title")) & ~F.try_element_at(properties, F.lit("title")).eqNullSafe(title))


def run_report(results: DataFrame) -> DataFrame:
    """results (campaign, status, seconds, warning, error) -> campaign, report: a JSON object of counts by status, failed items,
    seconds, and how many warnings of each text; campaigns of which all failed are told as untouched."""
    statuses = ("new", "changed", "same", "stale")
    counts = [F.count_if(F.col("error").isNull() & (F.col("status") == s)).alias(s) for s in statuses]
    failed = F.count("error")
    warnings = results.where("warning is not null").groupBy("campaign", "warning").agg(F.count("*").alias("n")).groupBy("campaign").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("warning", "n")))).alias("warnings"))
    out = results.groupBy("campaign").agg(*counts, failed.alias("failed"), F.round(F.sum("seconds"), 3).alias("seconds"), (failed == F.count("*")).alias("untouched"))
    body = F.struct("campaign", *statuses, "failed", "seconds", "untouched", "warnings")
    return out.join(warnings, "campaign", "left").select("campaign", F.to_json(body).alias("report"))


def restate_time(items: DataFrame, affected: Column, days: int) -> tuple[DataFrame, DataFrame]:
    """(items, extents): items whose start moves by so many days where affected, and the extents of their collections anew."""
    moved = items.withColumn("start", F.when(F.coalesce(affected, F.lit(False)), F.date_add("start", days)).otherwise(F.col("start")))
    return moved, collection_extent(moved)


def stale_outputs(existing: DataFrame, owners: DataFrame) -> DataFrame:
    """Leftover outputs: tile, owner of existing (tile) that no current group is named after, with the group that has its points now.

    owners: tile, owner (each tile's group; a group is named after one of its tiles). Null owner: its points are nowhere.
    """
    leftover = existing.select("tile").distinct().join(owners.select(F.col("owner").alias("tile")).distinct(), "tile", "left_anti")
    return leftover.join(owners, "tile", "left").select("tile", "owner")
