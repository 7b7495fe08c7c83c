"""Snapshot maintenance and roll-ups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terracat.operators.records import polygon_intersects_box


def file_fingerprint(content: DataFrame) -> DataFrame:
    """Size and published hash (prefix 1220 for sha-256) of each content."""
    raw = F.encode("content", "UTF-8")
    return content.select("path", F.octet_length("content").cast("long").alias("size"), F.concat(F.lit("1220"), F.sha2(raw, 256)).alias("checksum"))


def join_snapshot_diff(now: DataFrame, before: DataFrame) -> DataFrame:
    """path, status of a full comparison: new, changed, same or stale."""
    a, b = now.select("path", F.col("checksum").alias("now")), before.select("path", F.col("checksum").alias("was"))
    status = F.when(F.col("was").isNull(), "new").when(F.col("now").isNull(), "stale").when(F.col("now") == F.col("was"), "same").otherwise("changed")
    return a.join(b, "path", "full_outer").select("path", status.alias("status"))


def set_stale_items(now: DataFrame, before: DataFrame) -> DataFrame:
    return before.join(now, "path", "left_anti").select("path")


def run_counts(diff: DataFrame) -> DataFrame:
    """One row for each campaign (second part of the path) with a count for each status."""
    campaign = F.split("path", "/")[1]
    n = lambda s: F.count_if(F.col("status") == s)
    return diff.groupBy(campaign.alias("campaign")).agg(n("new").alias("n_new"), n("changed").alias("n_changed"), n("same").alias("n_same"), n("stale").alias("n_stale"))


def collection_extent(items: DataFrame) -> DataFrame:
    return items.groupBy("collection").agg(*[f(c).alias(c) for f, c in ((F.min, "x0"), (F.min, "y0"), (F.max, "x1"), (F.max, "y1"))], F.min("start").alias("t0"), F.max("start").alias("t1"), F.count("*").alias("n_items"))


def root_extent_union(items: DataFrame) -> DataFrame:
    """Union over the collections' extents; the whole world if there are none."""
    c = collection_extent(items)
    return c.agg(F.coalesce(F.min("x0"), F.lit(-180.0)).alias("x0"), F.coalesce(F.min("y0"), F.lit(-90.0)).alias("y0"), F.coalesce(F.max("x1"), F.lit(180.0)).alias("x1"), F.coalesce(F.max("y1"), F.lit(90.0)).alias("y1"))


def collection_summary_sets(items: DataFrame, field: str) -> DataFrame:
    return items.groupBy("collection").agg(F.array_join(F.sort_array(F.collect_set(field)), ",").alias("distinct_values"))


def collection_summary_ranges(items: DataFrame, field: str) -> DataFrame:
    return items.groupBy("collection").agg(F.min(field).alias("vmin"), F.max(field).alias("vmax"))


def summary_rollup(items: DataFrame) -> DataFrame:
    """Counts by collection and group, by collection, and in all; level tells which."""
    return items.rollup("collection", "grp").agg(F.grouping_id().cast("int").alias("level"), F.count("*").alias("n"), F.sum("points").alias("points")).select("collection", "grp", "level", "n", "points")


def search_spatiotemporal(items: DataFrame, collections: DataFrame, box: tuple[float, float, float, float], since: str, until: str, least: float, rings: str | None = None) -> DataFrame:
    """Items that touch the box, start within the dates and have so many points; item, collection, by item.

    collections (collection, x0, y0, x1, y1, t0, t1) is the stored table of extents: those that miss the box or the dates
    are skipped. rings: a column of polygons, which are then tested themselves after their boxes.
    """
    lo, hi = F.lit(since).cast("date"), F.lit(until).cast("date")
    near = (F.col("x1") >= box[0]) & (F.col("x0") <= box[2]) & (F.col("y1") >= box[1]) & (F.col("y0") <= box[3])
    open_ones = collections.where(near & (F.col("t0") <= hi) & (F.col("t1") >= lo)).select("collection")
    hit = items.where(near & F.col("start").between(lo, hi) & (F.col("points") >= least))
    if rings:
        hit = hit.where(polygon_intersects_box(F.col(rings), box))
    return hit.join(open_ones, "collection", "left_semi").select("item", "collection").orderBy("item", "collection")


def dir_own_stats(paths: DataFrame) -> DataFrame:
    """Files and bytes of each directory and extension; names without one fall under `(no ext)`."""
    parent, name = F.regexp_extract("path", "^(.*)/[^/]*$", 1), F.regexp_extract("path", "([^/]*)$", 1)
    ext = F.lower(F.regexp_extract(name, r"(\.[^.]+)$", 1))
    return paths.groupBy(parent.alias("dir"), F.when(ext == "", "(no ext)").otherwise(ext).alias("ext")).agg(F.count("*").alias("files"), F.sum("size").alias("bytes"))


def dir_depth_prune(dirs: DataFrame, depth: int) -> DataFrame:
    """Directories at most so many levels deep; what lies below is in their sizes already."""
    return dirs.where(F.size(F.split("dir", "/")) <= depth)


def dir_subtree_size(paths: DataFrame) -> DataFrame:
    """Bytes of each directory with all below it, from every path's ancestors."""
    parts = F.split("path", "/")
    up = paths.select("size", F.explode(F.transform(F.sequence(F.lit(1), F.size(parts) - 1), lambda k: F.array_join(F.slice(parts, F.lit(1), k), "/"))).alias("dir"))
    return up.groupBy("dir").agg(F.sum("size").alias("bytes"), F.count("*").alias("files"))
