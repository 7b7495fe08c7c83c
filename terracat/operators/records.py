"""What an item's record says: titles, bands, times, references, placement. Every operator is DataFrame -> DataFrame, or Column -> Column."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from terracat.functions.names import glob_regex, relative_path  # noqa: F401
from terracat.functions.projections import parameter_rows, to_degrees
from terracat.operators.classify import DATE, cloud_native  # noqa: F401

# Media types of labels, the type of a cloud-native raster, and extension addresses of key prefixes.
MEDIA = {"pointcloud_copc": "application/vnd.laszip+copc", "pointcloud": "application/vnd.laszip", "pointcloud_las": "application/vnd.las"}
TIFF, COG = "image/tiff; application=geotiff", "image/tiff; application=geotiff; profile=cloud-optimized"
EXTENSIONS = {
    "proj": "https://stac-extensions.github.io/projection/v2.0.0/schema.json", "pc": "https://stac-extensions.github.io/pointcloud/v2.0.0/schema.json",
    "raster": "https://stac-extensions.github.io/raster/v2.0.0/schema.json", "file": "https://stac-extensions.github.io/file/v2.1.0/schema.json",
    "eo": "https://stac-extensions.github.io/eo/v2.0.0/schema.json",
}
#: Seconds: GPS epoch on the Unix clock, the offset of adjusted GPS time, a week, a day. Days: how far a time may lie off its campaign.
GPS_EPOCH, ADJUSTED, WEEK, DAY, DRIFT = 315_964_800, 1_000_000_000, 604_800, 86_400, 14


def media_type(label: Column, native: Column) -> Column:
    of_label = F.coalesce(*[F.when(label == k, v) for k, v in MEDIA.items()])
    return F.coalesce(of_label, F.when(native, COG).otherwise(TIFF))


def item_title(group: Column, item: Column, category: Column, label: Column, campaign: Column) -> Column:
    """Tiles are named by their two trailing numbers, others by label and date."""
    tail = F.regexp_extract(item, r"(?:^|_)(\d+_\d+)$", 1)
    return F.when(group.isNotNull() & (tail != ""), F.concat(category, F.lit(" tile "), tail)).otherwise(F.concat_ws(" ", F.replace(label, F.lit("_"), F.lit(" ")), campaign))


def band_name(bands: DataFrame) -> DataFrame:
    """bands (item, band, description, color) + name, common_name."""
    n = F.count("*").over(Window.partitionBy("item"))
    usable = F.when((F.col("color") != "undefined") & ~((F.col("color") == "gray") & (n == 1)), F.col("color"))
    name = F.coalesce("description", usable, F.when(n > 1, F.concat(F.lit("band"), F.col("band"))))
    return bands.withColumn("name", name).withColumn("common_name", F.when(F.col("color").isin("red", "green", "blue", "nir"), F.col("color")))


def finite(value: Column) -> Column:
    """A number that JSON can hold, of four decimals, else null."""
    return F.when(~F.isnan(value) & (F.abs(value) < F.lit(float("inf"))), F.round(value, 4))


def nodata_text(value: Column) -> Column:
    return F.when(F.isnan(value), "nan").when(value == float("inf"), "inf").when(value == float("-inf"), "-inf").otherwise(F.round(value, 4).cast("string"))


def storage_type(code: Column) -> Column:
    """Kind of number of a type code; null if the code is unknown."""
    return F.when(code.rlike(r"^uint(8|16|32|64)$"), "unsigned").when(code.rlike(r"^int(8|16|32|64)$"), "signed").when(code.isin("float32", "float64"), "floating")


def band_hoist_shared(bands: DataFrame, keys: list[str]) -> DataFrame:
    """item, key, value of what all bands of an item share; such values belong to the asset."""
    total = bands.groupBy("item").agg(F.count("*").alias("n_bands"))
    long = bands.select("item", F.explode(F.array(*[F.struct(F.lit(k).alias("key"), F.col(k).cast("string").alias("value")) for k in keys])).alias("s")).select("item", "s.*")
    shared = long.groupBy("item", "key").agg(F.count("value").alias("n"), F.min("value").alias("value"), F.max("value").alias("top")).where("value = top")
    return shared.join(total, "item").where("n = n_bands").select("item", "key", "value")


def extension_declare(keys: Column) -> Column:
    uris = F.transform(keys, lambda k: F.coalesce(*[F.when(F.startswith(k, F.lit(f"{p}:")), F.lit(u)) for p, u in EXTENSIONS.items()]))
    return F.sort_array(F.array_distinct(F.filter(uris, lambda u: u.isNotNull())))


def native_bbox(items: DataFrame) -> DataFrame:
    """items (gt0..gt5, width, height) + the box of the four corners, also of rotated rasters."""
    w, h = F.col("width"), F.col("height")
    box = {}
    for axis, (o, a, b) in {"x": ("gt0", "gt1", "gt2"), "y": ("gt3", "gt4", "gt5")}.items():
        o, a, b = F.col(o), F.col(a) * w, F.col(b) * h
        corners = [o, o + a, o + b, o + a + b]
        box |= {f"{axis}min": F.round(F.least(*corners), 4), f"{axis}max": F.round(F.greatest(*corners), 4)}
    return items.withColumns(box)


def reproject_bbox(items: DataFrame, steps: int = 21) -> DataFrame:
    """items (item, epsg, x0, y0, x1, y1 in the plane of that code) -> item, the box in degrees over points set along all
    four edges (west, south, east, north), and error: `unsupported CRS` for codes without a projection, else null."""
    code = F.col("epsg").cast("int") if "epsg" in items.columns else F.lit(3857)
    dense = items.select("item", code.alias("epsg"), "x0", "y0", "x1", "y1", F.explode(F.transform(F.sequence(F.lit(0), F.lit(steps)), lambda k: k / steps)).alias("t"))
    x, y = F.col("x0") + (F.col("x1") - F.col("x0")) * F.col("t"), F.col("y0") + (F.col("y1") - F.col("y0")) * F.col("t")
    edge = dense.select("item", "epsg", F.explode(F.array(*[F.struct(a.alias("x"), b.alias("y")) for a, b in ((x, F.col("y0")), (x, F.col("y1")), (F.col("x0"), y), (F.col("x1"), y))])).alias("p"))
    placed = to_degrees(edge.select("item", "epsg", "p.x", "p.y"))
    sides = [F.round(f(c), 6).alias(n) for f, c, n in ((F.min, "lon", "west"), (F.min, "lat", "south"), (F.max, "lon", "east"), (F.max, "lat", "north"))]
    known = F.col("epsg").isin([r[0] for r in parameter_rows()])
    return placed.groupBy("item").agg(*sides, F.min(F.when(~F.coalesce(known, F.lit(False)), "unsupported CRS")).alias("error"))


def crs_fallback(items: DataFrame) -> DataFrame:
    """items (own_crs, fallback) + crs: that of the file, else the campaign's; failed where neither is known."""
    out = items.withColumn("crs", F.coalesce("own_crs", "fallback"))
    return out.withColumn("failed", F.col("crs").isNull())


def round_coords(rings: Column) -> Column:
    return F.transform(rings, lambda ring: F.transform(ring, lambda v: F.round(v, 7)))


def epoch_time_resolve(spans: DataFrame) -> DataFrame:
    """spans (gps_min, gps_max, campaign date, anchor date or null) + start, end (timestamp, null if not to be had).

    Over a week: adjusted GPS time. From a day on: seconds since the Sunday of the anchor's week. Less: seconds of the
    anchor's day. Ends before the start reach into the next week. Times over 14 days off the campaign count as none.
    """
    a, b = F.col("gps_min").cast("double"), F.col("gps_max").cast("double")
    anchor = F.coalesce("anchor", "campaign")
    b = F.when((b <= WEEK) & (b < a), b + WEEK).otherwise(b)
    adjusted = F.col("gps_max") > WEEK
    day = F.unix_date(anchor) - F.when(b >= DAY, F.dayofweek(anchor) - 1).otherwise(0)
    origin = F.when(adjusted, F.lit(GPS_EPOCH + ADJUSTED)).otherwise(day.cast("long") * DAY)
    usable = a.isNotNull() & b.isNotNull() & (F.col("gps_min") != F.col("gps_max")) & (a >= 0)
    micros = lambda v: F.when(usable, F.round((origin + v) * 1e6).cast("long"))
    near = lambda us: F.abs(F.floor(us / (DAY * 1e6)) - F.unix_date("campaign")) <= DRIFT
    out = spans.withColumn("s_", micros(a)).withColumn("e_", micros(b))
    ok = near(F.col("s_")) & near(F.col("e_"))
    return out.withColumn("start", F.when(ok, F.timestamp_micros("s_"))).withColumn("end", F.when(ok, F.timestamp_micros("e_"))).drop("s_", "e_")


def anchor_date(item: Column, campaign: Column) -> Column:
    """The date in the name if it lies within 14 days of the campaign, else the campaign's."""
    own = F.try_to_date(F.nullif(F.regexp_extract(item, DATE, 0), F.lit("")), "yyyy-MM-dd")
    return F.when(F.abs(F.date_diff(own, campaign)) <= DRIFT, own).otherwise(campaign)


def properties_overlay(base: Column, by_label: Column, by_id: Column) -> Column:
    """Maps laid over each other, the later winning; a null takes its key off."""
    none = F.create_map().cast("map<string,string>")

    def lay(under: Column, over: Column) -> Column:
        return F.map_concat(F.map_filter(under, lambda k, v: ~F.map_contains_key(over, k)), over)

    out = lay(lay(F.coalesce(base, none), F.coalesce(by_label, none)), F.coalesce(by_id, none))
    return F.map_filter(out, lambda k, v: v.isNotNull())


def registry_merge(defaults: DataFrame, overrides: DataFrame, campaigns: DataFrame | None = None) -> DataFrame:
    """Patterns of each campaign: an override replaces a default whole, lists it omits are empty, all in lower case.

    defaults (ord, label, require, forbid, extensions), a few rows; overrides (campaign, turn, label and the lists) may
    hold new labels, which come after the defaults in their turn. campaigns: all of them, those without overrides too.
    """
    lists = ["require", "forbid", "extensions"]
    empty = F.array().cast("array<string>")
    every = overrides.select("campaign") if campaigns is None else campaigns.select("campaign")
    own = overrides.select("campaign", "turn", "label", *[F.transform(F.coalesce(c, empty), F.lower).alias(c) for c in lists], F.lit(0).alias("rank"))
    base = every.distinct().join(F.broadcast(defaults), F.lit(True)).select("campaign", F.lit(None).cast("int").alias("turn"), "label", *lists, F.lit(1).alias("rank"))
    first = Window.partitionBy("campaign", "label").orderBy("rank", "turn")
    merged = base.unionByName(own).withColumn("rn", F.row_number().over(first)).where("rn = 1").drop("rn", "rank")
    known = merged.join(F.broadcast(defaults.select("label", "ord")), "label", "left")
    added = F.row_number().over(Window.partitionBy("campaign", F.col("ord").isNull()).orderBy("turn", "label"))
    last = defaults.agg(F.max("ord").alias("last"))
    return known.withColumn("added", added).join(F.broadcast(last), F.lit(True)).select("campaign", "label", *lists, F.coalesce("ord", F.col("last") + F.col("added")).alias("ord"))


# Extensions of side files, which are never products of their own.
SIDES = (".aux.xml", ".prj", ".tfw")
SIDE_END = "(?i)(" + "|".join(re.escape(e) for e in SIDES) + ")$"


def join_sidecar_files(prods: DataFrame, sides: DataFrame) -> DataFrame:
    """prods (parent, name, ext) with sides (parent, side) named after the stem or the full name: parent, name, n_sides, sides."""
    named = prods.select("parent", "name", F.explode(F.array(F.expr("left(name, length(name) - length(ext))"), "name")).alias("base"))
    cut = sides.where(F.col("side").rlike(SIDE_END)).select("parent", "side", F.regexp_replace("side", SIDE_END, "").alias("base"))
    return named.join(cut, ["parent", "base"]).groupBy("parent", "name").agg(F.count_distinct("side").alias("n_sides"), F.array_join(F.sort_array(F.collect_set("side")), ",").alias("sides"))


def _hits(items: DataFrame, placement: DataFrame) -> DataFrame:
    globs = placement.where(F.col("key").rlike(r"[*?\[]"))
    return items.join(F.broadcast(globs.select("ord", "key", "regex", "group")), F.expr("item rlike regex"))


def join_placement(items: DataFrame, placement: DataFrame) -> DataFrame:
    """items (item, auto) with placement (ord, key, regex, group; a few rows): an exact key, else the first glob, else auto; a null group means flat."""
    exact = placement.where(~F.col("key").rlike(r"[*?\[]")).select(F.col("key").alias("item"), F.col("group").alias("exact"), F.lit(True).alias("is_exact"))
    globs = _hits(items.select("item").distinct(), placement).groupBy("item").agg(F.min(F.struct("ord", "group")).alias("hit"))
    out = items.join(F.broadcast(exact), "item", "left").join(globs, "item", "left")
    return out.select("item", F.when(F.col("is_exact"), F.col("exact")).when(F.col("hit").isNotNull(), F.col("hit.group")).otherwise(F.col("auto")).alias("placed"))


def overlap_patterns(items: DataFrame, placement: DataFrame) -> DataFrame:
    """Combinations of globs that meet in an item, once each."""
    each = _hits(items.select("item").distinct(), placement).groupBy("item").agg(F.array_join(F.sort_array(F.collect_set("key")), " ").alias("keys"), F.count("*").alias("n"))
    return each.where("n > 1").groupBy("keys").agg(F.count("*").alias("n_items"))


def anti_unused_keys(items: DataFrame, placement: DataFrame) -> DataFrame:
    """Keys that no item meets."""
    ids = items.select("item").distinct()
    met = _hits(ids, placement).select("key").union(ids.join(F.broadcast(placement.select("key")), F.col("key") == F.col("item"), "left_semi").select(F.col("item").alias("key")))
    return placement.join(met.distinct(), "key", "left_anti").select("key")


def join_recorded_vs_actual(recorded: DataFrame, actual: DataFrame, on: list[str], relative: float = 1e-4, absolute: float = 5e-5) -> DataFrame:
    """on + recorded, actual, agrees: within the larger of both tolerances."""
    a, b = F.col("recorded"), F.col("actual")
    room = F.greatest(relative * F.greatest(F.abs(a), F.abs(b)), F.lit(absolute))
    return recorded.join(actual, on).withColumn("agrees", F.abs(a - b) <= room)


def dim_key(name: Column) -> Column:
    """Names are alike when they agree without leading underscores, blanks and case."""
    return F.lower(F.replace(F.regexp_replace(name, "^_+", ""), F.lit(" "), F.lit("")))


def flag_bits_compose(flags: list[Column]) -> Column:
    """One integer of flags (0 or 1, null: 0), the first in the lowest bit."""
    out = F.lit(0)
    for k, flag in enumerate(flags):
        out = out.bitwiseOR(F.shiftleft(F.coalesce(flag.cast("int"), F.lit(0)), k))
    return out


def nodata_exclude_scale(values: DataFrame) -> DataFrame:
    """values (raw, nodata or null, scale, off) without rows of exactly the nodata value, + value = raw * scale + off."""
    return values.where("nodata is null or raw <> nodata").withColumn("value", F.col("raw") * F.col("scale") + F.col("off"))


def angle_stats(stats: DataFrame, dim: str) -> DataFrame:
    """Statistics (dim, vmin, vmax, vmean, vstd) with those of one dimension turned from radians into degrees."""
    return stats.withColumns({c: F.when(F.col("dim") == dim, F.round(F.degrees(c), 4)).otherwise(F.col(c)) for c in ("vmin", "vmax", "vmean", "vstd")})


# Kinds of number of column type codes, and dimensions stored as integers (size, kind) whatever is reported.
CODES = {0: "signed", 2: "signed", 4: "signed", 9: "signed", 1: "unsigned", 3: "unsigned", 5: "unsigned", 11: "unsigned", 6: "floating", 7: "floating"}
AMPLITUDE, ANGLE_SHORT, ANGLE_BYTE = (2, "unsigned"), (2, "signed"), (1, "signed")


def _stored(name: Column, point_format: Column, k: int) -> Column:
    angle = F.when(point_format >= 6, F.lit(ANGLE_SHORT[k])).otherwise(F.lit(ANGLE_BYTE[k]))
    return F.when(name == "Amplitude", F.lit(AMPLITUDE[k])).when(name == "ScanAngle", angle)


def point_schema(dims: DataFrame) -> DataFrame:
    """dims (item, name, size, code, point_format) of all dimensions, constant ones too -> item, name, size, type.

    X, Y and Z are not listed, two dimensions are given as they are stored, and types of unknown codes are null.
    """
    name, fmt = F.col("name"), F.col("point_format")
    kind = F.coalesce(*[F.when(F.col("code") == k, v) for k, v in CODES.items()])
    size, kind = F.coalesce(_stored(name, fmt, 0), "size"), F.coalesce(_stored(name, fmt, 1), kind)
    return dims.where(~name.isin("X", "Y", "Z")).select("item", "name", size.cast("int").alias("size"), kind.alias("type"))


def restate_schema(items: DataFrame) -> DataFrame:
    """items (schemas array<struct<name,size,type>>, stats array<struct<name,vmin,vmax,vmean,vstd>>, point_format) of
    which those with a floating ScanAngle get its stored type, that of Amplitude, and its statistics in degrees."""
    fmt = F.col("point_format")
    wrong = F.exists("schemas", lambda s: (s["name"] == "ScanAngle") & (s["type"] == "floating"))
    mend = lambda s: F.struct(s["name"].alias("name"), F.coalesce(_stored(s["name"], fmt, 0), s["size"]).alias("size"), F.coalesce(_stored(s["name"], fmt, 1), s["type"]).alias("type"))
    turn = lambda s: F.struct(s["name"].alias("name"), *[F.when(s["name"] == "ScanAngle", F.round(F.degrees(s[c]), 4)).otherwise(s[c]).alias(c) for c in ("vmin", "vmax", "vmean", "vstd")])
    return items.withColumns({"schemas": F.when(wrong, F.transform("schemas", mend)).otherwise(F.col("schemas")), "stats": F.when(wrong, F.transform("stats", turn)).otherwise(F.col("stats"))})


def polygon_intersects_box(rings: Column, box: tuple[float, float, float, float]) -> Column:
    """Whether polygons (array of closed rings of struct<x,y>, holes among them) and a box have a point in common.

    They do if an edge meets the box (their extents overlap, and its corners are not all on one side of the edge), or
    if the box lies inside (its first corner has an odd number of edges to its right).
    """
    x0, y0, x1, y1 = (F.lit(float(v)) for v in box)
    steps = lambda ring: F.sequence(F.lit(1), F.size(ring) - 1)
    edge = lambda ring: F.transform(steps(ring), lambda i: F.struct(ring[i - 1]["x"].alias("ax"), ring[i - 1]["y"].alias("ay"), ring[i]["x"].alias("bx"), ring[i]["y"].alias("by")))
    edges = F.flatten(F.transform(F.filter(rings, lambda r: F.size(r) > 1), edge))

    def meets(e: Column) -> Column:
        near = (F.greatest(e["ax"], e["bx"]) >= x0) & (F.least(e["ax"], e["bx"]) <= x1) & (F.greatest(e["ay"], e["by"]) >= y0) & (F.least(e["ay"], e["by"]) <= y1)
        side = [(e["bx"] - e["ax"]) * (y - e["ay"]) - (e["by"] - e["ay"]) * (x - e["ax"]) for x in (x0, x1) for y in (y0, y1)]
        return near & (F.least(*side) <= 0) & (F.greatest(*side) >= 0)

    def right_of(e: Column) -> Column:
        spans = (e["ay"] > y0) != (e["by"] > y0)
        return spans & (x0 < (e["bx"] - e["ax"]) * (y0 - e["ay"]) / F.nullif(e["by"] - e["ay"], F.lit(0.0)) + e["ax"])

    inside = F.size(F.filter(edges, lambda e: F.coalesce(right_of(e), F.lit(False)))) % 2 == 1
    return F.coalesce(F.exists(edges, meets) | inside, F.lit(False))
