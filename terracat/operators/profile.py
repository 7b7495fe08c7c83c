"""Raster and point profiling over long tables of cells and points."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BUCKETS = 32


def band_stats(cells: DataFrame) -> DataFrame:
    """Minimum, maximum, mean and population deviation of the valid cells of each item."""
    return cells.where("valid").groupBy("item").agg(F.round(F.min("value"), 4).alias("vmin"), F.round(F.max("value"), 4).alias("vmax"), F.round(F.avg("value"), 4).alias("vmean"), F.round(F.stddev_pop("value"), 4).alias("vstd"))


def valid_percent(cells: DataFrame) -> DataFrame:
    return cells.groupBy("item").agg(F.round(F.try_divide(100.0 * F.count_if("valid"), F.count("*")), 4).alias("valid_percent"), F.count_if("valid").alias("valid_count"))


def band_histogram(cells: DataFrame) -> DataFrame:
    """Counts of 32 buckets; half a bucket is padded at both ends; what lies outside falls into the end buckets; items of one value have none."""
    ends = cells.where("valid").groupBy("item").agg(F.min("value").alias("a"), F.max("value").alias("b")).where("a < b")
    half = (F.col("b") - F.col("a")) / (BUCKETS - 1) / 2
    ends = ends.select("item", (F.col("a") - half).alias("lo"), (F.col("b") + half).alias("hi"))
    bucket = F.least(F.greatest(F.floor((F.col("value") - F.col("lo")) / (F.col("hi") - F.col("lo")) * BUCKETS), F.lit(0)), F.lit(BUCKETS - 1))
    counts = cells.where("valid").join(ends, "item").groupBy("item", bucket.cast("int").alias("bucket")).agg(F.count("*").alias("n"))
    grid = ends.select("item", F.explode(F.sequence(F.lit(0), F.lit(BUCKETS - 1))).alias("bucket"))
    return grid.join(counts, ["item", "bucket"], "left").select("item", "bucket", F.coalesce("n", F.lit(0)).cast("long").alias("n"))


def mask_majority_coarsen(cells: DataFrame, k: int = 4) -> DataFrame:
    """A k x k block is valid when half of its k * k cells are; cells beyond the edge count as invalid."""
    return cells.groupBy("item", F.floor(F.col("row") / k).alias("brow"), F.floor(F.col("col") / k).alias("bcol")).agg((F.count_if("valid") >= k * k / 2).alias("valid"))


def raster_avg_downsample(cells: DataFrame, k: int = 4) -> DataFrame:
    return cells.groupBy("item", F.floor(F.col("row") / k).alias("brow"), F.floor(F.col("col") / k).alias("bcol")).agg(F.round(F.avg("value"), 4).alias("value"))


def raster_valid_window(cells: DataFrame) -> DataFrame:
    return cells.where("valid").groupBy("item").agg(F.min("row").alias("row0"), F.max("row").alias("row1"), F.min("col").alias("col0"), F.max("col").alias("col1"))


def tile_raster_windows(cells: DataFrame, size: int = 16) -> DataFrame:
    """Windows of size x size cells that hold a valid cell, named by their offsets."""
    xoff, yoff = F.floor(F.col("col") / size) * size, F.floor(F.col("row") / size) * size
    out = cells.groupBy("item", xoff.alias("xoff"), yoff.alias("yoff")).agg(F.count_if("valid").alias("n_valid")).where("n_valid > 0")
    return out.select("item", "xoff", "yoff", "n_valid", F.concat_ws("_", F.col("item").cast("string"), F.col("xoff").cast("string"), F.col("yoff").cast("string")).alias("name"))


def point_stats(points: DataFrame, dims: list[str]) -> DataFrame:
    """Of each dimension that is not constant: count, minimum, maximum, mean and sample deviation."""
    long = points.select("item", F.explode(F.array(*[F.struct(F.lit(d).alias("dim"), F.col(d).cast("double").alias("value")) for d in dims])).alias("s")).select("item", "s.*").where("value is not null and not isnan(value)")
    out = long.groupBy("item", "dim").agg(F.count("*").alias("n"), F.min("value").alias("vmin"), F.max("value").alias("vmax"), F.round(F.avg("value"), 4).alias("vmean"), F.round(F.stddev_samp("value"), 4).alias("vstd"))
    return out.where("vmin <> vmax")


def point_time_span(points: DataFrame) -> DataFrame:
    """First and last finite time of each item; null where they are equal."""
    finite = points.where("gps_time is not null and not isnan(gps_time) and abs(gps_time) < double('infinity')")
    out = finite.groupBy("item").agg(F.min("gps_time").alias("t0"), F.max("gps_time").alias("t1"))
    return out.select("item", F.when(F.col("t0") < F.col("t1"), F.col("t0")).alias("t0"), F.when(F.col("t0") < F.col("t1"), F.col("t1")).alias("t1"))


def point_count_density(points: DataFrame) -> DataFrame:
    area = (F.max("x") - F.min("x")) * (F.max("y") - F.min("y"))
    return points.groupBy("item").agg(F.count("*").alias("n"), F.round(F.try_divide(F.count("*").cast("double"), area), 6).alias("density"))


def cell_maxz_grid(points: DataFrame, edge: int = 512) -> DataFrame:
    """Highest point of each cell; the longest edge of an item's extent has `edge` cells."""
    ext = points.groupBy("item").agg(F.min("x").alias("x0"), F.min("y").alias("y0"), F.greatest(F.max("x") - F.min("x"), F.max("y") - F.min("y")).alias("span"))
    cell = F.greatest(F.col("span") / edge, F.lit(1e-9))
    g = lambda v, o: F.least(F.floor((F.col(v) - F.col(o)) / cell), F.lit(edge - 1))
    return points.join(ext, "item").groupBy("item", g("x", "x0").alias("gx"), g("y", "y0").alias("gy")).agg(F.max("z").alias("z"))


def occupancy_grid(points: DataFrame, cells: int = 2048, least: float = 6.0) -> DataFrame:
    """Occupied cells; a cell's edge is span / cells, but `least` at least."""
    ext = points.groupBy("item").agg(F.min("x").alias("x0"), F.min("y").alias("y0"), F.greatest(F.max("x") - F.min("x"), F.max("y") - F.min("y")).alias("span"))
    edge = F.greatest(F.col("span") / cells, F.lit(least))
    g = lambda v, o: F.least(F.floor((F.col(v) - F.col(o)) / edge), F.lit(cells - 1))
    return points.join(ext, "item").select("item", g("x", "x0").alias("gx"), g("y", "y0").alias("gy")).distinct()


def tile_origin(points: DataFrame, beside: float = 0.0005) -> DataFrame:
    """ox, oy: a little beside the least coordinates, so that no point lies on a tile's edge there."""
    return points.agg((F.min("x") - beside).alias("ox"), (F.min("y") - beside).alias("oy"))


def tile_assign_points(points: DataFrame, size: float = 500.0) -> DataFrame:
    """Points of each tile; the origin lies 0.0005 below the least coordinates, so that no value lies on an edge."""
    origin = tile_origin(points)
    at = points.crossJoin(F.broadcast(origin))  # one row
    return at.groupBy(F.floor((F.col("x") - F.col("ox")) / size).alias("tile_col"), F.floor((F.col("y") - F.col("oy")) / size).alias("tile_row")).agg(F.count("*").alias("n"))


def tile_assign_buffer(points: DataFrame, size: float = 500.0, buffer: float = 20.0) -> DataFrame:
    """As above, but points within the buffer of a neighbour also belong to it."""
    origin = tile_origin(points)
    at = points.crossJoin(F.broadcast(origin))
    span = lambda v, o: F.sequence(F.floor((F.col(v) - buffer - F.col(o)) / size), F.floor((F.col(v) + buffer - F.col(o)) / size))
    cols = at.select("x", "y", "oy", F.explode(span("x", "ox")).alias("tile_col"))
    return cols.select("tile_col", F.explode(span("y", "oy")).alias("tile_row")).groupBy("tile_col", "tile_row").agg(F.count("*").alias("n"))
