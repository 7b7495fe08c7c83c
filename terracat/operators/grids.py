"""Grids of cells: filling, shading, thinning."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def band_stats_alpha(bands: DataFrame, alpha: int) -> DataFrame:
    """bands (item, row, col, band, value): moments of each band over cells whose alpha is above 0; the alpha band over all."""
    cell = bands.groupBy("item", "row", "col").agg(F.max(F.when(F.col("band") == alpha, F.col("value"))).alias("a"), F.collect_list(F.struct("band", "value")).alias("s"))  # a list as long as a cell has bands
    flat = cell.select("item", "a", F.explode("s").alias("s")).select("item", "s.band", F.when((F.col("a") > 0) | (F.col("s.band") == alpha), F.col("s.value")).alias("value"))
    return flat.groupBy("item", "band").agg(F.round(F.min("value"), 4).alias("vmin"), F.round(F.max("value"), 4).alias("vmax"), F.round(F.avg("value"), 4).alias("vmean"), F.round(F.stddev_pop("value"), 4).alias("vstd"))


def cell_maxz_union(points: DataFrame, edge: int = 512) -> DataFrame:
    """Highest point of each cell of one grid over all items."""
    ext = points.agg(F.min("x").alias("x0"), F.min("y").alias("y0"), F.greatest(F.max("x") - F.min("x"), F.max("y") - F.min("y")).alias("span"))
    g = lambda v, o: F.least(F.floor((F.col(v) - F.col(o)) / F.greatest(F.col("span") / edge, F.lit(1e-9))), F.lit(edge - 1))
    return points.crossJoin(F.broadcast(ext)).groupBy(g("x", "x0").alias("gx"), g("y", "y0").alias("gy")).agg(F.max("z").alias("z"))  # ext is one row


def grid_fill_small_gaps(grid: DataFrame, edge: int = 512, reach: int = 2) -> DataFrame:
    """grid (item, gx, gy, z) with empty cells within reach filled from the nearest cell (ties: lower row, then column)."""
    near = [(dx, dy) for dx in range(-reach, reach + 1) for dy in range(-reach, reach + 1) if dx * dx + dy * dy <= reach * reach]
    offers = F.explode(F.array(*[F.struct(F.lit(dx).alias("dx"), F.lit(dy).alias("dy")) for dx, dy in near]))
    spread = grid.select("item", "gx", "gy", "z", offers.alias("o"))
    d = F.struct((F.col("o.dx") * F.col("o.dx") + F.col("o.dy") * F.col("o.dy")).alias("d"), F.col("gy").alias("y"), F.col("gx").alias("x"), "z")
    to = spread.select("item", (F.col("gx") + F.col("o.dx")).alias("gx"), (F.col("gy") + F.col("o.dy")).alias("gy"), d.alias("d"))
    inside = F.col("gx").between(0, edge - 1) & F.col("gy").between(0, edge - 1)
    return to.where(inside).groupBy("item", "gx", "gy").agg(F.min("d").alias("d")).select("item", "gx", "gy", F.col("d.z").alias("z"))


def grid_percentile_clip(grid: DataFrame) -> DataFrame:
    """The 10th and 90th percentile of each item's grid, between which shades are stretched. A grid is bounded by its edge, so exact ranks are affordable."""
    return grid.groupBy("item").agg(F.round(F.percentile("z", F.lit(0.1)), 4).alias("p10"), F.round(F.percentile("z", F.lit(0.9)), 4).alias("p90"))


def raster_hillshade(cells: DataFrame, azimuth: float = 315.0, altitude: float = 45.0) -> DataFrame:
    """Shade 0..255 by the 3 x 3 slope of Horn, as one pass along rows and one along columns; values beyond an edge are extrapolated."""
    def sides(v: str, w: Window, at: str) -> tuple:
        before = F.when(F.lag(at).over(w) == F.col(at) - 1, F.lag(v).over(w))
        after = F.when(F.lead(at).over(w) == F.col(at) + 1, F.lead(v).over(w))
        v = F.col(v)
        return F.coalesce(before, 2 * v - after, v), F.coalesce(after, 2 * v - before, v)

    along, down = Window.partitionBy("item", "row").orderBy("col"), Window.partitionBy("item", "col").orderBy("row")
    left, right = sides("value", along, "col")
    one = cells.select("item", "row", "col", (right - left).alias("diff"), (left + 2 * F.col("value") + right).alias("sum"))
    (d0, d1), (s0, s1) = sides("diff", down, "row"), sides("sum", down, "row")
    slopes = one.select("item", "row", "col", ((d0 + 2 * F.col("diff") + d1) / 8).alias("p"), ((s1 - s0) / 8).alias("q"))
    az, alt = np.radians(360.0 - azimuth + 90.0), np.radians(altitude)
    steep = F.sqrt(F.col("p") * F.col("p") + F.col("q") * F.col("q") + 1)
    light = (float(np.sin(alt)) - F.col("p") * float(np.cos(alt) * np.cos(az)) + F.col("q") * float(np.cos(alt) * np.sin(az))) / steep
    return slopes.select("item", "row", "col", F.round(255 * F.greatest(light, F.lit(0.0)), 3).alias("shade"))


def sample_every_nth(points: DataFrame, target: int, chunk: str, order: list[str]) -> DataFrame:
    """Every n-th point of each chunk, n so that an item keeps about the target."""
    step = points.groupBy("item").agg(F.greatest(F.floor(F.count("*") / target), F.lit(1)).alias("step"))
    numbered = points.withColumn("rn", F.row_number().over(Window.partitionBy("item", F.expr(chunk)).orderBy(*order)))
    return numbered.join(step, "item").where("rn % step = 0").drop("rn", "step")


def sample_grid_thin(points: DataFrame, size: float) -> DataFrame:
    """One point of each cell of the size: the lowest."""
    at = [F.floor(F.col(c) / size).alias(f"g{c}") for c in "xy"]
    return points.groupBy("item", *at).agg(F.min(F.struct("z", "x", "y")).alias("p")).select("item", "p.*")
