"""Map projections as functions of columns: plane coordinates of a code to degrees on WGS 84.

A code's way there is a row of parameters: the ellipsoid, the transverse Mercator's meridian, scale and false origin,
and the seven numbers of its datum shift. The plane goes back to the ellipsoid by Krueger's series to the fourth order
(below a tenth of a millimetre within the zones), from there over space coordinates, shifted, rotated and scaled, to
the other ellipsoid. Codes without a row are not supported, and their results are null.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Semi-major axis and inverse flattening of ellipsoids.
ELLIPSOIDS = {"WGS84": (6378137.0, 298.257223563), "GRS80": (6378137.0, 298.257222101), "Bessel": (6377397.155, 299.1528128)}
# Datum shifts to WGS 84, in metres, arc seconds (position vector) and parts per million.
NONE, AUSTRIA, GERMANY = (0.0,) * 7, (577.326, 90.129, 463.919, 5.137, 1.474, 5.297, 2.4232), (598.1, 73.7, 418.2, 0.202, 0.045, -2.455, 6.7)
GEOGRAPHIC, MERCATOR, TRANSVERSE = "geographic", "mercator", "transverse"
FIELDS = "epsg int, kind string, a double, n double, e2 double, meridian double, scale double, east double, north double, tx double, ty double, tz double, rx double, ry double, rz double, ds double"


def _row(epsg: int, kind: str, ellipsoid: str, meridian: float = 0.0, scale: float = 1.0, east: float = 0.0, north: float = 0.0, shift: tuple[float, ...] = NONE) -> tuple:
    a, inverse = ELLIPSOIDS[ellipsoid]
    f = 1 / inverse
    second = math.pi / 180 / 3600
    return (epsg, kind, a, f / (2 - f), f * (2 - f), meridian, scale, east, north, *shift[:3], *(v * second for v in shift[3:6]), shift[6] * 1e-6)


def parameter_rows() -> list[tuple]:
    """A row for each supported code."""
    rows = [_row(4326, GEOGRAPHIC, "WGS84"), _row(4258, GEOGRAPHIC, "GRS80"), _row(3857, MERCATOR, "WGS84")]
    for zone in range(1, 61):
        rows += [_row(base + zone, TRANSVERSE, "WGS84", 6.0 * zone - 183, 0.9996, 500_000.0, north) for base, north in ((32600, 0.0), (32700, 10_000_000.0))]
    rows += [_row(25800 + zone, TRANSVERSE, "GRS80", 6.0 * zone - 183, 0.9996, 500_000.0) for zone in range(28, 39)]
    for k, meridian in enumerate((10 + 1 / 3, 13 + 1 / 3, 16 + 1 / 3)):  # the Austrian strips, plain and with false eastings
        rows.append(_row(31254 + k, TRANSVERSE, "Bessel", meridian, 1.0, 0.0, -5_000_000.0, AUSTRIA))
        rows.append(_row(31257 + k, TRANSVERSE, "Bessel", meridian, 1.0, 150_000.0 + 300_000.0 * k, -5_000_000.0, AUSTRIA))
    rows += [_row(31464 + zone, TRANSVERSE, "Bessel", 3.0 * zone, 1.0, 1_000_000.0 * zone + 500_000.0, 0.0, GERMANY) for zone in (2, 3, 4, 5)]
    return rows


def parameters(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(parameter_rows(), FIELDS)


def _series(n: Column, powers: list[list[float]]) -> list[Column]:
    """Polynomials in n; powers[j] holds the coefficients of n, n**2, n**3, n**4."""
    return [n * (c[0] + n * (c[1] + n * (c[2] + n * c[3]))) for c in powers]


# Coefficients of the inverse series and of the step from conformal to geodetic latitude.
BETA = [[1 / 2, -2 / 3, 37 / 96, -1 / 360], [0.0, 1 / 48, 1 / 15, -437 / 1440], [0.0, 0.0, 17 / 480, -37 / 840], [0.0, 0.0, 0.0, 4397 / 161280]]
DELTA = [[2.0, -2 / 3, -2.0, 116 / 45], [0.0, 7 / 3, -8 / 5, -227 / 45], [0.0, 0.0, 56 / 15, -136 / 35], [0.0, 0.0, 0.0, 4279 / 630]]


def plane_to_ellipsoid(points: DataFrame) -> DataFrame:
    """points (x, y and the parameters) + lat_, lon_ in radians on the code's own ellipsoid."""
    n, c = F.col("n"), F.col
    radius = c("scale") * c("a") / (1 + n) * (1 + n * n / 4 + n * n * n * n / 64)
    out = points.withColumns({"xi_": (c("y") - c("north")) / radius, "eta_": (c("x") - c("east")) / radius})
    beta = _series(n, BETA)
    xi, eta = c("xi_"), c("eta_")
    for j, b in enumerate(beta, 1):
        xi = xi - b * F.sin(2 * j * c("xi_")) * F.cosh(2 * j * c("eta_"))
        eta = eta - b * F.cos(2 * j * c("xi_")) * F.sinh(2 * j * c("eta_"))
    out = out.withColumns({"xi_2": xi, "eta_2": eta})
    out = out.withColumns({"chi_": F.asin(F.sin("xi_2") / F.cosh("eta_2")), "turn_": F.atan2(F.sinh("eta_2"), F.cos("xi_2"))})
    lat = c("chi_")
    for j, d in enumerate(_series(n, DELTA), 1):
        lat = lat + d * F.sin(2 * j * c("chi_"))
    kind, mercator = c("kind"), F.lit(MERCATOR)
    lat = F.when(kind == TRANSVERSE, lat).when(kind == mercator, 2 * F.atan(F.exp(c("y") / c("a"))) - math.pi / 2).when(kind == GEOGRAPHIC, F.radians("y"))
    lon = F.when(kind == TRANSVERSE, F.radians("meridian") + c("turn_")).when(kind == mercator, c("x") / c("a")).when(kind == GEOGRAPHIC, F.radians("x"))
    return out.withColumns({"lat_": lat, "lon_": lon}).drop("xi_", "eta_", "xi_2", "eta_2", "chi_", "turn_")


def shifted(points: DataFrame) -> DataFrame:
    """points with lat_, lon_ moved from the code's ellipsoid to WGS 84 by its seven parameters (height 0); no shift leaves them."""
    c = F.col
    a2, inverse = ELLIPSOIDS["WGS84"]
    e2 = (1 / inverse) * (2 - 1 / inverse)
    b2 = a2 * (1 - 1 / inverse)
    radius = c("a") / F.sqrt(1 - c("e2") * F.sin("lat_") * F.sin("lat_"))
    out = points.withColumns({"u_": radius * F.cos("lat_") * F.cos("lon_"), "v_": radius * F.cos("lat_") * F.sin("lon_"), "w_": radius * (1 - c("e2")) * F.sin("lat_")})
    u, v, w, grow = c("u_"), c("v_"), c("w_"), 1 + c("ds")
    out = out.withColumns({
        "u_2": c("tx") + grow * (u - c("rz") * v + c("ry") * w),
        "v_2": c("ty") + grow * (c("rz") * u + v - c("rx") * w),
        "w_2": c("tz") + grow * (-c("ry") * u + c("rx") * v + w),
    })
    out = out.withColumn("p_", F.sqrt(c("u_2") * c("u_2") + c("v_2") * c("v_2")))
    out = out.withColumn("t_", F.atan2(c("w_2") * a2, c("p_") * b2))
    lat = F.atan2(c("w_2") + e2 / (1 - e2) * b2 * F.pow(F.sin("t_"), 3), c("p_") - e2 * a2 * F.pow(F.cos("t_"), 3))
    moves = (c("tx") != 0) | (c("ty") != 0) | (c("tz") != 0)
    out = out.withColumns({"lat_2": F.when(moves, lat).otherwise(c("lat_")), "lon_2": F.when(moves, F.atan2("v_2", "u_2")).otherwise(c("lon_"))})
    return out.withColumns({"lat_": c("lat_2"), "lon_": c("lon_2")}).drop("u_", "v_", "w_", "u_2", "v_2", "w_2", "p_", "t_", "lat_2", "lon_2")


def to_degrees(points: DataFrame) -> DataFrame:
    """points (x, y, epsg) + lon, lat in degrees on WGS 84; null where the code is unknown or not supported."""
    table = F.broadcast(parameters(points.sparkSession))  # a fixed table of some hundred rows
    own = [c for c in points.columns]
    placed = shifted(plane_to_ellipsoid(points.join(table, "epsg", "left")))
    return placed.select(*own, F.degrees("lon_").alias("lon"), F.degrees("lat_").alias("lat"))
