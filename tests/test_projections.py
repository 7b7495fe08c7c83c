"""Plane coordinates to degrees, against known values and a way forward by other formulas."""

import math

import pytest

from terracat.functions import projections as J
from terracat.operators import records as R


def meridian_arc(a, e2, lat, steps=4000):
    """Simpson's rule over the meridian's radius of curvature."""
    f = lambda p: a * (1 - e2) / (1 - e2 * math.sin(p) ** 2) ** 1.5
    h = lat / steps
    return h / 3 * sum((1 if k in (0, steps) else 4 if k % 2 else 2) * f(k * h) for k in range(steps + 1))


def forward(row, lon, lat):
    """Degrees on WGS 84 to the plane: the shift undone step by step, then the classic series in the longitude's powers."""
    _, _, a, n, e2, meridian, scale, east, north, *shift = row
    aw, inverse = J.ELLIPSOIDS["WGS84"]
    ew = (1 / inverse) * (2 - 1 / inverse)
    lo, la = math.radians(lon), math.radians(lat)
    height = 0.0
    if any(shift):  # the height on WGS 84 that lies on the other ellipsoid is found by trying
        for _ in range(6):
            r = aw / math.sqrt(1 - ew * math.sin(la) ** 2)
            x = [(r + height) * math.cos(la) * math.cos(lo), (r + height) * math.cos(la) * math.sin(lo), (r * (1 - ew) + height) * math.sin(la)]
            t, (rx, ry, rz), m = shift[:3], shift[3:6], 1 + shift[6]
            d = [(p - q) / m for p, q in zip(x, t, strict=True)]
            own = d
            for _ in range(8):  # own + rotation(own) = d
                own = [d[0] + rz * own[1] - ry * own[2], d[1] - rz * own[0] + rx * own[2], d[2] + ry * own[0] - rx * own[1]]
            p, phi = math.hypot(own[0], own[1]), math.atan2(own[2], math.hypot(own[0], own[1]))
            for _ in range(20):
                rr = a / math.sqrt(1 - e2 * math.sin(phi) ** 2)
                phi = math.atan2(own[2] + e2 * rr * math.sin(phi), p)
            above = p * math.cos(phi) + own[2] * math.sin(phi) - a * math.sqrt(1 - e2 * math.sin(phi) ** 2)
            height -= above
        la_own, lo_own = phi, math.atan2(own[1], own[0])
    else:
        la_own, lo_own = la, lo
    r = a / math.sqrt(1 - e2 * math.sin(la_own) ** 2)
    t, c, k = math.tan(la_own) ** 2, e2 / (1 - e2) * math.cos(la_own) ** 2, (lo_own - math.radians(meridian)) * math.cos(la_own)
    ep = e2 / (1 - e2)
    x = r * (k + (1 - t + c) * k**3 / 6 + (5 - 18 * t + t * t + 72 * c - 58 * ep) * k**5 / 120)
    y = meridian_arc(a, e2, la_own) + r * math.tan(la_own) * (k**2 / 2 + (5 - t + 9 * c + 4 * c * c) * k**4 / 24 + (61 - 58 * t + t * t + 600 * c - 330 * ep) * k**6 / 720)
    return east + scale * x, north + scale * y


ROWS = {r[0]: r for r in J.parameter_rows()}


@pytest.mark.parametrize(("epsg", "lon", "lat"), [(31256, 16.37, 48.21), (31256, 15.65, 48.19), (31254, 10.2, 47.1), (31259, 16.0, 47.0), (31467, 9.4, 48.7), (25833, 14.2, 50.3), (32633, 15.0, 0.0), (32733, 16.1, -20.5)])
def test_there_and_back(spark, epsg, lon, lat):
    x, y = forward(ROWS[epsg], lon, lat)
    r = J.to_degrees(spark.createDataFrame([(x, y, epsg)], "x double, y double, epsg int")).first()
    assert abs(r.lon - lon) < 1e-7 and abs(r.lat - lat) < 1e-7


def test_known_values(spark):
    """Quarter and half of the meridian, the zone's meridian, and the shift of an Austrian point, as published or by hand."""
    quarter, half = 10_001_965.729, 4_984_944.378
    points = [(500_000.0, half * 0.9996, 32633), (500_000.0, 10_000_000.0 - half * 0.9996, 32701), (20037508.342789244, 0.0, 3857), (12.5, 47.5, 4326)]
    got = [(round(r.lon, 7), round(r.lat, 7)) for r in J.to_degrees(spark.createDataFrame(points, "x double, y double, epsg int")).collect()]
    assert got == [(15.0, 45.0), (-177.0, -45.0), (180.0, 0.0), (12.5, 47.5)]
    assert abs(meridian_arc(6378137.0, 0.0066943799901413165, math.pi / 2) - quarter) < 0.002


def test_boxes(spark):
    """The grid of 4 x 4 cells of 25 m at (-53000, 340000), and codes that nobody knows."""
    rows = [("grid", 31256, -53000.0, 339900.0, -52900.0, 340000.0), ("other", 31287, 0.0, 0.0, 1.0, 1.0), ("none", None, 0.0, 0.0, 1.0, 1.0)]
    got = {r["item"]: r for r in R.reproject_bbox(spark.createDataFrame(rows, "item string, epsg int, x0 double, y0 double, x1 double, y1 double")).collect()}
    r = got["grid"]
    assert 15.6 < r.west < r.east < 15.7 and 48.1 < r.south < r.north < 48.3 and r.error is None
    for lon, lat in ((r.west, r.south), (r.east, r.north)):
        x, y = forward(ROWS[31256], lon, lat)
        assert -53003 < x < -52897 and 339897 < y < 340003
    assert [got[k].error for k in ("other", "none")] == ["unsupported CRS"] * 2 and got["other"].west is None
