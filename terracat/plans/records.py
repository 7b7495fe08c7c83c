"""Queries on records, grids and upkeep, bound to the test tables, with their SQL counterparts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terracat.functions import projections as J
from terracat.operators import classify as C
from terracat.operators import grids as G
from terracat.operators import profile as P
from terracat.operators import records as R
from terracat.operators import snapshot as S
from terracat.operators import upkeep as U
from terracat.plans import catalog as base
from terracat.plans.catalog import ORACLES, QUERIES, TABLES, _prods, add, view
from terracat.sources import folders

TABLES |= {"BANDS": ["part"], "SPANS": ["orders"], "ARRIVALS": ["events"]}
_CAMPAIGN = "regexp_extract(parent, '\\d{4}-\\d{2}-\\d{2}')"
def _campaign():
    return F.regexp_extract("parent", C.DATE, 0)


# Records
add("sink_href_rewrite", "PATHS", lambda p: p.select("path", R.relative_path(F.regexp_extract("path", "^(.*)/[^/]*$", 1), F.concat(F.split("path", "/")[0], F.lit("/thumbs/a.png"))).alias("href")), "select path, repeat('../', len(a) - n) || array_to_string(b[n + 1:], '/') as href from (select *, len(list_filter(range(1, least(len(a), len(b) - 1) + 1), lambda k: a[1:k] = b[1:k])) as n from (select path, string_split(regexp_extract(path, '^(.*)/[^/]*$', 1), '/') as a, string_split(split_part(path, '/', 1) || '/thumbs/a.png', '/') as b from v_paths))")
def _native():
    return R.cloud_native(F.col("kind"), F.col("ext"), F.when(F.lower("name").rlike("_cog[._]"), "COG"))


_NATIVE = "case when kind = 'pcl' then ext = '.copc.laz' else regexp_matches(lower(name), '_cog[._]') end"
_MEDIA = f"case label when 'pointcloud_copc' then 'application/vnd.laszip+copc' when 'pointcloud' then 'application/vnd.laszip' when 'pointcloud_las' then 'application/vnd.las' else case when {_NATIVE} then 'image/tiff; application=geotiff; profile=cloud-optimized' else 'image/tiff; application=geotiff' end end"
add("media_type_select", "FILES", lambda f: _prods(f).select("parent", "name", R.media_type(F.col("label"), _native()).alias("media")), f"select parent, name, {_MEDIA} as media from prods")
def _long():
    return F.concat_ws("_", "item", F.when(F.col("length") % 2 == 0, F.col("length").cast("string")))


add("item_title", "FILES", lambda f: C.tile_group_assign(C.twin_dedupe(_prods(f))).select("parent", "name", R.item_title(F.col("group"), _long(), F.col("category"), F.col("label"), _campaign()).alias("title")), f"select parent, name, case when grp is not null and length % 2 = 0 and regexp_matches(item, '_\\d+$') then category || ' tile ' || regexp_extract(item, '_(\\d+)$', 1) || '_' || length else replace(label, '_', ' ') || ' ' || {_CAMPAIGN} end as title from grouped")
add("group_title", "FILES", lambda f: U.group_title(C.tile_group_assign(C.twin_dedupe(_prods(f))).where("group is not null")), "select grp as \"group\", case when count(distinct category) = 1 then min(category) || ' tiles' else grp end as title from grouped where grp is not null group by 1")
add("band_name", "BANDS", lambda b: R.band_name(b).select("item", "band", "name", "common_name"), "select item, band, coalesce(description, case when color <> 'undefined' and not (color = 'gray' and n = 1) then color end, case when n > 1 then 'band' || band end) as name, case when color in ('red', 'green', 'blue', 'nir') then color end as common_name from (select *, count(*) over (partition by item) as n from v_bands)")
add("json_safe_numbers", "BANDS", lambda b: b.select("item", "band", R.finite(F.col("nodata")).alias("number"), R.nodata_text(F.col("nodata")).alias("nodata")), "select item, band, case when isfinite(nodata) then round(nodata, 4) end as number, case when isnan(nodata) then 'nan' when nodata = 'Infinity'::double then 'inf' when nodata = '-Infinity'::double then '-inf' else cast(round(nodata, 4) as varchar) end as nodata from v_bands")
add("band_hoist_shared", "BANDS", lambda b: R.band_hoist_shared(b, ["data_type", "color"]), "select item, key, min(value) as value from (select item, unnest(['data_type', 'color']) as key, unnest([data_type, color]) as value, count(*) over (partition by item) as n from v_bands) group by 1, 2 having count(distinct value) = 1")
def _keys():
    return F.array(F.lit("proj:code"), F.when(F.col("points") > 1e5, "pc:count"), F.when(F.col("x0") > 50, "file:size"), F.when(F.col("y0") > 500, "eo:common_name"), F.lit("title"))


add("extension_declare", "ITEMS", lambda i: i.select("item", F.array_join(R.extension_declare(F.filter(_keys(), lambda k: k.isNotNull())), " ").alias("uris")), "select item, concat_ws(' ', case when y0 > 500 then 'https://stac-extensions.github.io/eo/v2.0.0/schema.json' end, case when x0 > 50 then 'https://stac-extensions.github.io/file/v2.1.0/schema.json' end, case when points > 100000 then 'https://stac-extensions.github.io/pointcloud/v2.0.0/schema.json' end, 'https://stac-extensions.github.io/projection/v2.0.0/schema.json') as uris from v_items")
add("native_bbox", "ITEMS", lambda i: R.native_bbox(i.selectExpr("item", "x0 as gt0", "25e0 as gt1", "3e0 as gt2", "y0 as gt3", "-2e0 as gt4", "-25e0 as gt5", "x1 as width", "y1 as height")).select("item", "xmin", "ymin", "xmax", "ymax"), "select item, x0 as xmin, x0 + 25 * x1 + 3 * y1 as xmax, y0 - 2 * x1 - 25 * y1 as ymin, y0 as ymax from v_items")
_BOXES = """select item, cast(case item % 5 when 0 then 31256 when 1 then 3857 when 2 then 25833 when 3 then 31467 else 31287 end as int) as epsg,
  case item % 5 when 0 then x0 * 50 - 60000 when 1 then x0 * 1000 when 2 then 450000 + x0 * 100 else 3480000 + x0 * 50 end as x0,
  case item % 5 when 0 then 330000 + y0 * 20 when 1 then y0 * 1000 when 2 then 5300000 + y0 * 100 else 5400000 + y0 * 50 end as y0, x1 - x0 as w, y1 - y0 as h
  from (select cast(item as bigint) as item, x0, y0, x1, y1 from {items})"""


def _boxes(items: DataFrame) -> DataFrame:
    """Boxes in the planes of five codes, one of them not supported."""
    return items.sparkSession.sql(_BOXES, items=items).selectExpr("cast(item as string) as item", "epsg", "x0", "y0", "x0 + w * 200 as x1", "y0 + h * 300 as y1")


def _projected_sql() -> str:
    """The same way in SQL: parameters by code, the series back to the ellipsoid, the shift, the other ellipsoid."""
    codes = (31256, 3857, 25833, 31467)
    real = lambda v: f"{v:.17e}"  # a double, not a decimal
    rows = ", ".join(f"({r[0]}, '{r[1]}', {', '.join(map(real, r[2:]))})" for r in J.parameter_rows() if r[0] in codes)
    poly = lambda c: f"(n * ({real(c[0])} + n * ({real(c[1])} + n * ({real(c[2])} + n * {real(c[3])}))))"
    xi = "xi" + "".join(f" - {poly(c)} * sin({2 * j} * xi) * cosh({2 * j} * eta)" for j, c in enumerate(J.BETA, 1))
    eta = "eta" + "".join(f" - {poly(c)} * cos({2 * j} * xi) * sinh({2 * j} * eta)" for j, c in enumerate(J.BETA, 1))
    lat = "chi" + "".join(f" + {poly(c)} * sin({2 * j} * chi)" for j, c in enumerate(J.DELTA, 1))
    a2, inverse = J.ELLIPSOIDS["WGS84"]
    e2, b2 = (1 / inverse) * (2 - 1 / inverse), a2 * (1 - 1 / inverse)
    return f"""par(epsg, kind, a, n, e2, meridian, scale, east, north, tx, ty, tz, rx, ry, rz, ds) as (select * from (values {rows})),
      boxes as ({_BOXES.format(items='v_items')}),
      pts as (select b.item, b.epsg, x0 + w * 200 * u as x, y0 + h * 300 * v as y from boxes b, (select case e when 0 then t when 1 then t when 2 then 0e0 else 1e0 end as u, case e when 0 then 0e0 when 1 then 1e0 else t end as v
        from (select unnest(range(22)) / 21e0 as t), (select unnest(range(4)) as e))),
      p1 as materialized (select *, (y - north) / r as xi, (x - east) / r as eta from (select *, scale * a / (1 + n) * (1 + n * n / 4 + n * n * n * n / 64) as r from pts left join par using (epsg))),
      p2 as materialized (select *, {xi} as xi2, {eta} as eta2 from p1),
      p3 as materialized (select *, asin(sin(xi2) / cosh(eta2)) as chi, atan2(sinh(eta2), cos(xi2)) as turn from p2),
      p4 as materialized (select *, case kind when 'transverse' then {lat} when 'mercator' then 2 * atan(exp(y / a)) - pi() / 2 end as la, case kind when 'transverse' then radians(meridian) + turn when 'mercator' then x / a end as lo from p3),
      p5 as materialized (select *, rr * cos(la) * cos(lo) as u, rr * cos(la) * sin(lo) as v, rr * (1 - e2) * sin(la) as w from (select *, a / sqrt(1 - e2 * sin(la) * sin(la)) as rr from p4)),
      p6 as materialized (select *, tx + (1 + ds) * (u - rz * v + ry * w) as u2, ty + (1 + ds) * (rz * u + v - rx * w) as v2, tz + (1 + ds) * (-ry * u + rx * v + w) as w2 from p5),
      p7 as materialized (select *, sqrt(u2 * u2 + v2 * v2) as p, atan2(w2 * {real(a2)}, sqrt(u2 * u2 + v2 * v2) * {real(b2)}) as th from p6),
      p8 as materialized (select item, degrees(case when tx <> 0 then atan2(w2 + {real(e2 / (1 - e2) * b2)} * pow(sin(th), 3), p - {real(e2 * a2)} * pow(cos(th), 3)) else la end) as lat, degrees(case when tx <> 0 then atan2(v2, u2) else lo end) as lon from p7)"""


add(
    "reproject_bbox",
    "ITEMS",
    lambda i: R.reproject_bbox(_boxes(i)),
    f"select * from (with {_projected_sql()} select cast(item as varchar) as item, round(min(lon), 6) as west, round(min(lat), 6) as south, round(max(lon), 6) as east, round(max(lat), 6) as north, case when min(lon) is null then 'unsupported CRS' end as error from p8 group by 1)",
)
add("crs_fallback", "ITEMS", lambda i: R.crs_fallback(i.select("item", F.when(F.col("x0") % 3 != 0, "EPSG:31256").alias("own_crs"), F.when(F.col("collection") != "NATION_7", "EPSG:3857").alias("fallback"))).select("item", "crs", "failed"), "select item, crs, crs is null as failed from (select item, case when x0 % 3 <> 0 then 'EPSG:31256' when collection <> 'NATION_7' then 'EPSG:3857' end as crs from v_items)")
add("round_coords", "ITEMS", lambda i: i.select("item", R.round_coords(F.array(F.array(F.col("x0") / 3, F.col("y0") / 7), F.array(F.col("x1") / 3, F.col("y1") / 7))).alias("r")).selectExpr("item", "r[0][0] as a", "r[0][1] as b", "r[1][0] as c", "r[1][1] as d"), "select item, round(x0 / 3, 7) as a, round(y0 / 7, 7) as b, round(x1 / 3, 7) as c, round(y1 / 7, 7) as d from v_items")
_SPAN = """select item, case when ok then s end as start_us, case when ok then e end as end_us from (select *, coalesce(abs(s // 86400000000 - (campaign - date '1970-01-01')) <= 14 and abs(e // 86400000000 - (campaign - date '1970-01-01')) <= 14, false) as ok from (select *, cast(round((o + gps_min) * 1e6) as bigint) as s, cast(round((o + b) * 1e6) as bigint) as e from (select *, case when gps_max > 604800 then 1315964800 else ((a - date '1970-01-01') - case when b >= 86400 then dayofweek(a) else 0 end) * 86400 end as o
 from (select *, coalesce(anchor, campaign) as a, case when gps_max <= 604800 and gps_max < gps_min then gps_max + 604800 else gps_max end as b from v_spans where gps_min >= 0 and gps_min <> gps_max)))) where ok"""
add("anchor_date", "FILES", lambda f: _prods(f).select("parent", "name", R.anchor_date(F.col("item"), F.to_date(_campaign())).cast("string").alias("anchor")), f"select parent, name, cast(case when abs(own - c) <= 14 then own else c end as varchar) as anchor from (select parent, name, try_cast(regexp_extract(item, '\\d{{4}}-\\d{{2}}-\\d{{2}}') as date) as own, cast({_CAMPAIGN} as date) as c from prods)")
_map = lambda *kv: F.create_map(*[x for k, v in kv for x in (F.lit(k), v)])
def _none():
    return F.lit(None).cast("string")


def _overlay():
    return R.properties_overlay(_map(("a", F.col("grp")), ("b", F.col("collection"))), F.when(F.col("x0") % 2 == 0, _map(("b", F.lit("L")), ("c", F.lit("C")))), F.when(F.col("y0") % 3 == 0, _map(("a", _none()), ("c", F.lit("I")))))


_props = lambda m: F.array_join(F.transform(F.array_sort(F.map_entries(m)), lambda e: F.concat_ws("=", e["key"], e["value"])), ";")
add("properties_overlay", "ITEMS", lambda i: i.select("item", _props(_overlay()).alias("props")), "select item, concat_ws(';', case when y0 % 3 <> 0 then 'a=' || grp end, 'b=' || case when x0 % 2 = 0 then 'L' else collection end, case when y0 % 3 = 0 then 'c=I' when x0 % 2 = 0 then 'c=C' end) as props from v_items")


add("ext_new_product_types", "FILES", lambda f: C.match_pattern(f, C.pattern_table(f.sparkSession).unionByName(f.sparkSession.createDataFrame([(99, "report", [], [], [".txt"])], "ord int, label string, require array<string>, forbid array<string>, extensions array<string>"))).where("label = 'report'").select("parent", "name"), "select parent, name from v_files where ends_with(lower(name), '.txt')")
# Placement keys of a campaign, as its settings give them.
KEYS = [(0, "*_DTM_1?", "terrain"), (1, "*dsm*", "surface"), (2, "*_1*", "ones"), (3, "zzz*", "never"), (4, "p_dtm_5", "five"), (5, "p_dtm_15", None), (6, "p_none", "none")]


def _placement(f: DataFrame) -> DataFrame:
    return f.sparkSession.createDataFrame([(o, k, R.glob_regex(k), g) for o, k, g in KEYS], "ord int, key string, regex string, group string")


_ids = lambda f: _prods(f).select("item", F.lit("auto").alias("auto")).distinct()
_PLACE = "case when item = 'p_dtm_5' then 'five' when item = 'p_dtm_15' then null when regexp_matches(lower(item), '^.*_dtm_1.$') then 'terrain' when contains(lower(item), 'dsm') then 'surface' when contains(item, '_1') then 'ones' else 'auto' end"
add("join_placement", "FILES", lambda f: R.join_placement(_ids(f), _placement(f)), f"select distinct item, {_PLACE} as placed from prods")
_MET = "(select distinct item, regexp_matches(lower(item), '^.*_dtm_1.$') as a, contains(lower(item), 'dsm') as b, contains(item, '_1') as c from prods)"
add("overlap_patterns", "FILES", lambda f: R.overlap_patterns(_ids(f), _placement(f)), f"select concat_ws(' ', case when c then '*_1*' end, case when a then '*_DTM_1?' end, case when b then '*dsm*' end) as keys, count(*) as n_items from {_MET} where a::int + b::int + c::int > 1 group by 1")
add("anti_unused_keys", "FILES", lambda f: R.anti_unused_keys(_ids(f), _placement(f)), f"select key from (values ('*_DTM_1?'), ('*dsm*'), ('*_1*'), ('zzz*'), ('p_dtm_5'), ('p_dtm_15'), ('p_none')) t(key) where not case key when '*_DTM_1?' then (select bool_or(a) from {_MET}) when '*dsm*' then (select bool_or(b) from {_MET}) when '*_1*' then (select bool_or(c) from {_MET}) else key in (select item from prods) end")
_recorded = lambda c: P.band_stats(c).select("item", (F.col("vmax") * (1 + F.col("item") * 4e-5)).alias("recorded"))
add("join_recorded_vs_actual", "CELLS", lambda c: R.join_recorded_vs_actual(_recorded(c), P.band_stats(c).select("item", F.col("vmax").alias("actual")), ["item"]).select("item", "agrees"), "select item, abs(m * (1 + item * 4e-5) - m) <= greatest(1e-4 * abs(m * (1 + item * 4e-5)), 5e-5) as agrees from (select item, round(max(value), 4) as m from v_cells where valid group by 1)")
add("flag_bits_compose", "POINTS", lambda p: p.groupBy("item", R.flag_bits_compose([F.col("x").cast("long") % k == 0 for k in (2, 3, 5, 7)]).alias("flags")).agg(F.count("*").alias("n")), "select item, cast((x % 2 = 0)::int + 2 * (x % 3 = 0)::int + 4 * (x % 5 = 0)::int + 8 * (x % 7 = 0)::int as int) as flags, count(*) as n from v_points group by 1, 2")

# Grids
_bands = "select item, row, cast(floor(col / 2) as bigint) as col, cast(col % 2 as int) as band, value from"
add("band_stats_alpha", "CELLS", lambda c: G.band_stats_alpha(c.selectExpr("item", "row", "cast(floor(col / 2) as bigint) as col", "cast(col % 2 as int) as band", "value"), 1), f"select b.item, b.band, round(min(b.value), 4) as vmin, round(max(b.value), 4) as vmax, round(avg(b.value), 4) as vmean, round(stddev_pop(b.value), 4) as vstd from ({_bands} v_cells) b join ({_bands} v_cells) a on a.item = b.item and a.row = b.row and a.col = b.col and a.band = 1 where b.band = 1 or a.value > 0 group by 1, 2")
add("cell_maxz_union", "POINTS", G.cell_maxz_union, "select cast(least(floor((x - ox) / (span / 512)), 511) as bigint) as gx, cast(least(floor((y - oy) / (span / 512)), 511) as bigint) as gy, max(z) as z from v_points cross join (select min(x) as ox, min(y) as oy, greatest(max(x) - min(x), max(y) - min(y)) as span from v_points) group by 1, 2")
_GRID = "select item, cast(least(floor((x - ox) / (span / 64)), 63) as bigint) as gx, cast(least(floor((y - oy) / (span / 64)), 63) as bigint) as gy, max(z) as z from v_points join (select item as i, min(x) as ox, min(y) as oy, greatest(max(x) - min(x), max(y) - min(y)) as span from v_points group by 1) on item = i group by 1, 2, 3"
add("grid_fill_small_gaps", "POINTS", lambda p: G.grid_fill_small_gaps(P.cell_maxz_grid(p, 64), 64), f"select item, tx as gx, ty as gy, arg_min(z, struct_pack(d := dx * dx + dy * dy, y := gy, x := gx)) as z from (select *, gx + dx as tx, gy + dy as ty from ({_GRID}) cross join (select unnest(range(-2, 3)) as dx) cross join (select unnest(range(-2, 3)) as dy) where dx * dx + dy * dy <= 4) where tx between 0 and 63 and ty between 0 and 63 group by 1, 2, 3")
add("grid_percentile_clip", "POINTS", lambda p: G.grid_percentile_clip(P.cell_maxz_grid(p, 64)), f"select item, round(quantile_cont(z, 0.1), 4) as p10, round(quantile_cont(z, 0.9), 4) as p90 from ({_GRID}) group by 1")
_SHADE = """with recursive c as (select cast(floor(row / 64) as bigint) as item, row, col, value from v_cells), h as (select item, row, col, coalesce(r, 2 * value - l, value) - coalesce(l, 2 * value - r, value) as d, coalesce(l, 2 * value - r, value) + 2 * value + coalesce(r, 2 * value - l, value) as s from (select a.*, l.value as l, r.value as r from c a left join c l on l.row = a.row and l.col = a.col - 1 left join c r on r.row = a.row and r.col = a.col + 1)),
 v as (select a.item, a.row, a.col, coalesce(u.d, 2 * a.d - w.d, a.d) + 2 * a.d + coalesce(w.d, 2 * a.d - u.d, a.d) as p, coalesce(w.s, 2 * a.s - u.s, a.s) - coalesce(u.s, 2 * a.s - w.s, a.s) as q from h a left join h u on u.item = a.item and u.col = a.col and u.row = a.row - 1 left join h w on w.item = a.item and w.col = a.col and w.row = a.row + 1)
 select item, row, col, round(255 * greatest((sqrt(0.5) - p / 8 * sqrt(0.5) * cos(radians(135)) + q / 8 * sqrt(0.5) * sin(radians(135))) / sqrt(p / 8 * (p / 8) + q / 8 * (q / 8) + 1), 0), 3) as shade from v"""
add("raster_hillshade", "CELLS", lambda c: G.raster_hillshade(c.withColumn("item", F.floor(F.col("row") / 64))), f"select * from ({_SHADE})")
add("sample_every_nth", "POINTS", lambda p: G.sample_every_nth(p, 500, "cast(floor(gps_time / 1000) as bigint)", ["gps_time", "x", "y", "z", "price"]).select("item", "x", "y", "z"), "select item, x, y, z from (select *, greatest(count(*) over (partition by item) // 500, 1) as step, row_number() over (partition by item, floor(gps_time / 1000) order by gps_time, x, y, z, price) as rn from v_points) where rn % step = 0")
add("sample_grid_thin", "POINTS", lambda p: G.sample_grid_thin(p, 25.0), "select item, m.z as z, m.x as x, m.y as y from (select item, min(struct_pack(z := z, x := x, y := y)) as m from v_points group by item, floor(x / 25), floor(y / 25))")
# Upkeep
_print = S.file_fingerprint
_group = lambda d: _print(d).withColumn("group", F.regexp_extract("path", "^(.*)/[^/]*$", 1))
add("sink_orphan_files", ("PREV", "CONTENT"), lambda a, b: U.orphan_files(b, a), "select path from v_content except select path from v_prev")
add("set_member_change", ("CONTENT", "PREV"), lambda a, b: U.set_member_change(_group(a), _group(b)), "select regexp_extract(coalesce(a.path, b.path), '^(.*)/[^/]*$', 1) as \"group\", bool_or(a.content is distinct from b.content or a.path is null or b.path is null) as changed from v_content a full join v_prev b on a.path = b.path group by 1")
add("set_extent_children", "ITEMS", U.set_extent_children, "select collection, min(x0) as x0, min(y0) as y0, max(x1) as x1, max(y1) as y1, min(start) as t0, max(start) as t1, count(*) as n_items from (select * from v_items union all select * replace (collection || '/' || grp as collection) from v_items) group by 1")
_stamped = lambda b: _print(b).withColumns({"created": F.lit("2020-01-01").cast("date"), "updated": F.lit("2021-01-01").cast("date")})
add("provenance_stamp", ("CONTENT", "PREV"), lambda a, b: U.provenance_stamp(_print(a), _stamped(b), "2025-06-01").select("path", F.col("created").cast("string").alias("created"), F.col("updated").cast("string").alias("updated")), "select a.path, case when b.path is null then '2025-06-01' else '2020-01-01' end as created, case when b.path is not null and a.content is not distinct from b.content then '2021-01-01' else '2025-06-01' end as updated from v_content a left join v_prev b on a.path = b.path")
def _moments():
    return U.restate_masked_moments(F.col("vmean"), F.col("vstd"), F.col("valid_percent") / 100)


add("restate_masked_moments", "CELLS", lambda c: P.band_stats(c).join(P.valid_percent(c), "item").select("item", F.round(_moments()[0], 3).alias("mean"), F.round(_moments()[1], 3).alias("sd")), "select item, round(m / p, 3) as mean, round(sqrt(greatest((s * s + m * m) / p - m / p * (m / p), 0)), 3) as sd from (select item, round(avg(value) filter (valid), 4) as m, round(stddev_pop(value) filter (valid), 4) as s, round(100.0 * count(*) filter (valid) / count(*), 4) / 100 as p from v_cells group by 1)")
_tiles = lambda p: P.tile_assign_points(p, 25.0)
_TILES = "select cast(floor((x - ox) / 25) as bigint) as tile_col, cast(floor((y - oy) / 25) as bigint) as tile_row, count(*) as n from v_points cross join (select min(x) - 0.0005 as ox, min(y) - 0.0005 as oy from v_points) group by 1, 2"
add("skip_existing_outputs", "POINTS", lambda p: U.skip_existing_outputs(_tiles(p), _tiles(p).where("n % 2 = 0"), ["tile_col", "tile_row"]), f"select * from ({_TILES}) where n % 2 = 1")
add("tile_runt_merge", "POINTS", lambda p: U.tile_runt_merge(_tiles(p).selectExpr("'all' as dataset", "format_string('t_%03d_%03d', tile_col, tile_row) as name", "n as size", "tile_col as col", "tile_row as row"), 50))
_OWN = ORACLES["dir_own_stats"].replace("with ", "", 1)
_dirs = lambda p: S.dir_own_stats(p)
add("dir_ext_share", "PATHS", lambda p: U.dir_ext_share(_dirs(p)), f"select dir, string_agg(ext || ' ' || case when files * 100 < t then '<1%' else cast(round(files * 100.0 / t) as int) || '%' end, ', ' order by files desc, ext) as shares from (select *, sum(files) over (partition by dir) as t from (with {_OWN})) group by 1")
_SUB = ORACLES["dir_subtree_size"].replace("with ", "", 1)
add("dir_depth_prune", "PATHS", lambda p: S.dir_depth_prune(S.dir_subtree_size(p), 2), f"select * from (with {_SUB}) where len(string_split(dir, '/')) <= 2")
def _name():
    return F.regexp_extract("path", "([^/]*)$", 1)


def _parent():
    return F.regexp_extract("path", "^(.*)/[^/]*$", 1)


_NAMES = "(select regexp_extract(path, '^(.*)/[^/]*$', 1) as dir, regexp_extract(path, '([^/]*)$', 1) as name from v_paths)"
add("max_listed", "PATHS", lambda p: U.max_listed(p.select(_parent().alias("dir"), _name().alias("name"))), f"select dir, string_agg(name, ', ' order by name) filter (rn <= 3) || case when count(*) > 3 then ' (' || (count(*) - 3) || ' more)' else '' end as listed from (select *, row_number() over (partition by dir order by name) as rn from {_NAMES}) group by 1")


# Folders and streams
def _tile_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = view(spark, sf_dir, "POINTS").withColumn("tile_col", F.floor(F.col("x") / 50)).withColumn("tile_row", F.floor(F.col("y") / 5))
    return folders.tile_partitions(points).groupBy("tile_col", "tile_row").agg(F.count("*").alias("n"), F.max("z").alias("top"))


QUERIES |= {"sink_tile_partitions": _tile_files}
ORACLES |= {
    "sink_tile_partitions": f"with v_points as ({base.V.POINTS}) select cast(floor(x / 50) as bigint) as tile_col, cast(floor(y / 5) as bigint) as tile_row, count(*) as n, max(z) as top from v_points group by 1, 2",
}
