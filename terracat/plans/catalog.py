"""The catalog queries, bound to the test tables, with their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terracat.operators import classify as C
from terracat.operators import profile as P
from terracat.operators import snapshot as S
from terracat.plans import views as V

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
TABLES = {"FILES": ["lineitem"], "CONTENT": ["documents"], "PREV": ["documents"], "POINTS": ["lineitem"], "ITEMS": ["orders", "customer", "nation"], "CELLS": ["embeddings"], "PATHS": ["pages"], "TREE": ["lineitem"], "CONFIG": ["lineitem"], "DIMS": ["part"]}


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A derived view as a DataFrame, over tables read from sf_dir; the tables are bound by name, not registered."""
    sql = (getattr(V, name, None) or getattr(V, f"{name}_SPARK")).replace("{", "{{").replace("}", "}}")
    args = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in TABLES[name]}
    for t in TABLES[name]:
        sql = _bind(sql, t)
    return spark.sql(sql, **args)


def _bind(sql: str, name: str) -> str:
    for word in ("from", "join"):
        sql = sql.replace(f"{word} {name}", f"{word} {{{name}}}")
    return sql


def add(key: str, source: str | tuple[str, ...], run: Callable[..., DataFrame], oracle: str | None = None) -> None:
    names = (source,) if isinstance(source, str) else source

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return run(*[view(spark, sf_dir, n) for n in names])

    QUERIES[key] = query
    if oracle:
        ctes = ", ".join(f"v_{n.lower()} as ({getattr(V, n, None) or getattr(V, f'{n}_DUCK')})" for n in names)
        ORACLES[key] = f"with {ctes}{', ' + _CHAINS if 'FILES' in names else ''} {oracle}"


_ROWS = ", ".join("({}, '{}', {}, {}, {})".format(i, p[0], *(f"{x}::varchar[]" for x in p[1:])) for i, p in enumerate(C.PATTERNS))
_LABELS = ", ".join(str(r) for r in C.CATEGORIES)
_CHAINS = f"""pats as (select * from (values {_ROWS}) t(ord, label, req, forb, exts)), labs as (select * from (values {_LABELS}) t(label, category, kind)),
 pe as (select ord, label, req, forb, unnest(exts) as pext from pats),
 cand as (select f.*, p.*, string_split(lower(name[:length(name) - length(pext)]), '_') as toks from v_files f join pe p on ends_with(lower(name), pext)),
 best as (select * from cand where list_has_all(toks, req) and not list_has_any(toks, forb) qualify row_number() over (partition by parent, name order by len(req) desc, length(pext) desc, ord) = 1),
 prods as (select parent, name, length, label, category, kind, array_to_string(list_filter(string_split(stem, '_'), lambda t: lower(t) <> 'cog'), '_') as item, pext as ext,
   list_contains(string_split(lower(stem), '_'), 'cog') as cog, case kind when 'pcl' then pext = '.copc.laz' else list_contains(string_split(lower(stem), '_'), 'cog') end as native
   from (select best.*, category, kind, name[:length(name) - length(pext)] as stem from best join labs on best.label = labs.label where category <> 'ignore')),
 twins as (select *, row_number() over w as rn, first_value(name) over w as winner from prods
   window w as (partition by parent, category, lower(item) order by native desc, cog desc, case ext when '.copc.laz' then 2 when '.laz' then 1 else 0 end desc, name)),
 grouped as (select *, case when count(*) over (partition by parent, category) > 1 and len(string_split(parent, '/')) > 2 then array_to_string(string_split(parent, '/')[3:], '_') end as grp from twins where rn = 1)"""


def _prods(f: DataFrame) -> DataFrame:
    return C.products(f, f.sparkSession)


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each campaign holds: products, bytes and categories."""
    won = C.tile_group_assign(C.twin_dedupe(_prods(view(spark, sf_dir, "FILES"))))
    return won.groupBy(F.regexp_extract("parent", C.DATE, 0).alias("campaign")).agg(F.count("*").alias("n_products"), F.sum("length").alias("bytes"), F.array_join(F.sort_array(F.collect_set("category")), ",").alias("categories"))


QUERIES["campaign_contents"] = flagship
ORACLES["campaign_contents"] = f"with v_files as ({V.FILES}), {_CHAINS} select regexp_extract(parent, '\\d{{4}}-\\d{{2}}-\\d{{2}}') as campaign, count(*) as n_products, cast(sum(length) as bigint) as bytes, array_to_string(list_sort(array_agg(distinct category)), ',') as categories from grouped group by 1"

add("match_longest_ext", "FILES", lambda f: C.match_longest_ext(f, C.pattern_table(f.sparkSession)).select("parent", "name", "ext"), "select parent, name, case when ends_with(lower(name), '.copc.laz') then '.copc.laz' when ends_with(lower(name), '.laz') then '.laz' when ends_with(lower(name), '.las') then '.las' when ends_with(lower(name), '.tif') then '.tif' end as ext from v_files")
add("name_tokens", "FILES", lambda f: C.name_tokens(C.match_longest_ext(f, C.pattern_table(f.sparkSession))).select("parent", "name", F.array_join("tokens", "|").alias("tokens")), "select parent, name, replace(lower(regexp_replace(name, '(\\.copc\\.laz|\\.laz|\\.las|\\.tif)$', '')), '_', '|') as tokens from v_files")
add("match_pattern", "FILES", lambda f: C.match_pattern(f, C.pattern_table(f.sparkSession)).select("parent", "name", "label"), "select f.parent, f.name, best.label from v_files f left join best on f.parent = best.parent and f.name = best.name")
add("match_label_join", "FILES", lambda f: C.match_label_join(C.match_pattern(f, C.pattern_table(f.sparkSession)), C.label_table(f.sparkSession)).select("parent", "name", "category"), "select f.parent, f.name, coalesce(category, 'unknown') as category from v_files f left join best on f.parent = best.parent and f.name = best.name left join labs on best.label = labs.label")
add("filter_ignore", "FILES", lambda f: _prods(f).select("parent", "name", "category"), "select parent, name, category from prods")
add("item_id", "FILES", lambda f: _prods(f).select("parent", "name", "item"), "select parent, name, item from prods")
add("qualify_id", "FILES", lambda f: _prods(f).select("parent", "name", C.qualify_id(F.col("item"), F.regexp_extract("parent", C.DATE, 0)).alias("qualified")), "select parent, name, case when regexp_matches(item, '\\d{4}-\\d{2}-\\d{2}') then item else regexp_extract(parent, '\\d{4}-\\d{2}-\\d{2}') || '_' || item end as qualified from prods")
add("point_encoding", "FILES", lambda f: _prods(f).where("kind = 'pcl'").select("parent", "name", C.point_encoding(F.col("ext")).alias("encoding")), "select parent, name, case ext when '.copc.laz' then 'copc' else ext[2:] end as encoding from prods where kind = 'pcl'")
add("twin_dedupe", "FILES", lambda f: C.twin_dedupe(_prods(f)).select("parent", "name", "category", "item"), "select parent, name, category, item from twins where rn = 1")
add("twin_superseded", "FILES", lambda f: C.twin_superseded(_prods(f)), "select parent, name, winner from twins where rn > 1")
add("twin_ext_mix", "FILES", lambda f: C.twin_ext_mix(_prods(f)), "select parent, category, lower(item) as item, count(distinct ext) filter (ext <> '.copc.laz') as n_ext from prods group by 1, 2, 3 having n_ext > 1")
add("tile_group_assign", "FILES", lambda f: C.tile_group_assign(C.twin_dedupe(_prods(f))).select("parent", "name", F.col("group").alias("grp")), "select parent, name, grp from grouped")
add("id_collision_local", "FILES", lambda f: C.id_collision_local(C.twin_dedupe(_prods(f))), "select regexp_extract(parent, '\\d{4}-\\d{2}-\\d{2}') as campaign, item, count(*) as n from grouped group by 1, 2 having n > 1")
add("file_fingerprint", "CONTENT", S.file_fingerprint, "select path, cast(strlen(content) as bigint) as size, '1220' || sha256(content) as checksum from v_content")
_diff = lambda a, b: S.join_snapshot_diff(S.file_fingerprint(a), S.file_fingerprint(b))
_DIFF = "select coalesce(a.path, b.path) as path, case when b.path is null then 'new' when a.path is null then 'stale' when a.content = b.content then 'same' else 'changed' end as status from v_content a full join v_prev b on a.path = b.path"
add("join_snapshot_diff", ("CONTENT", "PREV"), _diff, _DIFF)
add("set_stale_items", ("PREV", "CONTENT"), lambda a, b: S.set_stale_items(a, b), "select path from v_content where path not in (select path from v_prev)")
add("run_counts", ("CONTENT", "PREV"), lambda a, b: S.run_counts(_diff(a, b)), f"select split_part(path, '/', 2) as campaign, count(*) filter (status = 'new') as n_new, count(*) filter (status = 'changed') as n_changed, count(*) filter (status = 'same') as n_same, count(*) filter (status = 'stale') as n_stale from ({_DIFF}) group by 1")
add("band_stats", "CELLS", P.band_stats, "select item, round(min(value), 4) as vmin, round(max(value), 4) as vmax, round(avg(value), 4) as vmean, round(stddev_pop(value), 4) as vstd from v_cells where valid group by 1")
add("valid_percent", "CELLS", P.valid_percent, "select item, round(100.0 * count(*) filter (valid) / count(*), 4) as valid_percent, count(*) filter (valid) as valid_count from v_cells group by 1")
add("band_histogram", "CELLS", P.band_histogram, "select e.item, cast(b.bucket as int) as bucket, cast(count(c.value) as bigint) as n from (select item, min(value) - (max(value) - min(value)) / 31 / 2 as lo, max(value) + (max(value) - min(value)) / 31 / 2 as hi from v_cells where valid group by 1 having min(value) < max(value)) e cross join (select unnest(range(32)) as bucket) b left join (select * from v_cells where valid) c on c.item = e.item and least(greatest(floor((c.value - e.lo) / (e.hi - e.lo) * 32), 0), 31) = b.bucket group by 1, 2")
add("mask_majority_coarsen", "CELLS", P.mask_majority_coarsen, "select item, cast(row // 4 as bigint) as brow, cast(col // 4 as bigint) as bcol, count(*) filter (valid) >= 8 as valid from v_cells group by 1, 2, 3")
add("raster_avg_downsample", "CELLS", P.raster_avg_downsample, "select item, cast(row // 4 as bigint) as brow, cast(col // 4 as bigint) as bcol, round(avg(value), 4) as value from v_cells group by 1, 2, 3")
add("raster_valid_window", "CELLS", P.raster_valid_window, "select item, min(row) as row0, max(row) as row1, min(col) as col0, max(col) as col1 from v_cells where valid group by 1")
add("tile_raster_windows", "CELLS", P.tile_raster_windows, "select item, cast(col // 16 * 16 as bigint) as xoff, cast(row // 16 * 16 as bigint) as yoff, count(*) filter (valid) as n_valid, concat(item, '_', col // 16 * 16, '_', row // 16 * 16) as name from v_cells group by all having n_valid > 0")
add("point_stats", "POINTS", lambda p: P.point_stats(p, ["z", "price", "discount", "tax"]), "select item, dim, count(*) as n, min(value) as vmin, max(value) as vmax, round(avg(value), 4) as vmean, round(stddev_samp(value), 4) as vstd from (select item, unnest(['z', 'price', 'discount', 'tax']) as dim, unnest([z, price, discount, tax]) as value from v_points) group by 1, 2 having min(value) <> max(value)")
add("point_time_span", "POINTS", P.point_time_span, "select item, min(gps_time) as t0, max(gps_time) as t1 from v_points group by 1")
add("point_count_density", "POINTS", P.point_count_density, "select item, count(*) as n, round(count(*) / ((max(x) - min(x)) * (max(y) - min(y))), 6) as density from v_points group by 1")
_EXT = "(select item as i, min(x) as ox, min(y) as oy, greatest(max(x) - min(x), max(y) - min(y)) as span from v_points group by 1)"
add("cell_maxz_grid", "POINTS", P.cell_maxz_grid, f"select item, cast(least(floor((x - ox) / (span / 512)), 511) as bigint) as gx, cast(least(floor((y - oy) / (span / 512)), 511) as bigint) as gy, max(z) as z from v_points join {_EXT} on item = i group by 1, 2, 3")
add("occupancy_grid", "POINTS", P.occupancy_grid, f"select distinct item, cast(least(floor((x - ox) / greatest(span / 2048, 6.0)), 2047) as bigint) as gx, cast(least(floor((y - oy) / greatest(span / 2048, 6.0)), 2047) as bigint) as gy from v_points join {_EXT} on item = i")
_ORG = "(select min(x) - 0.0005 as ox, min(y) - 0.0005 as oy from v_points)"
add("tile_origin", "POINTS", P.tile_origin, f"select * from {_ORG}")
add("tile_assign_points", "POINTS", P.tile_assign_points, f"select cast(floor((x - ox) / 500) as bigint) as tile_col, cast(floor((y - oy) / 500) as bigint) as tile_row, count(*) as n from v_points cross join {_ORG} group by 1, 2")
add("tile_assign_buffer", "POINTS", P.tile_assign_buffer, f"select c as tile_col, r as tile_row, count(*) as n from (select c, unnest(range(cast(floor((y - 20 - oy) / 500) as bigint), cast(floor((y + 20 - oy) / 500) as bigint) + 1)) as r from (select y, oy, unnest(range(cast(floor((x - 20 - ox) / 500) as bigint), cast(floor((x + 20 - ox) / 500) as bigint) + 1)) as c from v_points cross join {_ORG})) group by 1, 2")
add("collection_extent", "ITEMS", S.collection_extent, "select collection, min(x0) as x0, min(y0) as y0, max(x1) as x1, max(y1) as y1, min(start) as t0, max(start) as t1, count(*) as n_items from v_items group by 1")
add("root_extent_union", "ITEMS", S.root_extent_union, "select min(x0) as x0, min(y0) as y0, max(x1) as x1, max(y1) as y1 from v_items")
add("collection_summary_sets", "ITEMS", lambda i: S.collection_summary_sets(i, "grp"), "select collection, array_to_string(list_sort(array_agg(distinct grp)), ',') as distinct_values from v_items group by 1")
add("collection_summary_ranges", "ITEMS", lambda i: S.collection_summary_ranges(i, "points"), "select collection, min(points) as vmin, max(points) as vmax from v_items group by 1")
add("summary_rollup", "ITEMS", lambda i: S.summary_rollup(i.withColumn("points", F.floor("points"))), "select collection, grp, cast(grouping(collection, grp) as int) as level, count(*) as n, cast(sum(floor(points)) as bigint) as points from v_items group by rollup(collection, grp)")
add("dir_own_stats", "PATHS", S.dir_own_stats, "select regexp_extract(path, '^(.*)/[^/]*$', 1) as dir, case when regexp_extract(regexp_extract(path, '([^/]*)$', 1), '(\\.[^.]+)$', 1) = '' then '(no ext)' else lower(regexp_extract(regexp_extract(path, '([^/]*)$', 1), '(\\.[^.]+)$', 1)) end as ext, count(*) as files, cast(sum(size) as bigint) as bytes from v_paths group by 1, 2")
add("dir_subtree_size", "PATHS", S.dir_subtree_size, "select array_to_string(p[1:k], '/') as dir, cast(sum(size) as bigint) as bytes, count(*) as files from (select string_split(path, '/') as p, size, unnest(range(1, len(string_split(path, '/')))) as k from v_paths) group by 1")
