"""Queries on what belongs to a run, on settings, headers, schemas and collection rows, with their SQL counterparts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from terracat.operators import classify as C
from terracat.operators import collections as K
from terracat.operators import discovery as D
from terracat.operators import links as L
from terracat.operators import profile as P
from terracat.operators import records as R
from terracat.operators import snapshot as S
from terracat.operators import upkeep as U
from terracat.plans.catalog import ORACLES, QUERIES, add, view
from terracat.plans.records import _SPAN, _campaign
from terracat.plans.views import DIMS, ITEMS
from terracat.sources import folders, headers
from terracat.sources import items as store

DATE = r"regexp_extract(parent, '\d{4}-\d{2}-\d{2}')"

# Campaigns and files
add(
    "scan_campaigns",
    "FILES",
    lambda f: D.campaigns(f.select(F.split("parent", "/")[1].alias("dir")).distinct(), output="1993-01-01").select("dir", F.col("date").cast("string").alias("date")),
    "select distinct string_split(parent, '/')[2] as dir, string_split(parent, '/')[2] as date from v_files where string_split(parent, '/')[2] <> '1993-01-01'",
)
add(
    "filter_exclude_globs",
    "FILES",
    lambda f: D.exclude_globs(f, ["*_MASKED_1*", "p_dtm_?.tif"]).select("parent", "name"),
    "select parent, name from v_files where not regexp_matches(lower(name), '_masked_1') and not regexp_matches(lower(name), '^p_dtm_.\\.tif$')",
)
add(
    "filter_config_self",
    "TREE",
    lambda t: D.candidates(t).select("parent", "name"),
    "select parent, name from v_tree where lower(name) <> 'campaign.yaml' and not ends_with(lower(name), '.prj') and not ends_with(lower(name), '.aux.xml') and not ends_with(lower(name), '.tfw')",
)
add(
    "filter_unknown_policy",
    ("TREE", "FILES"),
    lambda t, f: D.unknown_files(t),
    "select f.parent, f.name, 'no registry match' as reason from v_files f anti join best on f.parent = best.parent and f.name = best.name",
)


def _with_layout(files: DataFrame) -> DataFrame:
    return files.withColumn("layout", F.when(F.lower("name").contains("_cog.") & (F.col("length") % 3 != 0), "COG"))


add(
    "filter_non_cn_policy",
    "FILES",
    lambda f: D.non_native(C.twin_dedupe(C.products(_with_layout(f), f.sparkSession)), "skip"),
    """select parent, name, case when cog then 'named cog, not a COG' else 'non-cloud-native' end as reason, false as kept from (
         select *, row_number() over (partition by parent, category, lower(item)
           order by own desc, cog desc, case ext when '.copc.laz' then 2 when '.laz' then 1 else 0 end desc, name) as place
         from (select *, case kind when 'pcl' then native else cog and length % 3 <> 0 end as own from prods)) where place = 1 and not own""",
)


def _merged(files: DataFrame) -> DataFrame:
    """Overrides of the campaigns of even years, for all campaigns."""
    campaigns = files.select(_campaign().alias("campaign")).distinct()
    rows = [("dtm", ["DGM"], 0), ("intensity", ["Int"], 1), ("echo", None, 2)]
    own = files.sparkSession.createDataFrame([(a, b, ["X_"] if b else None, [".TIF"], t) for a, b, t in rows], "label string, require array<string>, forbid array<string>, extensions array<string>, turn int")
    overrides = campaigns.where("cast(substr(campaign, 4, 1) as int) % 2 = 0").join(F.broadcast(own), F.lit(True))
    merged = R.registry_merge(C.pattern_table(files.sparkSession), overrides, campaigns)
    return merged.select("campaign", "label", "ord", *[F.array_join(c, ",").alias(c) for c in ("require", "forbid", "extensions")])


add(
    "registry_merge",
    "FILES",
    _merged,
    f"""select campaign, label, ord, coalesce(array_to_string(req, ','), '') as require, coalesce(array_to_string(forb, ','), '') as forbid, array_to_string(exts, ',') as extensions
      from (select distinct {DATE} as campaign from v_files) cross join (
        select label, ord, req, forb, exts, label <> 'dtm' as even, true as odd from pats
        union all select 'dtm', (select ord from pats where label = 'dtm'), ['dgm'], ['x_'], ['.tif'], true, false
        union all select 'intensity', (select max(ord) + 1 from pats), ['int'], ['x_'], ['.tif'], true, false
        union all select 'echo', (select max(ord) + 2 from pats), [], [], ['.tif'], true, false)
      where case when campaign[4:4]::int % 2 = 0 then even else odd end""",
)
add(
    "join_sidecar_files",
    ("FILES", "TREE"),
    lambda f, t: R.join_sidecar_files(C.products(f, f.sparkSession), t.select("parent", F.col("name").alias("side"))),
    """select p.parent, p.name, count(distinct s.name) as n_sides, string_agg(distinct s.name, ',' order by s.name) as sides from prods p join v_tree s on p.parent = s.parent
      and (s.name = p.name || '.aux.xml' or s.name = p.name || '.PRJ' or s.name = p.name[:length(p.name) - length(p.ext)] || '.aux.xml' or s.name = p.name[:length(p.name) - length(p.ext)] || '.PRJ')
      group by 1, 2""",
)
add(
    "scan_config_blocks",
    "CONFIG",
    lambda c: D.config_blocks(c.select("campaign"), c).select("campaign", "title", "license", "crs", F.array_join("exclude", " ").alias("exclude"), F.col("properties")["a"].alias("a"), "failed"),
    """select campaign, case when ok and m % 7 = 2 then 'T' || m end as title, case when ok and m % 7 = 2 then 'CC-BY-4.0' else 'other' end as license,
      case when ok and m % 7 = 2 then 'EPSG:31256' end as crs, case when ok and m % 7 = 3 then '*_old* tmp?' else '' end as exclude,
      case when ok and m % 7 in (5, 6) then '1' end as a, ok and m % 7 in (0, 4) as failed from (select *, m % 5 <> 0 as ok from v_config)""",
)


# Headers, written from items and read back
_CLOUDS = """select item, cast(substr(item, 2) as int) as k, point_format, name, code % 11 as code, vmin, vmax from {dims} where name not in ('X', 'Y', 'Z')"""


def _heads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files with a header for each point cloud of the parts, some cut off, some none of these, some of the old layout, read back."""
    dims = spark.sql(_CLOUDS, dims=view(spark, sf_dir, "DIMS"))
    dim = F.struct("name", "code", F.when(F.col("code") % 2 == 0, F.lit(7.0)).alias("nodata"), F.lit(0.01).alias("scale"), (F.col("k") / 4).alias("offset"))
    clouds = dims.groupBy("item", "k", "point_format").agg(F.sort_array(F.collect_list(dim)).alias("dims"), F.min("vmin").alias("zmin"), F.max("vmax").alias("zmax"))
    items = clouds.selectExpr(
        "concat('c', k % 7, '/', item, case k % 3 when 0 then '.LAZ' else '.las' end) as path", "point_format", "k * 1000 as n_points", "k * 10e0 as xmin", "k * 20e0 as ymin", "zmin", "k * 10e0 + 5 as xmax", "k * 20e0 + 5 as ymax", "zmax",
        "dims", "case when k % 13 = 0 then 300 when k % 17 = 0 then 2 end as keep", "k % 5 = 0 as old",
    )
    folder = folders.shared_path(spark, "clouds")
    headers.write_headers(items, folder, padding=10_000)
    return headers.scan_headers(spark, folder)


_READ = f"""(select *, 'c' || k % 7 || '/' || item || case k % 3 when 0 then '.LAZ' else '.las' end as path, case when k % 13 = 0 then 'cut off' when k % 17 = 0 then 'cut off' end as error
  from ({_CLOUDS.format(dims='v_dims')}))"""
QUERIES["scan_binary_header"] = lambda spark, sf_dir: _heads(spark, sf_dir).select("path", "point_format", "n_points", "xmin", "ymin", "zmin", "xmax", "ymax", "zmax", "error", (F.col("bytes_read") <= 2 * headers.BLOCK).alias("small"))
ORACLES["scan_binary_header"] = f"""with v_dims as ({DIMS}) select path, case when error is null then point_format end as point_format, case when error is null then cast(k * 1000 as bigint) end as n_points,
  case when error is null then k * 10e0 end as xmin, case when error is null then k * 20e0 end as ymin, case when error is null then min(vmin) end as zmin, case when error is null then k * 10e0 + 5 end as xmax,
  case when error is null then k * 20e0 + 5 end as ymax, case when error is null then max(vmax) end as zmax, error, true as small from {_READ} group by path, k, point_format, error"""
QUERIES["scan_header_extra_dims"] = lambda spark, sf_dir: _heads(spark, sf_dir).select("path", F.explode("dims").alias("d")).select("path", "d.*")
ORACLES["scan_header_extra_dims"] = f"""with v_dims as ({DIMS}) select path, name, ['undefined', 'uint8', 'int8', 'uint16', 'int16', 'uint32', 'int32', 'uint64', 'int64', 'float32', 'float64'][code + 1] as type,
  case when code % 2 = 0 and code > 0 then 7e0 end as nodata, 0.01e0 as scale, k / 4e0 as "offset" from {_READ} where error is null"""


def _inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names and sizes of the files that the items were written to, by collection."""
    path = folders.shared_path(spark, "inventory")
    view(spark, sf_dir, "ITEMS").select("collection", F.col("item").alias("value")).repartition("collection").write.partitionBy("collection").text(path)
    of = F.replace(F.regexp_extract("path", "collection=([^/]+)/", 1), F.lit("%20"), F.lit(" "))
    return folders.scan_inventory(spark, path).groupBy(of.alias("collection")).agg(F.sum("length").alias("bytes"))


QUERIES["scan_inventory"] = _inventory
ORACLES["scan_inventory"] = f"select collection, cast(sum(strlen(item) + 1) as bigint) as bytes from ({ITEMS}) group by 1"

# Values, schemas, times
add(
    "nodata_exclude_scale",
    "BANDS",
    lambda b: R.nodata_exclude_scale(b.selectExpr("item", "band", "cast(band as double) as raw", "case when off = 2.0 then 2e0 end as nodata", "scale", "off")).select("item", "band", "value"),
    "select item, band, band * scale + off as value from v_bands where off <> 2 or band <> 2",
)
add(
    "unit_convert_dim",
    "POINTS",
    lambda p: R.angle_stats(P.point_stats(p, ["tax", "z"]), "tax").select("item", "dim", "vmin", "vmax", "vmean", "vstd"),
    """select item, dim, case dim when 'tax' then round(degrees(a), 4) else a end as vmin, case dim when 'tax' then round(degrees(b), 4) else b end as vmax,
      case dim when 'tax' then round(degrees(c), 4) else c end as vmean, case dim when 'tax' then round(degrees(d), 4) else d end as vstd
      from (select item, dim, min(v) as a, max(v) as b, round(avg(v), 4) as c, round(stddev_samp(v), 4) as d
        from (select item, unnest(['z', 'tax']) as dim, unnest([z, tax]) as v from v_points) group by 1, 2 having min(v) <> max(v))""",
)
add(
    "epoch_time_resolve",
    "SPANS",
    lambda s: R.epoch_time_resolve(s).select("item", F.unix_micros("start").alias("start_us"), F.unix_micros("end").alias("end_us")),
    f"select v.item, r.start_us, r.end_us from v_spans v left join ({_SPAN}) r on v.item = r.item",
)
_KIND = "case when code in (0, 2, 4, 9) then 'signed' when code in (1, 3, 5, 11) then 'unsigned' when code in (6, 7) then 'floating' end"
_SIZE = "case name when 'Amplitude' then 2 when 'ScanAngle' then case when point_format >= 6 then 2 else 1 end else size end"
_TYPE = f"case name when 'Amplitude' then 'unsigned' when 'ScanAngle' then 'signed' else {_KIND} end"
add("point_schema", "DIMS", R.point_schema, f"select item, name, cast({_SIZE} as int) as size, {_TYPE} as type from v_dims where name not in ('X', 'Y', 'Z')")
add(
    "storage_type_map",
    "DIMS",
    lambda d: R.point_schema(d).where("type is not null").select("item", "name", "type"),
    f"select item, name, {_TYPE} as type from v_dims where name not in ('X', 'Y', 'Z') and {_TYPE} is not null",
)


def _restated(dims: DataFrame) -> DataFrame:
    kind = F.coalesce(*[F.when(F.col("code") == k, v) for k, v in R.CODES.items()])
    given = dims.withColumn("type", kind).groupBy("item", "point_format").agg(F.collect_list(F.struct("name", "size", "type")).alias("schemas"), F.collect_list(F.struct("name", "vmin", "vmax", "vmean", "vstd")).alias("stats"))
    both = R.restate_schema(given).select("item", F.explode(F.arrays_zip("schemas", "stats")).alias("d"))
    return both.select("item", "d.schemas.name", "d.schemas.size", "d.schemas.type", "d.stats.vmin", "d.stats.vmax", "d.stats.vmean", "d.stats.vstd")


def _turned(c: str) -> str:
    return f"case when wrong and name = 'ScanAngle' then round(degrees({c}), 4) else {c} end as {c}"


add(
    "restate_schema",
    "DIMS",
    _restated,
    f"""select item, name, cast(case when wrong then {_SIZE} else size end as int) as size, case when wrong then {_TYPE} else {_KIND} end as type, {', '.join(map(_turned, ('vmin', 'vmax', 'vmean', 'vstd')))}
      from (select *, coalesce(bool_or(name = 'ScanAngle' and code in (6, 7)) over (partition by item), false) as wrong from v_dims)""",
)


# Search
def _ring(x: Column, y: Column, w: Column, h: Column) -> Column:
    """A right triangle, closed, as the only ring of a polygon."""
    corner = lambda a, b: F.struct(a.alias("x"), b.alias("y"))
    return F.array(F.array(corner(x, y), corner(x + w, y), corner(x, y + h), corner(x, y)))


_BOX = (100.0, 100.0, 700.0, 500.0)
_MEETS = "x0 <= 700 and x0 + {w} >= 100 and y0 <= 500 and y0 + {h} >= 100 and (greatest(x0, 100) - x0) / {w} + (greatest(y0, 100) - y0) / {h} <= 1"
add(
    "polygon_intersects_box",
    "ITEMS",
    lambda i: i.where(R.polygon_intersects_box(_ring(F.col("x0"), F.col("y0"), F.lit(64.0), F.lit(128.0)), _BOX)).select("item"),
    f"select item from v_items where {_MEETS.format(w=64, h=128)}",
)
def _search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The items are stored by collection, then searched."""
    items, folder = view(spark, sf_dir, "ITEMS"), folders.shared_path(spark, "items")
    store.store_items(items, folder)
    return store.search_stored(spark, folder, items.schema, _BOX, "1995-01-01", "1996-06-30", 1000.0, _ring(F.col("x0"), F.col("y0"), F.lit(5.0), F.lit(5.0)))


QUERIES["search_spatiotemporal"] = _search
ORACLES["search_spatiotemporal"] = f"with v_items as ({ITEMS}) select item, collection from v_items where {_MEETS.format(w=5, h=5)} and start between date '1995-01-01' and date '1996-06-30' and points >= 1000"


# The tree of root, collections, groups and items, written and checked
def _tree(spark: SparkSession, sf_dir: str, spoilt: bool) -> tuple[DataFrame, DataFrame]:
    """Documents and links of all items, written and read back; spoilt: some items share ids, some links lead nowhere, twice or one way."""
    items = view(spark, sf_dir, "ITEMS").withColumn("grp", F.when(F.col("x0") % 4 != 0, F.col("grp")))
    documents, links = L.catalog_tree(items, "all")
    if spoilt:
        n = F.try_to_number(F.regexp_extract("href", "([0-9]+)[.]json$", 1), F.lit("999999999999")).cast("long")
        down = (F.col("rel") == "item") & n.isNotNull()
        href = F.when(down & (n % 11 == 0), F.concat(F.lit("./x/"), "href")).otherwise(F.concat(F.when(down & (n % 3 == 0), "./").otherwise(""), "href"))
        copies = F.when(down & (n % 13 == 0), 2).when(down & (n % 17 == 0), 0).otherwise(1)
        links = links.select("source", "rel", href.alias("href"), F.explode(F.array_repeat(F.lit(1), copies)).alias("k")).drop("k")
        documents = documents.withColumns({"title": F.when((F.col("kind") != "item") | (F.try_to_number("id", F.lit("999999999999")) % 19 != 0), F.col("title")), "id": F.when((F.col("kind") == "item") & (F.try_to_number("id", F.lit("999999999999")) % 23 == 0), F.lit("all")).otherwise(F.col("id"))})
    path = folders.shared_path(spark, "tree")
    folders.tree_json(documents, links, path)
    return folders.read_tree(spark, path)


_TREE = f"""v_items as (select * replace (case when x0 % 4 <> 0 then grp end as grp) from ({ITEMS})),
  own as (select cast(item as bigint) as n, '/' || collection || coalesce('/' || grp, '') as home, collection, grp, item from v_items),
  docs as (select home || '/' || item || '/' || item || '.json' as path, 'item' as kind, n, home || '/collection.json' as up from own
    union all select distinct home || '/collection.json', 'group', null, '/' || collection || '/collection.json' from own where grp is not null
    union all select distinct '/' || collection || '/collection.json', 'collection', null, '/catalog.json' from own union all select '/catalog.json', 'root', null, null)"""
QUERIES["sink_catalog_json"] = lambda spark, sf_dir: (lambda d, k: k.select("source", "rel", L.resolve(F.col("source"), F.col("href")).alias("target")).join(d.select(F.col("path").alias("source"), "kind"), "source"))(*_tree(spark, sf_dir, spoilt=False))
ORACLES["sink_catalog_json"] = f"""with {_TREE} select path as source, 'root' as rel, '/catalog.json' as target, kind from docs where up is not null union all select path, 'parent', up, kind from docs where up is not null
  union all select d.up, case d.kind when 'item' then 'item' else 'child' end, d.path, u.kind from docs d join docs u on d.up = u.path"""
QUERIES["rules_check"] = lambda spark, sf_dir: L.rules_check(*_tree(spark, sf_dir, spoilt=True), ["title"])
ORACLES["rules_check"] = f"""with {_TREE}, items as (select *, n % 17 = 0 and n % 13 <> 0 as none, n % 11 = 0 as lost, regexp_extract(up, '^(.*)/[^/]*$', 1) as dir from docs where kind = 'item')
  , named as (select path from items where n % 23 = 0 union all select '/catalog.json')
  select path, 'missing' as rule, 'title' as detail from items where n % 19 = 0 union all select path, 'duplicate id', 'all' from named where path <> (select min(path) from named)
  union all select up, 'broken', 'item ./x/' || path[length(dir) + 2:] from items, unnest(range(case when n % 13 = 0 then 2 else 1 end)) where lost and not none
  union all select up, 'doubled', 'item ' || case when lost then dir || '/x/' || path[length(dir) + 2:] else path end from items where n % 13 = 0
  union all select path, 'dangling', 'item' from items where lost or none union all select path, 'one-way', up from items where lost or none"""


# Collections
def _published(items: DataFrame) -> DataFrame:
    spec = "map('Survey', named_struct('role', 'producer', 'url', cast(null as string)), 'Archive', named_struct('role', 'host', 'url', 'http://a'))"
    names = items.select("collection").distinct().unionByName(items.sparkSession.createDataFrame([("ATLANTIS",)], "collection string"))
    meta = names.selectExpr(
        "collection", "case when collection < 'NATION_14' then concat('Items of ', collection) end as title", "case when collection < 'NATION_11' then 'Long text' else '' end as description",
        "case when collection < 'NATION_16' then 'CC0' when collection < 'NATION_2' then 'other' end as license", "case when collection = 'NATION_17' then 'http://l' end as license_link",
        f"case when collection < 'NATION_22' then {spec} end as providers", "case when collection > 'NATION_12' then array('lidar', 'survey') end as keywords",
    )
    groups = items.select("collection", "grp").distinct().withColumn("title", F.concat("grp", F.lit(" tiles")))
    rows = K.build_collection_row(meta, items, groups)
    providers = F.array_join(F.transform("providers", lambda p: F.concat_ws(":", p["name"], p["role"], p["url"])), ";")
    return rows.select("id", "parent", "title", "description", "license", "warning", "error", "n_items", "x0", "y1", "t1", providers.alias("providers"), F.array_join("keywords", ",").alias("keywords"))


add(
    "build_collection_row",
    "ITEMS",
    _published,
    """select case when g is null then c else c || '/' || g end as id, case when g is not null then c end as parent,
      case when g is not null then g || ' tiles' when c < 'NATION_14' then 'Items of ' || c end as title,
      case when g is not null then 'Tiled products of ' || c || '.' when c < 'NATION_11' then 'Long text' when c < 'NATION_14' then 'Items of ' || c else c end as description,
      case when g is null and c < 'NATION_16' then 'CC0' else 'other' end as license, case when g is null and c >= 'NATION_16' and c < 'NATION_2' and c <> 'NATION_17' then 'license other without a link' end as warning,
      case when n_items is null then 'collection ' || c || ' would be empty' end as error, n_items, x0, y1, t1,
      case when c < 'NATION_22' then 'Archive:host:http://a;Survey:producer' else '' end as providers, case when c > 'NATION_12' then 'lidar,survey' else '' end as keywords
      from (select collection as c, grp as g, count(*) as n_items, min(x0) as x0, max(y1) as y1, max(start) as t1 from v_items group by grouping sets ((collection), (collection, grp))
        union all select 'ATLANTIS', null, null, null, null, null)""",
)
add(
    "anti_stale_collections",
    "ITEMS",
    lambda i: U.stale_collections(i, i.where("collection < 'NATION_2'")),
    "select distinct collection, true as acted from v_items where collection >= 'NATION_2'",
)


def _names(paths: DataFrame) -> DataFrame:
    return paths.select(F.regexp_extract("path", "^(.*)/[^/]*$", 1).alias("dir"), F.regexp_extract("path", "([^/]*)$", 1).alias("name"))


_SHARES = ORACLES["dir_ext_share"]
add(
    "dir_summarize_threshold",
    "PATHS",
    lambda p: U.summarize_dirs(_names(p), U.dir_ext_share(S.dir_own_stats(p)), 10),
    f"""select n.dir, case when count(*) < 10 then string_agg(n.name, ', ' order by n.name) end as names, case when count(*) >= 10 then any_value(s.shares) end as shares
      from (select regexp_extract(path, '^(.*)/[^/]*$', 1) as dir, regexp_extract(path, '([^/]*)$', 1) as name from v_paths) n join ({_SHARES}) s on n.dir = s.dir group by 1""",
)
