"""Shapes that the catalog works on, derived from the given tables. The SQL text is the same for Spark and the oracle
where both read it alike."""

from __future__ import annotations

FILES = """select concat('data/', substr(cast(date_trunc('year', l_shipdate) as string),1,10),
  case l_returnflag when 'A' then '/tiles_a' when 'R' then '/east/low' else '' end) as parent,
  concat('p_', case when l_orderkey % 5 = 0 then '' else concat(substr(cast(l_shipdate as string),1,10),'_') end,
  case l_suppkey % 6 when 0 then 'dtm' when 1 then 'DTM_filled' when 2 then 'dsm_masked' when 3 then 'transparent_mosaic' when 4 then 'dtm_shd' else 'ground' end,
  '_', cast(l_partkey % 50 as string), case when l_linenumber % 2 = 0 then '_cog' else '' end,
  case when l_suppkey % 6 = 5 then case l_linenumber % 3 when 0 then '.copc.laz' when 1 then '.laz' else '.las' end when l_linenumber = 7 then '.txt' else '.tif' end) as name,
  cast(sum(l_quantity) as bigint) as length from lineitem group by 1, 2"""
#: The files with side files and settings beside them.
TREE = f"""select parent, case k when 0 then name when 1 then concat(name, '.aux.xml') when 2 then concat(substr(name, 1, length(name) - 4), '.PRJ') else 'Campaign.YAML' end as name,
  cast(max(size) as bigint) as length
  from (select parent, name, length as size, k from ({FILES}) f cross join (select 0 as k union all select 1 union all select 2 union all select 3) ks
    where k = 0 or (k = 1 and name like '%.tif' and length % 5 = 0) or (k = 2 and name like '%.tif' and length % 7 = 0) or (k = 3 and length % 11 = 0)) t
  group by 1, 2"""
#: Settings files of monthly campaigns: none, empty, of other shapes, and good ones.
CONFIG = """select campaign, m, case when m % 5 = 0 then 'readme.md' when m % 2 = 0 then 'campaign.yaml' else 'Campaign.YAML' end as name,
  case m % 7 when 0 then '[1, 2]' when 1 then '' when 2 then concat('{"collection": {"title": "T', cast(m as string), '", "license": "CC-BY-4.0"}, "crs": "EPSG:31256"}')
    when 3 then '{"exclude": ["*_old*", "tmp?"]}' when 4 then 'just words' else '{"properties": {"a": "1"}}' end as text
  from (select substr(cast(date_trunc('month', l_shipdate) as string), 1, 10) as campaign, cast(max(extract(year from l_shipdate) * 12 + extract(month from l_shipdate)) as bigint) as m from lineitem group by 1) t"""
#: Dimensions of point clouds with their statistics.
DIMS = """select concat('c', cast(cast(floor(p_partkey / 8) as bigint) as string)) as item, cast(cast(floor(p_partkey / 8) as bigint) % 11 as int) as point_format,
  case p_partkey % 8 when 0 then 'X' when 1 then 'Y' when 2 then 'Z' when 3 then 'Amplitude' when 4 then 'ScanAngle' when 5 then 'Intensity' when 6 then 'Class' else 'Flags' end as name,
  cast(4 as int) as size, cast(p_size % 13 as int) as code, -p_size / 100e0 as vmin, p_size / 50e0 as vmax, p_size / 70e0 as vmean, p_size / 90e0 as vstd from part"""
CONTENT = "select concat('data/', source, '/', lang, '/', cast(doc_id as string), '.txt') as path, text as content from documents"
PREV = "select concat('data/', source, '/', lang, '/', cast(doc_id as string), '.txt') as path, case when doc_id % 11 = 0 then concat(text, '!') else text end as content from documents where doc_id % 17 <> 0"
POINTS = "select concat(l_returnflag, l_linestatus) as item, cast(l_partkey as double) as x, cast(l_suppkey as double) as y, cast(l_quantity as double) as z, cast(l_extendedprice as double) as price, cast(l_discount as double) as discount, cast(l_tax as double) as tax, cast(l_orderkey as double) as gps_time from lineitem"
ITEMS = """select cast(o_orderkey as string) as item, n_name as collection, o_orderpriority as grp, cast(o_custkey as double) as x0, cast(o_orderkey % 1000 as double) as y0,
  cast(o_custkey + 5 as double) as x1, cast(o_orderkey % 1000 + 5 as double) as y1, cast(o_orderdate as date) as start, cast(o_totalprice as double) as points
  from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey"""
CELLS_SPARK = "select label as item, cast(vec_id as int) as row, pos as col, cast(v as double) as value, v > 0 as valid from embeddings lateral view posexplode(embedding) t as pos, v"
CELLS_DUCK = "select label as item, cast(vec_id as int) as row, cast(unnest(range(len(embedding))) as int) as col, cast(unnest(embedding) as double) as value, unnest(embedding) > 0 as valid from embeddings"
PATHS_SPARK = "select regexp_replace(url, '^https?://', '') as path, cast(octet_length(html) as bigint) as size from pages"
PATHS_DUCK = "select regexp_replace(url, '^https?://', '') as path, cast(strlen(html) as bigint) as size from pages"
BANDS = """select concat('r', cast(cast(floor(p_partkey / 3) as bigint) as string)) as item, p_partkey % 3 + 1 as band, case when p_size % 4 = 0 then null else p_name end as description,
  case p_size % 5 when 0 then 'undefined' when 1 then 'gray' when 2 then 'red' when 3 then 'green' else 'nir' end as color, case p_size % 6 when 0 then 'uint8' when 1 then 'int16' when 2 then 'float32' when 3 then 'complex64' else 'uint16' end as data_type,
  case when p_size % 3 = 0 then 1.0e0 else 0.5e0 end as scale, case when p_size % 2 = 0 then 0.0e0 else 2.0e0 end as off, case p_size % 7 when 0 then cast('NaN' as double) when 1 then cast('Infinity' as double) when 2 then cast('-Infinity' as double) else p_retailprice end as nodata
  from part"""
_SPANS = """select o_orderkey as item, d as campaign, case when o_orderkey % 3 = 0 then {near} end as anchor,
  case o_orderkey % 5 when 0 then o_totalprice when 1 then o_totalprice % 80000 when 2 then {days} * 86400.0e0 - 1315964800 + o_orderkey % 2000000 when 3 then -1.0e0 end as gps_min,
  case o_orderkey % 5 when 0 then case when o_orderkey % 2 = 0 then o_totalprice % 1000 else o_totalprice + 60 end when 1 then o_totalprice % 80000 + 100 when 2 then {days} * 86400.0e0 - 1315964800 + o_orderkey % 2000000 + 3600 when 3 then 5.0e0 end as gps_max
  from (select o_orderkey, o_totalprice, {date} as d from orders)"""
SPANS_SPARK = _SPANS.format(near="date_add(d, 9)", days="unix_date(d)", date="date_add(cast(o_orderdate as date), 7305)")
SPANS_DUCK = _SPANS.format(near="d + 9", days="(d - date '1970-01-01')", date="(cast(o_orderdate as date) + 7305)")
ARRIVALS = "select event_type as campaign, cast(user_id as string) as item, value from events"
