"""Queries on the rules of publication, with their SQL counterparts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terracat.operators import classify as C
from terracat.operators import discovery as D
from terracat.operators import profile as P
from terracat.operators import records as R
from terracat.operators import rules as U
from terracat.operators import snapshot as S
from terracat.plans.catalog import ORACLES, QUERIES, _prods, add, view
from terracat.plans.records import _CAMPAIGN, _TILES, _overlay
from terracat.plans.views import FILES
from terracat.sources import folders


def _only(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files stored by campaign: the glob on that column prunes folders."""
    path = folders.shared_path(spark, "files")
    files = view(spark, sf_dir, "FILES").withColumn("campaign", F.split("parent", "/")[1])
    files.repartition("campaign").write.partitionBy("campaign").parquet(path)
    stored = spark.read.schema(files.schema).parquet(path)
    return D.only_campaigns(stored, F.col("campaign"), "199[5-7]-*").select("parent", "name")


QUERIES["scan_only_glob"] = _only
ORACLES["scan_only_glob"] = f"with v_files as ({FILES}) select parent, name from v_files where string_split(parent, '/')[2] between '1995' and '1998'"


def _checked(files: DataFrame) -> DataFrame:
    cog = F.lower("name").contains("_cog.")
    probed = _prods(files).withColumns({"layout": F.when(cog & (F.col("length") % 3 != 0), "COG"), "errors": F.when(F.col("length") % 4 == 0, F.array(F.lit("offset"), F.lit("overview"))).otherwise(F.array().cast("array<string>"))})
    return U.flag_cloud_native(probed.drop("native")).select("parent", "name", "native", "warning")


_COG = "kind = 'raster' and contains(lower(name), '_cog.') and length % 3 <> 0"
add("flag_cloud_native", "FILES", _checked, f"select parent, name, case kind when 'pcl' then ext = '.copc.laz' else {_COG} and length % 4 <> 0 end as native, case when {_COG} and length % 4 = 0 then 'invalid COG (' || name || '): offset; overview; demoted to plain GeoTIFF' end as warning from prods")


def _enough(items: DataFrame) -> DataFrame:
    """Both sides of a run: what is listed now and what the last run had."""
    now = items.select("item", F.when(F.col("x0") % 3 == 0, "raster").otherwise("pcl").alias("kind"), F.when(F.col("y0") % 10 != 0, F.col("points")).alias("points"))
    a, b = U.filter_min_points(now, items.where("y0 % 2 = 0").select("item"), 60_000)
    return a.select("item", F.lit("now").alias("side")).unionByName(b.select("item", F.lit("before").alias("side")))


_FEW = "(x0 % 3 <> 0 and y0 % 10 <> 0 and points < 60000)"
add("filter_min_points", "ITEMS", _enough, f"select item, 'now' as side from v_items where not {_FEW} union all select item, 'before' from v_items where y0 % 2 = 0 and not {_FEW}")


def _pruned(bands: DataFrame) -> DataFrame:
    low = F.col("band").cast("double")
    stats = F.create_map(F.lit("minimum"), low, F.lit("maximum"), low + 1, F.lit("mean"), F.when(F.col("off") == 0, low + 0.5), F.lit("count"), F.lit(9.0), F.lit("median"), low)
    return U.band_field_prune(bands.select("item", "band", "scale", "off", F.when(F.col("color") == "red", "m").alias("unit"), stats.alias("statistics")))


add(
    "band_field_prune",
    "BANDS",
    _pruned,
    """select item, band, '{' || concat_ws(',', case when color = 'red' then '"unit":"m"' end, '"statistics":{"minimum":' || band || '.0,"maximum":' || band + 1 || '.0' || case when off = 0 then ',"mean":' || band || '.5' else '' end || '}',
      case when scale <> 1 then '"raster:scale":' || scale end, case when off <> 0 then '"raster:offset":' || off end) || '}' as fields, 'median' as dropped from v_bands""",
)


def _shapes(files: DataFrame) -> DataFrame:
    listed = _prods(files).select(F.concat_ws("/", "parent", "name").alias("path"), F.array(F.lit("data")).alias("roles"), R.media_type(F.col("label"), F.col("native")).alias("media"), "length")
    stored = listed.where("length % 5 <> 0").select("path", F.when(F.col("length") % 17 != 0, F.col("roles")).otherwise(F.array(F.lit("data"), F.lit("old"))).alias("roles"), F.when(F.col("length") % 13 != 0, F.col("media")).alias("media"))
    return U.join_shape_check(stored, listed)


add("join_shape_check", "FILES", _shapes, "select parent || '/' || name as path, length % 17 = 0 as roles_differ, length % 13 = 0 as media_differ from prods where length % 5 <> 0 and (length % 17 = 0 or length % 13 = 0)")


def _dims(dims: DataFrame) -> DataFrame:
    """Names as the files have them: some by their alias, some with an underscore and blanks, some not at all."""
    file = F.when(F.col("name") == "Amplitude", F.when(F.col("code") % 2 == 0, "Intensity").otherwise("amplitude")).when(F.col("name") == "ScanAngle", "ScanAngleRank").when(F.col("name") == "Class", "_cl ass").when(F.col("name") == "Flags", F.when(F.col("code") % 3 != 0, "FLAGS"))
    actual = dims.select("item", F.coalesce(file, F.when(~F.col("name").isin("Flags"), F.col("name"))).alias("name")).where("name is not null")
    return U.map_dim_names(dims.select("item", "name"), actual)


add(
    "map_dim_names",
    "DIMS",
    _dims,
    """select item, name, case name when 'Amplitude' then case when code % 2 = 0 or has then 'Intensity' end when 'ScanAngle' then 'ScanAngleRank' when 'Class' then '_cl ass' when 'Flags' then case when code % 3 <> 0 then 'FLAGS' end
      else name end as actual from (select *, bool_or(name = 'Intensity') over (partition by item) as has from v_dims)""",
)


def _drawn(files: DataFrame) -> DataFrame:
    grouped = C.tile_group_assign(C.twin_dedupe(_prods(files))).withColumn("campaign", F.regexp_extract("parent", C.DATE, 0))
    return U.sample_stratified(grouped, 17)


add("sample_stratified_seeded", "FILES", _drawn, f"select campaign, stratum, arg_min(parent, h) as parent, arg_min(name, h) as name from (select *, {_CAMPAIGN} as campaign, md5('17|' || parent || '|' || name) as h, case when grp is not null then 'tile' when label = 'orthophoto' then 'orthophoto' when kind = 'raster' then 'raster' end as stratum from grouped) where stratum is not null group by 1, 2")


def _refresh(items: DataFrame) -> DataFrame:
    have = F.create_map(F.lit("a"), F.col("grp"), F.lit("b"), F.col("collection"), F.lit("c"), F.lit("I"), F.lit("title"), F.concat(F.lit("T"), F.when(F.col("x0") % 5 == 0, "old").otherwise(F.col("item"))))
    own = F.when(F.col("y0") % 7 == 0, F.map_concat(_overlay(), F.create_map(F.lit("title"), F.concat(F.lit("T"), F.when(F.col("x0") % 5 == 0, "old").otherwise("x"))))).otherwise(_overlay())
    return items.select("item", U.needs_refresh(own, have, F.concat(F.lit("T"), "item")).alias("refresh"))


add("gate_refresh_properties", "ITEMS", _refresh, "select item, x0 % 2 = 0 or case when y0 % 7 = 0 then x0 % 5 <> 0 else x0 % 5 = 0 end as refresh from v_items")


def _report(now: DataFrame, before: DataFrame) -> DataFrame:
    """Every file of both runs with its outcome: those of 300 bytes in a hundred warn, of some lengths fail."""
    size = S.file_fingerprint(now).select("path", "size")
    rows = S.join_snapshot_diff(S.file_fingerprint(now), S.file_fingerprint(before)).join(size, "path", "left")
    return U.run_report(rows.select(F.split("path", "/")[1].alias("campaign"), "status", (F.coalesce("size", F.lit(0)) % 8 / 8).alias("seconds"), F.when(F.col("size") % 100 < 3, "odd size").when(F.col("size") > 9000, "long").alias("warning"), F.when(F.col("size") % 31 == 0, "broken").alias("error")))


_STATUS = "case when b.path is null then 'new' when a.path is null then 'stale' when a.content is not distinct from b.content then 'same' else 'changed' end"
add(
    "sink_run_report",
    ("CONTENT", "PREV"),
    _report,
    f"""select campaign, '{{"campaign":"' || campaign || '","new":' || n || ',"changed":' || c || ',"same":' || s || ',"stale":' || st || ',"failed":' || f || ',"seconds":' || sec || ',"untouched":' || (f = m)
        || coalesce(',"warnings":{{' || nullif(concat_ws(',', case when w1 > 0 then '"long":' || w1 end, case when w2 > 0 then '"odd size":' || w2 end), '') || '}}', '') || '}}' as report
      from (select campaign, count(*) as m, count(*) filter (ok and status = 'new') as n, count(*) filter (ok and status = 'changed') as c, count(*) filter (ok and status = 'same') as s, count(*) filter (ok and status = 'stale') as st,
          count(*) filter (not ok) as f, sum(coalesce(size, 0) % 8 / 8e0) as sec, count(*) filter (size > 9000 and size % 100 >= 3) as w1, count(*) filter (size % 100 < 3) as w2
        from (select split_part(coalesce(a.path, b.path), '/', 2) as campaign, {_STATUS} as status, strlen(a.content) as size, coalesce(strlen(a.content) % 31 <> 0, true) as ok from v_content a full join v_prev b on a.path = b.path) group by 1)""",
)
add("restate_time", "ITEMS", lambda i: U.restate_time(i, F.col("points") > 2e5, 7)[1].select("collection", "t0", "t1"), "select collection, min(s) as t0, max(s) as t1 from (select collection, case when points > 200000 then start + 7 else start end as s from v_items) group by 1")


def _leftover(points: DataFrame) -> DataFrame:
    """Tiles of the last run; now tiles of few points belong to the one at the start of their block of ten columns."""
    tiles = P.tile_assign_points(points, 2.0)
    name = lambda c: F.concat_ws("_", F.lit("t"), c.cast("string"), F.col("tile_row").cast("string"))
    owner = F.when(F.col("n") > 12, name(F.col("tile_col"))).otherwise(name(F.floor(F.col("tile_col") / 10) * 10))
    return U.stale_outputs(tiles.select(name(F.col("tile_col")).alias("tile")), tiles.where("n > 2").select(name(F.col("tile_col")).alias("tile"), owner.alias("owner")))


add(
    "anti_stale_outputs",
    "POINTS",
    _leftover,
    f"""select tile, owner from (with t as (select *, 't_' || tile_col || '_' || tile_row as tile, case when n > 12 then 't_' || tile_col || '_' || tile_row else 't_' || tile_col // 10 * 10 || '_' || tile_row end as own from ({_TILES.replace('/ 25)', '/ 2)')}))
      select tile, case when n > 2 then own end as owner from t where tile not in (select own from t where n > 2))""",
)
