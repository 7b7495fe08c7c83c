"""Queries on settings that act on items, with their SQL counterparts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terracat.operators import classify as C
from terracat.operators import settings as T
from terracat.plans.catalog import _prods, add

_TEXTS = {
    0: """{"properties": {"a": "1", "b": "2", "byLabel": {"dtm": {"a": null, "c": "L"}, "dsm": {"b": "S"}}, "byId": {"p_dtm_5": {"b": "I"}}},
           "hierarchy": {"placement": {"*_dtm_1*": "ones", "p_dtm_5": null, "*DTM*": "rest"}, "groups": {"ones": {"title": "Ones"}}}, "crs": "EPSG:31256"}""",
    1: """{"exclude": ["*_dtm_?.tif", "*.LAZ"], "collection": {"title": "T", "providers": {"P": {"roles": ["host"], "url": "u"}, "Q": {"roles": ["producer"]}}}, "properties": {"a": "x"}}""",
    2: "[1, 2]",
}


def _settings(files: DataFrame) -> DataFrame:
    """Settings by year: full, partly, failed, none."""
    campaigns = files.select(F.regexp_extract("parent", C.DATE, 0).alias("campaign")).distinct()
    year = F.substring("campaign", 1, 4).cast("int") % 4
    text = F.coalesce(*[F.when(year == k, t) for k, t in _TEXTS.items()])
    found = campaigns.select("campaign", F.when(year == 1, "CAMPAIGN.yaml").otherwise("campaign.yaml").alias("name"), text.alias("text")).where("text is not null")
    return T.settings_blocks(campaigns, found)


def _applied(files: DataFrame) -> DataFrame:
    grouped = C.tile_group_assign(C.twin_dedupe(_prods(files))).withColumn("campaign", F.regexp_extract("parent", C.DATE, 0))
    laid = F.array_join(F.transform(F.array_sort(F.map_entries("properties")), lambda e: F.concat_ws("=", e["key"], e["value"])), ";")
    return T.apply_settings(grouped, _settings(files)).select("parent", "name", F.col("group").alias("grp"), "group_title", laid.alias("properties"), "crs")


_YEAR = "cast(parent[6:9] as int) % 4"
add(
    "settings_items",
    "FILES",
    _applied,
    f"""select parent, name, placed as grp, case when y = 0 and placed = 'ones' then 'Ones' end as group_title,
      case y when 0 then case when label = 'dtm' then 'b=' || case item when 'p_dtm_5' then 'I' else '2' end || ';c=L' when label = 'dsm' then 'a=1;b=S' else 'a=1;b=' || case item when 'p_dtm_5' then 'I' else '2' end end when 1 then 'a=x' else '' end as properties,
      case when y = 0 then 'EPSG:31256' end as crs
      from (select *, case when y = 0 then case when item = 'p_dtm_5' then null when lower(item) like '%\\_dtm\\_1%' escape '\\' then 'ones' when lower(item) like '%dtm%' then 'rest' else grp end else grp end as placed
        from (select *, {_YEAR} as y from grouped) where y <> 2 and not (y = 1 and (regexp_matches(lower(name), '_dtm_.\\.tif$') or ends_with(lower(name), '.laz'))))""",
)


def _blocks(files: DataFrame) -> DataFrame:
    s = _settings(files)
    providers = F.array_join(F.transform("collection.providers", lambda p: F.concat_ws(":", p["name"], F.array_join(p["roles"], "+"), p["url"])), ";")
    keys = F.array_join(F.transform("placement", lambda p: F.concat_ws(">", p["key"], p["group"])), ";")
    return s.select("campaign", "collection.title", "collection.license", providers.alias("providers"), "crs", F.array_join("exclude", " ").alias("exclude"), keys.alias("placement"), F.array_join(F.map_keys("by_label"), ",").alias("by_label"), F.try_element_at("by_id", F.lit("p_dtm_5"))["b"].alias("own"), "failed")


add(
    "settings_blocks",
    "FILES",
    _blocks,
    f"""select campaign, case when y = 1 then 'T' end as title, 'other' as license, case when y = 1 then 'P:host:u;Q:producer' end as providers, case when y = 0 then 'EPSG:31256' end as crs,
      case when y = 1 then '*_dtm_?.tif *.LAZ' else '' end as exclude, case when y = 0 then '*_dtm_1*>ones;p_dtm_5;*DTM*>rest' else '' end as placement, case when y = 0 then 'dtm,dsm' else '' end as by_label,
      case when y = 0 then 'I' end as own, y = 2 as failed from (select distinct parent[6:15] as campaign, {_YEAR} as y from v_files)""",
)
