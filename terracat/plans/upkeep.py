"""Queries on gates, settings, registries, failed rows and streams, with their SQL counterparts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terracat.operators import classify as C
from terracat.operators import registry as G
from terracat.operators import snapshot as S
from terracat.operators import upkeep as U
from terracat.plans.catalog import ORACLES, QUERIES, add, view
from terracat.plans.views import CONTENT, PREV
from terracat.sources import folders
from terracat.streaming.arrivals import RunningSummary
from terracat.streaming.catalog import IncrementalCatalog

_CAMPAIGN = "regexp_extract(parent, '\\d{4}-\\d{2}-\\d{2}')"
_BOTH = "v_content a full join v_prev b on a.path = b.path"


def _print(content: DataFrame) -> DataFrame:
    return S.file_fingerprint(content).withColumn("campaign", F.split("path", "/")[1])


# Settings and their digests: of each source now, and as the last run kept them
def _settings(spark: SparkSession, sf_dir: str, was: bool) -> DataFrame:
    """The settings of each source now, or those it had in the last run: a code and labels that depend on its documents."""
    source = "try_cast(substr(source, 4) as int)"
    crs = f"case when {source} % 5 = 0 then {'9999' if was else '31256'} when {source} % 5 = 1 then 31256 end"
    label = "concat('v', cast(count(*) % 7 as string))"
    labels = f"map('b', {label}, 'a', 'x')" if was else f"map('a', 'x', 'b', {label})"
    changed = f"case when {source} % 4 = 3 then map('a', 'y') else {labels} end" if was else labels
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").where("source is not null")
    return docs.groupBy("source").agg(F.expr(f"cast(first({crs}) as string)").alias("crs"), F.expr(changed.replace(source, f"first({source})")).alias("labels")).withColumnRenamed("source", "campaign")


def _digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = U.config_digest(_settings(spark, sf_dir, was=True)).where("campaign <> 'src7'")
    return U.gate_digest_change(_settings(spark, sf_dir, was=False), stored)


#: Sources whose settings are the stored ones: neither the code nor the labels have changed, and something was stored.
_SAME = "(try_cast(source[4:] as int) % 5 <> 0 and try_cast(source[4:] as int) % 4 <> 3 and source <> 'src7')"
_JSON = """'{' || case try_cast(source[4:] as int) % 5 when 0 then '"crs":"31256",' when 1 then '"crs":"31256",' else '' end || '"labels":[{"key":"a","value":"x"},{"key":"b","value":"v' || count(*) % 7 || '"}]}'"""
QUERIES["config_digest"] = lambda spark, sf_dir: U.config_digest(_settings(spark, sf_dir, was=False))
ORACLES["config_digest"] = f"select source as campaign, sha256({_JSON}) as digest from documents where source is not null group by source"
QUERIES["gate_digest_change"] = lambda spark, sf_dir: _digests(spark, sf_dir).select("campaign", "same")
ORACLES["gate_digest_change"] = f"select distinct source as campaign, {_SAME} as same from documents where source is not null"


def _gated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files now and of the last run, whose items are pieces of text here; every ninth lost its media type."""
    before = _print(view(spark, sf_dir, "PREV")).withColumn("media", F.when(F.length("path") % 9 != 0, "text/plain"))
    ok = U.shape_ok(F.lit("text"), F.array(F.lit("data")), F.col("media"), F.create_map(F.lit("a"), F.lit("b")))
    return U.gate_status(_print(view(spark, sf_dir, "CONTENT")), before.withColumn("shape_ok", ok), _digests(spark, sf_dir))


QUERIES["gate_status"] = _gated
ORACLES["gate_status"] = f"""with v_content as ({CONTENT}), v_prev as ({PREV}), same as (select distinct source, {_SAME} as same from documents)
  select coalesce(a.path, b.path) as path, case when a.path is null then 'stale' when b.path is not null and a.content is not distinct from b.content and length(a.path) % 9 <> 0 and coalesce(s.same, false) then 'reuse' else 'rebuild' end as gate
  from {_BOTH} left join same s on split_part(a.path, '/', 2) = s.source"""


def _hashed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sizes from a listing, kept sums, and contents stored apart."""
    content = view(spark, sf_dir, "CONTENT").where("content is not null")
    listed = content.select("path", F.octet_length("content").cast("long").alias("length"))
    stored = S.file_fingerprint(view(spark, sf_dir, "PREV").where("content is not null")).withColumnRenamed("size", "length")
    return U.gate_two_stage_hash(listed, stored, content)


QUERIES["gate_two_stage_hash"] = _hashed
ORACLES["gate_two_stage_hash"] = f"with v_content as ({CONTENT}), v_prev as ({PREV}) select path, case when strlen(a.content) <> strlen(b.content) then 'size' when a.content = b.content then 'same' else 'content' end as gate from v_content a join v_prev b using (path) where a.content is not null and b.content is not null"
_WAY = "regexp_extract(path, '^(.*)/[^/]*$', 1) as parent"
add("set_stale_keep", ("PREV", "CONTENT"), U.set_stale_keep, f"select path, {_WAY}, path not in (select path from v_prev) as stale from v_content")
add("stale_policy", ("PREV", "CONTENT"), lambda a, b: U.stale_policy(a, b, "remove"), f"select path, {_WAY}, false as stale from v_prev")

# Failed rows apart
_NUMBER = "try_cast(case when x0 % 7 = 0 or collection = 'NATION_3' then concat('x', item) else item end as bigint)"


def _split(items: DataFrame) -> DataFrame:
    """Good and bad items, each told by which side they are on, where their campaign is touched."""
    rows = items.select(F.col("collection").alias("campaign"), "item", F.when(F.expr(_NUMBER).isNull(), "not a number").alias("error"))
    good, bad, counts = U.failure_isolation(rows)
    both = good.withColumn("error", F.lit(None).cast("string")).unionByName(bad)
    return both.join(counts, "campaign")


add("failure_isolation", "ITEMS", _split, f"select campaign, item, error, n_ok, n_failed, n_ok > 0 as touched from (select *, count(*) filter (error is null) over w as n_ok, count(error) over w as n_failed from (select collection as campaign, item, case when {_NUMBER} is null then 'not a number' end as error from v_items) window w as (partition by campaign))")
add(
    "id_collision_global",
    "ITEMS",
    lambda i: U.id_collision_global(U.id_register("NATION_5", i.withColumn("item", F.when(F.col("x0") % 31 == 0, F.concat_ws("_", "collection", "grp")).otherwise(F.col("item"))))),
    """select id, owner, f as first_owner from (select *, min(owner) over (partition by id) as f from (
      select distinct * from (select 'NATION_5' as id, 'root' as owner union all select collection, 'collection ' || collection from v_items union all select collection || '_' || grp, 'group ' || collection || '/' || grp from v_items
        union all select i, 'item ' || collection || '/' || grp || '/' || i from (select *, case when x0 % 31 = 0 then collection || '_' || grp else item end as i from v_items)))) where owner <> f""",
)


# Registries: campaigns of even years have their own
_OWN = {"dtm": (["FILLED"], ["masked"], [".TIF"]), "plain": (None, None, [".txt"]), "mosaic": (["mosaic"], ["cog"], [".tif"])}
_OWN_LABELS = {"plain": ("notes", ""), "mosaic": ("picture", "raster"), "dsm_masked": ("ignore", "raster")}


def _registry(files: DataFrame) -> DataFrame:
    spark = files.sparkSession
    rows = files.withColumn("campaign", F.regexp_extract("parent", C.DATE, 0))
    own = spark.createDataFrame([(_OWN, _OWN_LABELS)], "patterns map<string, struct<require:array<string>, forbid:array<string>, extensions:array<string>>>, labels map<string, struct<category:string, kind:string>>")
    settings = rows.select("campaign").distinct().where("cast(substr(campaign, 4, 1) as int) % 2 = 0").join(F.broadcast(own), F.lit(True))
    return G.products_by_settings(rows, settings).select("campaign", "parent", "name", "label", "category", "kind", "item", "native")


def _listed(values: list[str] | None) -> str:
    return "[" + ", ".join(f"'{v.lower()}'" for v in values or []) + "]::varchar[]"


_RULES = ", ".join(f"('{k}', {_listed(r)}, {_listed(f)}, {_listed(e)})" for k, (r, f, e) in _OWN.items())
add(
    "registry_products",
    "FILES",
    _registry,
    f"""select * from (with own as (select * from (values {_RULES}) t(label, req, forb, exts)),
      every as (select false as even, ord, label, req, forb, exts from pats union all select true, ord, label, req, forb, exts from pats where label not in (select label from own)
        union all select true, coalesce(p.ord, 100 + rank() over (order by p.ord is null, o.label)), o.label, o.req, o.forb, o.exts from own o left join pats p on p.label = o.label),
      kinds as (select false as even, * from labs union all select true, * from labs where label <> 'dsm_masked' union all select * from (values (true, 'dsm_masked', 'ignore', 'raster'), (true, 'plain', 'notes', ''), (true, 'mosaic', 'picture', 'raster'))),
      fits as (select f.*, e.label, e.ord, len(e.req) as n, x.ext, string_split(lower(name[:length(name) - length(x.ext)]), '_') as toks, e.req, e.forb from (select *, {_CAMPAIGN} as campaign from v_files) f
        join every e on e.even = (f.campaign[4:4]::int % 2 = 0), unnest(e.exts) as x(ext) where ends_with(lower(f.name), x.ext)),
      chosen as (select * from fits where list_has_all(toks, req) and not list_has_any(toks, forb) qualify row_number() over (partition by parent, name order by n desc, length(ext) desc, ord) = 1)
      select campaign, parent, name, c.label, category, kind, array_to_string(list_filter(string_split(name[:length(name) - length(ext)], '_'), lambda t: lower(t) <> 'cog'), '_') as item,
        case kind when 'pcl' then ext = '.copc.laz' else list_contains(toks, 'cog') end as native
      from chosen c join kinds k on k.label = c.label and k.even = (campaign[4:4]::int % 2 = 0) where category <> 'ignore')""",
)


# Streams: the files of the last run arrive, then those of this one


def _arrivals(content: DataFrame, seen: int) -> DataFrame:
    kind = F.length(F.regexp_extract("path", "^data/[^/]*", 0)) % 3
    name = F.concat(F.lit("p_"), F.when(kind == 0, "dtm").when(kind == 1, "dsm").otherwise("unknown"), F.lit("_"), F.regexp_extract("path", "([0-9]+)[.]txt$", 1), F.lit(".tif"))
    rows = _print(content).select("campaign", F.regexp_extract("path", "^(.*)/[^/]*$", 1).alias("parent"), name.alias("name"), F.col("size").alias("length"), "checksum")
    return rows.withColumn("seen", F.lit(seen).cast("long"))


def _incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs: what stood before, then what stands now; each file with the batches that made and last changed it."""
    path, folder = folders.shared_path(spark, "arrivals"), folders.shared_path(spark, "catalog_state")
    _arrivals(view(spark, sf_dir, "PREV"), 1).write.parquet(path)
    IncrementalCatalog(spark, folder).run(path)
    _arrivals(view(spark, sf_dir, "CONTENT"), 2).write.mode("append").parquet(path)
    return IncrementalCatalog(spark, folder).run(path).select("campaign", "parent", "name", "category", "length", "checksum", "created", "updated")


def _summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events in two arrivals, summed up by type after each."""
    path, folder = folders.shared_path(spark, "events"), folders.shared_path(spark, "summary")
    events = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", "event_type", "value")
    out = None
    for late in (False, True):
        events.where(F.col("event_id") % 3 == 0 if late else F.col("event_id") % 3 != 0).write.mode("append").parquet(path)
        out = RunningSummary(spark, path, "event_type", "value", folder).run()
    return out.withColumnRenamed("event_type", "campaign")


_KIND = "case length(regexp_extract(path, '^data/[^/]*')) % 3 when 0 then 'dtm' when 1 then 'dsm' else 'unknown' end"
QUERIES |= {"stream_incremental_catalog": _incremental, "stream_running_summary": _summary}
ORACLES |= {
    "stream_incremental_catalog": f"""with v_content as ({CONTENT}), v_prev as ({PREV}), last as (select coalesce(a.path, b.path) as path, case when a.content is null then b.content else a.content end as content,
        case when b.content is null then 1 else 0 end as created, case when a.content is null or a.content is not distinct from b.content then case when b.content is null then 1 else 0 end else 1 end as updated from {_BOTH})
      select split_part(path, '/', 2) as campaign, regexp_extract(path, '^(.*)/[^/]*$', 1) as parent, 'p_' || {_KIND} || '_' || regexp_extract(path, '([0-9]+)[.]txt$', 1) || '.tif' as name, {_KIND} as category,
        cast(strlen(content) as bigint) as length, '1220' || sha256(content) as checksum, cast(created as bigint) as created, cast(updated as bigint) as updated from last where content is not null and {_KIND} <> 'unknown'""",
    "stream_running_summary": "select event_type as campaign, count(*) as n, min(value) as vmin, max(value) as vmax from events where event_type is not null group by 1",
}
