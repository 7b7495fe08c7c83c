"""Upkeep of a snapshot: gates, sets, policies, corrections, and listings of directories."""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terracat.operators.snapshot import collection_extent
from terracat.sources.folders import shared_path


def config_digest(settings: DataFrame) -> DataFrame:
    """campaign, digest of settings (campaign, crs, labels map<string, ...>): of the keys alone that leave no trace on items.

    Labels are in order of their names, so the order they were written in does not matter; null and empty are alike.
    """
    labels = F.array_sort(F.map_entries("labels"))
    labels = F.when(F.size(labels) > 0, labels)
    return settings.select("campaign", F.sha2(F.to_json(F.struct("crs", labels.alias("labels"))), 256).alias("digest"))


def gate_digest_change(settings: DataFrame, stored: DataFrame) -> DataFrame:
    """campaign, digest, same: whether a campaign's digest (config_digest) is the one that was stored (campaign, digest) with its last run."""
    old = stored.select("campaign", F.col("digest").alias("was"))
    return config_digest(settings).join(old, "campaign", "left").select("campaign", "digest", F.col("digest").eqNullSafe(F.col("was")).alias("same"))


def shape_ok(kind: Column, roles: Column, media: Column, properties: Column) -> Column:
    """Whether a stored item has what its kind needs: the data role, a media type and the kind's own properties."""
    own = F.when(kind == "pcl", F.map_contains_key(properties, F.lit("pc:count"))).when(kind == "raster", F.map_contains_key(properties, F.lit("proj:shape"))).otherwise(True)
    return F.coalesce(F.array_contains(roles, "data"), F.lit(False)) & media.isNotNull() & F.coalesce(own, F.lit(False))


def gate_status(now: DataFrame, before: DataFrame, digests: DataFrame | None = None, forced: bool = False) -> DataFrame:
    """path, gate: reuse only what was known, unchanged, of the shape it should have, and under the settings it was built with.

    now and before: path, checksum. digests (campaign, same) with a campaign in now says which settings hold; without it,
    digests of both sides are compared where both have one. before may have shape_ok (null: not). Paths of before
    that now has not are stale.
    """
    has = lambda df, c: F.col(c) if c in df.columns else F.lit(None)
    a = now.select("path", F.lit(True).alias("here"), F.col("checksum").alias("is"), has(now, "campaign").cast("string").alias("campaign"), has(now, "digest").cast("string").alias("d_is"))
    shape = F.coalesce(F.col("shape_ok"), F.lit(False)) if "shape_ok" in before.columns else F.lit(True)
    b = before.select("path", F.lit(True).alias("known"), F.col("checksum").alias("was"), shape.alias("shape"), has(before, "digest").cast("string").alias("d_was"))
    both = a.join(b, "path", "full_outer")
    if digests is None:
        both = both.withColumn("same", F.col("d_is").eqNullSafe(F.col("d_was")))
    else:
        both = both.join(digests.select("campaign", "same"), "campaign", "left")
    reuse = F.col("known") & F.col("shape") & F.coalesce("same", F.lit(False)) & F.col("is").eqNullSafe(F.col("was")) & ~F.lit(forced)
    gate = F.when(F.col("here").isNull(), "stale").when(F.coalesce(reuse, F.lit(False)), "reuse").otherwise("rebuild")
    return both.select("path", gate.alias("gate"))


def gate_two_stage_hash(listed: DataFrame, stored: DataFrame, contents: DataFrame) -> DataFrame:
    """path, gate of files in both: `size` where sizes differ, else `same` or `content` by the hash.

    listed (path, length) is a listing, stored (path, length, checksum) what the last run kept; contents (path, content)
    is read for the paths of equal sizes alone, which come to its scan as a filter.
    """
    sizes = listed.select("path", "length").join(stored.select("path", F.col("length").alias("old"), "checksum"), "path")
    alike = sizes.where("length = old").select("path", "checksum")
    digest = F.concat(F.lit("1220"), F.sha2(F.col("content").cast("binary"), 256))
    hashed = contents.join(alike, "path").select("path", F.when(digest == F.col("checksum"), "same").otherwise("content").alias("gate"))
    return hashed.unionByName(sizes.where("length <> old").select("path", F.lit("size").alias("gate")))


def hash_files(listed: DataFrame, stored: DataFrame, folder: str) -> DataFrame:
    """gate_two_stage_hash of files below a folder: those of equal sizes are opened in tasks, a block at a time, and no others.

    listed (path relative to the folder, length), stored (path, length, checksum).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, at = fs.FileSystem.from_uri(folder)
        for b in batches:
            gates = []
            for path, checksum in zip(*[c.to_pylist() for c in b.columns], strict=True):
                digest = hashlib.sha256()
                with store.open_input_stream(f"{at.rstrip('/')}/{path}") as f:
                    while block := f.read(1 << 20):
                        digest.update(block)
                gates.append("same" if "1220" + digest.hexdigest() == checksum else "content")
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(gates, pa.string())], names=["path", "gate"])

    sizes = listed.select("path", "length").join(stored.select("path", F.col("length").alias("old"), "checksum"), "path")
    opened = sizes.where("length = old").select("path", "checksum").mapInArrow(run, "path string, gate string")
    return opened.unionByName(sizes.where("length <> old").select("path", F.lit("size").alias("gate")))


def set_member_change(now: DataFrame, before: DataFrame) -> DataFrame:
    """group, changed: whether members came, went or were altered. No group is gathered in one place."""
    a = now.select("group", "path", F.col("checksum").alias("is"))
    b = before.select("group", "path", F.col("checksum").alias("was"))
    return a.join(b, ["group", "path"], "full_outer").groupBy("group").agg(F.max(~F.col("is").eqNullSafe(F.col("was"))).alias("changed"))


def set_stale_keep(now: DataFrame, before: DataFrame) -> DataFrame:
    """path, parent, stale: current rows under their parent, stale ones under their old one (parent: the collection or
    group an item belongs to; without that column the way to the file)."""
    way = lambda df: F.col("parent") if "parent" in df.columns else F.regexp_extract("path", "^(.*)/[^/]*$", 1)
    gone = before.select("path", way(before).alias("parent")).join(now.select("path"), "path", "left_anti")
    return now.select("path", way(now).alias("parent"), F.lit(False).alias("stale")).unionByName(gone.select("path", "parent", F.lit(True).alias("stale")))


def orphan_parents(kept: DataFrame) -> DataFrame:
    """Parents that hold stale rows alone (kept: set_stale_keep's rows): they are made again for them, with how many."""
    return kept.groupBy("parent").agg(F.count("*").alias("n"), F.min("stale").alias("alone")).where("alone").select("parent", "n")


def stale_policy(now: DataFrame, before: DataFrame, policy: str = "warn") -> DataFrame:
    """warn keeps stale rows, remove drops them, raise fails if there are any."""
    if policy == "raise" and not before.join(now, "path", "left_anti").isEmpty():
        raise ValueError("stale items")
    kept = set_stale_keep(now, before)
    return kept if policy == "warn" else kept.where("not stale")


def provenance_stamp(now: DataFrame, before: DataFrame, moment: str) -> DataFrame:
    """created survives; updated moves on a change only. before: path, checksum, created, updated."""
    b = before.select("path", F.col("checksum").alias("was"), "created", "updated")
    stamp = F.lit(moment).cast("date")
    same = F.col("checksum").eqNullSafe(F.col("was"))
    return now.select("path", "checksum").join(b, "path", "left").select("path", F.coalesce("created", stamp).alias("created"), F.when(same, F.col("updated")).otherwise(stamp).alias("updated"))


def set_extent_children(items: DataFrame) -> DataFrame:
    """Extents of collections from their own items and their groups' items, and of the groups."""
    groups = items.withColumn("collection", F.concat_ws("/", "collection", "grp"))
    return collection_extent(items.unionByName(groups))


def failure_isolation(rows: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """rows (campaign, error, ...) -> good rows, bad rows and counts (campaign, n_ok, n_failed, touched).

    A bad row takes nothing else with it. A campaign without any good row stays untouched: it has no good rows, so
    nothing of what was known of it changes. Good rows lose the column error.
    """
    counts = rows.groupBy("campaign").agg(F.count_if(F.col("error").isNull()).alias("n_ok"), F.count("error").alias("n_failed")).withColumn("touched", F.col("n_ok") > 0)
    return rows.where("error is null").drop("error"), rows.where("error is not null"), counts


def restate_masked_moments(mean: Column, sd: Column, share: Column) -> tuple[Column, Column]:
    """Moments over valid cells from moments in which invalid cells counted as zero."""
    new = mean / share
    return new, F.sqrt(F.greatest((sd * sd + mean * mean) / share - new * new, F.lit(0.0)))


def group_title(prods: DataFrame) -> DataFrame:
    """Title of each group: its name if it mixes categories."""
    out = prods.groupBy("group").agg(F.min("category").alias("a"), F.max("category").alias("b"))
    return out.select("group", F.when(F.col("a") == F.col("b"), F.concat(F.col("a"), F.lit(" tiles"))).otherwise(F.col("group")).alias("title"))


def id_collision_global(register: DataFrame, policy: str = "warn") -> DataFrame:
    """register (id, owner) -> id, owner, first_owner of all but the first owner of an id.

    The register holds the ids of the root, of collections, groups and items alike (id_register); with policy raise the
    least collision is an error.
    """
    first = register.groupBy("id").agg(F.min("owner").alias("first_owner"))
    out = register.distinct().join(first, "id").where("owner <> first_owner").select("id", "owner", "first_owner")
    if policy == "raise":
        least = out.orderBy("id", "owner").first()
        if least is not None:
            raise ValueError(f"id {least['id']} of {least['owner']} is taken by {least['first_owner']}")
    return out


def id_register(root: str, items: DataFrame) -> DataFrame:
    """id, owner of all that has an id in the catalog: the root, collections, groups and items (collection, grp or null, item).

    An owner tells what it is and where: `root`, `collection C`, `group C/G`, `item C/G/I`.
    """
    one = items.sparkSession.createDataFrame([(root, "root")], "id string, owner string")
    collections = items.select(F.col("collection").alias("id"), F.concat(F.lit("collection "), "collection").alias("owner")).distinct()
    groups = items.where("grp is not null").select(F.concat_ws("_", "collection", "grp").alias("id"), F.concat(F.lit("group "), "collection", F.lit("/"), "grp").alias("owner")).distinct()
    own = items.select(F.col("item").alias("id"), F.concat(F.lit("item "), F.concat_ws("/", "collection", "grp", "item")).alias("owner"))
    return one.unionByName(collections).unionByName(groups).unionByName(own)


def orphan_files(listed: DataFrame, referenced: DataFrame) -> DataFrame:
    """path of listed files that nothing refers to, once each."""
    return listed.select("path").distinct().join(referenced.select("path"), "path", "left_anti")


def skip_existing_outputs(wanted: DataFrame, existing: DataFrame, on: list[str]) -> DataFrame:
    """wanted outputs that are not there yet, by their names or places."""
    return wanted.join(existing.select(on).distinct(), on, "left_anti")


def dir_ext_share(own: DataFrame) -> DataFrame:
    """own (dir, ext, files) -> dir, shares: extensions by falling share."""
    total = own.groupBy("dir").agg(F.sum("files").alias("total"))
    pct = F.when(F.col("files") * 100 < F.col("total"), "<1%").otherwise(F.concat(F.round(F.col("files") * 100.0 / F.col("total")).cast("int").cast("string"), F.lit("%")))
    rows = own.join(total, "dir").select("dir", F.struct((-F.col("files")).alias("k"), "ext", F.concat_ws(" ", "ext", pct).alias("t")).alias("s"))
    return rows.groupBy("dir").agg(F.array_join(F.transform(F.array_sort(F.collect_list("s")), lambda s: s["t"]), ", ").alias("shares"))


def summarize_dirs(names: DataFrame, shares: DataFrame, threshold: int) -> DataFrame:
    """names (dir, name) -> dir, names, shares: directories of at least `threshold` files show the shares of their
    extensions (shares: dir, shares), others their sorted names. Only names of small directories are gathered."""
    total = names.groupBy("dir").agg(F.count("*").alias("n"))
    few = names.join(total.where(F.col("n") < threshold), "dir", "left_semi").groupBy("dir").agg(F.array_join(F.sort_array(F.collect_list("name")), ", ").alias("names"))
    many = total.where(F.col("n") >= threshold).select("dir").join(shares, "dir")
    none = F.lit(None).cast("string")
    return few.withColumn("shares", none).unionByName(many.withColumn("names", none))


def stale_collections(previous: DataFrame, current: DataFrame, filtered: bool = False, failed: bool = False) -> DataFrame:
    """Collections (collection) of the last run without a campaign in this one, and whether they are acted on.

    A run over some campaigns alone says nothing of the others; after a failure they are only told.
    """
    gone = previous.select("collection").distinct().join(current.select("collection").distinct(), "collection", "left_anti")
    return gone.where(F.lit(not filtered)).withColumn("acted", F.lit(not failed))


def max_listed(names: DataFrame, most: int = 3) -> DataFrame:
    """names (dir, name): the first names of each directory and how many more there are, without gathering the rest."""
    from pyspark.sql.window import Window

    # The first names of parts of a directory, then of those: a large directory is dealt over many tasks.
    first = lambda *by: F.row_number().over(Window.partitionBy(*by).orderBy("name"))
    few = names.withColumn("part", F.pmod(F.xxhash64("name"), F.lit(64))).withColumn("rn", first("dir", "part")).where(F.col("rn") <= most)
    ranked = few.withColumn("rn", first("dir")).where(F.col("rn") <= most)
    shown = ranked.groupBy("dir").agg(F.array_join(F.sort_array(F.collect_list("name")), ", ").alias("shown"))
    total = names.groupBy("dir").agg(F.count("*").alias("n"))
    more = F.when(F.col("n") > most, F.concat(F.col("shown"), F.lit(" ("), (F.col("n") - most).cast("string"), F.lit(" more)"))).otherwise(F.col("shown"))
    return shown.join(total, "dir").select("dir", more.alias("listed"))


#: Side of the square blocks, in tiles, in which tile_runt_merge begins.
BLOCK = 512
_GROUPS = "dataset string, id string, size long, col long, row long, top_size long, top string, beside array<string>, gone_to string, merged_into string"
_ROWS = pa.schema([(c.split()[0], {"string": pa.string(), "long": pa.int64()}.get(c.split()[1], pa.list_(pa.string()))) for c in _GROUPS.split(", ")])


def _written(df: DataFrame, label: str) -> DataFrame:
    path = shared_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _merge_block(threshold: int):
    """Merges within one block that no group outside can influence, in the order of a single pass over the dataset."""

    def merge(frame: pd.DataFrame) -> pd.DataFrame:
        out = frame.sort_values("id", ignore_index=True)
        ids, size, k = out["id"].tolist(), out["size"].tolist(), len(out)
        at = dict(zip(ids, range(k), strict=True))
        beside = [{at[n] for n in near if n in at} for near in out["beside"]]
        outer = [[n for n in near if n not in at] for near in out["beside"]]
        shut = bytearray(map(bool, outer))  # beside a group that is elsewhere or has to wait
        gone = list(range(k))
        order = lambda i: size[i] * k + i  # noqa: E731  (by size, then by id)
        todo = [order(i) for i in range(k) if size[i] < threshold]
        heapq.heapify(todo)
        while todo:
            n, small = divmod(heapq.heappop(todo), k)
            if gone[small] != small or size[small] != n or not beside[small]:
                continue
            # All that come earlier have gone or wait. One that waits does so to the end: nothing beside it or next to that can go.
            if shut[small] or any(shut[i] for i in beside[small]):
                for i in beside[small]:
                    shut[i] = 1
                continue
            into = min(beside[small], key=order)
            gone[small] = into
            size[into] += n
            for other in beside[small]:
                beside[other].discard(small)
                if other != into:
                    beside[other].add(into)
                    beside[into].add(other)
            beside[small] = set()
            if size[into] < threshold:
                heapq.heappush(todo, order(into))
        end = np.array(gone, dtype=np.int64)
        while (end[end] != end).any():
            end = end[end]
        out["size"] = size
        # Two groups that are large enough have no more to do with each other; this is left to a round that has both.
        out["beside"] = [sorted(ids[j] for j in beside[i] if size[i] < threshold or size[j] < threshold) + outer[i] for i in range(k)]
        out["gone_to"] = [None if i == j else ids[j] for i, j in enumerate(end.tolist())]
        return out

    return merge


def _merge_round(threshold: int):
    """One round within a block: merges, and the largest tile (top) of groups; those without neighbours are settled (merged_into)."""
    merge = _merge_block(threshold)

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        out = merge(frame)
        end = out["gone_to"].where(out["gone_to"].notna(), out["id"])
        tops = out[["top_size", "top"]].assign(end=end).sort_values(["top_size", "top"], ascending=[False, True]).drop_duplicates("end").set_index("end")
        out["top_size"], out["top"] = end.map(tops["top_size"]), end.map(tops["top"])
        out["merged_into"] = out["top"].where(~end.isin(out["id"][out["beside"].map(len) > 0]))
        return out[_ROWS.names]

    return run


def _components(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least of the nodes 0 to n - 1 that each is linked with by the links a, b."""
    least = np.arange(n)
    while True:
        a, b = least[a], least[b]
        apart = a != b
        if not apart.any():
            return least
        a, b = a[apart], b[apart]
        np.minimum.at(least, np.maximum(a, b), np.minimum(a, b))
        while (least[least] != least).any():
            least = least[least]


def _first_round(threshold: int, side: int):
    """The first round within a block of tiles: c, r from 1 to side are its own, 0 and side + 1 those of others beside them."""
    merge = _merge_round(threshold)

    def links(code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of tiles side by side, of the sorted numbers of their places."""
        a, b = [], []
        for step in (1, side + 2):
            low, high = (np.searchsorted(code, code + step, where) for where in ("left", "right"))
            n = high - low  # several tiles may have one place
            a.append(np.repeat(np.arange(len(code)), n))
            b.append(np.arange(n.sum()) + np.repeat(low - np.cumsum(n) + n, n))
        return np.concatenate(a), np.concatenate(b)

    def run(table: pa.Table) -> pa.Table:
        table, n = table.combine_chunks(), table.num_rows
        known = np.logical_and.reduce([table[c].is_valid().to_numpy() for c in ("size", "c", "r")])  # without a size or a place a tile has no neighbour
        size, c, r = (pc.fill_null(table[c], 0).to_numpy() for c in ("size", "c", "r"))
        own = ~known | ((c >= 1) & (c <= side) & (r >= 1) & (r <= side))
        code = c * (side + 2) + r
        placed = np.flatnonzero(known)
        placed = placed[np.argsort(code[placed], kind="stable")]
        a, b = (placed[x] for x in links(code[placed]))
        kept = (own[a] | own[b]) & ((size[a] < threshold) | (size[b] < threshold))
        a, b = a[kept], b[kept]
        within = own[a] & own[b]
        part = _components(n, a[within], b[within])
        opened, linked = np.zeros(n, bool), np.zeros(n, bool)
        opened[part[a[~within]]] = opened[part[b[~within]]] = True
        linked[a] = linked[b] = True
        # Tiles that are too small even together, with none beside them, all end in one group, whose largest names it.
        whole = ~opened[part] & (np.bincount(part, weights=np.maximum(size, 0), minlength=n)[part] < threshold)
        some, rest = np.flatnonzero(own & linked & whole), np.flatnonzero(own & linked & ~whole)
        into = np.arange(n)
        if len(some):
            some = some[np.lexsort((pc.rank(table["id"].take(some), tiebreaker="dense").to_numpy(), -size[some], part[some]))]
            first = np.r_[True, np.diff(part[some]) != 0]
            into[some] = some[first][np.cumsum(first) - 1]
        done = np.flatnonzero(own & ~(linked & ~whole))
        settled = {"dataset": table["dataset"].take(done), "id": table["id"].take(done), "merged_into": table["id"].take(into[done])}
        tables = [pa.table([settled.get(f.name, pa.nulls(len(done), f.type)) for f in _ROWS], schema=_ROWS)]
        if len(rest):
            ends = np.concatenate([a, b]), np.concatenate([b, a])
            order = np.argsort(ends[0], kind="stable")
            near = table["id"].take(ends[1][order]).to_numpy()
            cuts = (np.searchsorted(ends[0][order], rest, where) for where in ("left", "right"))
            frame = table.select(["dataset", "id", "size", "col", "row"]).take(rest).to_pandas()
            frame = frame.assign(top_size=frame["size"], top=frame["id"], beside=[near[i:j].tolist() for i, j in zip(*cuts, strict=True)])
            tables.append(pa.Table.from_pandas(merge(frame), schema=_ROWS, preserve_index=False))
        return pa.concat_tables(tables)

    return run


def _shifted(c: str, side: Column, number: int) -> Column:
    """Column or row c counted from where a round's blocks of this side begin; each round moves them."""
    half, quarter = F.floor(side / 2), F.floor(side / 4)
    return F.col(c) + (F.lit(0), half, quarter, side - quarter)[(number + (c == "row")) % 4]


def _blocks(side: Column, number: int) -> dict[str, Column]:
    return {f"b{c}": F.floor(_shifted(c, side, number) / side) for c in ("col", "row")}


def _bordered(tiles: DataFrame, side: int, number: int) -> DataFrame:
    """Tiles by block (bcol, brow) with their place in it (c, r, from 1), those on its border also in the block next to it."""
    at = tiles.withColumns(_blocks(F.lit(side), number)).withColumns({c[0]: F.pmod(_shifted(c, F.lit(side), number), F.lit(side)) for c in ("col", "row")})
    to = lambda c, r: F.struct(F.lit(c).alias("c"), F.lit(r).alias("r"))
    inner = F.col("c").between(1, side - 2) & F.col("r").between(1, side - 2)
    ends = [F.when(F.col(k) == at_, to(*d)) for k, at_, d in (("c", 0, (-1, 0)), ("c", side - 1, (1, 0)), ("r", 0, (0, -1)), ("r", side - 1, (0, 1)))]
    copies = at.withColumn("to", F.explode(F.when(inner, F.array(to(0, 0))).otherwise(F.array_compact(F.array(to(0, 0), *ends)))))
    spread = F.pmod(F.xxhash64("id"), F.lit(1024))  # tiles without a place
    return copies.select(
        "dataset", "id", "size", "col", "row", *[(F.col(k) - F.col(f"to.{k}") * side + 1).alias(k) for k in ("c", "r")],
        *[F.coalesce(F.col(b) + F.col(f"to.{b[1]}"), spread).alias(b) for b in ("bcol", "brow")],
    )


def tile_runt_merge(tiles: DataFrame, threshold: int) -> DataFrame:
    """tiles (dataset, name, size, col, row) + merged_into: small tiles join a neighbour until none is too small.

    Order rule: of the groups of a dataset below the threshold with a neighbour the smallest joins its smallest
    neighbour; a group's first tile breaks ties. A group that is the least of all groups up to two steps away takes
    that step whatever happens elsewhere, so such groups are merged side by side, with the same result: the first round
    parts the plane into blocks and takes all such steps within each. Groups that are large enough and beside no smaller
    one are settled; later rounds hold only the others, in shifted blocks that are as wide as lets none hold more than a
    quarter of BLOCK x BLOCK groups, BLOCK at least. Four rounds without a change double that, so a task outgrows it only where
    groups have grown wider. Every round is a written table. Names are unique within a dataset, sizes not negative.
    """
    kinds = {"dataset": "string", "size": "long", "col": "long", "row": "long"}
    base = tiles.select(F.col("name").alias("id"), *[F.col(c).cast(t).alias(c) for c, t in kinds.items()])
    least, number, left, stalled = BLOCK, 1, None, 0
    keys = "dataset", "bcol", "brow"
    rounds = [_written(_bordered(base, least, number).groupBy(*keys).applyInArrow(_first_round(threshold, least), _GROUPS), "groups")]
    while True:
        groups = rounds[-1].where("merged_into is null and gone_to is null")
        number += 1
        sides = groups.withColumn("side", F.explode(F.array(*[F.lit(least << k) for k in range(7)])))
        loads = sides.withColumns(_blocks(F.col("side"), number)).groupBy("side", *keys).count()
        full = {r["side"]: (r["most"], r["n"]) for r in loads.groupBy("side").agg(F.max("count").alias("most"), F.sum("count").alias("n")).collect()}
        if not full:
            break
        stalled = stalled + 1 if left == full[least][1] else 0
        left = full[least][1]
        if stalled == 4:
            least, stalled = 2 * least, 0
        side = max([s for s, (most, _) in full.items() if s >= least and most <= BLOCK * BLOCK // 4], default=least)
        keyed = groups.withColumns(_blocks(F.lit(side), number))
        rounds.append(_written(keyed.groupBy(*keys).applyInPandas(_merge_round(threshold), _GROUPS), "groups"))
    # What was not settled in a round is looked up among the ends of the rounds after it.
    ends = None
    for done in reversed(rounds):
        settled = done.where("merged_into is not null").select("dataset", "id", "merged_into")
        if ends is not None:
            later = _written(ends, "ends").select(F.col("dataset").alias("in"), F.col("id").alias("end"), "merged_into")
            moved = done.where("merged_into is null").select("dataset", "id", F.coalesce("gone_to", "id").alias("end"))
            settled = settled.union(moved.join(later, F.col("dataset").eqNullSafe(F.col("in")) & (moved["end"] == later["end"])).select("dataset", "id", "merged_into"))
        ends = settled
    return ends.withColumnRenamed("id", "name")
