"""Footprints of masks: connected regions, specks, parts and holes, outlines.

A mask has (item, gx, gy, valid), one row for each cell of an item's grid, with 0 <= gx < 2**20. Cells of a null item
or place are left out; a null valid is false; of repeated cells a valid one counts. Regions are labelled block by block and
joined across the blocks' borders, contracted in rounds of written tables: no task holds more than a block of a mask.
"""

from __future__ import annotations

import heapq
from collections import defaultdict
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from terracat.functions.projections import to_degrees
from terracat.operators.upkeep import _written

#: Square metres of the smallest part and the smallest hole.
PART_M2, HOLE_M2 = 4000.0, 1000.0
#: Cells on a side of the blocks that are labelled in one go.
BLOCK = 512
#: Sides of a cell as edges (x0, y0, x1, y1) from its place, the cell on their right: above, after, below, before.
SIDES = np.array([(0, 0, 1, 0), (1, 0, 1, 1), (1, 1, 0, 1), (0, 1, 0, 0)])
RINGS = pa.schema([("item", pa.string()), ("part", pa.int64()), ("ring", pa.int64()), ("hole", pa.bool_()), ("cells", pa.int64()), ("corners", pa.string())])


def _row():
    return Window.partitionBy("item", "gy").orderBy("gx")


def _column():
    return Window.partitionBy("item", "gx").orderBy("gy")


def _dealt(small: DataFrame) -> DataFrame:
    """A table that grows with the masks, for a join: its file is small beside its rows, which would all go to the driver to be broadcast."""
    return small.hint("merge")


def _key() -> Column:
    return F.col("gy").cast("long") * (1 << 20) + F.col("gx").cast("long")


def roots(links: DataFrame) -> DataFrame:
    """links (item, a long, b long) -> item, node, root: the smallest node reachable, for nodes with links.

    Each round hooks every node to its smallest neighbour, follows the hooks once and renames the links' ends; the
    rounds' hooks are joined in the end.
    """
    edges = _written(links.where("a <> b").select("item", "a", "b").distinct(), "links")
    hooks = []
    while not edges.isEmpty():
        both = edges.unionByName(edges.select("item", F.col("b").alias("a"), F.col("a").alias("b")))
        hook = both.groupBy("item", "a").agg(F.least("a", F.min("b")).alias("to"))
        up = hook.select("item", F.col("a").alias("to"), F.col("to").alias("further"))
        hook = _written(hook.join(_dealt(up), ["item", "to"]).select("item", "a", F.col("further").alias("to")), "hooks")
        hooks.append(hook)
        for end in ("a", "b"):
            edges = edges.join(_dealt(hook.select("item", F.col("a").alias(end), "to")), ["item", end]).drop(end).withColumnRenamed("to", end)
        edges = _written(edges.where("a <> b").select("item", F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
    if not hooks:
        return edges.select("item", F.col("a").alias("node"), F.col("b").alias("root"))
    found = hooks[0].select("item", F.col("a").alias("node"), F.col("to").alias("root"))
    for hook in hooks[1:]:  # as many as the logarithm of the largest region
        up = hook.select("item", F.col("a").alias("root"), "to")
        found = found.join(_dealt(up), ["item", "root"], "left").select("item", "node", F.coalesce("to", "root").alias("root"))
    return found


def _beside(along, at: str, value: str) -> Column:
    """The value of the cell before along a row or column, null if there is none."""
    return F.when(F.lag(at).over(along) == F.col(at) - 1, F.lag(value).over(along))


def labels(valid: np.ndarray) -> np.ndarray:
    """Of a grid (1 valid, 0 not, -1 no cell) each cell's four-connected region of equal values, as its smallest place in row order.

    Every round hooks the labels of neighbours to the smaller one and follows the hooks until nothing moves.
    """
    n, width = valid.size, valid.shape[1]
    place = np.arange(n).reshape(valid.shape)
    across, down = (valid[:, 1:] == valid[:, :-1]) & (valid[:, 1:] >= 0), (valid[1:] == valid[:-1]) & (valid[1:] >= 0)
    a = np.concatenate((place[:, :-1][across], place[:-1][down]))
    b = np.concatenate((a[: across.sum()] + 1, a[across.sum() :] + width))
    root = np.arange(n)
    while True:
        x, y = root[a], root[b]
        apart = x != y
        if not apart.any():
            return root.reshape(valid.shape)
        a, b = a[apart], b[apart]
        np.minimum.at(root, np.maximum(x, y)[apart], np.minimum(x, y)[apart])
        while not np.array_equal(up := root[root], root):
            root = up


def _block(frame: pd.DataFrame) -> pd.DataFrame:
    """Cells of one block with their region within it, named by its smallest cell."""
    x0, y0 = int(frame["gx"].min()), int(frame["gy"].min())
    x, y = frame["gx"].to_numpy() - x0, frame["gy"].to_numpy() - y0
    grid = np.full((int(y.max()) + 1, int(x.max()) + 1), -1, dtype=np.int8)
    np.maximum.at(grid, (y, x), frame["valid"].to_numpy().astype(np.int8))  # of repeated cells a valid one counts
    y, x = np.nonzero(grid >= 0)
    root = labels(grid)[y, x]
    key = (root // grid.shape[1] + y0) * (1 << 20) + root % grid.shape[1] + x0
    return pd.DataFrame({"item": frame["item"].iloc[0], "gx": x + x0, "gy": y + y0, "valid": grid[y, x] == 1, "region": key})


def regions(mask: DataFrame, block: int = BLOCK) -> DataFrame:
    """item, gx, gy, valid, region: four-connected cells of equal valid share a region, the smallest of their keys gy * 2**20 + gx.

    Square blocks of so many cells a side are labelled each in one go; regions that meet across blocks' borders are
    then joined by their labels. A task holds one block; grids of one block need no joins of borders. The result is a written table.
    """
    cells = mask.where("item is not null and gx is not null and gy is not null")
    cells = cells.select(F.col("item"), F.col("gx").cast("long").alias("gx"), F.col("gy").cast("long").alias("gy"), F.coalesce("valid", F.lit(False)).alias("valid"))
    kind = cells.schema["item"].dataType.simpleString()
    at = cells.withColumns({"bx": F.floor(F.col("gx") / block), "by": F.floor(F.col("gy") / block)})
    made = at.groupBy("item", "bx", "by").applyInPandas(_block, f"item {kind}, gx long, gy long, valid boolean, region long")
    blocks = _written(made, "blocks")
    edge = blocks.where((F.col("gx") % block == 0) | (F.col("gx") % block == block - 1) | (F.col("gy") % block == 0) | (F.col("gy") % block == block - 1))
    before = edge.select("item", "gx", "gy", "valid", F.col("region").alias("b"))
    over = []
    for c, d in (("gx", "gy"), ("gy", "gx")):
        after = edge.where((F.col(c) % block == 0) & (F.col(c) > 0)).select("item", (F.col(c) - 1).alias(c), d, "valid", F.col("region").alias("a"))
        over.append(after.join(_dealt(before), ["item", "gx", "gy", "valid"]).select("item", "a", "b"))
    links = _written(over[0].unionByName(over[1]).distinct(), "borders")
    if links.isEmpty():
        return blocks
    root = roots(links).select("item", F.col("node").alias("region"), "root")
    return _written(blocks.join(_dealt(root), ["item", "region"], "left").select("item", "gx", "gy", "valid", F.coalesce("root", "region").alias("region")), "regions")


def footprint_components(mask: DataFrame, least: int) -> DataFrame:
    """mask (item, gx, gy) -> item, gx, gy, part, cells: four-connected parts of at least so many cells; part is the smallest cell's key gy * 2**20 + gx."""
    cells = regions(mask.select("item", "gx", "gy", F.lit(True).alias("valid")))
    large = cells.groupBy("item", "region").agg(F.count("*").alias("cells")).where(F.col("cells") >= least)
    return cells.join(_dealt(large), ["item", "region"]).select("item", "gx", "gy", F.col("region").alias("part"), "cells")


def absorb_specks(mask: DataFrame, least: int) -> DataFrame:
    """mask with regions of fewer than so many cells, valid or not, given to their largest neighbour (ties: the smaller key).

    Where that is a speck itself, its own largest neighbour is asked, and so on; two specks that are each other's
    largest neighbours stay as they are.
    """
    cells = regions(mask)
    size = _written(cells.groupBy("item", "region").agg(F.count("*").alias("cells"), F.first("valid").alias("valid")), "sizes")
    specks = size.where(F.col("cells") < least).select("item", "region")
    met = [cells.select("item", F.col("region").alias("a"), _beside(w, at, "region").alias("b")) for w, at in ((_row(), "gx"), (_column(), "gy"))]
    met = met[0].unionByName(met[1]).where("a <> b").distinct()
    met = met.unionByName(met.select("item", F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    largest = met.join(_dealt(size.select("item", F.col("region").alias("b"), "cells")), ["item", "b"]).groupBy("item", "a").agg(F.max(F.struct("cells", (-F.col("b")).alias("k"))).alias("m"))
    asks = _written(specks.join(_dealt(largest.select("item", F.col("a").alias("region"), (-F.col("m.k")).alias("to"))), ["item", "region"]), "specks")
    # Every step leads to a larger region or back to where it came from, so only pairs can be cycles.
    back = asks.select("item", F.col("region").alias("to"), F.col("to").alias("region"))
    asks = _written(asks.join(_dealt(back), ["item", "region", "to"], "left_anti"), "specks")
    while True:
        up = asks.select("item", F.col("region").alias("to"), F.col("to").alias("further"))
        if asks.join(_dealt(up), ["item", "to"], "left_semi").isEmpty():
            break
        asks = _written(asks.join(_dealt(up), ["item", "to"], "left").select("item", "region", F.coalesce("further", "to").alias("to")), "specks")
    given = asks.join(_dealt(size.select("item", F.col("region").alias("to"), F.col("valid").alias("given"))), ["item", "to"]).select("item", "region", "given")
    return cells.join(_dealt(given), ["item", "region"], "left").select("item", "gx", "gy", F.coalesce("given", "valid").alias("valid"))


def footprint_regions(mask: DataFrame, cell_m2: float, part_m2: float = PART_M2, hole_m2: float = HOLE_M2) -> DataFrame:
    """Cells of the parts that are kept: item, gx, gy, part.

    Specks are absorbed first. Parts of less than part_m2 go; of the invalid regions that don't touch the grid's edge,
    those under hole_m2 belong to the part around them and the others stay holes. part is the key of the part's
    smallest cell.
    """
    least = max(1, int(min(part_m2, hole_m2) / cell_m2))
    cells = regions(absorb_specks(mask, least))
    edge = cells.groupBy("item").agg(*[f(c).alias(f"{f.__name__}_{c}") for f in (F.min, F.max) for c in ("gx", "gy")])
    outside = F.col("gx").isin(F.col("min_gx"), F.col("max_gx")) | F.col("gy").isin(F.col("min_gy"), F.col("max_gy"))
    size = _written(cells.join(_dealt(edge), "item").groupBy("item", "region", "valid").agg(F.count("*").alias("cells"), F.max(outside).alias("open")), "sizes")
    area = F.col("cells") * cell_m2
    kept = size.where(F.col("valid") & (area >= part_m2)).select("item", "region", F.col("region").alias("part"))
    small = size.where(~F.col("valid") & ~F.col("open") & (area < hole_m2)).select("item", "region")
    # The cell above a hole's smallest cell lies in the part around it.
    around = cells.select("item", F.col("region").alias("part"), (_key() + (1 << 20)).alias("region"))
    filled = _dealt(small).join(around, ["item", "region"]).join(_dealt(kept.select("item", "part")), ["item", "part"], "left_semi").select("item", "region", "part")
    return cells.join(_dealt(kept.unionByName(filled)), ["item", "region"]).select("item", "gx", "gy", "part")


def _outlines(item: np.ndarray, part: np.ndarray, gx: np.ndarray, gy: np.ndarray, free: np.ndarray) -> list[tuple]:
    """Rows of footprint_rings for the boundary cells of whole parts, part after part; bit k of free: side k of SIDES is open."""
    starts = np.concatenate(([True], (item[1:] != item[:-1]) | (part[1:] != part[:-1])))
    cell, side = np.nonzero((free[:, None] >> np.arange(4)) & 1)
    own = np.cumsum(starts)[cell] - 1
    x0, y0, x1, y1 = (v[cell] + SIDES[side, k] for k, v in enumerate((gx, gy, gx, gy)))
    order = np.lexsort((y0, x0, own))
    own, x0, y0, x1, y1 = own[order], x0[order], y0[order], x1[order], y1[order]
    # Edges by the number of the place they start from; one edge leaves a place, or two where parts touch at a corner.
    fresh = np.concatenate(([True], (own[1:] != own[:-1]) | (x0[1:] != x0[:-1]) | (y0[1:] != y0[:-1])))
    ends = np.lexsort((y1, x1, own))  # as many edges end in each place as leave it
    to = np.empty(len(own), dtype=np.int64)
    to[ends] = np.flatnonzero(fresh)[np.cumsum(fresh) - 1]
    dx, dy = x1 - x0, y1 - y0
    second = np.minimum(to + 1, len(own) - 1)
    two = ~fresh[second] & (second > to)
    right = (x1[second] == x1 - dy) & (y1[second] == y1 + dx)  # where parts touch at a corner each keeps to itself
    after = np.where(two & right, second, to).tolist()
    seen, chain, heads = bytearray(len(after)), [], []
    for edge in range(len(after)):
        if not seen[edge]:
            heads.append(len(chain))
            while not seen[edge]:
                seen[edge] = 1
                chain.append(edge)
                edge = after[edge]
    chain, heads = np.array(chain), np.array(heads)
    ring = np.repeat(np.arange(len(heads)), np.diff(np.append(heads, len(chain))))
    before = np.arange(len(chain)) - 1
    before[heads] = np.append(heads[1:], len(chain)) - 1
    turns = (dx[chain] != dx[chain][before]) | (dy[chain] != dy[chain][before])
    chain, ring = chain[turns], ring[turns]
    x, y = x0[chain], y0[chain]
    heads = np.flatnonzero(np.concatenate(([True], ring[1:] != ring[:-1])))
    bounds = np.append(heads, len(ring))
    ahead = np.arange(len(ring)) + 1
    ahead[bounds[1:] - 1] = heads
    area = np.add.reduceat(x * y[ahead] - y * x[ahead], heads) // 2
    corners = [f"{a},{b}" for a, b in zip(x.tolist(), y.tolist(), strict=True)]
    of = own[chain[heads]]
    found = sorted((k, a < 0, " ".join(corners[i:j]), abs(a)) for k, a, i, j in zip(of.tolist(), area.tolist(), bounds[:-1].tolist(), bounds[1:].tolist(), strict=True))
    item, part = item[starts], part[starts]
    out, number = [], 0
    for n, (k, hole, text, cells) in enumerate(found):
        number = number + 1 if n and found[n - 1][0] == k else 0
        out.append((item[k], part[k], number, hole, cells, text))
    return out


def _rings(chunk: int):
    """Boundary cells sorted by (item, part) to rings: parts are gathered to chunks of about so many cells; a task holds a chunk or a part."""

    def made(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(held)
        item, part = (np.array(table[c].to_pylist() + [None], dtype=object)[:-1] for c in ("item", "part"))
        rows = _outlines(item, part, *(table[c].to_numpy() for c in ("gx", "gy", "free")))
        return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*rows, strict=True), RINGS, strict=True)], schema=RINGS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n, last = [], 0, None
        for batch in batches:
            if not batch.num_rows:
                continue
            items, parts = batch.column("item").to_pylist(), batch.column("part").to_pylist()
            cut = len(items) - 1  # where the last part of the batch begins
            while cut and (items[cut - 1], parts[cut - 1]) == (items[-1], parts[-1]):
                cut -= 1
            if n + cut >= chunk and (cut or (items[0], parts[0]) != last):
                yield made([*held, batch.slice(0, cut)])
                held, n, batch = [], 0, batch.slice(cut)
            held.append(batch)
            n += batch.num_rows
            last = items[-1], parts[-1]
        if held:
            yield made(held)

    return run


def footprint_rings(parts: DataFrame, edge: int = 2048, chunk: int = 100_000) -> DataFrame:
    """parts (item, gx, gy, part) -> item, part, ring, hole, cells, corners: the outline of each part (ring 0 and, where
    it touches itself at corners, others) and of its holes; cells is the area inside, corners 'x,y' in order.

    Grids may be of so many cells on a side at most, so a task holds the boundary of a part of that grid; larger ones
    raise an error. chunk: boundary cells of several parts that are outlined at once; the result does not depend on it.
    """
    parts = _written(parts, "parts")  # read for the span too
    span = parts.groupBy("item").agg(F.greatest(F.max("gx") - F.min("gx"), F.max("gy") - F.min("gy")).alias("span"))
    checked = span.select("item", F.assert_true(F.col("span") < edge, F.lit(f"a grid of more than {edge} cells on a side")).isNull().alias("fits"))
    cells = parts.join(_dealt(checked), "item").where("fits")
    side = lambda w, at, f, d: ~F.coalesce((f(at).over(w) == F.col(at) + d) & (f("part").over(w) == F.col("part")), F.lit(False))
    sides = (side(_column(), "gy", F.lag, -1), side(_row(), "gx", F.lead, 1), side(_column(), "gy", F.lead, 1), side(_row(), "gx", F.lag, -1))
    free = reduce(Column.__add__, [F.when(open_, 1 << k).otherwise(0) for k, open_ in enumerate(sides)])
    kept = F.col("item").cast("string").alias("item"), F.col("part").cast("long").alias("part"), F.col("gx").cast("long").alias("gx"), F.col("gy").cast("long").alias("gy")
    rim = cells.select(*kept, free.cast("int").alias("free")).where("free > 0")
    # By part, not by grid; parts are small beside what a group of its own costs in Python, so a task goes through its parts in order.
    dealt = rim.repartition("item", "part").sortWithinPartitions("item", "part")
    return dealt.mapInArrow(_rings(chunk), "item string, part long, ring long, hole boolean, cells long, corners string")


def simplified(rings: list[list[tuple[int, int]]], least: float) -> list[list[tuple[int, int]]]:
    """Rings of one grid without the corners whose triangle with their neighbours is smaller than least cells, smallest first.

    A corner stays where its triangle holds any other corner of any ring, so no edges come to cross and no ring leaves
    its place; where it is one of several rings' corners, so neighbours keep touching there; and in rings of four.
    """
    seen: dict[tuple[int, int], int] = defaultdict(int)
    near: dict[tuple[int, int], set] = defaultdict(set)
    for ring in rings:
        for p in ring:
            seen[p] += 1
            near[p[0] >> 3, p[1] >> 3].add(p)
    before = [[(k - 1) % len(r) for k in range(len(r))] for r in rings]
    after = [[(k + 1) % len(r) for k in range(len(r))] for r in rings]
    left, gone = [len(r) for r in rings], [[False] * len(r) for r in rings]
    turn = lambda a, b, c: (b[0] - a[0]) * (c[1] - a[1]) - (b[1] - a[1]) * (c[0] - a[0])

    def corner(r: int, k: int) -> tuple:
        return rings[r][before[r][k]], rings[r][k], rings[r][after[r][k]]

    def empty(a, b, c) -> bool:
        xs, ys = sorted((a[0], b[0], c[0])), sorted((a[1], b[1], c[1]))
        for gx in range(xs[0] >> 3, (xs[2] >> 3) + 1):
            for gy in range(ys[0] >> 3, (ys[2] >> 3) + 1):
                for p in near.get((gx, gy), ()):
                    if p not in (a, b, c) and xs[0] <= p[0] <= xs[2] and ys[0] <= p[1] <= ys[2]:
                        sides = (turn(a, b, p), turn(b, c, p), turn(c, a, p))
                        if min(sides) >= 0 or max(sides) <= 0:
                            return False
        return True

    heap = [(abs(turn(*corner(r, k))) / 2, r, k) for r, ring in enumerate(rings) for k in range(len(ring))]
    heapq.heapify(heap)
    while heap and heap[0][0] < least:
        area, r, k = heapq.heappop(heap)
        if gone[r][k] or left[r] <= 4 or seen[rings[r][k]] > 1 or area != abs(turn(*corner(r, k))) / 2 or not empty(*corner(r, k)):
            continue
        gone[r][k] = True
        left[r] -= 1
        p = rings[r][k]
        near[p[0] >> 3, p[1] >> 3].discard(p)
        a, b = before[r][k], after[r][k]
        after[r][a], before[r][b] = b, a
        for n in (a, b):
            heapq.heappush(heap, (abs(turn(*corner(r, n))) / 2, r, n))
    return [[p for p, out in zip(ring, gone[r], strict=True) if not out] for r, ring in enumerate(rings)]


def _simpler(least: float):
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["part", "ring"])
        rings = simplified([[tuple(map(int, p.split(","))) for p in c.split()] for c in frame["corners"]], least)
        area = [abs(sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(r, r[1:] + r[:1], strict=True))) / 2 for r in rings]
        return frame.assign(cells=area, corners=[" ".join(f"{x},{y}" for x, y in r) for r in rings])[["item", "part", "ring", "hole", "cells", "corners"]]

    return run


def simplify_rings(rings: DataFrame, least: float = 1.0) -> DataFrame:
    """rings (footprint_rings' rows) with fewer corners: item, part, ring, hole, cells double (the area now), corners.

    See simplified: nothing crosses, nothing that touched parts, and each corner that goes changes the area by less than
    `least` cells. The rings of one grid, which footprint_rings bounds, are in one task, as they must not cross.
    """
    return rings.groupBy("item").applyInPandas(_simpler(least), "item string, part long, ring long, hole boolean, cells double, corners string")


def footprint_areas(rings: DataFrame) -> DataFrame:
    """item, area in cells of all its rings, holes taken off."""
    return rings.groupBy("item").agg(F.sum(F.when(F.col("hole"), -F.col("cells")).otherwise(F.col("cells"))).cast("double").alias("area"))


def footprint_accept(counts: DataFrame, rings: DataFrame, ratio: float = 0.5) -> DataFrame:
    """item, shape: `rings`, or `bbox` where all cells are valid or none, or the rings hold less than ratio of the valid area.

    counts: item, n_valid, n_cells; rings in the same cells. Items without rings keep their box.
    """
    area = F.coalesce("area", F.lit(0.0))
    box = (F.col("n_valid") == 0) | (F.col("n_valid") == F.col("n_cells")) | (area < ratio * F.col("n_valid"))
    return counts.join(_dealt(footprint_areas(rings)), "item", "left").select("item", F.when(box, "bbox").otherwise("rings").alias("shape"))


def rings_to_degrees(rings: DataFrame, grids: DataFrame) -> DataFrame:
    """rings with corners in degrees: item, part, ring, hole, points array<struct<lon, lat>> in order; null for unsupported codes.

    grids: item, epsg and the geotransform gt0..gt5 of the cells.
    """
    at = rings.select("item", "part", "ring", "hole", F.posexplode(F.split("corners", " ")).alias("k", "p")).join(grids, "item")
    c, r = F.split_part("p", F.lit(","), F.lit(1)).cast("double"), F.split_part("p", F.lit(","), F.lit(2)).cast("double")
    plane = at.withColumns({"x": F.col("gt0") + c * F.col("gt1") + r * F.col("gt2"), "y": F.col("gt3") + c * F.col("gt4") + r * F.col("gt5")})
    placed = to_degrees(plane.select("item", "part", "ring", "hole", "k", "x", "y", "epsg"))
    ordered = F.array_sort(F.collect_list(F.struct("k", "lon", "lat")))
    return placed.groupBy("item", "part", "ring", "hole").agg(F.transform(ordered, lambda p: F.struct(p["lon"].alias("lon"), p["lat"].alias("lat"))).alias("points"))
