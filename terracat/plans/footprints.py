"""Queries on footprints, with SQL that labels regions by recursion."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terracat.operators import footprints as FP
from terracat.plans.catalog import add

#: Square metres of a cell of the test grids: specks are single cells, parts have 8 cells at least, holes 2.
CELL_M2 = 500.0


def _mask(cells: DataFrame) -> DataFrame:
    """Grids of 64 rows."""
    return cells.select(F.floor(F.col("row") / 64).cast("string").alias("item"), F.col("col").alias("gx"), F.col("row").alias("gy"), "valid")


def _kept(cells: DataFrame) -> DataFrame:
    return FP.footprint_regions(_mask(cells), cell_m2=CELL_M2)


def _outlines(cells: DataFrame) -> DataFrame:
    """Of each part what its rings hold and how often they turn."""
    rings = FP.footprint_rings(_kept(cells))
    net = F.when(F.col("hole"), -F.col("cells")).otherwise(F.col("cells"))
    return rings.groupBy("item", "part").agg(F.sum(net).alias("cells"), F.sum(F.size(F.split("corners", " "))).cast("long").alias("corners"))


def _accepted(cells: DataFrame) -> DataFrame:
    """Rings with fewer corners decide, at every column of the cells that is valid beyond the first half of the grids."""
    thin = cells.withColumn("valid", F.col("valid") & ((F.floor(F.col("row") / 64) % 3 != 1) | ((F.col("row") + F.col("col")) % 3 == 0)))
    counts = _mask(thin).groupBy("item").agg(F.count_if("valid").alias("n_valid"), F.count("*").alias("n_cells"))
    return FP.footprint_accept(counts, FP.simplify_rings(FP.footprint_rings(_kept(thin))))


def _labelled(name: str, cells: str) -> str:
    """CTE {name} (item, k, valid, region) of whole grids of 64 columns in cells (item, k, valid).

    Each item is a list of its cells. A step takes for each cell the least label of itself and its neighbours of its
    kind, then the label of the cell that the label names, until none falls.
    """
    near = " ".join(f", case when {inside} and v[i + {d}] = v[i + 1] then l[i + {d}] else l[i + 1] end" for d, inside in ((0, "i % 64 > 0"), (2, "i % 64 < 63"), (-63, "i > 63"), (65, "true")))
    return f"""{name} as materialized (with recursive g(item, base, step, v, l) as (
        select item, min(k), 0, list(valid order by k), range(count(*)) from {cells} group by item
        union all select item, base, step + 1, v, n from (select *, list_transform(m, lambda t: m[t + 1]) as n from (select *, list_transform(range(len(l)), lambda i: least(l[i + 1]{near})) as m from g)) where n <> l),
      done as (select item, any_value(base) as base, any_value(v) as v, arg_max(l, step) as l from g group by item)
      select item, base + i // 64 * 1048576 + i % 64 as k, v[i + 1] as valid, base + l[i + 1] // 64 * 1048576 + l[i + 1] % 64 as region from (select *, unnest(range(len(l))) as i from done))"""


_VALID = "valid"
_THIN = "valid and (row // 64 % 3 <> 1 or (row + col) % 3 = 0)"


def _parts(valid: str) -> str:
    """CTEs up to kept (item, k, part): specks absorbed, small parts dropped, small holes filled."""
    return f"""m0 as materialized (select cast(row // 64 as varchar) as item, row * 1048576 + col as k, {valid} as valid from v_cells),
      {_labelled('r0', 'm0')},
      s0 as materialized (select item, region, count(*) as n, any_value(valid) as valid from r0 group by 1, 2),
      met as (select distinct a.item, a.region as a, b.region as b from (select item, region, unnest([k + 1, k - 1, k + 1048576, k - 1048576]) as k from r0) a join r0 b on b.item = a.item and b.k = a.k and b.region <> a.region),
      asks as (select m.item, m.a as region, arg_max(m.b, struct_pack(n := t.n, k := -m.b)) as goes from met m join s0 s on s.item = m.item and s.region = m.a and s.n < 2 join s0 t on t.item = m.item and t.region = m.b group by 1, 2),
      clear as materialized (select * from asks a where not exists (select 1 from asks b where b.item = a.item and b.region = a.goes and b.goes = a.region)),
      chain as materialized (with recursive c(item, region, goes) as (select * from clear union select c.item, c.region, n.goes from c join clear n on n.item = c.item and n.region = c.goes) select * from c),
      told as (select c.item, c.region, s.valid from chain c join s0 s on s.item = c.item and s.region = c.goes where not exists (select 1 from clear n where n.item = c.item and n.region = c.goes)),
      m1 as materialized (select r.item, r.k, coalesce(t.valid, r.valid) as valid from r0 r left join told t on t.item = r.item and t.region = r.region),
      {_labelled('r1', 'm1')},
      edge as (select item, min(k % 1048576) as x0, max(k % 1048576) as x1, min(k // 1048576) as y0, max(k // 1048576) as y1 from r1 group by 1),
      s1 as materialized (select item, region, valid, count(*) as n, bool_or(k % 1048576 in (x0, x1) or k // 1048576 in (y0, y1)) as open from r1 join edge using (item) group by 1, 2, 3),
      big as (select item, region from s1 where valid and n * 500 >= 4000),
      filled as (select s.item, s.region, a.region as part from s1 s join r1 a on a.item = s.item and a.k = s.region - 1048576 join big on big.item = a.item and big.region = a.region where not s.valid and not s.open and s.n * 500 < 1000),
      kept as materialized (select r.item, r.k, p.part from r1 r join (select item, region, region as part from big union all select * from filled) p on p.item = r.item and p.region = r.region)"""


add("footprint_components", "CELLS", _kept, f"select * from (with {_parts(_VALID)} select item, k % 1048576 as gx, k // 1048576 as gy, part from kept)")
add(
    "footprint_rings",
    "CELLS",
    _outlines,
    f"""select * from (with {_parts(_VALID)}, spots as (select item, part, k + dx + dy * 1048576 as p, (1 - dx) + 2 * (1 - dy) as q from kept, (select unnest([0, 1]) as dx), (select unnest([0, 1]) as dy)),
      turns as (select item, part, p, case when count(*) in (1, 3) then 1 when count(*) = 2 and sum(q) = 3 and (bool_or(q = 0) or bool_or(q = 1)) and min(q) + max(q) = 3 then 2 else 0 end as n from spots group by 1, 2, 3)
      select c.item, c.part, c.cells, t.corners from (select item, part, count(*) as cells from kept group by 1, 2) c join (select item, part, cast(sum(n) as bigint) as corners from turns group by 1, 2) t using (item, part))""",
)
add(
    "footprint_accept",
    "CELLS",
    _accepted,
    f"select * from (with {_parts(_THIN)} select item, case when n = 0 or n = m or coalesce(a, 0) < 0.5 * n then 'bbox' else 'rings' end as shape from (select item, count(*) filter (valid) as n, count(*) as m from m0 group by 1) left join (select item, count(*) as a from kept group by 1) using (item))",
)
