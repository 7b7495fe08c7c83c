"""Every catalog query against its SQL counterpart in DuckDB, on the smallest tables."""

import duckdb
import pytest

from terracat.plans import catalog, discovery, footprints, records, rules, settings, upkeep  # noqa: F401

SF = "/root/testdata/sf0.001"


def plain(rows, columns):
    return sorted((tuple(round(v, 3) if isinstance(v, float) else v for v in (r[columns.index(c)] for c in sorted(columns))) for r in rows), key=str)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split():
        con.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("key", sorted(catalog.ORACLES))
def test_oracle(spark, duck, key):
    got = catalog.QUERIES[key](spark, SF)
    want = duck.sql(catalog.ORACLES[key])
    assert sorted(got.columns) == sorted(want.columns)
    a, b = plain([tuple(r) for r in got.collect()], got.columns), plain(want.fetchall(), want.columns)
    assert len(a) > 0 and a == b
