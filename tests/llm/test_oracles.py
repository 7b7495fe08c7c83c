"""The numbered queries that SQL can express, against DuckDB on the smallest tables."""

import duckdb
import pytest

from terracat.llm.oracles import ORACLES
from terracat.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ORACLES)
def test_same_rows(spark, name):
    db = duckdb.connect()
    for t in ("documents", "benchmark", "pages"):
        db.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    want = db.execute(ORACLES[name])
    columns = [c[0] for c in want.description]
    got = QUERIES[name](spark, SF)
    assert sorted(got.columns) == sorted(columns)
    order = lambda rows: sorted(map(str, rows))
    want = want.fetchall()
    assert want and order(tuple(r) for r in got.select(columns).collect()) == order(want)
