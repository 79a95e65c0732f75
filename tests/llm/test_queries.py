"""Registered queries against their oracles, and the names they are registered under."""

import duckdb
import pytest

import __spark_entry__ as entry
from vigie.llm import registry

SF = "/root/testdata/sf0.001"


def test_names():
    names = [n for n in entry.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert "pipeline" in entry.queries()
    assert set(registry.ORACLE) <= set(registry.QUERIES)


@pytest.mark.parametrize("name", sorted(registry.ORACLE))
def test_oracle(spark, name):
    con = duckdb.connect()
    for table in ("documents", "embeddings", "benchmark"):
        con.execute(f"create view {table} as select * from read_parquet('{SF}/{table}.parquet')")
    want = con.sql(registry.ORACLE[name])
    cols = sorted(want.columns)
    got = registry.QUERIES[name](spark, SF)
    assert sorted(got.columns) == cols
    key = lambda rows: sorted(rows, key=str)
    one = key([tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in got.select(*cols).collect()])
    two = key([tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in want.project(", ".join(cols)).fetchall()])
    assert one == two
