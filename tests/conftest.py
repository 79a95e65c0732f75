import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from vigie.session import local_session

    s = local_session("*", shuffle_partitions=8, app="vigie-tests")
    yield s


@pytest.fixture(scope="session")
def duck():
    import duckdb

    from vigie.sources.tables import TABLES

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{SMALL}/{t}.parquet')")
    return con
