"""Every registered query against its DuckDB oracle on the sf0.001 tables (row count, columns, sorted values)."""

import math

import pytest

import __spark_entry__ as E
from tests.conftest import SMALL


def _norm(v):
    import pandas as pd

    if v is None or (not hasattr(v, "__len__") and pd.isna(v)):
        return None
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    if type(v).__name__ == "Decimal":
        return round(float(v), 6)
    if hasattr(v, "to_pydatetime"):
        return v.to_pydatetime().replace(tzinfo=None)
    return v


def _rows(pdf):
    cols = sorted(pdf.columns)
    out = []
    for r in pdf[cols].astype(object).itertuples(index=False):
        out.append(tuple(_norm(x) for x in r))
    return cols, sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


@pytest.mark.parametrize("key", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, duck, key):
    got = E.queries()[key](spark, SMALL).toPandas()
    exp = duck.execute(E.oracle_sql()[key]).df()
    cs, rs = _rows(got)
    co, ro = _rows(exp)
    assert cs == co
    assert len(rs) == len(ro)
    assert rs == ro


def test_every_query_without_oracle_runs(spark):
    for key in sorted(set(E.queries()) - set(E.oracle_sql())):
        df = E.queries()[key](spark, SMALL)
        assert df.count() >= 0


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "geozone_id" in df.columns
