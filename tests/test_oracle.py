"""Every registered query against its DuckDB oracle on the smallest driver tables."""

import math
import os

import pytest

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


def _norm(df):
    import pandas as pd

    df = df[sorted(df.columns)]
    out = []
    for r in df.itertuples(index=False):
        vals = []
        for v in r:
            if v is None or v is pd.NA or (isinstance(v, float) and math.isnan(v)):
                vals.append("NULL")
            elif isinstance(v, float):
                vals.append(str(int(v)) if v.is_integer() else f"{v:.4f}")
            elif hasattr(v, "isoformat"):
                vals.append(pd.Timestamp(v).isoformat())
            else:
                vals.append(str(v))
        out.append("|".join(vals))
    return sorted(out)


@pytest.fixture(scope="module")
def duck():
    import duckdb

    from vitrine.sources.tables import DRIVER_TABLES

    con = duckdb.connect()
    for t in DRIVER_TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def _keys():
    import __spark_entry__ as E

    return sorted(E.oracle_sql())


@pytest.mark.parametrize("key", _keys())
def test_query_matches_oracle(spark, duck, key):
    import __spark_entry__ as E

    got = E.queries()[key](spark, SF).toPandas()
    want = duck.sql(E.oracle_sql()[key]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert _norm(got) == _norm(want)


def test_entry_smoke(spark):
    import __spark_entry__ as E

    df = E.entry(spark)
    assert df.count() > 0 and "brand" in df.columns


def test_every_oracle_has_a_query():
    import __spark_entry__ as E

    assert set(E.oracle_sql()) <= set(E.queries())
