"""Whole-table profile against pandas on a small table with nulls, NaN, a constant column and no rows."""

import math

import pandas as pd

from vitrine.operators.table_profile import table_profile

ROWS = [(1, 2.0, 7, "x", "only"), (2, float("nan"), 7, "y", None), (None, 5.0, 7, "x", None), (4, 9.5, 7, None, None), (4, -1.0, 7, "", None)]
SCHEMA = "a int, `b c` double, const long, s string, t string"


def test_profile_equals_pandas(spark):
    got = {(r.column_name, r.stat, r.key): r.value for r in table_profile(spark.createDataFrame(ROWS, SCHEMA), bins=4).collect()}
    pdf = pd.DataFrame(ROWS, columns=["a", "b c", "const", "s", "t"])
    for c in pdf:
        assert got[c, "missing", ""] == pdf[c].isna().sum() and got[c, "missing_pct", ""] == 100 * pdf[c].isna().mean()
    for c in ("a", "b c", "const"):
        for stat in ("mean", "std", "min", "max"):
            assert math.isclose(got[c, stat, ""], getattr(pdf[c], stat)())
    assert math.isclose(got["a", "corr", "b c"], pdf["a"].corr(pdf["b c"])) and got["a", "corr", "const"] is None
    bins = {k: v for k, v in got.items() if k[1] == "bin"}
    assert bins == {("a", "bin", "0"): 1, ("a", "bin", "1"): 1, ("a", "bin", "3"): 2, ("b c", "bin", "1"): 1, ("b c", "bin", "2"): 1, ("b c", "bin", "3"): 1,
                    ("b c", "bin", "0"): 1, ("const", "bin", "0"): 5}
    assert {k: v for k, v in got.items() if k[1] == "count"} == {
        ("s", "count", "x"): 2, ("s", "count", "y"): 1, ("s", "count", ""): 1, ("t", "count", "only"): 1}


def test_empty_table(spark):
    got = table_profile(spark.createDataFrame([], SCHEMA)).collect()
    assert len(got) == 10 and all(r.value in (0.0, None) for r in got)
