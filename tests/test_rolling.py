"""Hand-made series for the rolling operators, and pandas as a second opinion."""

from __future__ import annotations

import datetime as dt
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from factorloom.functions import elem, ts
from factorloom.functions.derived import with_derived


def panel(spark, series: dict[str, list], name: str = "x"):
    day = dt.date(2024, 1, 1)
    rows = [(c, day + dt.timedelta(days=i), None if v is None else float(v)) for c, xs in series.items() for i, v in enumerate(xs)]
    return spark.createDataFrame(rows, f"stock_code string, trade_date date, {name} double").repartition(3)


def values(df, column, code="a"):
    rows = df.select("stock_code", "trade_date", column.alias("y")).where(F.col("stock_code") == code)
    return [r["y"] for r in rows.orderBy("trade_date").collect()]


def test_ramp(spark):
    df = panel(spark, {"a": [1.0, 2, 3, 4, 5, 6], "b": [10.0, 20, 30, 40, 50, 60]})
    assert values(df, ts.ma("x", 3)) == [None, None, 2, 3, 4, 5]
    assert values(df, ts.ts_sum("x", 2), "b") == [None, 30, 50, 70, 90, 110]
    assert values(df, ts.ref("x", 2)) == [None, None, 1, 2, 3, 4]
    assert values(df, ts.ref("x", -1)) == [2, 3, 4, 5, 6, None]
    assert values(df, ts.delta("x", 1)) == [None, 1, 1, 1, 1, 1]
    assert values(df, ts.sequence()) == [1, 2, 3, 4, 5, 6]
    assert values(df, ts.prod("x", 2)) == [None, 2, 6, 12, 20, 30]
    assert values(df, ts.decaylinear("x", 3))[2] == pytest.approx((1 + 4 + 9) / 6)
    assert values(df, ts.wma("x", 2))[1] == pytest.approx((0.9 * 1 + 2) / 1.9)
    assert values(df, ts.forward_return("x", 2))[:5] == pytest.approx([math.log(3), math.log(2), math.log(5 / 3), math.log(1.5), None])


def test_gap_empties_the_windows_it_touches(spark):
    df = panel(spark, {"a": [1.0, None, 3, 4, 5]})
    assert values(df, ts.ma("x", 2)) == [None, None, None, 3.5, 4.5]
    assert values(df, ts.ts_rank("x", 2)) == [None, None, None, 1.0, 1.0]
    assert values(df, ts.wma("x", 2))[:3] == [None, None, None]
    assert values(df, ts.sumac("x")) == [1, 1, 4, 8, 13]
    assert values(df, ts.std("x"))[0] is None
    assert values(df, ts.count(elem.gt("x", 2), 2)) == [None, 0, 1, 2, 2]
    assert values(df, ts.sumif("x", elem.gt("x", 2), 2)) == [None, 0, 3, 7, 9]


def test_ties_count_the_oldest_extreme(spark):
    df = panel(spark, {"a": [2.0, 2, 1, 1, 2]})
    assert values(df, ts.highday("x", 3)) == [None, None, 2, 2, 0]
    assert values(df, ts.lowday("x", 3)) == [None, None, 0, 1, 2]
    assert values(df, ts.ts_rank("x", 3)) == pytest.approx([None, None, 1 / 3, 0.5, 1.0])


def test_flat_windows_have_no_correlation_or_slope(spark):
    df = panel(spark, {"a": [7.0] * 4}).withColumn("y", F.col("trade_date").cast("timestamp").cast("double"))
    for op in (ts.corr("x", "y", 3), ts.regbeta("y", "x", 3), ts.regresi("y", "x", 3)):
        assert values(df, op) == [None] * 4
    assert values(df, ts.std("x", 3)) == [None, None, 0, 0]
    assert values(df, ts.regbeta("x", "y", 3))[2:] == [0, 0]


def test_nothing_divides_by_zero(spark):
    df = panel(spark, {"a": [0.0, -1, 4]})
    assert values(df, elem.div(1, "x")) == [None, -1, 0.25]
    assert values(df, elem.log("x"))[:2] == [None, None]
    assert values(df, elem.power("x", 0.5)) == [0, None, 2]
    assert values(df, elem.power("x", -1)) == [None, -1, 0.25]
    assert values(df, elem.if_number("x", 1, 2)) == [2, 1, 1]
    assert values(df, elem.ne(F.lit(None), "x")) == [True] * 3
    assert values(df, elem.lt(F.lit(None), "x")) == [False] * 3
    assert values(df, ts.ret("x")) == [None, None, -5]


def test_long_weighted_mean_takes_the_array_way(spark):
    xs = [float(v) for v in np.random.default_rng(0).normal(size=80)]
    got = values(panel(spark, {"a": xs}), ts.decaylinear("x", 70))
    w = np.arange(1, 71) / np.arange(1, 71).sum()
    assert got[68] is None
    assert got[69:] == pytest.approx([float(np.dot(xs[i - 69 : i + 1], w)) for i in range(69, 80)])


def test_against_pandas(spark):
    rng = np.random.default_rng(3)
    s = {c: [None if rng.random() < 0.1 else float(np.round(v, 1)) for v in rng.normal(size=60)] for c in "ab"}
    df = panel(spark, s).withColumn("y", F.sin(F.col("x") * 3) + F.dayofyear("trade_date"))
    for code in "ab":
        x = pd.Series(s[code], dtype=float)
        y = np.sin(x * 3) + np.arange(1, 61)
        wanted = [
            (ts.std("x", 7), x.rolling(7).std()),
            (ts.ts_max("x", 4), x.rolling(4).max()),
            (ts.corr("x", "y", 8), x.rolling(8).corr(y)),
            (ts.covariance("x", "y", 8), x.rolling(8).cov(y)),
            (ts.ts_rank("x", 6), x.rolling(6).rank() / 6),
            (ts.std("x"), x.expanding().std()),
        ]
        for op, want in wanted:
            got = pd.Series(values(df, op, code), dtype=float)
            np.testing.assert_allclose(got, want, rtol=1e-9, atol=1e-9)


def test_derived_columns(spark):
    cols = "stock_code string, trade_date date, open double, high double, low double, close double, volume double, turnover double"
    rows = [
        ("a", dt.date(2024, 1, 1), 10.0, 12.0, 9.0, 11.0, 5.0, 50.0),
        ("a", dt.date(2024, 1, 2), 11.0, 14.0, 10.0, 13.0, 0.0, 60.0),
        ("a", dt.date(2024, 1, 3), 9.0, 10.0, 5.0, 6.0, 2.0, 20.0),
    ]
    out = with_derived(spark.createDataFrame(rows, cols)).orderBy("trade_date").collect()
    assert [r["vwap"] for r in out] == [10, None, 10]
    assert [r["dtm"] for r in out] == [0, 3, 0]
    assert [r["dbm"] for r in out] == [0, 0, 4]
    assert [r["tr"] for r in out] == [3, 4, 8]
    assert [r["hd"] for r in out] == [None, 2, -4]
    assert [r["ld"] for r in out] == [None, -1, 5]
    assert [r["mkt"] for r in out] == [0, 0, 0]


def test_results_do_not_depend_on_row_order(spark):
    df = panel(spark, {"a": [3.0, 1, 2, 5, 4], "b": [1.0, 1, 1, 2, 2]})
    again = df.orderBy(F.rand(1))
    for op in (ts.ts_rank("x", 3), ts.ma("x", 2)):
        assert values(df, op) == values(again, op)
