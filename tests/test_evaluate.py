"""Evaluation and correlation on small tables, checked by hand, by pandas, and one way against the other."""

from __future__ import annotations

import datetime as dt
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from factorloom.operators import correlation as co
from factorloom.operators import evaluate as ev
from factorloom.operators import latest
from factorloom.plans import factors as plan

DAY = dt.date(2024, 1, 1)
VALUES = "factor_id string, trade_date date, stock_code string, factor_value double"


def day(i):
    return DAY + dt.timedelta(days=i)


@pytest.fixture(scope="module")
def bars(spark):
    rng = np.random.default_rng(11)
    rows = []
    for c in range(24):
        price = 100.0
        for i in range(30):
            price *= math.exp(rng.normal(0, 0.02))
            o = price * (1 + rng.normal(0, 0.005))
            vol = float(rng.integers(0, 5)) * 100
            rows.append((f"s{c}", day(i), o, max(o, price) * 1.01, min(o, price) * 0.99, price, vol, vol * price))
    cols = "stock_code string, trade_date date, open double, high double, low double, close double, volume double, turnover double"
    return spark.createDataFrame(rows, cols).cache()


@pytest.fixture(scope="module")
def values(spark, bars):
    mine = {"mom": plan.momentum(3), "vol": plan.signed_volume(2), "const": F.lit(1.5)}
    return plan.compute_factors(bars, mine).cache()


def reference_metrics(v: pd.DataFrame, close: pd.DataFrame, horizon: int, n: int):
    """The metrics of one factor, written plainly in pandas."""
    close = close.sort_values("trade_date")
    fwd = np.log(close.groupby("stock_code").close.shift(-horizon) / close.close)
    df = v.merge(close.assign(ret=fwd), on=["trade_date", "stock_code"]).dropna(subset=["factor_value", "ret"])
    df["factor_value"] = df.factor_value.round(10)
    ics, ls, held, turns = [], [], None, []
    for _, g in df.groupby("trade_date"):
        if g.factor_value.nunique() >= 2:
            ics.append(g.factor_value.rank().corr(g.ret.rank()))
        if g.factor_value.nunique() < n:
            continue
        q = pd.qcut(g.factor_value, n, labels=False, duplicates="drop")
        by = g.groupby(q).ret.mean()
        ls.append(by.iloc[-1] - by.iloc[0])
        top = set(g[q == q.max()].stock_code)
        if held is not None:
            turns.append(1 - len(held & top) / len(top))
        held = top
    ls = pd.Series(ls, dtype=float)
    cum = (1 + ls).cumprod()
    return {
        "ic_value": np.mean(ics) if ics else np.nan,
        "ic_ir": np.mean(ics) / np.std(ics, ddof=1) if len(ics) > 1 else np.nan,
        "sharpe_ratio": ls.mean() / ls.std() * np.sqrt(252) if len(ls) else np.nan,
        "max_drawdown": (cum / cum.cummax() - 1).min() if len(ls) else np.nan,
        "turnover": np.mean(turns) if turns else np.nan,
    }


def test_metrics_against_pandas(values, bars):
    out = {r["factor_id"]: r for r in ev.evaluate(values, bars, 2, 5, "ALL").collect()}
    assert set(out) == {"mom", "vol", "const"}
    pv, pc = values.toPandas(), bars.select("trade_date", "stock_code", "close").toPandas()
    for factor, row in out.items():
        want = reference_metrics(pv[pv.factor_id == factor], pc, 2, 5)
        for metric, w in want.items():
            got = np.nan if row[metric] is None else row[metric]
            assert got == pytest.approx(w, abs=1e-9, nan_ok=True), (factor, metric)
        assert row["backtest_period"] == f"{day(0)} 至 {day(29)}" and row["horizon"] == "2d"
        if factor != "const":
            assert 0 <= row["turnover"] <= 1 and row["max_drawdown"] <= 0
    assert out["const"]["ic_value"] is None and out["const"]["turnover"] is None


def test_turnover_skips_unusable_dates(spark):
    rows = []
    for i, top in ((0, "a"), (1, None), (2, "a"), (3, "b")):
        for j, c in enumerate("abcd"):
            v = 1.0 if top is None else (10.0 if c == top else float(j))
            rows.append(("f", day(i), c, v, 0.1 * j))
    paired = spark.createDataFrame(rows, VALUES + ", ret double")
    buckets = ev.bucketed(paired, 4)
    daily = ev.daily_metrics(buckets, 4)
    assert [r["ordinal"] for r in daily.orderBy("trade_date").collect()] == [1, None, 2, 3]
    out = {r["trade_date"]: r["turnover"] for r in ev.turnover_daily(buckets, daily).collect()}
    assert out == {day(2): 0.0, day(3): 1.0}


def test_returns_stop_at_the_factors_last_date(spark, bars):
    v = bars.where(F.col("trade_date") <= day(10)).select(
        F.lit("f").alias("factor_id"), "trade_date", "stock_code", F.col("open").alias("factor_value")
    )
    assert ev.pair_with_returns(v, bars, 3).agg(F.max("trade_date")).first()[0] == day(7)


def test_future_bars_do_not_change_values(bars):
    mine = {"mom": plan.momentum(3), "rc": plan.rank_correlation(4)}
    early = plan.compute_factors(bars.where(F.col("trade_date") <= day(20)), mine)
    late = plan.compute_factors(bars, mine).where(F.col("trade_date") <= day(20))
    assert early.exceptAll(late).count() == 0


def test_bad_factor_is_left_out(bars):
    good, bad = plan.usable_factors(bars, {"ok": plan.momentum(2), "bad": F.col("no_such_column") + 1})
    assert list(good) == ["ok"] and "no_such_column" in bad["bad"]


def test_daily_equals_batch_cross_section(bars):
    mine = plan.library("momentum_20", "rank_corr_10")
    batch = plan.compute_factors(bars, mine).where(F.col("trade_date") == day(29))
    daily = plan.compute_day(bars, mine, day(33), 400)
    keys = ["factor_id", "trade_date", "stock_code"]
    both = batch.join(daily.withColumnRenamed("factor_value", "d"), keys)
    assert both.count() == daily.count() == 48
    assert both.where("not (round(factor_value, 10) <=> round(d, 10))").count() == 0


@pytest.mark.parametrize("block", [128, 2])
def test_correlation_against_pandas(values, spark, monkeypatch, block):
    monkeypatch.setattr(co, "BLOCK", block)
    monkeypatch.setattr(co, "SLICE", 50)
    noisy = values.where("factor_id <> 'const'").withColumn(
        "factor_value", F.when(F.xxhash64("stock_code", "trade_date") % 5 != 0, F.col("factor_value") + 1000)
    )
    extra = noisy.where("factor_id = 'mom'").select(
        F.lit("sum").alias("factor_id"), "trade_date", "stock_code", (F.col("factor_value") * 2 + F.dayofmonth("trade_date")).alias("factor_value")
    )
    flat = extra.withColumns({"factor_id": F.lit("flat"), "factor_value": F.lit(0.1)})
    df = noisy.unionByName(extra).unionByName(flat)
    wide = df.toPandas().pivot(index=["trade_date", "stock_code"], columns="factor_id", values="factor_value")
    want = wide.corr()
    pairs = co.correlation_pairs(df).collect()
    assert len(pairs) == 6
    for r in pairs:
        w = want.at[r["factor_a"], r["factor_b"]]
        if "flat" in (r["factor_a"], r["factor_b"]):
            assert r["corr"] is None
        else:
            assert r["corr"] == pytest.approx(w, abs=1e-9)
        both = wide[[r["factor_a"], r["factor_b"]]].dropna()
        assert r["n"] == len(both)
        days = [wide[c].dropna().index.get_level_values(0).unique() for c in (r["factor_a"], r["factor_b"])]
        assert r["overlap_days"] == len(days[0].intersection(days[1]))
    passing = {(r["factor_a"], r["factor_b"]): r["corr"] for r in co.passing_pairs(co.correlation_pairs(df), 1).collect()}
    assert len(passing) == 6
    for (a, b), v in passing.items():
        assert passing[b, a] == pytest.approx(v)
    counts = co.pair_counts(co.correlation_pairs(df), 10_000).first()
    assert tuple(counts) == (12, 6, 0)


def test_rows_of_correlations_go_to_python_without_measuring_batches(spark, values, monkeypatch):
    key, seen, write = "spark.sql.execution.arrow.maxBytesPerBatch", [], co.stored
    before = spark.conf.get(key)
    monkeypatch.setattr(co, "stored", lambda df: seen.append(spark.conf.get(key)) or write(df))
    co.correlation_pairs(values)
    assert set(seen) == {str(2**31 - 1)} and spark.conf.get(key) == before
    with pytest.raises(ValueError), co.batches_by_rows(spark):
        raise ValueError
    assert spark.conf.get(key) == before


def test_standardising_moves_no_rows_to_meet_a_row_per_group(bars):
    text = plan.compute_factors(bars, plan.library("momentum_20"))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in text and "BroadcastHashJoin" in text


def test_no_window_without_partitions(values, bars):
    """No plan collects all rows into one partition for a window."""
    for df in (plan.compute_factors(bars, plan.library()), ev.with_curve(ev.daily_metrics(ev.bucketed(ev.pair_with_returns(values, bars, 2), 5), 5))):
        assert "SinglePartition" not in df._jdf.queryExecution().executedPlan().toString()


def test_one_exchange_for_all_rolling_factors(bars):
    mine = {n: f() for n, f in plan.LIBRARY.items() if n != "rank_corr_10"}
    text = plan.wide_factors(bars, mine)._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange hashpartitioning") == 1


def test_shuffled_rows_of_correlations_follow_values(spark, monkeypatch):
    """A tile and chunk hand on one row, whatever the number of factors and pairs."""
    monkeypatch.setattr(co, "BLOCK", 10)
    k, days = 40, 30
    df = spark.range(k * days).select(
        F.concat(F.lit("f"), F.col("id") % k).alias("factor_id"), F.expr(f"date_add(DATE '2024-01-01', cast(id div {k} as int))").alias("trade_date"),
        F.lit("s").alias("stock_code"), F.rand(3).alias("factor_value"),
    )
    pairs = co.correlation_pairs(df)
    rows = pairs.collect()
    assert len(rows) == k * (k - 1) // 2 and all(r["n"] == r["overlap_days"] == days for r in rows)
    wide = df.toPandas().pivot(index="trade_date", columns="factor_id", values="factor_value").corr()
    assert all(r["corr"] == pytest.approx(wide.at[r["factor_a"], r["factor_b"]], abs=1e-9) for r in rows)


def test_asof_join(spark, monkeypatch):
    rng = np.random.default_rng(4)
    keys = ["hot"] * 5 + ["a", "b", None]
    known = [(keys[rng.integers(8)], int(rng.integers(50, 150)), int(rng.integers(9))) for _ in range(200)]
    asked = [(i, keys[rng.integers(8)] if i % 9 else "unknown", int(rng.integers(0, 200)) if i % 13 else None) for i in range(400)]
    k = spark.createDataFrame(known + [("hot", None, 5)], "k string, day int, v int")
    a = spark.createDataFrame(asked, "id int, k string, day int").repartition(5)
    got = {r["id"]: r["asof"] and tuple(r["asof"]) for r in latest.asof_join(a, k, ["k"], "day").collect()}
    for i, key, day in asked:
        mine = sorted((d, v) for x, d, v in known if x == key)
        upto = [x for x in mine if day is not None and x[0] <= day]
        first = [x for x in mine if x[0] == mine[0][0]]
        assert got[i] == (None if day is None or not mine else (upto or first)[-1]), (i, key, day)
    assert len(got) == len(asked)
    assert latest.asof_join(a, k.limit(0), ["k"], "day").where("asof is not null").count() == 0


def test_wide_rows_are_stored_and_only_what_is_read(spark, bars, monkeypatch):
    """Raw factors are written a row per bar, not per factor; a function's unread columns are not written."""
    written = []
    real = plan.stored
    monkeypatch.setattr(plan, "stored", lambda df: written.append(real(df)) or written[-1])
    out = plan.compute_factors(bars, plan.library("momentum_20", "trend_12"))
    assert [w.count() for w in written] == [bars.count()] and out.count() == 2 * bars.count()
    written.clear()
    plan.wide_factors(bars, plan.library("rank_corr_10"))
    assert set(written[0].columns) == {"trade_date", "stock_code", "close", "volume"}


def test_significant_digits(spark):
    odd = [None, 0.0, -0.0, 5e-324, 1e-310, -1e-300, 1.7e308, 123456789012.5, -123456789012.5, 1.23456789012349, -0.000123456789012351, math.inf, -math.inf]
    rows = spark.createDataFrame([(v,) for v in odd], "x double").select("x", ev.significant("x").alias("y")).collect()
    want = [None, 0.0, 0.0, 5e-324, 1e-310, -1e-300, 1.7e308, 123456789013.0, -123456789013.0, 1.23456789012, -0.000123456789012, math.inf, -math.inf]
    assert [r["y"] for r in rows] == want
    plan_ = spark.range(3).select(ev.significant(F.rand())).where("1 = 1")._jdf.queryExecution().executedPlan().toString()
    assert "round(" not in plan_.lower().replace("bround(", "")  # which takes each value through a decimal


def test_values_are_not_sorted_to_meet_returns(values, bars):
    """A bar's return serves all factors, so the values are hashed to it and only the returns' own window sorts."""
    plan_ = ev.pair_with_returns(values, bars, 2)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin [stock_code" not in plan_ and "ShuffledHashJoin [stock_code" in plan_
