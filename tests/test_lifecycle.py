"""Threshold decisions, latest rows, upserts."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from factorloom.operators import lifecycle as lc
from factorloom.operators.latest import first_per_key, latest_date_upto, latest_per_key
from factorloom.operators.upsert import insert_if_absent, keep_recent, update_flags, upsert

METRICS = "id int, ic_value double, ic_ir double, sharpe_ratio double, max_drawdown double, turnover double"
TH = {"ic_min": 0.02, "ic_ir_min": 0.5, "sharpe_min": 0.8, "max_drawdown_max": -0.2, "turnover_max": 0.6}
NAN = float("nan")


def test_pass_needs_every_configured_metric(spark):
    rows = [
        (1, 0.02, 0.5, 0.8, -0.2, 0.6),
        (2, 0.019, 0.5, 0.8, -0.2, 0.6),
        (3, None, 0.5, 0.8, -0.2, 0.6),
        (4, NAN, 0.5, 0.8, -0.2, 0.6),
        (5, 0.1, NAN, 0.8, -0.1, 0.1),
        (6, 0.1, 0.9, 0.9, -0.21, 0.1),
        (7, 0.1, 0.9, 0.9, -0.1, NAN),
    ]
    df = spark.createDataFrame(rows, METRICS)
    ok = {r["id"] for r in df.where(lc.passes(TH)).collect()}
    assert ok == {1}
    assert df.where(lc.passes({})).count() == 7
    loose = {r["id"] for r in df.where(lc.passes({"turnover_max": 0.5, "ic_min": None})).collect()}
    assert loose == {5, 6}


@pytest.mark.parametrize(
    ("init", "latest", "gone"),
    [
        (0.10, 0.01, True),
        (0.10, 0.02, False),  # not below the floor
        (0.03, 0.016, False),  # decayed by less than half
        (-0.1, 0.01, True),
        (0.0, 0.02, False),
        (1e-9, 0.01, True),
        (None, 0.01, False),
        (0.1, None, False),
        (0.1, NAN, False),
    ],
)
def test_deprecation(spark, init, latest, gone):
    df = spark.createDataFrame([(init, latest)], "ic_value_init double, ic_value_latest double")
    th = {"ic_decay_threshold": 0.5, "latest_ic_min": 0.02}
    assert df.select(lc.should_deprecate(th)).first()[0] is gone
    assert df.select(lc.should_deprecate({})).first()[0] is False


def test_latest_breaks_equal_times_by_id(spark):
    rows = [("a", "2024-01-01", 1, 0.1), ("a", "2024-01-01", 3, 0.3), ("a", "2023-01-01", 9, 0.9), ("b", "2024-01-01", 2, 0.2)]
    df = spark.createDataFrame(rows, "k string, t string, id int, v double")
    assert {(r["k"], r["id"]) for r in latest_per_key(df, ["k"], ["t", "id"]).collect()} == {("a", 3), ("b", 2)}
    assert {(r["k"], r["id"]) for r in first_per_key(df, ["k"], ["t", "id"]).collect()} == {("a", 9), ("b", 2)}


def test_effective_date_falls_back_to_the_earliest(spark):
    df = spark.sql("select explode(array(date'2024-01-02', date'2024-01-05')) d")
    for asked, got in (("2024-01-04", "2024-01-02"), ("2024-01-05", "2024-01-05"), ("2023-12-01", "2024-01-02")):
        assert str(latest_date_upto(df, "d", F.lit(asked).cast("date")).first()[0]) == got


def test_thresholds(spark):
    rows = [(1, "s", "v1", 0.1, True, "2024-01-01"), (2, "s", "v2", 0.2, True, "2024-02-01"), (3, "s", "v3", 0.3, False, "2024-03-01")]
    df = spark.createDataFrame(rows, "id int, scene string, version string, ic_min double, is_active boolean, created_at string")
    assert lc.active_thresholds(df, "s")["ic_min"] == 0.2
    with pytest.raises(ValueError, match="no active thresholds"):
        lc.active_thresholds(df, "other")


@pytest.fixture()
def tables(spark):
    target = spark.createDataFrame([(1, "a", 1.0), (2, "b", None), (3, "c", 3.0)], "k int, s string, v double")
    source = spark.createDataFrame([(2, 20.0), (3, None), (4, 40.0)], "k int, v double")
    return target, source


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_upsert_rules(tables):
    target, source = tables
    assert rows(upsert(target, source, ["k"], "replace")) == [(1, "a", 1.0), (2, None, 20.0), (3, None, None), (4, None, 40.0)]
    assert rows(upsert(target, source, ["k"], "patch")) == [(1, "a", 1.0), (2, "b", 20.0), (3, "c", None), (4, None, 40.0)]
    assert rows(upsert(target, source, ["k"], "coalesce")) == [(1, "a", 1.0), (2, "b", 20.0), (3, "c", 3.0), (4, None, 40.0)]
    with pytest.raises(ValueError):
        upsert(target, source, ["k"], "merge")
    with pytest.raises(ValueError):
        upsert(target, source.withColumn("new", F.lit(1)), ["k"])


@pytest.mark.parametrize("rule", ["replace", "patch", "coalesce"])
def test_upsert_twice_changes_nothing(tables, rule):
    target, source = tables
    once = upsert(target, source, ["k"], rule)
    assert rows(upsert(once, source, ["k"], rule)) == rows(once)


def test_other_merges(tables, spark):
    target, source = tables
    assert rows(insert_if_absent(target, source, ["k"]))[-1] == (4, None, 40.0)
    assert len(rows(insert_if_absent(target, source, ["k"]))) == 4
    flags = spark.createDataFrame([(1, "z"), (2, None), (9, "q")], "k int, s string")
    assert rows(update_flags(target, flags, ["k"])) == [(1, "z", 1.0), (2, "b", None), (3, "c", 3.0)]


def test_retention_keeps_the_latest(spark):
    df = spark.createDataFrame([("A", "2024-01-01"), ("A", "2024-02-01"), ("B", "2023-01-01"), ("A", "2023-12-31")], "u string, d string")
    df = df.withColumn("d", F.col("d").cast("date"))
    kept = {(r["u"], str(r["d"])) for r in keep_recent(df, "d", ["u"], "2024-01-31", 30).collect()}
    assert kept == {("A", "2024-01-01"), ("A", "2024-02-01"), ("B", "2023-01-01")}


def test_reactivation(spark):
    basic = spark.createDataFrame(
        [("a", False, "performance", "2024-01-01 00:00:00"), ("b", False, "performance", "2024-01-30 00:00:00"),
         ("c", False, "manual", "2023-01-01 00:00:00"), ("d", False, "performance", None), ("e", True, None, None)],
        "factor_id string, is_valid boolean, deprecate_reason string, deprecate_time string",
    ).withColumns({"deprecate_time": F.col("deprecate_time").cast("timestamp"), "reactivated_time": F.lit(None).cast("timestamp")})
    runs = spark.createDataFrame(
        [(1, "a", 0.9, "2024-01-02"), (2, "a", 0.05, "2024-01-03"), (3, "b", 0.9, "2024-01-03")],
        "id int, factor_id string, ic_value double, backtest_time string",
    )
    for c in ("ic_ir", "sharpe_ratio", "max_drawdown"):
        runs = runs.withColumn(c, F.lit(None).cast("double"))
    assert [r[0] for r in lc.reactivation_candidates(basic, 30, "2024-01-31 00:00:00").collect()] == ["a"]
    out = {r["factor_id"]: r["is_valid"] for r in lc.reactivate(basic, runs, {"ic_min_reactivate": 0.03}, 30, "2024-01-31 00:00:00").collect()}
    assert out == {"a": True, "b": False, "c": False, "d": False, "e": True}
    out = {r["factor_id"]: r["is_valid"] for r in lc.reactivate(basic, runs, {"ic_min_reactivate": 0.06}, 30, "2024-01-31 00:00:00").collect()}
    assert out["a"] is False
