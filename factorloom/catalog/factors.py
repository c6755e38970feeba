"""Factors over the week panel: single, nested, conditional, many at once, and one day's values."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..functions import elem, ts
from ..operators import conform
from ..operators import cross_section as xs
from ..plans import factors as plan
from .base import SERIES, WEEK, full, lag, rank01, rounded, select, significant, week_panel

KEYS = ["trade_date", "stock_code"]
LONG_KEYS = ["factor_id", *KEYS]
QUERIES, SQL = {}, {}
MANY = ("momentum_20", "signed_volume_8", "trend_12", "vwap_gap_10")
DAY, LOOKBACK = "2000-06-10", 380


def factor_momentum(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = week_panel(spark, sf_dir).withColumn("raw", plan.momentum(20))
    df = xs.winsorize_and_standardize(df, "raw", "value")
    return rounded(df.select(*KEYS, "raw", "value"), KEYS)


def factor_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = plan.wide_factors(week_panel(spark, sf_dir), plan.library("rank_corr_10"))
    return rounded(df, KEYS)


def factor_conditional(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 6-row volume sum where the close stands above its 10-row mean, else minus the 6-row volume range."""
    above = elem.gt("close", ts.ma("close", 10))
    spread = ts.ts_max("volume", 6) - ts.ts_min("volume", 6)
    value = elem.if_(above, ts.ts_sum("volume", 6), -spread)
    df = week_panel(spark, sf_dir)
    df = df.select(*KEYS, value.alias("value"), elem.filter_(ts.decaylinear("volume", 5), above).alias("kept"))
    return rounded(df, KEYS)


def factors_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = plan.compute_factors(week_panel(spark, sf_dir), plan.library(*MANY))
    return rounded(df, LONG_KEYS)


def factor_asof_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = plan.compute_day(week_panel(spark, sf_dir), plan.library(*MANY), DAY, LOOKBACK)
    return rounded(df, LONG_KEYS)


def factor_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = plan.wide_factors(week_panel(spark, sf_dir), plan.library(*MANY))
    return conform.value_counts(plan.long_values(raw, MANY), "1995-03-13")


QUERIES.update(
    factor_counts=factor_counts,
    factor_momentum=factor_momentum,
    factor_nested=factor_nested,
    factor_conditional=factor_conditional,
    factors_long=factors_long,
    factor_asof_day=factor_asof_day,
)


def raw_sql(source: str = "w") -> str:
    """CTEs up to ``raw_long(factor_id, trade_date, stock_code, x)`` for the factors of ``MANY``."""
    move = f"close - {lag('close')}"
    return f"""
d AS (
  SELECT *, turnover / nullif(volume, 0) AS vwap, {move} AS mv, row_number() OVER {SERIES} AS seq FROM {source}
),
f AS (SELECT *, CASE WHEN mv > 0 THEN volume WHEN mv < 0 THEN -volume ELSE 0.0 END AS flow FROM d),
raw AS (
  SELECT trade_date, stock_code,
    (close - {lag('close', 20)}) / nullif({lag('close', 20)}, 0) AS momentum_20,
    {full(8, 'flow', 'sum(flow) {w}')} AS signed_volume_8,
    {full(12, 'close', 'covar_samp(close, seq) {w} / nullif(var_samp(seq) {w}, 0)')} AS trend_12,
    close / nullif({full(10, 'vwap', 'avg(vwap) {w}')}, 0) - 1 AS vwap_gap_10
  FROM f
),
raw_long AS (
  {' UNION ALL '.join(f"SELECT '{n}' AS factor_id, trade_date, stock_code, {significant(n)} AS x FROM raw" for n in MANY)}
)"""


def standardised_sql(source: str = "raw_long") -> str:
    """CTE ``z(factor_id, trade_date, stock_code, factor_value)``."""
    return f"""
zq AS (
  SELECT factor_id, trade_date, quantile_cont(x, 0.01) AS lo, quantile_cont(x, 0.99) AS hi
  FROM {source} GROUP BY factor_id, trade_date
),
zc AS (
  SELECT l.*, CASE WHEN x IS NOT NULL THEN least(greatest(x, lo), hi) END AS c
  FROM {source} l JOIN zq USING (factor_id, trade_date)
),
zs AS (SELECT factor_id, trade_date, avg(c) AS m, stddev_samp(c) AS sd, min(c) = max(c) AS flat FROM zc GROUP BY factor_id, trade_date),
z AS (
  SELECT factor_id, trade_date, stock_code,
    CASE WHEN sd IS NULL OR flat THEN 0.0 ELSE (c - m) / sd END AS factor_value
  FROM zc JOIN zs USING (factor_id, trade_date)
)"""


LONG = "factor_id, trade_date, stock_code"
SQL["factors_long"] = f"WITH {WEEK},{raw_sql()},{standardised_sql()}\n" + select(
    {"factor_value": "factor_value"}, "z", keys=LONG
)
SQL["factor_counts"] = f"""WITH {WEEK},{raw_sql()}
SELECT factor_id, count(*) AS n_rows, CAST(count_if(trade_date = DATE '1995-03-13') AS BIGINT) AS n_day,
  CAST(count_if(trade_date = DATE '1995-03-13' AND x IS NOT NULL) AS BIGINT) AS n_day_known
FROM raw_long GROUP BY factor_id"""
SQL["factor_momentum"] = f"""WITH {WEEK},
raw_long AS (
  SELECT 'm' AS factor_id, trade_date, stock_code, (close - {lag('close', 20)}) / nullif({lag('close', 20)}, 0) AS x FROM w
),{standardised_sql()}
""" + select({"raw": "x", "value": "factor_value"}, "raw_long JOIN z USING (factor_id, trade_date, stock_code)")
SQL["factor_nested"] = f"""WITH {WEEK},
a AS (SELECT trade_date, stock_code, {rank01('close')} AS rc, {rank01('volume')} AS rv FROM w),
b AS (
  SELECT trade_date, stock_code, round({full(10, 'rc + rv',
         'covar_samp(rc, rv) {w} / nullif(stddev_samp(rc) {w} * stddev_samp(rv) {w}, 0)')}, 10) AS c
  FROM a
)
""" + select({"rank_corr_10": f"-({rank01('c')})"}, "b")
SQL["factor_conditional"] = f"""WITH {WEEK},
a AS (
  SELECT *, {full(10, 'close', 'avg(close) {w}')} AS m10, {full(6, 'volume', 'sum(volume) {w}')} AS s6,
    {full(6, 'volume', 'max(volume) {w}')} - {full(6, 'volume', 'min(volume) {w}')} AS rg,
    {' + '.join(f"({lag('volume', 5 - i) if i < 5 else 'volume'}) * {i / 15!r}" for i in range(1, 6))} AS dl
  FROM w
)
""" + select(
    {
        "value": "CASE WHEN close > m10 THEN s6 ELSE -rg END",
        "kept": "CASE WHEN close > m10 THEN dl END",
    },
    "a",
)
SQL["factor_asof_day"] = f"""WITH {WEEK},
t AS (
  SELECT coalesce(max(CASE WHEN trade_date <= DATE '{DAY}' THEN trade_date END), min(trade_date)) AS day
  FROM w WHERE trade_date BETWEEN DATE '{DAY}' - {LOOKBACK} AND DATE '{DAY}'
),
w2 AS (SELECT w.* FROM w, t WHERE trade_date BETWEEN day - {LOOKBACK} AND day),{raw_sql('w2')},
today AS (SELECT l.* FROM raw_long l, t WHERE trade_date = day),{standardised_sql('today')}
""" + select({"factor_value": "factor_value"}, "z", keys=LONG)
