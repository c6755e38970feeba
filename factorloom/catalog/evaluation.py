"""Evaluation and correlation of several factors over the week panel."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import correlation as co
from ..operators import evaluate as ev
from ..operators.lineage import stored
from ..plans import factors as plan
from ..sources import writers
from .base import WEEK, avg_rank, lag, pearson, r, rounded, select, significant, sr, week_panel
from .factors import MANY, raw_sql, standardised_sql

GROUP = ["factor_id", "trade_date"]
PAIR = ["factor_a", "factor_b"]
HORIZON, BUCKETS = 5, 10
WINDOW_END, WINDOW_DAYS, MIN_DAYS = "2001-06-30", 2000, 120
QUERIES, SQL = {}, {}


def _stored(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Factor values and bars as stored tables."""
    bars = stored(week_panel(spark, sf_dir))
    return stored(plan.compute_factors(bars, plan.library(*MANY))), bars


def _paired(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ev.pair_with_returns(*_stored(spark, sf_dir), HORIZON)


def ic_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(ev.ic_daily(_paired(spark, sf_dir)), [*GROUP, "n"])


def ic_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    daily = ev.ic_daily(_paired(spark, sf_dir))
    return rounded(daily.groupBy("factor_id").agg(*[c.alias(k) for k, c in ev.ic_metrics().items()]), ["factor_id"])


def quantile_returns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(ev.quantile_returns(_paired(spark, sf_dir), BUCKETS), [*GROUP, "q", "n"])


def _buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ev.bucketed(_paired(spark, sf_dir), BUCKETS).select(*ev.BUCKET_COLUMNS)


def long_short(spark: SparkSession, sf_dir: str) -> DataFrame:
    daily = ev.daily_metrics(_buckets(spark, sf_dir), BUCKETS).where("ordinal is not null")
    return rounded(ev.with_curve(daily).select(*GROUP, "ls_ret", "drawdown"), GROUP)


def turnover(spark: SparkSession, sf_dir: str) -> DataFrame:
    buckets = _buckets(spark, sf_dir)
    return rounded(ev.turnover_daily(buckets, ev.daily_metrics(buckets, BUCKETS)), GROUP)


def sharpe_maxdd(spark: SparkSession, sf_dir: str) -> DataFrame:
    daily = ev.daily_metrics(_buckets(spark, sf_dir), BUCKETS).where("ordinal is not null")
    curve = ev.with_curve(daily)
    risk = curve.groupBy("factor_id").agg(
        ev.sharpe().alias("sharpe_ratio"), F.min("drawdown").alias("max_drawdown"), F.count("ls_ret").alias("days")
    )
    return rounded(risk, ["factor_id", "days"])


def evaluate_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = ev.evaluate(*_stored(spark, sf_dir), HORIZON, BUCKETS, "ALL")
    return rounded(out, ["factor_id", "test_universe", "backtest_period", "horizon"])


def _window_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    values = plan.compute_factors(week_panel(spark, sf_dir), plan.library(*MANY))
    end = F.lit(WINDOW_END).cast("date")
    return stored(values.where(F.col("trade_date").between(F.date_sub(end, WINDOW_DAYS), end)))


def corr_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(co.correlation_pairs(_window_values(spark, sf_dir)), [*PAIR, "overlap_days", "n"])


def corr_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return co.overlap_days(_window_values(spark, sf_dir))


def corr_passing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = co.passing_pairs(co.correlation_pairs(_window_values(spark, sf_dir)), MIN_DAYS)
    return rounded(pairs, [*PAIR, "overlap_days"])


def corr_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return co.pair_counts(co.correlation_pairs(_window_values(spark, sf_dir)), MIN_DAYS)


def snapshot_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The snapshot's JSON document, read back into one row per ordered pair."""
    pairs = rounded(co.passing_pairs(co.correlation_pairs(_window_values(spark, sf_dir)), MIN_DAYS), PAIR)
    doc = co.nested_document(pairs, WINDOW_END, "ALL", WINDOW_DAYS, "2001-07-01T00:00:00")
    layout = "as_of_date string, test_universe string, window string, corr map<string,map<string,double>>, generated_at string"
    head = doc.select("as_of_date", F.from_json("payload", layout).alias("d"))
    rows = head.select("as_of_date", "d", F.explode("d.corr").alias("factor_a", "row"))
    rows = rows.select("as_of_date", "d", "factor_a", F.explode("row").alias("factor_b", "corr"))
    return rows.select(
        "as_of_date",
        F.col("d.as_of_date").alias("written_date"),
        "d.test_universe",
        "d.window",
        "d.generated_at",
        *PAIR,
        "corr",
    )


def evaluation_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The JSON document of each factor's evaluation, read back; one factor has no metadata."""
    results = ev.evaluate(*_stored(spark, sf_dir), HORIZON, BUCKETS, "all_a")
    meta = results.where("factor_id <> 'trend_12'").select(
        "factor_id",
        F.upper("factor_id").alias("factor_name"),
        F.lit("price").alias("factor_type"),
        F.lit("week").alias("trading_cycle"),
        F.lit(None).cast("string").alias("source_url"),
    )
    doc = writers.evaluation_document(F.lit("2001-07-01 00:00:00"))
    layout = (
        "factor_id string, factor_name string, factor_type string, test_universe string, trading_cycle string,"
        " source_url string, horizon string, key_metrics struct<ic_value double, sharpe_ratio double, turnover double>,"
        " pass_standard boolean, backtest_time string"
    )
    back = results.join(meta, "factor_id", "left").select(F.from_json(doc, layout).alias("d"))
    names = ["factor_id", "factor_name", "factor_type", "test_universe", "trading_cycle", "source_url", "horizon"]
    return back.select(
        *[f"d.{n}" for n in names],
        "d.backtest_time",
        F.col("d.pass_standard").isNull().alias("undecided"),
        *[r(f"d.key_metrics.{m}").alias(m) for m in ("ic_value", "sharpe_ratio", "turnover")],
    )


for _q in (
    ic_daily, ic_summary, quantile_returns, long_short, turnover, sharpe_maxdd, evaluate_all,
    corr_pairs, corr_overlap, corr_passing, corr_counts, snapshot_json, evaluation_json,
):
    QUERIES[_q.__name__] = _q

_BY = "factor_id, trade_date"
_PAIRED = f"""WITH {WEEK},{raw_sql()},{standardised_sql()},
fr AS (
  SELECT trade_date, stock_code, ln(nullif({lag('close', -HORIZON)} / nullif(close, 0), 0)) AS ret,
    {lag('trade_date', -HORIZON)} AS ret_date
  FROM w
),
span AS (SELECT factor_id, min(trade_date) AS d0, max(trade_date) AS d1 FROM z GROUP BY factor_id),
p AS (
  SELECT factor_id, trade_date, stock_code, {significant('factor_value')} AS v, ret, {significant('ret')} AS rk
  FROM z JOIN fr USING (trade_date, stock_code) JOIN span USING (factor_id)
  WHERE factor_value IS NOT NULL AND ret IS NOT NULL AND ret_date <= d1
),
ranked AS (SELECT *, {avg_rank('v', _BY)} AS rv, {avg_rank('rk', _BY)} AS rr FROM p),
ic AS (
  SELECT factor_id, trade_date, count(*) AS n, count(DISTINCT v) AS nv, {pearson('rv', 'rr')} AS ic,
    count(DISTINCT rk) AS nr
  FROM ranked GROUP BY factor_id, trade_date
),
ic_ok AS (SELECT * FROM ic WHERE nv >= 2 AND nr >= 2 AND ic IS NOT NULL)"""
_LIST = "list(v ORDER BY v)"
_BUCKETED = f"""{_PAIRED},
l AS (SELECT factor_id, trade_date, {_LIST} AS l, count(*) AS n, count(DISTINCT v) AS nv FROM p GROUP BY factor_id, trade_date),
e AS (
  SELECT factor_id, trade_date, nv, list_distinct(list_transform(range(0, {BUCKETS + 1}), lambda k:
    l[(n - 1) * k // {BUCKETS} + 1] + (l[((n - 1) * k + {BUCKETS - 1}) // {BUCKETS} + 1] - l[(n - 1) * k // {BUCKETS} + 1])
      * (((n - 1) * k % {BUCKETS}) / {BUCKETS}.0)
  )) AS edges
  FROM l WHERE nv >= {BUCKETS}
),
b AS (
  SELECT p.*, greatest(len(list_filter(edges, lambda g: g < v)) - 1, 0) AS q FROM p JOIN e USING (factor_id, trade_date)
),
qr AS (SELECT factor_id, trade_date, q, avg(ret) AS mean_ret, count(*) AS n FROM b GROUP BY factor_id, trade_date, q),
ls AS (
  SELECT factor_id, trade_date, arg_max(mean_ret, q) - arg_min(mean_ret, q) AS ls_ret, max(q) AS top FROM qr
  GROUP BY factor_id, trade_date
),
o AS (SELECT *, row_number() OVER (PARTITION BY factor_id ORDER BY trade_date) AS ord FROM ls),
hold AS (SELECT b.factor_id, b.trade_date, ord, stock_code FROM b JOIN o USING (factor_id, trade_date) WHERE q = top),
tn AS (
  SELECT a.factor_id, a.trade_date, 1 - count(h.stock_code) / CAST(count(*) AS DOUBLE) AS turnover
  FROM hold a LEFT JOIN hold h ON h.factor_id = a.factor_id AND h.ord = a.ord - 1 AND h.stock_code = a.stock_code
  WHERE a.ord > 1 GROUP BY a.factor_id, a.trade_date
),
cu AS (
  SELECT *, product(1 + ls_ret) OVER (PARTITION BY factor_id ORDER BY trade_date ROWS UNBOUNDED PRECEDING) AS cum FROM o
),
pk AS (SELECT *, max(cum) OVER (PARTITION BY factor_id ORDER BY trade_date ROWS UNBOUNDED PRECEDING) AS peak FROM cu),
dd AS (SELECT *, cum / nullif(peak, 0) - 1 AS drawdown FROM pk)"""
_SHARPE = "avg(ls_ret) / nullif(stddev_samp(ls_ret), 0) * sqrt(252.0)"

SQL["ic_daily"] = f"{_PAIRED}\nSELECT factor_id, trade_date, n, {sr('ic')} AS ic FROM ic_ok"
SQL["ic_summary"] = (
    f"{_PAIRED}\nSELECT factor_id, {sr('avg(ic)')} AS ic_value, {sr('avg(ic) / nullif(stddev_samp(ic), 0)')} AS ic_ir"
    " FROM ic_ok GROUP BY factor_id"
)
SQL["quantile_returns"] = (
    f"{_BUCKETED}\nSELECT factor_id, trade_date, CAST(q AS INTEGER) AS q, n, {sr('mean_ret')} AS mean_ret FROM qr"
)
SQL["long_short"] = f"{_BUCKETED}\n" + select(
    {c: c for c in ("ls_ret", "drawdown")}, "dd", keys="factor_id, trade_date"
)
SQL["turnover"] = f"{_BUCKETED}\nSELECT factor_id, trade_date, {sr('turnover')} AS turnover FROM tn"
SQL["sharpe_maxdd"] = (
    f"{_BUCKETED}\nSELECT factor_id, {sr(_SHARPE)} AS sharpe_ratio, {sr('min(drawdown)')} AS max_drawdown,"
    " count(ls_ret) AS days FROM dd GROUP BY factor_id"
)
_SUMMARY = f"""{_BUCKETED},
a AS (SELECT factor_id, avg(ic) AS ic_value, avg(ic) / nullif(stddev_samp(ic), 0) AS ic_ir FROM ic_ok GROUP BY factor_id),
g AS (SELECT factor_id, {_SHARPE} AS sharpe_ratio, min(drawdown) AS max_drawdown FROM dd GROUP BY factor_id),
h AS (SELECT factor_id, avg(turnover) AS turnover FROM tn GROUP BY factor_id),
res AS (SELECT * FROM span LEFT JOIN a USING (factor_id) LEFT JOIN g USING (factor_id) LEFT JOIN h USING (factor_id))"""
SQL["evaluate_all"] = f"""{_SUMMARY}
SELECT factor_id, 'ALL' AS test_universe, d0 || ' 至 ' || d1 AS backtest_period, '{HORIZON}d' AS horizon,
  {', '.join(f"{sr(c)} AS {c}" for c in ('ic_value', 'ic_ir', 'sharpe_ratio', 'max_drawdown', 'turnover'))}
FROM res"""
SQL["evaluation_json"] = f"""{_SUMMARY}
SELECT factor_id, CASE WHEN factor_id = 'trend_12' THEN factor_id ELSE upper(factor_id) END AS factor_name,
  CASE WHEN factor_id <> 'trend_12' THEN 'price' END AS factor_type, 'ALL' AS test_universe,
  CASE WHEN factor_id <> 'trend_12' THEN 'week' END AS trading_cycle, CAST(NULL AS VARCHAR) AS source_url,
  '{HORIZON}d' AS horizon, '2001-07-01 00:00:00' AS backtest_time, true AS undecided,
  {', '.join(f"{sr(c)} AS {c}" for c in ('ic_value', 'sharpe_ratio', 'turnover'))}
FROM res"""

_WINDOW = f"""WITH {WEEK},{raw_sql()},{standardised_sql()},
v AS (
  SELECT * FROM z
  WHERE trade_date BETWEEN DATE '{WINDOW_END}' - {WINDOW_DAYS} AND DATE '{WINDOW_END}' AND factor_value IS NOT NULL
),
days AS (SELECT DISTINCT factor_id, trade_date FROM v),
ov AS (
  SELECT a.factor_id AS factor_a, b.factor_id AS factor_b, count(*) AS overlap_days
  FROM days a JOIN days b USING (trade_date) WHERE a.factor_id < b.factor_id GROUP BY 1, 2
),
cp AS (
  SELECT a.factor_id AS factor_a, b.factor_id AS factor_b, {pearson('a.factor_value', 'b.factor_value')} AS corr, count(*) AS n
  FROM v a JOIN v b USING (trade_date, stock_code) WHERE a.factor_id < b.factor_id GROUP BY 1, 2
),
pr AS (SELECT factor_a, factor_b, corr, overlap_days, n FROM cp JOIN ov USING (factor_a, factor_b)),
ok AS (SELECT * FROM pr WHERE corr IS NOT NULL AND overlap_days >= {MIN_DAYS}),
both_ways AS (SELECT factor_a, factor_b, corr, overlap_days FROM ok UNION ALL SELECT factor_b, factor_a, corr, overlap_days FROM ok)"""
SQL["corr_pairs"] = f"{_WINDOW}\nSELECT factor_a, factor_b, {sr('corr')} AS corr, overlap_days, n FROM pr"
SQL["corr_overlap"] = f"{_WINDOW}\nSELECT * FROM ov"
SQL["corr_passing"] = f"{_WINDOW}\nSELECT factor_a, factor_b, {sr('corr')} AS corr, overlap_days FROM both_ways"
SQL["corr_counts"] = f"""{_WINDOW}
SELECT 2 * count(*) AS total_pairs, 2 * count(corr) AS known_pairs,
  2 * count(CASE WHEN corr IS NOT NULL AND overlap_days >= {MIN_DAYS} THEN 1 END) AS passing_pairs
FROM pr"""
SQL["snapshot_json"] = f"""{_WINDOW}
SELECT DATE '{WINDOW_END}' AS as_of_date, '{WINDOW_END}' AS written_date, 'ALL' AS test_universe, '{WINDOW_DAYS}d' AS window,
  '2001-07-01T00:00:00' AS generated_at, factor_a, factor_b, {sr('corr')} AS corr
FROM both_ways"""
