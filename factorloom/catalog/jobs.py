"""Whole jobs: as-of questions, files, snapshots, daily and batch runs, ingest, thresholds, pointers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import latest as lt
from ..operators.correlation import nested_rows
from ..operators.lineage import run_folder
from ..plans import backtest as bt
from ..plans import factors as plan
from ..plans import ingest
from ..schema import VALUE_FILES
from ..sources import readers, writers
from . import evaluation
from .base import WEEK, lag, rounded, select, sr, table, week_panel
from .factors import standardised_sql
from .keyed import _BASIC, _CANDIDATES, _FIRST_LAST, _GONE, _HISTORY, COOLDOWN, NOW, THRESHOLDS, _ntz, basic, history

QUERIES, SQL = {}, {}


def asof_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For every order the customer's dearest finished order of the latest day up to it, else of the first such day."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("day"), "o_totalprice", "o_orderstatus")
    known = orders.where("o_orderstatus = 'F'").select("o_custkey", "day", F.col("o_totalprice").alias("price"))
    out = lt.asof_join(orders.select("o_orderkey", "o_custkey", "day"), known, ["o_custkey"], "day")
    return out.select("o_orderkey", "o_custkey", F.col("asof.day").alias("asof_day"), "asof.price")


SQL["asof_orders"] = """
WITH o AS (SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS day, o_totalprice, o_orderstatus FROM orders),
k AS (SELECT o_custkey, day, max(o_totalprice) AS price FROM o WHERE o_orderstatus = 'F' GROUP BY o_custkey, day),
f AS (SELECT DISTINCT ON (o_custkey) * FROM k ORDER BY o_custkey, day)
SELECT o.o_orderkey, o.o_custkey, coalesce(k.day, f.day) AS asof_day, coalesce(k.price, f.price) AS price
FROM o ASOF LEFT JOIN k ON o.o_custkey = k.o_custkey AND o.day >= k.day LEFT JOIN f ON o.o_custkey = f.o_custkey"""


def values_newest_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as factor files, an older and a newer span each, one name off the convention: the newer ones are read."""
    root = run_folder(spark, "files")
    orders = table(spark, sf_dir, "orders").select(
        "o_orderstatus", F.year("o_orderdate").alias("y"), F.to_date("o_orderdate").alias("trade_date"), F.col("o_orderkey").cast("string").alias("stock_code"),
        F.when(F.col("o_orderkey") % 97 == 0, F.lit("bad")).otherwise(F.col("o_totalprice").cast("string")).alias("factor_value"),
    )
    columns = ["trade_date", "stock_code", "factor_value"]
    for status in "FOP":
        for a, b in ((1992, 1996), (1997, 2001)):
            part = orders.where((F.col("o_orderstatus") == status) & F.col("y").between(a, b)).select(columns)
            part.write.option("header", True).csv(f"{root}/by_universe/ALL/a {status}[1]+_ALL_{a}-01-01_{b}-12-31.csv")
    orders.select(columns).write.option("header", True).csv(f"{root}/by_universe/ALL/notes.csv")
    return readers.read_values_dir(spark, root, " all")


SQL["values_newest_files"] = """
SELECT 'a ' || o_orderstatus || '[1]+' AS factor_id, CAST(o_orderdate AS DATE) AS trade_date, CAST(o_orderkey AS VARCHAR) AS stock_code,
  CASE WHEN o_orderkey % 97 <> 0 THEN o_totalprice END AS factor_value
FROM orders WHERE year(o_orderdate) BETWEEN 1997 AND 2001"""

SNAPSHOTS = ("2000-01-31", "2000-02-29", "2000-03-31")


def _snapshot_folder(spark: SparkSession, sf_dir: str) -> str:
    """Three snapshots of two universes: of the customers' orders up to a day, per status pair."""
    path = run_folder(spark, "snapshots")
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderstatus", "o_orderpriority", F.to_date("o_orderdate").alias("day"))
    for as_of in SNAPSHOTS:
        upto = orders.where(F.col("day") <= F.lit(as_of).cast("date"))
        pairs = upto.groupBy(F.col("o_orderstatus").alias("factor_a"), F.col("o_orderpriority").alias("factor_b")).agg((F.count("*") / 7).alias("corr"))
        writers.write_snapshot(pairs, path, "ALL", as_of)
        if as_of != SNAPSHOTS[2]:  # this one's latest is older than what is kept
            writers.write_snapshot(pairs, path, "HS300", as_of)
    writers.drop_snapshots(spark, path, "2000-04-20", 45)
    return path


def snapshot_retention(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = writers.read_snapshots(spark, _snapshot_folder(spark, sf_dir))
    return rounded(kept, ["universe", "as_of_date", "factor_a", "factor_b"])


def snapshot_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row per factor of the newest snapshot, its correlations as JSON."""
    path = _snapshot_folder(spark, sf_dir)
    both = [nested_rows(writers.read_latest_snapshot(spark, path, u)).withColumn("universe", F.lit(u)) for u in ("ALL", "HS300")]
    rows = reduce(DataFrame.unionByName, both)
    return rounded(rows.select("universe", "factor_id", F.explode("corr").alias("factor_b", "corr")), ["universe", "factor_id", "factor_b"])


_SNAP = f"""
WITH s AS (
  SELECT u AS universe, d AS as_of_date, o_orderstatus AS factor_a, o_orderpriority AS factor_b, round(count(*) / 7, 6) AS corr
  FROM orders, unnest(['ALL', 'HS300']) AS x(u), unnest([DATE '{SNAPSHOTS[0]}', DATE '{SNAPSHOTS[1]}', DATE '{SNAPSHOTS[2]}']) AS y(d)
  WHERE CAST(o_orderdate AS DATE) <= d AND (u = 'ALL' OR d < DATE '{SNAPSHOTS[2]}') GROUP BY ALL
)"""
SQL["snapshot_retention"] = f"""{_SNAP}
SELECT * FROM s WHERE as_of_date >= DATE '2000-04-20' - 45 OR (universe = 'HS300' AND as_of_date = DATE '{SNAPSHOTS[1]}')"""
SQL["snapshot_latest"] = f"""{_SNAP}
SELECT universe, factor_a AS factor_id, factor_b, corr FROM s WHERE as_of_date = CASE universe WHEN 'ALL' THEN DATE '{SNAPSHOTS[2]}' ELSE DATE '{SNAPSHOTS[1]}' END"""

DAYS = ("1999-03-10", "1999-03-17", "1999-03-10")


def _empty_registry(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], VALUE_FILES)


def daily_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two days' values and their registry, the first day run again, with one factor that does not fit the panel."""
    bars, path, registry = week_panel(spark, sf_dir), run_folder(spark, "daily"), _empty_registry(spark)
    mine = {"mom4": plan.momentum(4), "gone": F.col("nope")}
    for i, day in enumerate(DAYS):
        now = f"2001-01-0{i + 1} 00:00:00"
        registry, bad = bt.run_daily(bars, mine, day, "", path, registry, now, days=60)
        assert list(bad) == ["gone"]
    values = spark.read.parquet(path)
    listed = registry.groupBy("factor_id", "universe", "trade_date").agg(F.count("*").alias("entries"), F.max(F.dayofmonth("created_at")).alias("last_run"))
    both = values.select("factor_id", "trade_date", "stock_code", "factor_value").join(listed, ["factor_id", "trade_date"], "full")
    return rounded(both, ["factor_id", "universe", "trade_date", "stock_code", "entries", "last_run"])


def _day(day: str, run: int) -> str:
    return f"""
SELECT *, {run} AS last_run FROM (
  WITH t AS (
    SELECT coalesce(max(CASE WHEN trade_date <= DATE '{day}' THEN trade_date END), min(trade_date)) AS day
    FROM w WHERE trade_date BETWEEN DATE '{day}' - 60 AND DATE '{day}'
  ),
  w2 AS (SELECT w.* FROM w, t WHERE trade_date BETWEEN day - 60 AND day),
  m AS (SELECT trade_date, stock_code, (close - {lag('close', 4)}) / nullif({lag('close', 4)}, 0) AS x FROM w2),
  today AS (SELECT 'mom4' AS factor_id, m.* FROM m, t WHERE trade_date = day),{standardised_sql('today')}
  SELECT factor_id, 'ALL' AS universe, trade_date, stock_code, round(factor_value, 6) + 0.0 AS factor_value FROM z
)"""


SQL["daily_job"] = f"""WITH {WEEK}
SELECT factor_id, universe, trade_date, stock_code, factor_value, CAST(1 AS BIGINT) AS entries, last_run
FROM ({_day(DAYS[0], 3)} UNION ALL {_day(DAYS[1], 2)})"""


def batch_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A range of values with a factor that does not fit the panel, then the same span again: values and registry."""
    bars, path, registry = week_panel(spark, sf_dir), run_folder(spark, "batch"), _empty_registry(spark)
    mine = {"mom4": plan.momentum(4), "gone": F.col("nope")}
    for now in ("2001-01-01 00:00:00", "2001-01-02 00:00:00"):
        registry, bad = bt.run_batch(bars, mine, "ALL", "1998-01-01", "1999-12-31", path, registry, now)
        assert list(bad) == ["gone"]
    listed = registry.groupBy("factor_id", "universe", "date_start", "date_end").agg(F.count("*").alias("entries"), F.max(F.dayofmonth("created_at")).alias("last_run"))
    values = spark.read.parquet(path).select("factor_id", "trade_date", "stock_code", "factor_value")
    both = values.join(listed, "factor_id", "full")
    return rounded(both, ["factor_id", "universe", "trade_date", "stock_code", "date_start", "date_end", "entries", "last_run"])


SQL["batch_job"] = f"""WITH {WEEK},
w2 AS (SELECT * FROM w WHERE trade_date BETWEEN DATE '1998-01-01' AND DATE '1999-12-31'),
raw AS (SELECT 'mom4' AS factor_id, trade_date, stock_code, (close - {lag('close', 4)}) / nullif({lag('close', 4)}, 0) AS x FROM w2),{standardised_sql('raw')}
""" + select(
    {"factor_value": "factor_value"},
    "z",
    keys="factor_id, 'ALL' AS universe, trade_date, stock_code, DATE '1998-01-01' AS date_start, DATE '1999-12-31' AS date_end, CAST(1 AS BIGINT) AS entries, 2 AS last_run",
)


def _ingested(spark: SparkSession, sf_dir: str, order: tuple[int, ...]) -> DataFrame:
    """Week bars after a first load and three overlapping batches; of a bar in several the one updated last counts."""
    path = run_folder(spark, "bars")
    bars = week_panel(spark, sf_dir).select("stock_code", "trade_date", "open", "close")
    stamp = lambda n: F.lit(f"2001-01-0{n} 00:00:00").cast("timestamp")
    first = bars.where("trade_date < '1998-01-01'").withColumn("update_time", stamp(1))
    batches = [
        bars.where("trade_date between '1997-06-01' and '1998-06-30'").withColumns({"close": F.col("close") + 1, "update_time": stamp(2)}),
        bars.where("trade_date between '1998-03-01' and '1998-09-30'").withColumns({"close": F.col("close") + 2, "update_time": stamp(3)}),
        bars.where("trade_date between '1997-11-01' and '1998-04-30'").withColumns({"close": F.col("close") + 3, "update_time": stamp(4)}),
    ]
    ingest.load_history(first, path, "1990-01-01", "1997-12-31")
    for i in order:
        ingest.sync_bars(spark, batches[i], path, "1998-09-30", 500, rule="latest")
    return spark.read.parquet(path).select("stock_code", "trade_date", "open", "close", F.dayofmonth("update_time").alias("batch"))


def ingest_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table after the batches in two orders: a row of both has ``runs`` 2."""
    both = _ingested(spark, sf_dir, (0, 1, 2)).unionByName(_ingested(spark, sf_dir, (2, 0, 1)))
    keys = ["stock_code", "trade_date", "batch"]
    return rounded(both.groupBy(*keys, "open", "close").agg(F.count("*").alias("runs")), [*keys, "runs"], {"open": 7, "close": 7})


SQL["ingest_batches"] = f"""WITH {WEEK},
b AS (
  SELECT stock_code, trade_date, open, close + up AS close, batch
  FROM w, (VALUES (0, 1, DATE '1990-01-01', DATE '1997-12-31'), (1, 2, DATE '1997-06-01', DATE '1998-06-30'),
           (2, 3, DATE '1998-03-01', DATE '1998-09-30'), (3, 4, DATE '1997-11-01', DATE '1998-04-30')) AS x(up, batch, a, z)
  WHERE trade_date BETWEEN a AND z AND trade_date <= DATE '1998-09-30' AND (batch = 1 OR trade_date >= DATE '1998-09-30' - 500)
)
SELECT stock_code, trade_date, round(arg_max(open, batch), 7) AS open, round(arg_max(close, batch), 7) AS close, max(batch) AS batch, CAST(2 AS BIGINT) AS runs
FROM b GROUP BY stock_code, trade_date"""


def _config(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Threshold rows by nation, of which the last active one of the scene holds the thresholds in use."""
    nation = table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("bigint").alias("id"))
    right = F.col("id") == 20
    limits = [F.when(right, F.lit(v)).otherwise(F.lit(v * 10)).alias(k) for k, v in THRESHOLDS.items()]
    created = F.to_timestamp(F.lit(NOW)) + F.make_dt_interval(F.col("id").cast("int"))
    return nation.select("id", F.when(F.col("id") % 2 == 0, "prod").otherwise("test").alias("scene"), (F.col("id") <= 20).alias("is_active"), created.alias("created_at"), *limits)


def recheck_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Retirement by thresholds that the plan reads from their table."""
    out = bt.run_recheck(basic(spark, sf_dir), history(spark, sf_dir), _config(spark, sf_dir), "prod", NOW)
    return _ntz(out.select("factor_id", "is_valid", "deprecate_reason", "deprecate_time"))


def reactivation_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = bt.run_reactivation(basic(spark, sf_dir), history(spark, sf_dir), _config(spark, sf_dir), "prod", COOLDOWN, NOW)
    return _ntz(out.select("factor_id", "is_valid", "deprecate_reason", "reactivated_time"))


SQL["recheck_table"] = f"""WITH {_HISTORY},{_BASIC},{_FIRST_LAST},
g AS (SELECT factor_id FROM fl WHERE {_GONE})
SELECT b.factor_id, is_valid AND g.factor_id IS NULL AS is_valid,
  CASE WHEN g.factor_id IS NULL THEN deprecate_reason ELSE coalesce(deprecate_reason, 'performance') END AS deprecate_reason,
  CASE WHEN g.factor_id IS NULL THEN deprecate_time ELSE TIMESTAMP '{NOW}' END AS deprecate_time
FROM b LEFT JOIN g USING (factor_id)"""
SQL["reactivation_table"] = f"""WITH {_HISTORY},{_BASIC},{_CANDIDATES},
l AS (SELECT DISTINCT ON (factor_id) * FROM h JOIN cand USING (factor_id) ORDER BY factor_id, backtest_time DESC, id DESC),
y AS (SELECT factor_id FROM l WHERE ic_value >= 0.026 AND ic_ir >= 0.52 AND sharpe_ratio >= 0.93 AND max_drawdown >= -0.19)
SELECT b.factor_id, is_valid OR y.factor_id IS NOT NULL AS is_valid, deprecate_reason,
  CASE WHEN y.factor_id IS NOT NULL THEN TIMESTAMP '{NOW}' END AS reactivated_time
FROM b LEFT JOIN y USING (factor_id)"""


def pointer_ranks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that lie where a run registered them, under the name by universe, under the old name, or nowhere."""
    runs = history(spark, sf_dir)
    n = F.regexp_extract("factor_id", r"(\d+)$", 1).cast("int") % 4
    name = F.when(n == 1, F.concat(F.lit("docs/by_universe/ALL/"), "factor_id", F.lit("_ALL_backtest.json"))).when(
        n == 2, F.concat(F.lit("docs/"), "factor_id", F.lit("_backtest.json"))
    )
    files = runs.select(F.when(n == 0, F.col("result_json_rel_path")).otherwise(name).alias("rel_path")).where("rel_path is not null")
    return bt.document_pointers(lt.latest_per_key(runs, list(bt.RUN_KEYS), ["backtest_time", "id"]), files, "ALL", "docs")


SQL["pointer_ranks"] = f"""WITH {_HISTORY},
l AS (SELECT DISTINCT ON (factor_id, test_universe) * FROM h ORDER BY factor_id, test_universe, backtest_time DESC, id DESC),
f AS (
  SELECT factor_id, CAST(substr(factor_id, 2) AS INTEGER) % 4 AS n, max(CASE WHEN test_universe = 'ALL' THEN result_json_rel_path END) AS p
  FROM l GROUP BY factor_id
)
SELECT factor_id, CASE n WHEN 0 THEN p WHEN 1 THEN 'docs/by_universe/ALL/' || factor_id || '_ALL_backtest.json'
  ELSE 'docs/' || factor_id || '_backtest.json' END AS backtest_json_path
FROM f WHERE n IN (1, 2) OR (n = 0 AND p IS NOT NULL)"""

DOCUMENT = "factor_id string, factor_name string, key_metrics struct<ic_value double>"


def persist_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An evaluation whose one result feeds documents, the history and the list of factors; one factor is listed already."""
    documents, runs = run_folder(spark, "documents"), run_folder(spark, "runs")
    values, bars = evaluation._stored(spark, sf_dir)
    none = F.lit(None).cast("string")
    meta = values.select("factor_id").distinct().select(
        "factor_id", F.upper("factor_id").alias("factor_name"), none.alias("factor_type"), none.alias("trading_cycle"), none.alias("source_url")
    )
    listed = meta.where("factor_id = 'trend_12'").select("factor_id", F.lit("known").alias("factor_name"), F.lit(False).alias("is_valid"))
    now = F.lit(NOW).cast("timestamp")
    factors = bt.run_evaluation(values, bars, meta, listed, documents, runs, now, evaluation.HORIZON, evaluation.BUCKETS, "all_a")
    written = spark.read.text(documents).select(F.from_json("value", DOCUMENT).alias("d"))
    written = written.select("d.factor_id", F.col("d.key_metrics.ic_value").alias("document_ic"))
    history_ = spark.read.parquet(runs).select("factor_id", "test_universe", "ic_value", "turnover", F.col("pass_standard").isNull().alias("undecided"))
    both = factors.select("factor_id", "factor_name", "is_valid").join(history_, "factor_id", "full").join(written, "factor_id", "full")
    return rounded(both, ["factor_id", "factor_name", "is_valid", "test_universe", "undecided"])


SQL["persist_job"] = f"""{evaluation._SUMMARY}
SELECT factor_id, CASE WHEN factor_id = 'trend_12' THEN 'known' ELSE upper(factor_id) END AS factor_name, factor_id <> 'trend_12' AS is_valid,
  'ALL' AS test_universe, true AS undecided, {sr('ic_value')} AS ic_value, {sr('turnover')} AS turnover, {sr('ic_value')} AS document_ic
FROM res"""

for _q in (
    persist_job, asof_orders, values_newest_files, snapshot_retention, snapshot_latest, daily_job, batch_job, ingest_batches, recheck_table,
    reactivation_table, pointer_ranks,
):
    QUERIES[_q.__name__] = _q
