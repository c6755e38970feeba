"""Latest-per-key, decisions, upserts and retention over tables derived from orders and customers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import latest as lt
from ..operators import lifecycle as lc
from ..operators import upsert as up
from ..operators.universe import choose_ids, missing_ids
from ..plans.backtest import select_and_store
from .base import table

QUERIES, SQL = {}, {}
NOW, COOLDOWN = "2001-01-01 00:00:00", 30
CUT = "2000-01-01"
THRESHOLDS = {
    "ic_min": 0.013,
    "ic_ir_min": 0.41,
    "sharpe_min": 0.72,
    "max_drawdown_max": -0.27,
    "turnover_max": 0.66,
    "ic_decay_threshold": 0.45,
    "latest_ic_min": 0.017,
    "ic_min_reactivate": 0.026,
    "ic_ir_min_reactivate": 0.52,
    "sharpe_min_reactivate": 0.93,
    "max_drawdown_max_reactivate": -0.19,
}


def history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as evaluation runs: the customer is the factor, the price level the metrics."""
    ic = F.round(F.col("o_totalprice") / 1_000_000 - 0.2, 8)
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.concat(F.lit("F"), F.col("o_custkey")).alias("factor_id"),
        F.when(F.col("o_orderpriority") < "3", "ALL").otherwise("HS300").alias("test_universe"),
        ic.alias("ic_value"),
        F.when(F.col("o_orderstatus") != "P", F.round(ic * 4, 8)).alias("ic_ir"),
        F.when(F.col("o_orderpriority") == "5-LOW", float("nan")).otherwise(F.round(ic * 10, 8)).alias("sharpe_ratio"),
        F.round(-F.col("o_totalprice") / 2_000_000, 9).alias("max_drawdown"),
        F.round(F.col("o_totalprice") / 500_000, 8).alias("turnover"),
        F.col("o_orderdate").cast("timestamp").alias("backtest_time"),
        F.lit(None).cast("boolean").alias("pass_standard"),
        F.concat(F.lit("runs/"), F.col("o_orderkey"), F.lit(".json")).alias("result_json_rel_path"),
    )


def basic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as factor metadata; those with a low balance are retired."""
    retired = F.col("c_acctbal") < 3000
    return table(spark, sf_dir, "customer").select(
        F.concat(F.lit("F"), F.col("c_custkey")).alias("factor_id"),
        F.col("c_name").alias("factor_name"),
        (~retired).alias("is_valid"),
        F.when(retired, F.when(F.col("c_mktsegment") < "C", "manual").otherwise("performance")).alias("deprecate_reason"),
        F.when(retired, F.to_timestamp(F.lit(NOW)) - F.make_dt_interval(F.abs("c_acctbal").cast("int") % 90)).alias(
            "deprecate_time"
        ),
        F.lit(None).cast("timestamp").alias("reactivated_time"),
    )


_HISTORY = """
h0 AS (SELECT *, round(o_totalprice / 1000000 - 0.2, 8) AS ic FROM orders),
h AS (
  SELECT o_orderkey AS id, 'F' || o_custkey AS factor_id,
    CASE WHEN o_orderpriority < '3' THEN 'ALL' ELSE 'HS300' END AS test_universe, ic AS ic_value,
    CASE WHEN o_orderstatus <> 'P' THEN round(ic * 4, 8) END AS ic_ir,
    CASE WHEN o_orderpriority <> '5-LOW' THEN round(ic * 10, 8) END AS sharpe_ratio,
    round(-o_totalprice / 2000000, 9) AS max_drawdown, round(o_totalprice / 500000, 8) AS turnover,
    o_orderdate AS backtest_time, 'runs/' || o_orderkey || '.json' AS result_json_rel_path
  FROM h0
)"""
_BASIC = f"""
b AS (
  SELECT 'F' || c_custkey AS factor_id, c_name AS factor_name, NOT (c_acctbal < 3000) AS is_valid,
    CASE WHEN c_acctbal < 3000 THEN CASE WHEN c_mktsegment < 'C' THEN 'manual' ELSE 'performance' END END AS deprecate_reason,
    CASE WHEN c_acctbal < 3000
      THEN TIMESTAMP '{NOW}' - to_days(CAST(trunc(abs(c_acctbal)) AS INTEGER) % 90) END AS deprecate_time
  FROM customer
)"""
_LATEST = "SELECT DISTINCT ON (factor_id, test_universe) * FROM h ORDER BY factor_id, test_universe, backtest_time DESC, id DESC"
_PASS = (
    "coalesce(ic_value >= 0.013, false) AND coalesce(ic_ir >= 0.41, false) AND coalesce(sharpe_ratio >= 0.72, false)"
    " AND coalesce(max_drawdown >= -0.27, false) AND coalesce(turnover <= 0.66, false)"
)
_FIRST_LAST = """
fl AS (
  SELECT factor_id, arg_min(ic_value, row(backtest_time, id)) AS ic_init, arg_max(ic_value, row(backtest_time, id)) AS ic_latest,
    arg_min(id, row(backtest_time, id)) AS id_init, arg_max(id, row(backtest_time, id)) AS id_latest
  FROM h WHERE factor_id IN (SELECT factor_id FROM b WHERE is_valid) GROUP BY factor_id
)"""
_GONE = """coalesce(CASE WHEN ic_init <= 0 OR abs(ic_init) <= 1e-8 THEN ic_latest < 0.017
  ELSE (ic_init - ic_latest) / ic_init > 0.45 AND ic_latest < 0.017 END, false)"""
_KEEP = ["factor_id", "test_universe", "id", "ic_value", "turnover", "backtest_time"]


def _ntz(df: DataFrame) -> DataFrame:
    """Timestamps without a zone, as DuckDB has them."""
    return df.select(*[F.col(c).cast("timestamp_ntz").alias(c) if t == "timestamp" else F.col(c) for c, t in df.dtypes])


def latest_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = lt.latest_per_key(history(spark, sf_dir), ["factor_id", "test_universe"], lc.RUN_ORDER)
    return _ntz(rows.select(*_KEEP))


def first_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = lc.init_and_latest_ic(history(spark, sf_dir), basic(spark, sf_dir))
    return df.select(
        "factor_id",
        F.col("ic_value_init").alias("ic_init"),
        F.col("ic_value_latest").alias("ic_latest"),
        "id_init",
        "id_latest",
    )


def asof_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("d"))
    asked = ("2000-06-11", "1990-01-01")
    found = [lt.latest_date_upto(days, "d", F.lit(a).cast("date")).withColumn("asked", F.lit(a)) for a in asked]
    return found[0].unionByName(found[1])


def threshold_pass(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = lt.latest_per_key(history(spark, sf_dir), ["factor_id", "test_universe"], lc.RUN_ORDER)
    return rows.select("factor_id", "test_universe", "id", lc.passes(THRESHOLDS).alias("passed"))


def deprecate(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = lc.deprecate(basic(spark, sf_dir), history(spark, sf_dir), THRESHOLDS, NOW)
    return _ntz(out.select("factor_id", "is_valid", "deprecate_reason", "deprecate_time"))


def reactivate_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lc.reactivation_candidates(basic(spark, sf_dir), COOLDOWN, NOW)


def reactivate(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = lc.reactivate(basic(spark, sf_dir), history(spark, sf_dir), THRESHOLDS, COOLDOWN, NOW)
    return _ntz(out.select("factor_id", "is_valid", "deprecate_reason", "reactivated_time"))


def valid_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = lt.latest_per_key(history(spark, sf_dir), ["factor_id", "test_universe"], lc.RUN_ORDER)
    status = rows.select("factor_id", "test_universe", lc.passes(THRESHOLDS).alias("is_valid"))
    return lc.valid_anywhere(status, basic(spark, sf_dir)).select("factor_id", "is_valid")


def selection_step(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Status, validity and document pointer after a whole selection step, one row per factor."""
    runs, meta = history(spark, sf_dir), basic(spark, sf_dir)
    # the listing of existing documents holds those of runs with a known ic_ir
    files = runs.where("ic_ir is not null").select(F.col("result_json_rel_path").alias("rel_path"))
    empty = meta.select("factor_id", *[F.lit(None).cast("string").alias(c) for c in ("doc_path", "backtest_json_path", "log_path")])
    status = runs.select("factor_id", "test_universe", F.lit(False).alias("is_valid"), F.lit(NOW).cast("timestamp").alias("updated_at"))
    status = status.dropDuplicates(["factor_id", "test_universe"]).where("test_universe = 'HS300'")
    out = select_and_store(runs, meta, status, empty, files, THRESHOLDS, now=NOW)
    flags = out["backtests"].groupBy("factor_id").agg(F.count_if("pass_standard").alias("runs_passed"))
    live = out["status"].groupBy("factor_id").agg(F.count(F.lit(1)).alias("universes"), F.count_if("is_valid").alias("universes_valid"))
    df = out["basic"].select("factor_id", "is_valid")
    for part in (flags, live, out["files"].select("factor_id", "backtest_json_path")):
        df = df.join(part, "factor_id", "left")
    return df


def upsert_parts(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Latest order per customer before and since the cut date; a high priority order has no price."""
    df = table(spark, sf_dir, "orders").select(
        "o_custkey",
        "o_orderdate",
        "o_orderkey",
        F.when(F.col("o_orderpriority") != "1-URGENT", F.col("o_totalprice")).alias("price"),
        F.col("o_orderstatus").alias("status"),
    )
    old = lt.latest_per_key(df.where(F.col("o_orderdate") < CUT), ["o_custkey"], ["o_orderdate", "o_orderkey"])
    return old.drop("o_orderdate"), df.where(F.col("o_orderdate") >= CUT)


def upsert_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    old, new = upsert_parts(spark, sf_dir)
    new = lt.latest_per_key(new, ["o_custkey"], ["o_orderdate", "o_orderkey"])
    return up.upsert(old, new.select("o_custkey", "o_orderkey", "price"), ["o_custkey"], "replace")


def upsert_patch(spark: SparkSession, sf_dir: str) -> DataFrame:
    old, new = upsert_parts(spark, sf_dir)
    new = lt.latest_per_key(new, ["o_custkey"], ["o_orderdate", "o_orderkey"])
    return up.upsert(old, new.select("o_custkey", "price"), ["o_custkey"], "patch")


def upsert_coalesce(spark: SparkSession, sf_dir: str) -> DataFrame:
    old, new = upsert_parts(spark, sf_dir)
    new = lt.latest_per_key(new, ["o_custkey"], ["o_orderdate", "o_orderkey"])
    return up.upsert(old, new.select("o_custkey", "price", "status"), ["o_custkey"], "coalesce")


def insert_if_absent(spark: SparkSession, sf_dir: str) -> DataFrame:
    old, new = upsert_parts(spark, sf_dir)
    new = lt.first_per_key(new, ["o_custkey"], ["o_orderdate", "o_orderkey"]).drop("o_orderdate")
    return up.insert_if_absent(old, new, ["o_custkey"])


def update_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    old, new = upsert_parts(spark, sf_dir)
    new = lt.latest_per_key(new, ["o_custkey"], ["o_orderdate", "o_orderkey"])
    decided = new.select("o_custkey", F.when(F.col("price").isNotNull(), "SEEN").alias("status"))
    return up.update_flags(old, decided, ["o_custkey"])


def retention(spark: SparkSession, sf_dir: str) -> DataFrame:
    # low priority orders lie three years back, so their latest snapshot lies outside the kept days
    day = F.to_date("o_orderdate")
    day = F.when(F.col("o_orderpriority") == "5-LOW", F.date_sub(day, 1100)).otherwise(day)
    snaps = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", "o_orderstatus", day.alias("as_of_date"))
    kept = up.keep_recent(snaps, "as_of_date", ["o_orderpriority"], "2001-07-15", 30)
    return kept.select("o_orderkey", "o_orderpriority", "as_of_date")


def path_sync(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latest non-blank path per customer's factor patched into the file table."""
    runs = history(spark, sf_dir)
    registry = runs.select(
        "factor_id", F.when(F.col("turnover") > 0.1, F.col("result_json_rel_path")).otherwise(" ").alias("rel_path"), "backtest_time", "id"
    )
    newest = lt.latest_per_key(registry, ["factor_id"], lc.RUN_ORDER).where(F.trim("rel_path") != "")
    files = basic(spark, sf_dir).where("is_valid").select(
        "factor_id", F.col("factor_name").alias("doc_path"), F.lit(None).cast("string").alias("factor_values_path")
    )
    return up.upsert(files, newest.select("factor_id", F.col("rel_path").alias("factor_values_path")), ["factor_id"], "patch")


def id_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Factors by scope, with the requested ones that are missing somewhere."""
    meta, runs = basic(spark, sf_dir), history(spark, sf_dir)
    chosen = choose_ids(meta.where("is_valid").select("factor_id"), exclude=["F1", "F2"])
    lacking = missing_ids(meta.select("factor_id"), chosen, runs.select("factor_id"))
    return chosen.withColumn("kind", F.lit("chosen")).unionByName(lacking.withColumn("kind", F.lit("missing")))


for _q in (
    latest_per_key, first_latest, asof_date, threshold_pass, deprecate, reactivate_candidates, reactivate,
    valid_rollup, selection_step, upsert_replace, upsert_patch, upsert_coalesce, insert_if_absent, update_flags,
    retention, path_sync, id_lists,
):
    QUERIES[_q.__name__] = _q

SQL["latest_per_key"] = f"WITH {_HISTORY}, l AS ({_LATEST})\nSELECT {', '.join(_KEEP)} FROM l"
SQL["first_latest"] = f"WITH {_HISTORY},{_BASIC},{_FIRST_LAST}\nSELECT * FROM fl"
SQL["asof_date"] = """
WITH d AS (SELECT CAST(o_orderdate AS DATE) AS d FROM orders)
SELECT max(d) AS effective_date, '2000-06-11' AS asked FROM d WHERE d <= DATE '2000-06-11'
UNION ALL SELECT min(d), '1990-01-01' FROM d"""
SQL["threshold_pass"] = f"WITH {_HISTORY}, l AS ({_LATEST})\nSELECT factor_id, test_universe, id, {_PASS} AS passed FROM l"
SQL["deprecate"] = f"""WITH {_HISTORY},{_BASIC},{_FIRST_LAST},
g AS (SELECT factor_id FROM fl WHERE {_GONE})
SELECT b.factor_id, is_valid AND g.factor_id IS NULL AS is_valid,
  CASE WHEN g.factor_id IS NULL THEN deprecate_reason ELSE coalesce(deprecate_reason, 'performance') END AS deprecate_reason,
  CASE WHEN g.factor_id IS NULL THEN deprecate_time ELSE TIMESTAMP '{NOW}' END AS deprecate_time
FROM b LEFT JOIN g USING (factor_id)"""
_CANDIDATES = f"""
cand AS (
  SELECT factor_id FROM b WHERE NOT is_valid AND deprecate_reason = 'performance'
    AND deprecate_time <= TIMESTAMP '{NOW}' - INTERVAL {COOLDOWN} DAY
)"""
SQL["reactivate_candidates"] = f"WITH {_BASIC},{_CANDIDATES}\nSELECT * FROM cand"
SQL["reactivate"] = f"""WITH {_HISTORY},{_BASIC},{_CANDIDATES},
l AS (SELECT DISTINCT ON (factor_id) * FROM h JOIN cand USING (factor_id) ORDER BY factor_id, backtest_time DESC, id DESC),
y AS (
  SELECT factor_id FROM l
  WHERE ic_value >= 0.026 AND ic_ir >= 0.52 AND sharpe_ratio >= 0.93 AND max_drawdown >= -0.19
)
SELECT b.factor_id, is_valid OR y.factor_id IS NOT NULL AS is_valid, deprecate_reason,
  CASE WHEN y.factor_id IS NOT NULL THEN TIMESTAMP '{NOW}' END AS reactivated_time
FROM b LEFT JOIN y USING (factor_id)"""
SQL["valid_rollup"] = f"""WITH {_HISTORY},{_BASIC}, l AS ({_LATEST}), s AS (SELECT factor_id, {_PASS} AS ok FROM l)
SELECT factor_id, factor_id IN (SELECT factor_id FROM s WHERE ok) AS is_valid FROM b"""
SQL["selection_step"] = f"""WITH {_HISTORY},{_BASIC}, l AS ({_LATEST}),
s AS (SELECT *, {_PASS} AS ok FROM l),
pt AS (SELECT factor_id, result_json_rel_path FROM s WHERE test_universe = 'ALL' AND ic_ir IS NOT NULL),
ag AS (SELECT factor_id, count(*) AS universes, count_if(ok) AS passed FROM s GROUP BY factor_id)
SELECT b.factor_id, CASE WHEN ag.factor_id IS NULL THEN b.is_valid ELSE passed > 0 END AS is_valid,
  CAST(passed AS BIGINT) AS runs_passed, universes, CAST(passed AS BIGINT) AS universes_valid,
  result_json_rel_path AS backtest_json_path
FROM b LEFT JOIN ag USING (factor_id) LEFT JOIN pt USING (factor_id)"""

_PARTS = f"""
o AS (
  SELECT o_custkey, o_orderdate, o_orderkey, CASE WHEN o_orderpriority <> '1-URGENT' THEN o_totalprice END AS price,
    o_orderstatus AS status FROM orders
),
old AS (SELECT DISTINCT ON (o_custkey) * FROM o WHERE o_orderdate < DATE '{CUT}' ORDER BY o_custkey, o_orderdate DESC, o_orderkey DESC),
new AS (SELECT DISTINCT ON (o_custkey) * FROM o WHERE o_orderdate >= DATE '{CUT}' ORDER BY o_custkey, o_orderdate DESC, o_orderkey DESC),
fst AS (SELECT DISTINCT ON (o_custkey) * FROM o WHERE o_orderdate >= DATE '{CUT}' ORDER BY o_custkey, o_orderdate, o_orderkey)"""


def _merge(orderkey: str, price: str, status: str) -> str:
    return f"""WITH {_PARTS}
SELECT coalesce(new.o_custkey, old.o_custkey) AS o_custkey, {orderkey} AS o_orderkey, {price} AS price, {status} AS status
FROM old FULL JOIN new ON old.o_custkey = new.o_custkey"""


_HIT = "new.o_custkey IS NOT NULL"
SQL["upsert_replace"] = _merge(
    "coalesce(new.o_orderkey, old.o_orderkey)",
    f"CASE WHEN {_HIT} THEN new.price ELSE old.price END",
    f"CASE WHEN {_HIT} THEN NULL ELSE old.status END",
)
SQL["upsert_patch"] = _merge("old.o_orderkey", f"CASE WHEN {_HIT} THEN new.price ELSE old.price END", "old.status")
SQL["upsert_coalesce"] = _merge("old.o_orderkey", "coalesce(new.price, old.price)", "coalesce(new.status, old.status)")
SQL["insert_if_absent"] = f"""WITH {_PARTS}
SELECT o_custkey, o_orderkey, price, status FROM old
UNION ALL SELECT o_custkey, o_orderkey, price, status FROM fst WHERE o_custkey NOT IN (SELECT o_custkey FROM old)"""
SQL["update_flags"] = f"""WITH {_PARTS}
SELECT old.o_custkey, old.o_orderkey, old.price, CASE WHEN new.price IS NOT NULL THEN 'SEEN' ELSE old.status END AS status
FROM old LEFT JOIN new ON old.o_custkey = new.o_custkey"""
SQL["retention"] = """
WITH s AS (
  SELECT o_orderkey, o_orderpriority,
    CAST(o_orderdate AS DATE) - CASE WHEN o_orderpriority = '5-LOW' THEN 1100 ELSE 0 END AS as_of_date FROM orders
)
SELECT * FROM s
WHERE as_of_date >= DATE '2001-07-15' - 30
  OR as_of_date = (SELECT max(as_of_date) FROM s t WHERE t.o_orderpriority = s.o_orderpriority)"""
SQL["path_sync"] = f"""WITH {_HISTORY},{_BASIC},
l AS (SELECT DISTINCT ON (factor_id) * FROM h ORDER BY factor_id, backtest_time DESC, id DESC),
n AS (SELECT factor_id, result_json_rel_path AS p FROM l WHERE turnover > 0.1),
f AS (SELECT factor_id, factor_name AS doc_path FROM b WHERE is_valid)
SELECT coalesce(f.factor_id, n.factor_id) AS factor_id, doc_path, p AS factor_values_path
FROM f FULL JOIN n ON f.factor_id = n.factor_id"""
SQL["id_lists"] = f"""WITH {_BASIC},
c AS (SELECT factor_id FROM b WHERE is_valid AND factor_id NOT IN ('F1', 'F2'))
SELECT factor_id, 'chosen' AS kind FROM c
UNION ALL
SELECT factor_id, 'missing' AS kind FROM b
WHERE factor_id NOT IN (SELECT factor_id FROM c) OR factor_id NOT IN (SELECT 'F' || o_custkey FROM orders)"""
