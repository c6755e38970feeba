"""Codes, universes and conformance, over rows derived from line items, parts, suppliers and orders."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import codes
from ..operators import conform as cf
from ..operators import universe as un
from ..operators.documents import number_raw_factors
from ..sources import readers
from .base import WEEK, r, rounded, sr, table, week_panel

KEYS = ["trade_date", "stock_code"]
QUERIES, SQL = {}, {}
DAY = "1999-01-01"

# --- instruments: suppliers with exchange suffixes by nation ---

_SUFFIX = {0: ".XSHE", 1: ".XSHG", 2: ".CCFX", 3: ".XDCE", 4: ".XSGE", 5: ".XZCE", 6: ".XINE"}


def _vendor_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    suffix = F.lit("")
    for k, s in _SUFFIX.items():
        suffix = F.when(F.col("s_nationkey") % 9 == k, s).otherwise(suffix)
    bare = F.lpad((F.col("s_suppkey") * 7919 + 600000).cast("string"), 6, "0")
    return table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey", bare.alias("bare"), F.concat(bare, suffix).alias("vendor"))


_VENDOR = f"""
v0 AS (SELECT s_suppkey, s_nationkey, substr(lpad(CAST(s_suppkey * 7919 + 600000 AS VARCHAR), 6, '0'), 1, 6) AS bare FROM supplier),
v AS (
  SELECT *, bare || CASE s_nationkey % 9 {' '.join(f"WHEN {k} THEN '{s}'" for k, s in _SUFFIX.items())} ELSE '' END AS vendor
  FROM v0
)"""


def code_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _vendor_codes(spark, sf_dir).withColumn("internal", codes.source_to_internal(F.concat(F.lit(" "), "vendor")))
    return df.select(
        "s_suppkey",
        "internal",
        codes.internal_to_vendor("internal").alias("back"),
        codes.infer_suffix("bare").alias("listed"),
        codes.universe_code(F.when(F.col("s_nationkey") % 3 == 0, " all_a ").when(F.col("s_nationkey") % 3 == 1, "hs300").otherwise(" ")).alias(
            "universe"
        ),
        codes.file_tag(F.concat(F.col("vendor"), F.lit(":a/b"))).alias("tag"),
        codes.rel_path("root", F.concat(F.lit("by\\"), "bare")).alias("path"),
        F.concat_ws("|", codes.split_list(F.concat(F.lit(" "), "bare", F.lit(", ,"), "vendor", F.lit(" ,")))).alias("items"),
    )


SQL["code_normalise"] = f"""WITH {_VENDOR},
i AS (
  SELECT *, CASE WHEN vendor LIKE '%.XSHE' THEN replace(vendor, '.XSHE', '.SZ') WHEN vendor LIKE '%.XSHG' THEN replace(vendor, '.XSHG', '.SH')
    ELSE regexp_replace(vendor, '\\.(CCFX|XDCE|XSGE|XZCE|XINE)$', '') END AS internal
  FROM v
)
SELECT s_suppkey, internal,
  CASE WHEN internal LIKE '%.SZ' THEN replace(internal, '.SZ', '.XSHE') WHEN internal LIKE '%.SH' THEN replace(internal, '.SH', '.XSHG')
    ELSE internal END AS back,
  bare || CASE WHEN bare LIKE '6%' THEN '.SH' ELSE '.SZ' END AS listed,
  CASE s_nationkey % 3 WHEN 0 THEN 'ALL' WHEN 1 THEN 'HS300' ELSE 'CUSTOM' END AS universe,
  vendor || '_a_b' AS tag, 'root/by/' || bare AS path, bare || '|' || vendor AS items
FROM i"""


def date_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = F.col("o_orderdate")
    text = (
        F.when(F.col("o_orderstatus") == "P", F.date_format(d, "yyyy-MM-dd"))
        .when(F.col("o_orderstatus") == "F", F.concat(F.lit(" "), F.date_format(d, "yyyyMMdd")))
        .when(F.col("o_orderpriority") < "3", " ")
        .when(F.col("o_orderpriority") < "4", "n/a")
    )
    df = table(spark, sf_dir, "orders").select("o_orderkey", text.alias("text"))
    return df.select("o_orderkey", codes.to_date("text").alias("day"), codes.to_yyyymmdd("text").alias("compact"))


SQL["date_normalise"] = """
SELECT o_orderkey, CASE WHEN o_orderstatus IN ('P', 'F') THEN CAST(o_orderdate AS DATE) END AS day,
  CASE WHEN o_orderstatus IN ('P', 'F') THEN strftime(o_orderdate, '%Y%m%d') ELSE '' END AS compact
FROM orders"""


def id_generate(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = F.when(F.col("p_size") < 10, "fd").when(F.col("p_size") < 20, "jq").when(F.col("p_size") < 30, "bq").otherwise("web")
    raw = table(spark, sf_dir, "part").select("p_partkey", source.alias("source"))
    numbered = number_raw_factors(raw, "p_partkey", "2024-03-05")
    return numbered.select(
        "p_partkey", "factor_id", codes.id_from_name(F.concat(F.lit("alpha_"), "p_partkey")).alias("alpha_id")
    )


SQL["id_generate"] = """
WITH s AS (
  SELECT p_partkey, CASE WHEN p_size < 10 THEN 'FD' WHEN p_size < 20 THEN 'JQ' WHEN p_size < 30 THEN 'BQ' ELSE 'WEB' END AS tag FROM part
),
n AS (SELECT *, row_number() OVER (PARTITION BY tag ORDER BY p_partkey) AS k FROM s)
SELECT p_partkey, format('FACTOR_{}_20240305_{:03d}', tag, k) AS factor_id, format('JQ_ALPHA_{:03d}', p_partkey) AS alpha_id
FROM n"""


# --- universes ---


def _membership(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers shipping in a month are members of that month's list, universe by nation."""
    ships = table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("s_suppkey"), F.trunc("l_shipdate", "month").alias("as_of")
    )
    kind = F.when(F.col("s_nationkey") % 4 == 0, "HS300").when(F.col("s_nationkey") % 4 == 1, "STOCK").when(F.col("s_nationkey") % 4 == 2, "ETF").otherwise("INDEX")
    sup = table(spark, sf_dir, "supplier").select("s_suppkey", kind.alias("universe"))
    return ships.distinct().join(sup, "s_suppkey").select("universe", F.col("s_suppkey").cast("string").alias("stock_code"), "as_of")


_MEMBERS = """
m AS (
  SELECT DISTINCT CASE s_nationkey % 4 WHEN 0 THEN 'HS300' WHEN 1 THEN 'STOCK' WHEN 2 THEN 'ETF' ELSE 'INDEX' END AS universe,
    CAST(s_suppkey AS VARCHAR) AS stock_code, CAST(date_trunc('month', l_shipdate) AS DATE) AS as_of
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
),
lm AS (SELECT universe, max(as_of) AS as_of FROM m WHERE as_of <= DATE '{day}' GROUP BY universe),
cur AS (SELECT m.* FROM m JOIN lm USING (universe, as_of))""".format(day=DAY)


def universe_members_asof(spark: SparkSession, sf_dir: str) -> DataFrame:
    members = _membership(spark, sf_dir)
    parts = [un.members_asof(members, u, DAY).withColumn("universe", F.lit(u)) for u in ("HS300", "ETF", "ZZ500", "ALL")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


SQL["universe_members_asof"] = f"""WITH {_MEMBERS}
SELECT universe, stock_code FROM cur WHERE universe IN ('HS300', 'ETF')
UNION ALL SELECT DISTINCT 'ALL' AS universe, stock_code FROM cur WHERE universe <> 'HS300'"""


def universe_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    panel = week_panel(spark, sf_dir)
    wide = readers.scan_bars(panel, "1998-01-01", "1998-12-31", "HS300", _membership(spark, sf_dir))
    listed = F.when(F.length("stock_code") == 1, ".SH").when(F.length("stock_code") == 2, ".SZ").otherwise(".X")
    stock = un.filter_universe(panel.withColumn("stock_code", F.concat("stock_code", listed)), "STOCK")
    custom = un.filter_universe(panel, "CUSTOM", stock_codes="3, 17 ,,5")
    out = [d.select(*KEYS, "close", F.lit(u).alias("universe")) for d, u in ((wide, "HS300"), (stock, "STOCK"), (custom, "CUSTOM"))]
    return rounded(out[0].unionByName(out[1]).unionByName(out[2]), [*KEYS, "universe"], 8)


SQL["universe_filter"] = f"""WITH {WEEK},
m AS (
  SELECT DISTINCT CASE s_nationkey % 4 WHEN 0 THEN 'HS300' ELSE 'x' END AS universe,
    CAST(s_suppkey AS VARCHAR) AS stock_code, CAST(date_trunc('month', l_shipdate) AS DATE) AS as_of
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey WHERE s_nationkey % 4 = 0
),
cur AS (SELECT stock_code FROM m WHERE as_of = (SELECT max(as_of) FROM m WHERE as_of <= DATE '1998-12-31'))
SELECT trade_date, stock_code, 'HS300' AS universe, {sr('close', 8)} AS close FROM w
WHERE trade_date BETWEEN DATE '1998-01-01' AND DATE '1998-12-31' AND stock_code IN (SELECT stock_code FROM cur)
UNION ALL
SELECT trade_date, stock_code || CASE length(stock_code) WHEN 1 THEN '.SH' ELSE '.SZ' END, 'STOCK', {sr('close', 8)} FROM w
WHERE length(stock_code) <= 2
UNION ALL
SELECT trade_date, stock_code, 'CUSTOM', {sr('close', 8)} FROM w WHERE stock_code IN ('3', '17', '5')"""


# --- conformance ---


def _landed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as landed vendor bars, some without prices, code or date."""
    li = table(spark, sf_dir, "lineitem")
    flag = F.col("l_returnflag")
    return li.select(
        F.when(F.col("l_linenumber") != 7, F.date_format("l_shipdate", "yyyyMMdd")).otherwise("").alias("time"),
        F.when(F.col("l_discount") < 0.09, F.concat(F.col("l_suppkey"), F.lit(".XSHE"))).otherwise(" ").alias("code"),
        F.when(flag != "R", F.col("l_extendedprice")).alias("open"),
        F.when(F.col("l_linestatus") == "O", F.col("l_extendedprice") * 2).alias("close"),
        F.col("l_tax").alias("low"),
        F.when(F.col("l_tax") > 0.05, float("nan")).otherwise(F.col("l_tax")).alias("high"),
        F.col("l_quantity").alias("volume"),
        F.col("l_extendedprice").alias("money"),
        F.when(F.col("l_tax") > 0, F.col("l_extendedprice")).otherwise(0.0).alias("pre_close"),
        F.lit(None).cast("double").alias("high_limit"),
        F.lit(None).cast("double").alias("low_limit"),
        F.when(flag == "A", 1.0).when(flag == "N", 0.0).alias("paused"),
        F.col("l_orderkey").alias("order"),
    )


def conform_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = readers.landed_bars(_landed(spark, sf_dir), readers.VENDOR_A_COLUMNS, update_time=F.lit("2024-01-01"))
    keep = ["stock_code", "trade_date", "is_suspend", "multiple"]
    nums = [c for c in ("open", "high", "low", "close", "volume", "turnover", "pre_close", "return")]
    return rounded(df.select(*keep, *nums), keep, 4)


SQL["conform_bars"] = f"""
WITH x AS (
  SELECT *, CASE WHEN l_returnflag <> 'R' THEN l_extendedprice END AS o, CASE WHEN l_linestatus = 'O' THEN l_extendedprice * 2 END AS c,
    CASE WHEN l_tax > 0 THEN l_extendedprice ELSE 0.0 END AS pc
  FROM lineitem WHERE l_linenumber <> 7 AND l_discount < 0.09
)
SELECT l_suppkey || '.SZ' AS stock_code, CAST(l_shipdate AS DATE) AS trade_date,
  CASE l_returnflag WHEN 'A' THEN true WHEN 'N' THEN false END AS is_suspend, CAST(1 AS INTEGER) AS multiple,
  {sr('o', 4)} AS open, {sr('CASE WHEN l_tax <= 0.05 THEN l_tax END', 4)} AS high, {sr('l_tax', 4)} AS low, {sr('c', 4)} AS close,
  {sr('l_quantity', 4)} AS volume, {sr('l_extendedprice', 4)} AS turnover, {sr('pc', 4)} AS pre_close,
  {sr('(c / nullif(pc, 0) - 1) * 10000', 4)} AS return
FROM x WHERE o IS NOT NULL OR c IS NOT NULL"""


def multiplier_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = F.when(F.col("s_acctbal") > 0, F.col("s_nationkey") + 2)
    m = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").cast("string").alias("stock_code"), known.alias("multiple"))
    df = cf.with_multiplier(week_panel(spark, sf_dir).withColumn("multiple", F.lit(0)), m)
    return df.select(*KEYS, "multiple", r(F.col("volume") * F.col("multiple"), 4).alias("units"))


SQL["multiplier_lookup"] = f"""WITH {WEEK},
m AS (SELECT CAST(s_suppkey AS VARCHAR) AS stock_code, CASE WHEN s_acctbal > 0 THEN s_nationkey + 2 END AS k FROM supplier)
SELECT trade_date, stock_code, CAST(coalesce(k, 1) AS INTEGER) AS multiple, {sr('volume * coalesce(k, 1)', 4)} AS units
FROM w LEFT JOIN m USING (stock_code)"""


def key_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = cf.key_violations(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])
    return df.select("l_orderkey", "l_linenumber", "rows")


SQL["key_violations"] = """
SELECT l_orderkey, l_linenumber, count(*) AS rows FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1"""


def _registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = F.to_date("o_orderdate")
    p = F.col("o_orderpriority")
    kind = F.when(F.col("o_orderstatus") == "P", "batch_csv").when(F.col("o_orderstatus") == "F", "daily_csv").otherwise("other")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        kind.alias("artifact_type"),
        F.when(p < "3", d).alias("date_start"),
        F.when(p < "4", d).alias("date_end"),
        F.when((p >= "2") & (p != "3-MEDIUM"), d).alias("trade_date"),
    )


def registry_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    good, bad = cf.split_registry(_registry(spark, sf_dir))
    return good.select("o_orderkey", F.lit(True).alias("accepted")).unionByName(
        bad.select("o_orderkey", F.lit(False).alias("accepted"))
    )


SQL["registry_checks"] = """
SELECT o_orderkey, (o_orderstatus = 'P' AND o_orderpriority = '1-URGENT')
  OR (o_orderstatus = 'F' AND o_orderpriority IN ('4-NOT SPECIFIED', '5-LOW')) AS accepted
FROM orders"""


def calendar_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = table(spark, sf_dir, "orders").where("o_orderstatus = 'P' and o_totalprice > 300000").select(
        F.to_date("o_orderdate").alias("trade_date")
    )
    return cf.calendar_flags(spark, "1994-12-01", "2001-12-31", days)


SQL["calendar_flags"] = """
SELECT CAST(g.d AS DATE) AS trade_date, CAST(CASE WHEN g.d IN (
    SELECT CAST(o_orderdate AS DATE) FROM orders WHERE o_orderstatus = 'P' AND o_totalprice > 300000) THEN 1 ELSE 0 END AS INTEGER) AS is_trade_day
FROM (SELECT CAST(unnest(generate_series(DATE '1994-12-01', DATE '2001-12-31', INTERVAL 1 DAY)) AS DATE) AS d) g"""


def load_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cf.log_summary(week_panel(spark, sf_dir))


SQL["load_summary"] = f"""WITH {WEEK}
SELECT count(*) AS n_rows, count(DISTINCT stock_code) AS n_stocks, min(trade_date) AS start_date, max(trade_date) AS end_date FROM w"""


def close_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Closes of two years for the instruments that sold in one of its weeks."""
    panel = week_panel(spark, sf_dir)
    mine = panel.where("trade_date = date'1997-03-03'").select("stock_code")
    return rounded(readers.scan_closes(panel, "1997-01-01", "1998-12-31", mine), KEYS, 8)


SQL["close_scan"] = f"""WITH {WEEK}
SELECT trade_date, stock_code, {sr('close', 8)} AS close FROM w
WHERE trade_date BETWEEN DATE '1997-01-01' AND DATE '1998-12-31'
  AND stock_code IN (SELECT stock_code FROM w WHERE trade_date = DATE '1997-03-03')"""

for _q in (
    code_normalise, date_normalise, id_generate, universe_members_asof, universe_filter, conform_bars,
    multiplier_lookup, key_violations, registry_checks, calendar_flags, load_summary, close_scan,
):
    QUERIES[_q.__name__] = _q
