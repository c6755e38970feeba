"""Readers and writers, by writing to a folder of the run and reading back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.lineage import run_folder
from ..sources import readers, writers
from .base import table
from .keyed import basic, history

QUERIES, SQL = {}, {}
FIRST, LAST = "1996-03-01", "1998-08-15"


def _prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", F.date_format("o_orderdate", "yyyy-MM").alias("month"), F.col("o_totalprice").alias("price"), "o_orderstatus"
    )


def upsert_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders stored by month, those not yet shipped merged in anew at twice the price."""
    path, orders = run_folder(spark, "upsert"), _prices(spark, sf_dir)
    first = orders.where("o_orderstatus <> 'P'").drop("o_orderstatus")
    second = orders.where("o_orderstatus <> 'F'").withColumn("price", F.col("price") * 2).drop("o_orderstatus")
    for part in (first, second):
        writers.upsert_table(spark, path, part, ["o_orderkey", "month"], ["month"])
    return spark.read.parquet(path).select("o_orderkey", F.col("month").cast("string").alias("month"), "price")


SQL["upsert_stored"] = """
SELECT o_orderkey, strftime(o_orderdate, '%Y-%m') AS month, CASE WHEN o_orderstatus = 'F' THEN o_totalprice ELSE o_totalprice * 2 END AS price
FROM orders"""


def batch_values_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values by universe, factor and span; the spans of 1996 written again, one higher."""
    path = run_folder(spark, "values")
    values = table(spark, sf_dir, "orders").select(
        F.when(F.col("o_orderpriority") < "3", "ALL").otherwise("HS300").alias("universe"),
        F.concat(F.lit("F"), "o_orderstatus").alias("factor_id"),
        F.concat(F.lit("y"), F.year("o_orderdate")).alias("span"),
        F.col("o_orderkey").alias("stock_code"),
        F.col("o_totalprice").alias("factor_value"),
    )
    writers.write_batch_values(values, path)
    again = values.where("span = 'y1996'").withColumn("factor_value", F.col("factor_value") + 1)
    writers.write_batch_values(again, path)
    return spark.read.parquet(path)


SQL["batch_values_roundtrip"] = """
SELECT CASE WHEN o_orderpriority < '3' THEN 'ALL' ELSE 'HS300' END AS universe, 'F' || o_orderstatus AS factor_id,
  'y' || year(o_orderdate) AS span, o_orderkey AS stock_code,
  CASE WHEN year(o_orderdate) = 1996 THEN o_totalprice + 1 ELSE o_totalprice END AS factor_value
FROM orders"""


def backtests_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Evaluation runs appended in two parts, the universe in small letters and blanks."""
    path = run_folder(spark, "runs")
    runs = history(spark, sf_dir).select(
        "id", "factor_id", F.concat(F.lit(" "), F.lower("test_universe")).alias("test_universe"), "ic_value", F.lit(True).alias("pass_standard")
    )
    for part in (runs.where("test_universe = ' all'"), runs.where("test_universe <> ' all'")):
        writers.append_backtests(part, path)
    return spark.read.parquet(path)


SQL["backtests_append"] = """
SELECT o_orderkey AS id, 'F' || o_custkey AS factor_id, CASE WHEN o_orderpriority < '3' THEN 'ALL' ELSE 'HS300' END AS test_universe,
  round(o_totalprice / 1000000 - 0.2, 8) AS ic_value, CAST(NULL AS BOOLEAN) AS pass_standard
FROM orders"""


def calendar_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.to_date("o_orderdate").alias("trade_date")
    days = table(spark, sf_dir, "orders").select(day).distinct().withColumn("is_trade_day", F.weekday("trade_date") < 5)
    return readers.calendar_scan(days, FIRST, LAST)


SQL["calendar_range"] = f"""
SELECT DISTINCT CAST(o_orderdate AS DATE) AS trade_date, isodow(o_orderdate) < 6 AS is_trade_day FROM orders
WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '{FIRST}' AND DATE '{LAST}'"""


def ids_sorted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readers.factor_ids(basic(spark, sf_dir))


SQL["ids_sorted"] = "SELECT 'F' || c_custkey AS factor_id FROM customer WHERE NOT c_acctbal < 3000 ORDER BY 1"


def preview_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first five evaluation runs in key order."""
    return writers.preview(history(spark, sf_dir).select("factor_id", "id", "turnover"), ["factor_id", "id"])


SQL["preview_rows"] = """
SELECT 'F' || o_custkey AS factor_id, o_orderkey AS id, round(o_totalprice / 500000, 8) AS turnover FROM orders ORDER BY 1, 2 LIMIT 5"""

for _q in (upsert_stored, batch_values_roundtrip, backtests_append, calendar_range, ids_sorted, preview_rows):
    QUERIES[_q.__name__] = _q
