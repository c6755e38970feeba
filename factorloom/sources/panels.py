"""Bar panels made from transaction and event tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.elem import div, finite


def week_panel(lineitem: DataFrame) -> DataFrame:
    """Supplier x week bars of unit prices; the first and last sale of a week give open and close."""
    price = finite(div("l_extendedprice", "l_quantity"))
    day = F.to_date("l_shipdate")
    sales = lineitem.select(
        "l_suppkey",
        F.date_sub(day, F.weekday(day)).alias("trade_date"),
        F.struct("l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", price.alias("p")).alias("sale"),
        "l_quantity",
        "l_extendedprice",
    )
    # numeric keys until the rows are aggregated; the price is the last field that orders the sales
    bars = sales.groupBy("l_suppkey", "trade_date").agg(
        F.min(F.when(F.col("sale.p").isNotNull(), F.col("sale"))).alias("first"),
        F.max(F.when(F.col("sale.p").isNotNull(), F.col("sale"))).alias("last"),
        F.max("sale.p").alias("high"),
        F.min("sale.p").alias("low"),
        F.sum("l_quantity").alias("volume"),
        F.sum("l_extendedprice").alias("turnover"),
    )
    return bars.select(
        F.col("l_suppkey").cast("string").alias("stock_code"),
        "trade_date",
        F.col("first.p").alias("open"),
        "high",
        "low",
        F.col("last.p").alias("close"),
        "volume",
        F.round("turnover", 2).alias("turnover"),
    )


def user_day_panel(events: DataFrame) -> DataFrame:
    """User x day bars of event values."""
    return (
        events.select(
            F.col("user_id").cast("string").alias("stock_code"), F.to_date("ts").alias("trade_date"), "ts", "value"
        )
        .groupBy("stock_code", "trade_date")
        .agg(
            F.min_by("value", "ts").alias("open"),
            F.max("value").alias("high"),
            F.min("value").alias("low"),
            F.max_by("value", "ts").alias("close"),
            F.count(F.lit(1)).cast("double").alias("volume"),
            F.round(F.sum("value"), 6).alias("turnover"),
        )
    )
