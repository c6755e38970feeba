"""Bringing landed rows into the bar, calendar and registry layouts, and checking them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions import codes
from ..functions.elem import finite, return_bp
from ..schema import BARS


def rename(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Select source columns under their target names; absent ones raise."""
    lacking = [c for c in mapping if c not in df.columns]
    if lacking:
        raise ValueError(f"source lacks columns {lacking}; it has {df.columns}")
    return df.select(*[F.col(f"`{src}`").alias(dst) for src, dst in mapping.items()])


def conform_bars(df: DataFrame) -> DataFrame:
    """Rows in the bar layout.

    Codes and dates are normalised, rows without either are dropped, and so are rows whose open and close
    are both missing. A missing return is computed from close and pre_close, a missing multiple is 1, a
    missing suspend flag stays NULL. Non-finite numbers are NULL.
    """
    have = set(df.columns)
    num = {f.name: finite(F.col(f.name).cast("double")) for f in BARS if f.dataType.typeName() == "double" and f.name in have}
    num = {c: num.get(c, F.lit(None).cast("double")) for c in [f.name for f in BARS if f.dataType.typeName() == "double"]}
    day = F.col("trade_date")
    if dict(df.dtypes)["trade_date"] == "string":
        day = codes.to_date(day)
    out = df.select(
        codes.source_to_internal("stock_code").alias("stock_code"),
        day.cast("date").alias("trade_date"),
        *[c.alias(name) for name, c in num.items()],
        (F.col("is_suspend").cast("double") != 0 if "is_suspend" in have else F.lit(None).cast("boolean")).alias(
            "is_suspend"
        ),
        (F.coalesce(F.col("multiple").cast("int"), F.lit(1)) if "multiple" in have else F.lit(1)).alias("multiple"),
        (F.col("update_time") if "update_time" in have else F.current_timestamp()).cast("timestamp").alias("update_time"),
    )
    kept = (F.col("stock_code") != "") & F.col("trade_date").isNotNull()
    priced = F.col("open").isNotNull() | F.col("close").isNotNull()
    filled = F.coalesce(F.col("return"), return_bp("close", "pre_close"))
    return out.where(kept & priced).withColumn("return", filled).select(*[f.name for f in BARS])


def with_multiplier(bars: DataFrame, multipliers: DataFrame) -> DataFrame:
    """Contract multiplier by stock_code, 1 where there is none."""
    found = multipliers.select("stock_code", F.col("multiple").alias("_m"))
    joined = bars.drop("multiple").join(found, "stock_code", "left")
    return joined.withColumn("multiple", F.coalesce(F.col("_m").cast("int"), F.lit(1))).drop("_m")


def calendar_flags(spark, start, end, trading_days: DataFrame) -> DataFrame:
    """Every day of the range with is_trade_day 1 or 0."""
    days = spark.range(1).select(
        F.explode(F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"))).alias("trade_date")
    )
    marks = trading_days.select(F.col("trade_date").cast("date")).distinct().withColumn("_open", F.lit(1))
    return days.join(marks, "trade_date", "left").select(
        "trade_date", F.coalesce("_open", F.lit(0)).alias("is_trade_day")
    )


def registry_ok() -> Column:
    """A registry row is a batch file with a date range and no single date, or a daily file with the reverse."""
    kind = F.col("artifact_type")
    span = F.col("date_start").isNotNull() & F.col("date_end").isNotNull()
    no_span = F.col("date_start").isNull() & F.col("date_end").isNull()
    day = F.col("trade_date").isNotNull()
    ok = ((kind == "batch_csv") & span & ~day) | ((kind == "daily_csv") & day & no_span)
    return F.coalesce(ok, F.lit(False))


def split_registry(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Accepted and rejected registry rows."""
    return rows.where(registry_ok()), rows.where(~registry_ok())


def key_violations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")


def log_summary(bars: DataFrame) -> DataFrame:
    """Row count, instruments and date range of a load, one row."""
    return bars.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.countDistinct("stock_code").alias("n_stocks"),
        F.min("trade_date").alias("start_date"),
        F.max("trade_date").alias("end_date"),
    )


def observe_load(df: DataFrame, name: str = "load") -> tuple[DataFrame, Observation]:
    """``df`` and an observation of its rows, date range and approximate instruments, filled as it is written."""
    seen = Observation(name)
    return df.observe(
        seen,
        F.count(F.lit(1)).alias("n_rows"),
        F.approx_count_distinct("stock_code").alias("n_stocks"),
        F.min("trade_date").alias("start_date"),
        F.max("trade_date").alias("end_date"),
    ), seen


def value_counts(values: DataFrame, day) -> DataFrame:
    """Per factor: rows written, rows of the day, and how many of those have a value."""
    today = F.col("trade_date") == F.lit(day).cast("date")
    return values.groupBy("factor_id").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(today).alias("n_day"),
        F.count_if(today & F.col("factor_value").isNotNull()).alias("n_day_known"),
    )
