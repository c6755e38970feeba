"""Bringing landed bars and calendars into the stored tables, over a history or a lookback.

Late rows need no state: each run pulls a lookback range again and merges it by key. The bar table is
partitioned by month, so a run rewrites the months it has rows in and no others.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.conform import calendar_flags, key_violations
from ..operators.latest import latest_per_key
from ..operators.universe import filter_universe
from ..schema import BAR_KEYS
from ..sources import writers
from ..sources.readers import between_dates, lookback

MONTH = "month"


def with_month(bars: DataFrame) -> DataFrame:
    return bars.withColumn(MONTH, F.date_format("trade_date", "yyyy-MM"))


def unique_bars(bars: DataFrame) -> DataFrame:
    """One row per date and instrument, the one updated last."""
    return latest_per_key(bars, BAR_KEYS, ["update_time", "close", "open"])


def load_history(
    bars: DataFrame, path: str, start, end, universe: str = "ALL", membership: DataFrame | None = None, stock_codes: str = ""
) -> None:
    """First load: the range's bars of a universe, one row per key, written by month."""
    rows = filter_universe(between_dates(bars, start, end), universe, membership, end, stock_codes)
    writers.overwrite_partitions(with_month(unique_bars(rows)), path, [MONTH])


def sync_bars(
    spark: SparkSession,
    bars: DataFrame,
    path: str,
    end,
    days: int,
    universe: str = "ALL",
    membership: DataFrame | None = None,
    stock_codes: str = "",
    rule: str = "replace",
) -> None:
    """Merge the bars of the ``days`` calendar days up to ``end`` into the table; the later row of a key wins.

    ``rule="patch"`` keeps the table's other columns when the source brings only some; with ``rule="latest"`` the row
    updated last stays, so late batches and replays may come in any order.
    """
    rows = lookback(bars, F.lit(end).cast("date"), days)
    rows = filter_universe(rows, universe, membership, end, stock_codes)
    order = ["update_time"] if "update_time" in bars.columns else ["close"]
    source = latest_per_key(with_month(rows), BAR_KEYS, order)
    writers.upsert_table(spark, path, source, BAR_KEYS, [MONTH], rule, order if rule == "latest" else None)


def sync_calendar(spark: SparkSession, trading_days: DataFrame, path: str, start, end, now) -> None:
    """Merge the flags of every day of a range into the calendar table, partitioned by year."""
    flags = calendar_flags(spark, start, end, trading_days).withColumns(
        {"update_time": F.lit(now).cast("timestamp"), "year": F.year("trade_date")}
    )
    writers.upsert_table(spark, path, flags, ["trade_date"], ["year"])


def duplicate_bars(bars: DataFrame) -> DataFrame:
    """Keys a bar table holds more than once; rolling windows rely on there being none."""
    return key_violations(bars, BAR_KEYS)
