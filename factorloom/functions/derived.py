"""Columns derived from one bar and the bar before it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .elem import div
from .ts import ref, ret


def vwap() -> Column:
    return div("turnover", "volume")


def dtm() -> Column:
    """0 when the open did not rise (or there is no previous bar), else max(high - open, open - previous open)."""
    o, prev = F.col("open"), ref("open", 1)
    flat = prev.isNull() | F.coalesce(o <= prev, F.lit(False))
    return F.when(flat, 0.0).otherwise(F.greatest(F.col("high") - o, o - prev))


def dbm() -> Column:
    """0 when the open did not fall (or there is no previous bar), else max(open - low, open - previous open)."""
    o, prev = F.col("open"), ref("open", 1)
    flat = prev.isNull() | F.coalesce(o >= prev, F.lit(False))
    return F.when(flat, 0.0).otherwise(F.greatest(o - F.col("low"), o - prev))


def tr() -> Column:
    """True range; missing parts are skipped."""
    high, low, prev = F.col("high"), F.col("low"), ref("close", 1)
    return F.greatest(high - low, F.abs(high - prev), F.abs(low - prev))


def hd() -> Column:
    return F.col("high") - ref("high", 1)


def ld() -> Column:
    return ref("low", 1) - F.col("low")


def with_derived(panel: DataFrame) -> DataFrame:
    """Add all derived columns.

    The market, size and value factors and the benchmark prices are 0.0 unless the panel already brings
    real ones (join them on trade_date first).
    """
    made = {
        "vwap": vwap(),
        "ret": ret(),
        "prev_open": ref("open", 1),
        "prev_close": ref("close", 1),
        "prev_high": ref("high", 1),
        "prev_low": ref("low", 1),
        "dtm": dtm(),
        "dbm": dbm(),
        "tr": tr(),
        "hd": hd(),
        "ld": ld(),
    }
    for name in ("mkt", "smb", "hml", "benchmark_open", "benchmark_close"):
        if name not in panel.columns:
            made[name] = F.lit(0.0)
    return panel.withColumns(made)
