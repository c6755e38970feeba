"""Factors as Python functions over a bar panel, and jobs that compute many of them at once.

A factor is a Column over the panel's columns, or a function panel -> panel that adds a column of the
given name; the latter form is needed where a cross-sectional step feeds a rolling one.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from ..functions import elem, ts
from ..functions.derived import with_derived
from ..operators import cross_section as xs
from ..operators.latest import latest_date_upto
from ..operators.lineage import stored
from ..sources.readers import lookback

Factor = Column | Callable[[DataFrame, str], DataFrame]
GROUP = ("factor_id", "trade_date")


def momentum(n: int = 20) -> Column:
    """Relative change of the close over n rows."""
    return elem.div(F.col("close") - ts.ref("close", n), ts.ref("close", n))


def vwap_gap(n: int = 10) -> Column:
    """Distance of the close from its n-row volume-weighted price."""
    return elem.div("close", ts.ma("vwap", n)) - 1


def volatility(n: int = 20) -> Column:
    return ts.std("ret", n)


def trend(n: int = 12) -> Column:
    """Slope of the close on the row number."""
    return ts.regbeta("close", ts.sequence().cast("double"), n)


def signed_volume(n: int = 8) -> Column:
    """Volume of the last n rows counted by the sign of the close's move."""
    move = ts.delta("close", 1)
    flow = elem.if_(elem.gt(move, 0), "volume", elem.if_(elem.lt(move, 0), -F.col("volume"), 0))
    return ts.ts_sum(flow, n)


def rank_correlation(n: int = 10) -> Factor:
    """Negative rank of the correlation between the ranks of close and volume."""

    def build(panel: DataFrame, name: str) -> DataFrame:
        base = stored(panel)
        df = xs.rank01(base, "close", "_rc", base=base)
        df = xs.rank01(df, "volume", "_rv", base=base)
        df = df.withColumn("_c", F.round(ts.corr("_rc", "_rv", n), 10)).drop("_rc", "_rv")
        df = xs.rank01(df, "_c", name)
        return df.withColumn(name, -F.col(name)).drop("_c")

    build.inputs = ("close", "volume")
    return build


LIBRARY: dict[str, Callable[[], Factor]] = {
    "momentum_20": momentum,
    "rank_corr_10": rank_correlation,
    "signed_volume_8": signed_volume,
    "trend_12": trend,
    "volatility_20": volatility,
    "vwap_gap_10": vwap_gap,
}


def library(*names: str) -> dict[str, Factor]:
    """The named factors, all when none is named."""
    return {n: LIBRARY[n]() for n in names or LIBRARY}


def add_factor(panel: DataFrame, name: str, factor: Factor) -> DataFrame:
    """``panel`` with one factor column."""
    if isinstance(factor, Column):
        return panel.withColumn(name, factor)
    return factor(panel, name)


def usable_factors(panel: DataFrame, factors: Mapping[str, Factor]) -> tuple[dict[str, Factor], dict[str, str]]:
    """Factors that fit the panel, and the reasons why the others do not.

    Each is analysed on its own, without running anything, so that one bad factor does not stop the rest.
    """
    good, bad = {}, {}
    for name, factor in factors.items():
        try:
            add_factor(panel, name, factor)
            good[name] = factor
        except (AnalysisException, ValueError, TypeError) as e:
            bad[name] = str(e)
    return good, bad


def wide_factors(
    panel: DataFrame, factors: Mapping[str, Factor], keep: tuple[str, ...] = ()
) -> DataFrame:
    """The panel's keys, the ``keep`` columns, and one column per factor.

    Factors that are plain Columns are added together and share one exchange by instrument. Functions may name the
    columns they read as ``inputs``; when all do, no other column is computed and handed to them.
    """
    plain = {n: f for n, f in factors.items() if isinstance(f, Column)}
    built = {n: f for n, f in factors.items() if n not in plain}
    df = with_derived(panel).withColumns(plain)
    if all(hasattr(f, "inputs") for f in built.values()):
        read = [c for f in built.values() for c in f.inputs]
        df = df.select("trade_date", "stock_code", *dict.fromkeys([*keep, *plain, *read]))
    for name, f in built.items():
        df = add_factor(df, name, f)
    values = [elem.significant(F.col(n).cast("double")).alias(n) for n in factors]  # rounding noise ties
    return df.select("trade_date", "stock_code", *keep, *values)


def long_values(wide: DataFrame, names, keep: tuple[str, ...] = ()) -> DataFrame:
    """Rows (factor_id, trade_date, stock_code, keep..., factor_value)."""
    ids = ["trade_date", "stock_code", *keep]
    return wide.unpivot(ids, list(names), "factor_id", "factor_value")


def compute_factors(
    panel: DataFrame, factors: Mapping[str, Factor], keep: tuple[str, ...] = ()
) -> DataFrame:
    """Long values of many factors, winsorized and standardised per factor and date."""
    raw = long_values(stored(wide_factors(panel, factors, keep)), factors, keep)  # a stored row holds all factors
    done = xs.winsorize_and_standardize(raw, "factor_value", "_z", GROUP, base=raw, apart=True)
    return done.select("factor_id", "trade_date", "stock_code", *keep, F.col("_z").alias("factor_value"))


def effective_date(bars: DataFrame, requested, days: int):
    """The latest bar date in the ``days`` up to the requested day; the earliest one there if none is."""
    wanted = F.lit(requested).cast("date")
    return latest_date_upto(lookback(bars, wanted, days), "trade_date", wanted).first()[0]


def compute_day(
    bars: DataFrame, factors: Mapping[str, Factor], requested, days: int = 380
) -> DataFrame:
    """Values of one day's cross-section, from the bars of the ``days`` calendar days before it.

    The day is first moved to the latest date with bars; no rows when there are none. The date filter
    stands after the rolling windows, which need the history, and before the cross-sectional post-processing.
    """
    day = effective_date(bars, requested, days)
    target = F.lit(day).cast("date")
    panel = lookback(bars, target, days)
    raw = long_values(stored(wide_factors(panel, factors).where(F.col("trade_date") == target)), factors)
    done = xs.winsorize_and_standardize(raw, "factor_value", "_z", GROUP, base=raw, apart=True)
    return done.select("factor_id", "trade_date", "stock_code", F.col("_z").alias("factor_value"))
