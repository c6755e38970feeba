"""Evaluation of factor values against forward returns, for all factors in one plan.

Rows are (factor_id, trade_date, stock_code, factor_value, ret). Ranks and buckets work per factor and
date; the curves work per factor over its dates, at most one row per calendar day.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import ts
from ..functions.elem import significant
from .groups import EDGES, bucket_edges, bucket_of, cells_of, in_outer, join_keys, with_average_rank
from .lineage import stored

GROUP = ("factor_id", "trade_date")
BUCKET_COLUMNS = (
    *GROUP, "stock_code", "ret", "factor_rank", "factor_ties", "ret_rank", "ret_ties", "in_top", "in_bottom"
)


def null_safe_corr(x: Column, y: Column) -> Column:
    """Pearson correlation over pairs without NULLs; NULL when either side is constant."""
    both = x.isNotNull() & y.isNotNull()
    x, y = F.when(both, x), F.when(both, y)
    return F.try_divide(F.covar_samp(x, y), F.stddev_samp(x) * F.stddev_samp(y))


def forward_returns(bars: DataFrame, horizon: int = 5) -> DataFrame:
    """(trade_date, stock_code, ret, ret_date): log return to the bar ``horizon`` rows ahead and its date."""
    return bars.select(
        "trade_date",
        "stock_code",
        ts.forward_return("close", horizon).alias("ret"),
        ts.ref("trade_date", -horizon).alias("ret_date"),
    )


def factor_spans(values: DataFrame) -> DataFrame:
    """First and last date of each factor's values."""
    return values.groupBy("factor_id").agg(F.min("trade_date").alias("first_date"), F.max("trade_date").alias("last_date"))


def pair_with_returns(values: DataFrame, bars: DataFrame, horizon: int = 5) -> DataFrame:
    """Values joined with forward returns; rows missing either are dropped.

    A return may not look past its factor's last date, as closes are read up to that date only.
    """
    spans = factor_spans(values).select("factor_id", "last_date")
    known = values.where(F.col("factor_value").isNotNull())
    # a return serves all factors: hashing a partition's returns saves sorting the values, which are several times as many
    returns = forward_returns(bars, horizon).where(F.col("ret").isNotNull()).hint("shuffle_hash")
    paired = known.join(returns, ["stock_code", "trade_date"])
    return paired.join(spans, "factor_id").where(F.col("ret_date") <= F.col("last_date")).drop("ret_date", "last_date")


def ranked_pairs(paired: DataFrame, digits: int = 12) -> DataFrame:
    """Add average ranks (``factor_rank``, ``ret_rank``) and tie counts.

    Values that agree to ``digits`` significant digits tie: ``factor_key`` and ``ret_key`` are what is ranked.
    """
    keyed = _keyed(paired, digits)
    by_factor, by_ret = (cells_of(keyed, c, GROUP) for c in ("factor_key", "ret_key"))
    ranked = with_average_rank(keyed, by_factor, "factor_rank", "factor_ties")
    return with_average_rank(ranked, by_ret, "ret_rank", "ret_ties")


def _keyed(paired: DataFrame, digits: int = 12, drop: tuple[str, ...] = ()) -> DataFrame:
    keys = {"factor_key": significant("factor_value", digits), "ret_key": significant("ret", digits)}
    return stored(paired.withColumns(keys).drop(*drop))


def _distinct(ties: str) -> Column:
    return F.round(F.sum(1 / F.col(ties))).cast("int")


def ic_aggregates() -> dict[str, Column]:
    """Rank correlation and distinct counts of one factor and date, over ``ranked_pairs``."""
    return {
        "n": F.count(F.lit(1)),
        "n_values": _distinct("factor_ties"),
        "n_rets": _distinct("ret_ties"),
        "ic": null_safe_corr(F.col("factor_rank"), F.col("ret_rank")),
    }


def ic_daily(paired: DataFrame) -> DataFrame:
    """Spearman IC per factor and date; dates with fewer than 2 distinct values on either side are left out."""
    daily = ranked_pairs(paired.select(*GROUP, "factor_value", "ret")).groupBy(*GROUP).agg(*[c.alias(k) for k, c in ic_aggregates().items()])
    return daily.where("n_values >= 2 and n_rets >= 2 and ic is not null").select(*GROUP, "n", "ic")


def ic_metrics() -> dict[str, Column]:
    """Mean IC and its ratio to the deviation (NULL with one date or no spread)."""
    return {"ic_value": F.avg("ic"), "ic_ir": F.try_divide(F.avg("ic"), F.stddev_samp("ic"))}


def bucketed(paired: DataFrame, n_quantiles: int = 10) -> DataFrame:
    """``ranked_pairs`` with bucket ``q`` and the flags of the extreme occupied buckets; of the factor, ``factor_key`` only.

    The pairs are written once, the ranks are part of the plan: who reads no ranks moves no rows for them, and who reads
    them moves only the columns it reads.
    """
    keyed = _keyed(paired, drop=("factor_value",))
    by_factor, by_ret = (cells_of(keyed, c, GROUP) for c in ("factor_key", "ret_key"))
    edges = stored(bucket_edges(keyed, by_factor, n_quantiles))
    x = F.col("factor_key")
    top, bottom = in_outer(x)
    flagged = join_keys(keyed, edges, GROUP).withColumns({"q": bucket_of(x), "in_top": top, "in_bottom": bottom}).drop(*EDGES)
    ranked = with_average_rank(flagged, by_factor, "factor_rank", "factor_ties")
    return with_average_rank(ranked, by_ret, "ret_rank", "ret_ties").drop("ret_key")


def quantile_returns(paired: DataFrame, n_quantiles: int = 10) -> DataFrame:
    """Mean return per factor, date and bucket, dates with fewer distinct values than buckets left out."""
    per_bucket = (
        bucketed(paired.select(*GROUP, "factor_value", "ret"), n_quantiles)
        .groupBy(*GROUP, "q")
        .agg(F.avg("ret").alias("mean_ret"), F.count(F.lit(1)).alias("n"), F.sum(1 / F.col("factor_ties")).alias("_d"))
    )
    values = F.round(F.sum("_d").over(Window.partitionBy(*GROUP)))  # one row per bucket here
    return per_bucket.withColumn("_values", values).where(F.col("_values") >= n_quantiles).drop("_d", "_values")


def daily_metrics(buckets: DataFrame, n_quantiles: int = 10) -> DataFrame:
    """IC, long-short return and the date's place among the dates with enough distinct values.

    ``ls_ret`` and ``ordinal`` are NULL on dates with fewer distinct values than buckets. Returns of the outer buckets are
    summed apart from the ranks, so that no row takes its return and its flags along while it is ranked.
    """
    top, bottom = F.when(F.col("in_top"), F.col("ret")), F.when(F.col("in_bottom"), F.col("ret"))
    outer = buckets.groupBy(*GROUP).agg((F.avg(top) - F.avg(bottom)).alias("ls_ret"))
    daily = join_keys(buckets.groupBy(*GROUP).agg(*[c.alias(k) for k, c in ic_aggregates().items()]), outer, GROUP)
    enough = F.col("n_values") >= n_quantiles
    usable = (F.col("n_values") >= 2) & (F.col("n_rets") >= 2)
    so_far = Window.partitionBy("factor_id").orderBy("trade_date").rowsBetween(Window.unboundedPreceding, 0)
    return daily.select(
        *GROUP,
        F.when(usable, F.col("ic")).alias("ic"),
        F.when(enough, F.col("ls_ret")).alias("ls_ret"),
        F.when(enough, F.sum(F.when(enough, 1)).over(so_far)).alias("ordinal"),
    )


def turnover_daily(buckets: DataFrame, daily: DataFrame) -> DataFrame:
    """Share of the top bucket that was not in it on the previous usable date; none on the first.

    A row is "held" when the same instrument's previous top-bucket row lies on the previous usable date.
    """
    usable = daily.where(F.col("ordinal").isNotNull()).select(*GROUP, "ordinal")
    top = buckets.where("in_top").select(*GROUP, "stock_code").join(usable, list(GROUP))
    before = F.lag("ordinal").over(Window.partitionBy("factor_id", "stock_code").orderBy("ordinal"))
    held = F.coalesce((before == F.col("ordinal") - 1).cast("int"), F.lit(0))
    return (
        top.withColumn("held", held)
        .where("ordinal > 1")
        .groupBy(*GROUP)
        .agg((1 - F.sum("held") / F.count(F.lit(1))).alias("turnover"))
    )


def with_curve(daily: DataFrame, ret: str = "ls_ret") -> DataFrame:
    """Cumulative curve, its running peak and the drawdown; the peak starts at the first point, not at 1."""
    so_far = Window.partitionBy("factor_id").orderBy("trade_date").rowsBetween(Window.unboundedPreceding, 0)
    df = daily.withColumn("cum", F.product(1 + F.col(ret)).over(so_far))
    df = df.withColumn("peak", F.max("cum").over(so_far))
    return df.withColumn("drawdown", F.try_divide(F.col("cum"), F.col("peak")) - 1)


def sharpe(ret: str = "ls_ret") -> Column:
    """Mean over deviation times sqrt(252), whatever the horizon."""
    return F.try_divide(F.avg(ret), F.stddev_samp(ret)) * F.sqrt(F.lit(252.0))


def evaluate(
    values: DataFrame,
    bars: DataFrame,
    horizon: int = 5,
    n_quantiles: int = 10,
    test_universe: str = "ALL",
) -> DataFrame:
    """One row of metrics per factor: IC, IC_IR, Sharpe, maximum drawdown and turnover.

    Long-short returns are log returns compounded as if daily. Factors without usable dates get NULLs.
    ``values`` is read several times: pass a stored table (or one with its lineage cut), not a long plan.
    The daily metrics are written once, since all parts need them.
    """
    buckets = bucketed(pair_with_returns(values, bars, horizon), n_quantiles).select(*BUCKET_COLUMNS)
    daily = stored(daily_metrics(buckets, n_quantiles))
    turnover = turnover_daily(buckets, daily).groupBy("factor_id").agg(F.avg("turnover").alias("turnover"))
    ic = daily.groupBy("factor_id").agg(*[c.alias(k) for k, c in ic_metrics().items()])
    curve = with_curve(daily.where(F.col("ls_ret").isNotNull()))
    risk = curve.groupBy("factor_id").agg(sharpe().alias("sharpe_ratio"), F.min("drawdown").alias("max_drawdown"))
    out = factor_spans(values)
    for part in (ic, risk, turnover):
        out = out.join(part, "factor_id", "left")
    return out.select(
        "factor_id",
        F.lit(test_universe).alias("test_universe"),
        F.concat_ws(" 至 ", F.col("first_date").cast("string"), F.col("last_date").cast("string")).alias("backtest_period"),
        F.lit(f"{horizon}d").alias("horizon"),
        "ic_value",
        "ic_ir",
        "sharpe_ratio",
        "max_drawdown",
        "turnover",
    )
