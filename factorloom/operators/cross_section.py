"""Cross-sectional operators: each row against the other rows of its date (or of its factor and date).

Every function takes and returns a DataFrame, and goes one way whatever the size of a group: values are counted
by cell, or aggregated, map-side, and what a row needs is joined back (see ``groups``). The values are read more
than once, so ``df`` is written once first; or pass as ``base`` a stored table of the same rows that holds them, from
which ``df`` only adds columns. Several functions called in a row then share one table.
"""

from __future__ import annotations

from collections.abc import Sequence
from fractions import Fraction

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .groups import EDGES, bucket_edges, bucket_of, cells_of, group_quantiles, join_keys, with_average_rank
from .lineage import stored

DATE = ("trade_date",)


def _both(df: DataFrame, base: DataFrame | None) -> tuple[DataFrame, DataFrame]:
    """The rows to add columns to and the stored table to count from."""
    base_ = stored(df) if base is None else base
    return (base_ if base is None else df), base_



def average_rank(df: DataFrame, value: str, out: str, by: Sequence[str] = DATE, ties: str = "_ties", base: DataFrame | None = None) -> DataFrame:
    """Rank from 1, ties share their mean rank, missing values are unranked.

    Also adds ``ties``, the rows sharing the value; ``sum(1 / ties)`` of a group is its distinct count.
    """
    df, base = _both(df, base)
    return with_average_rank(df, cells_of(base, value, by), out, ties)


def rank01(df: DataFrame, value: str, out: str, by: Sequence[str] = DATE, base: DataFrame | None = None) -> DataFrame:
    """(average rank - 1) / (rows - 1); rows with a missing value count in the divisor, a lone row gives 0."""
    df, base = _both(df, base)
    rows = base.groupBy(*by).agg(F.count(F.lit(1)).alias("_rows"))
    ranked = with_average_rank(df, cells_of(base, value, by), "_rank", "_ties")
    r = F.when(F.col("_rows") == 1, 0.0).otherwise(F.try_divide(F.col("_rank") - 1, F.col("_rows") - 1))
    return join_keys(ranked, rows, by).withColumn(out, r).drop("_rank", "_ties", "_rows")


def scale(df: DataFrame, value: str, out: str, k: float = 1.0, by: Sequence[str] = DATE, base: DataFrame | None = None) -> DataFrame:
    """Scaled so that the absolute values of the group add up to k."""
    df, base = _both(df, base)
    total = base.groupBy(*by).agg(F.sum(F.abs(F.col(value))).alias("_total"))
    scaled = F.try_divide(F.col(value), F.col("_total")) * F.lit(float(k))
    return join_keys(df, total, by).withColumn(out, scaled).drop("_total")


def with_quantiles(
    df: DataFrame, value: str, probs: Sequence[Fraction | float], out: str, by: Sequence[str] = DATE, base: DataFrame | None = None
) -> DataFrame:
    """Add the exact linear quantiles of the row's group as an array (NULLs skipped)."""
    df, base = _both(df, base)
    return join_keys(df, group_quantiles(base, cells_of(base, value, by), probs, out), by, "left")


def _clip(x: Column, q: Column | tuple[Column, Column]) -> Column:
    return F.when(x.isNotNull(), F.least(F.greatest(x, q[0]), q[1]))


def winsorize(
    df: DataFrame, value: str, out: str, lower: float = 0.01, upper: float = 0.99, by: Sequence[str] = DATE, base: DataFrame | None = None
) -> DataFrame:
    """Clip to the group's quantiles; missing values stay missing."""
    df = with_quantiles(df, value, (lower, upper), "_q", by, base)
    return df.withColumn(out, _clip(F.col(value), F.col("_q"))).drop("_q")


def _standard(x: Column, undefined: str) -> Column:
    """The z-score of x by the columns _mean, _sd, _least and _most of its group."""
    flat = F.col("_sd").isNull() | (F.col("_least") == F.col("_most"))
    other = F.lit(0.0 if undefined == "zero" else None).cast("double")
    return F.when(flat, other).otherwise((x - F.col("_mean")) / F.col("_sd"))


def zscore(df: DataFrame, value: str, out: str, by: Sequence[str] = DATE, undefined: str = "zero", base: DataFrame | None = None) -> DataFrame:
    """(x - mean) / sample standard deviation of the group.

    Where all values are equal, or there are fewer than two, every row of the group becomes 0.0, missing ones
    too; pass ``undefined="null"`` to leave them NULL. The size of the values makes no difference.
    """
    (df, base), x = _both(df, base), F.col(value)
    stats = base.groupBy(*by).agg(
        F.avg(x).alias("_mean"), F.stddev_samp(x).alias("_sd"), F.min(x).alias("_least"), F.max(x).alias("_most")
    )
    return join_keys(df, stats, by).withColumn(out, _standard(x, undefined)).drop("_mean", "_sd", "_least", "_most")


def clip_statistics(base: DataFrame, value: str, by: Sequence[str] = DATE) -> DataFrame:
    """A row per group of a stored table: the 1 % and 99 % quantiles (_lo, _hi), and _mean, _sd, _least, _most of the clipped values.

    Mean and deviation are of distances from the lower quantile, which keep their digits.
    """
    q = group_quantiles(base, cells_of(base, value, by), (0.01, 0.99), "_q")
    ends = (F.col("_lo"), F.col("_hi"))  # plain numbers: an array in the aggregation would make it sort all rows
    # a stored table's size is known, so that the planner need not move all rows to meet a row per group
    q = stored(q.select(*by, *[F.col("_q")[i].alias(name) for i, name in enumerate(("_lo", "_hi"))]))
    clipped = join_keys(base.select(*by, value), q, by).withColumn("_c", _clip(F.col(value), ends))
    off = F.col("_c") - F.col("_lo")
    sums = clipped.groupBy(*by).agg(
        *[F.any_value(name).alias(name) for name in ("_lo", "_hi")],
        F.avg(off).alias("_off"), F.stddev_samp(off).alias("_sd"), F.min("_c").alias("_least"), F.max("_c").alias("_most")
    )
    return sums.withColumn("_mean", F.col("_lo") + F.col("_off")).drop("_off")


def winsorize_and_standardize(
    df: DataFrame, value: str, out: str, by: Sequence[str] = DATE, undefined: str = "zero", base: DataFrame | None = None, apart: bool = False
) -> DataFrame:
    """The post-processing of a factor: clip to the 1 % and 99 % quantiles, then z-score the clipped values.

    ``apart``: the groups' statistics are stored first, so that rows meet them unmoved; else they are part of the plan.
    """
    df, base = _both(df, base)
    stats = clip_statistics(base, value, by)
    stats = stored(stats) if apart else stats
    z = _standard(_clip(F.col(value), (F.col("_lo"), F.col("_hi"))), undefined)
    return join_keys(df, stats, by, "left").withColumn(out, z).drop("_lo", "_hi", "_mean", "_sd", "_least", "_most")


def quantile_bucket(df: DataFrame, value: str, n: int, out: str, by: Sequence[str] = DATE, base: DataFrame | None = None) -> DataFrame:
    """Bucket 0..n-1 by the group's quantile edges; right-closed, lowest edge included, equal edges merged."""
    df, base = _both(df, base)
    edges = bucket_edges(base, cells_of(base, value, by), n)
    return join_keys(df, edges, by, "left").withColumn(out, bucket_of(F.col(value))).drop(*EDGES)


def extreme_buckets(df: DataFrame, bucket: str, by: Sequence[str] = DATE, base: DataFrame | None = None) -> DataFrame:
    """Flag rows of the highest and lowest occupied bucket: ``in_top`` and ``in_bottom``."""
    (df, base), b = _both(df, base), F.col(bucket)
    ends = base.groupBy(*by).agg(F.max(b).alias("_top"), F.min(b).alias("_low"))
    flags = {"in_top": b == F.col("_top"), "in_bottom": b == F.col("_low")}
    return join_keys(df, ends, by).withColumns(flags).drop("_top", "_low")
