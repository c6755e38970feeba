"""Cross-sectional operators over the week panel."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import ts
from ..operators import cross_section as xs
from ..operators.lineage import stored
from .base import WEEK, lag, rank01, rounded, select, week_panel

KEYS = ["trade_date", "stock_code"]
QUERIES, SQL = {}, {}

# a momentum column with missing warm-up rows, and a volume column with many ties
_X = "x AS (SELECT trade_date, stock_code, volume, close / nullif({lag}, 0) - 1 AS mom FROM w)".format(lag=lag("close", 4))


def _input(spark: SparkSession, sf_dir: str) -> DataFrame:
    mom = F.try_divide(F.col("close"), ts.ref("close", 4)) - 1
    return stored(week_panel(spark, sf_dir).select(*KEYS, "volume", mom.alias("mom")))


def xs_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = _input(spark, sf_dir)
    df = xs.rank01(base, "mom", "rank_mom", base=base)
    df = xs.rank01(df, "volume", "rank_volume", base=base)
    return rounded(df.select(*KEYS, "rank_mom", "rank_volume"), KEYS)


def xs_scale(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = _input(spark, sf_dir)
    df = xs.scale(base, "mom", "scaled", base=base)
    df = xs.scale(df, "volume", "scaled_100", k=100, base=base)
    return rounded(df.select(*KEYS, "scaled", "scaled_100"), KEYS)


def xs_winsor_zscore(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = _input(spark, sf_dir)
    df = xs.winsorize(base, "mom", "clipped", base=base)
    df = xs.zscore(df, "volume", "z_volume", base=base)
    df = xs.winsorize_and_standardize(df, "mom", "z", base=base)
    return rounded(df.select(*KEYS, "clipped", "z_volume", "z"), KEYS)


def xs_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = _input(spark, sf_dir)
    df = xs.quantile_bucket(base, "volume", 10, "q", base=base)
    df = xs.extreme_buckets(df, "q")
    return df.select(*KEYS, "q", "in_top", "in_bottom")


def scale_invariance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A column and the same column times 1e-9 through every cross-sectional operator."""
    df = base = stored(_input(spark, sf_dir).withColumn("tiny", F.col("volume") * F.lit(1e-9)))
    for c in ("volume", "tiny"):
        df = xs.rank01(df, c, f"rank_{c}", base=base)
        df = xs.winsorize_and_standardize(df, c, f"z_{c}", base=base)
        df = xs.quantile_bucket(df, c, 10, f"q_{c}", base=base)
    return rounded(df.select(*KEYS, *[f"{k}_{c}" for c in ("volume", "tiny") for k in ("rank", "z", "q")]), KEYS)


QUERIES.update(scale_invariance=scale_invariance)
QUERIES.update(xs_rank=xs_rank, xs_scale=xs_scale, xs_winsor_zscore=xs_winsor_zscore, xs_buckets=xs_buckets)

SQL["xs_rank"] = f"WITH {WEEK},\n{_X}\n" + select({"rank_mom": rank01("mom"), "rank_volume": rank01("volume")}, "x")
SQL["xs_scale"] = f"WITH {WEEK},\n{_X}\n" + select(
    {
        "scaled": "mom / nullif(sum(abs(mom)) OVER (PARTITION BY trade_date), 0)",
        "scaled_100": "volume / nullif(sum(abs(volume)) OVER (PARTITION BY trade_date), 0) * 100",
    },
    "x",
)
SQL["xs_winsor_zscore"] = f"""WITH {WEEK},
{_X},
q AS (SELECT trade_date, quantile_cont(mom, 0.01) AS lo, quantile_cont(mom, 0.99) AS hi FROM x GROUP BY trade_date),
c AS (SELECT x.*, CASE WHEN mom IS NOT NULL THEN least(greatest(mom, lo), hi) END AS clipped FROM x JOIN q USING (trade_date)),
s AS (
  SELECT trade_date, avg(clipped) AS m, stddev_samp(clipped) AS sd, avg(volume) AS vm, stddev_samp(volume) AS vsd,
    min(clipped) = max(clipped) AS flat, min(volume) = max(volume) AS vflat
  FROM c GROUP BY trade_date
)
""" + select(
    {
        "clipped": "clipped",
        "z_volume": "CASE WHEN vsd IS NULL OR vflat THEN 0.0 ELSE (volume - vm) / vsd END",
        "z": "CASE WHEN sd IS NULL OR flat THEN 0.0 ELSE (clipped - m) / sd END",
    },
    "c JOIN s USING (trade_date)",
)
SQL["xs_buckets"] = f"""WITH {WEEK},
v AS (SELECT trade_date, list(volume ORDER BY volume) AS l, count(volume) AS n FROM w GROUP BY trade_date),
e AS (
  SELECT trade_date, list_distinct(list_transform(range(0, 11), lambda k:
    l[(n - 1) * k // 10 + 1] + (l[((n - 1) * k + 9) // 10 + 1] - l[(n - 1) * k // 10 + 1]) * (((n - 1) * k % 10) / 10.0)
  )) AS edges FROM v
),
b AS (
  SELECT trade_date, stock_code, CAST(greatest(len(list_filter(edges, lambda v: v < volume)) - 1, 0) AS INTEGER) AS q
  FROM w JOIN e USING (trade_date)
)
SELECT trade_date, stock_code, q, q = max(q) OVER (PARTITION BY trade_date) AS in_top,
  q = min(q) OVER (PARTITION BY trade_date) AS in_bottom
FROM b"""
_Z = "CASE WHEN sd IS NULL OR flat THEN 0.0 ELSE (c - m) / sd END"
SQL["scale_invariance"] = f"""WITH {WEEK},
{_X},
v AS (
  SELECT trade_date, list(volume ORDER BY volume) AS l, count(volume) AS n, quantile_cont(volume, 0.01) AS lo, quantile_cont(volume, 0.99) AS hi
  FROM x GROUP BY trade_date
),
e AS (
  SELECT trade_date, lo, hi, list_distinct(list_transform(range(0, 11), lambda k:
    l[(n - 1) * k // 10 + 1] + (l[((n - 1) * k + 9) // 10 + 1] - l[(n - 1) * k // 10 + 1]) * (((n - 1) * k % 10) / 10.0)
  )) AS edges FROM v
),
c AS (
  SELECT trade_date, stock_code, {rank01("volume")} AS k, least(greatest(volume, lo), hi) AS c,
    CAST(greatest(len(list_filter(edges, lambda g: g < volume)) - 1, 0) AS DOUBLE) AS q
  FROM x JOIN e USING (trade_date)
),
s AS (SELECT trade_date, avg(c) AS m, stddev_samp(c) AS sd, min(c) = max(c) AS flat FROM c GROUP BY trade_date)
""" + select(
    {"rank_volume": "k", "z_volume": _Z, "q_volume": "q", "rank_tiny": "k", "z_tiny": _Z, "q_tiny": "q"}, "c JOIN s USING (trade_date)"
)
