"""Tables, panels and rounding shared by the registered queries and their SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import panels


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def week_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return panels.week_panel(table(spark, sf_dir, "lineitem"))


def user_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return panels.user_day_panel(table(spark, sf_dir, "events"))


def r(c: str | Column, digits: int = 6) -> Column:
    """Rounded, without a negative zero."""
    return F.round(F.col(c) if isinstance(c, str) else c, digits) + 0.0


def rounded(df: DataFrame, keys: list[str], digits: int | dict[str, int] = 6) -> DataFrame:
    """Keys as they are, all other columns rounded under their own names."""
    d = digits if isinstance(digits, dict) else {}
    default = digits if isinstance(digits, int) else 6
    return df.select(*keys, *[r(c, d.get(c, default)).alias(c) for c in df.columns if c not in keys])


# --- SQL ---

WEEK = """
w0 AS (
  SELECT l_suppkey, CAST(date_trunc('week', l_shipdate) AS DATE) AS trade_date, l_quantity, l_extendedprice,
         l_extendedprice / nullif(l_quantity, 0) AS p,
         row(l_shipdate, l_orderkey, l_linenumber, l_partkey, l_extendedprice / nullif(l_quantity, 0)) AS k
  FROM lineitem
),
w AS (
  SELECT CAST(l_suppkey AS VARCHAR) AS stock_code, trade_date,
         arg_min(p, k) AS open, max(p) AS high, min(p) AS low, arg_max(p, k) AS close,
         sum(l_quantity) AS volume, round(sum(l_extendedprice), 2) AS turnover
  FROM w0 GROUP BY l_suppkey, trade_date
)"""

USER_DAY = """
u AS (
  SELECT CAST(user_id AS VARCHAR) AS stock_code, CAST(ts AS DATE) AS trade_date,
         arg_min(value, ts) AS open, max(value) AS high, min(value) AS low, arg_max(value, ts) AS close,
         CAST(count(*) AS DOUBLE) AS volume, round(sum(value), 6) AS turnover
  FROM events GROUP BY user_id, CAST(ts AS DATE)
)"""


def sr(expr: str, digits: int = 6) -> str:
    return f"round({expr}, {digits}) + 0.0"


def significant(x: str) -> str:
    """Rounded to 12 significant digits."""
    p = f"pow(10.0, 11 - floor(log10(nullif(abs({x}), 0))))"
    return f"CASE WHEN {x} = 0 THEN 0.0 ELSE round({x} * {p}) / {p} END"


def select(cols: dict[str, str], source: str, digits: int | dict[str, int] = 6, keys="trade_date, stock_code") -> str:
    d = digits if isinstance(digits, dict) else {}
    default = digits if isinstance(digits, int) else 6
    body = ",\n  ".join(f"{sr(e, d.get(c, default))} AS {c}" for c, e in cols.items())
    return f"SELECT {keys},\n  {body}\nFROM {source}"


def frame(n: int) -> str:
    return f"(PARTITION BY stock_code ORDER BY trade_date ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"


SERIES = "(PARTITION BY stock_code ORDER BY trade_date)"
SO_FAR = "(PARTITION BY stock_code ORDER BY trade_date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"


def full(n: int, known: str, expr: str) -> str:
    """``expr`` (with {w} for the frame) where all n values of ``known`` are there."""
    return f"CASE WHEN count({known}) OVER {frame(n)} = {n} THEN {expr.format(w='OVER ' + frame(n))} END"


def lag(x: str, n: int = 1) -> str:
    return f"lag({x}, {n}) OVER {SERIES}" if n >= 0 else f"lead({x}, {-n}) OVER {SERIES}"


def avg_rank(x: str, by: str) -> str:
    """Average rank of a column that is not NULL."""
    return f"(rank() OVER (PARTITION BY {by} ORDER BY {x}) + (count(*) OVER (PARTITION BY {by}, {x}) - 1) / 2.0)"


def rank01(x: str, by: str = "trade_date") -> str:
    """Rank to 0..1; NULLs are unranked but count in the divisor."""
    r = f"(rank() OVER (PARTITION BY {by} ORDER BY {x} NULLS LAST) + (count({x}) OVER (PARTITION BY {by}, {x}) - 1) / 2.0)"
    rows = f"count(*) OVER (PARTITION BY {by})"
    return f"CASE WHEN {rows} = 1 THEN 0.0 WHEN {x} IS NOT NULL THEN ({r} - 1) / ({rows} - 1) END"


def pearson(x: str, y: str) -> str:
    return f"covar_samp({x}, {y}) / nullif(stddev_samp({x}) * stddev_samp({y}), 0)"
