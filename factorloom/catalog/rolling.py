"""Rolling operators, derived columns and elementwise functions over the derived panels."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import elem, ts
from ..functions.derived import with_derived
from .base import SERIES, SO_FAR, USER_DAY, WEEK, full, lag, r, rounded, select, user_panel, week_panel

KEYS = ["trade_date", "stock_code"]
QUERIES, SQL = {}, {}


def _rolling(name: str, columns, sql: dict[str, str], digits: int | dict[str, int] = 6) -> None:
    """Register columns over the week panel."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = week_panel(spark, sf_dir).select(*KEYS, *[c.alias(k) for k, c in columns().items()])
        return rounded(df, KEYS, digits)

    QUERIES[name] = run
    SQL[name] = f"WITH {WEEK}\n{select(sql, 'w', digits)}"


def panel_week(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(week_panel(spark, sf_dir), KEYS, 8)


def panel_userday(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(user_panel(spark, sf_dir), KEYS)


_BAR = {c: c for c in ("open", "high", "low", "close", "volume", "turnover")}
QUERIES["panel_week"] = panel_week
SQL["panel_week"] = f"WITH {WEEK}\n{select(_BAR, 'w', 8)}"
QUERIES["panel_userday"] = panel_userday
SQL["panel_userday"] = f"WITH {USER_DAY}\n{select(_BAR, 'u')}"

# prices are cents over whole quantities up to 50, so 8 decimals hold them and their differences exactly
EXACT = {c: 8 for c in ("ref_3", "lead_2", "delta_2", "max_10", "min_10")}
_rolling(
    "ts_basic",
    lambda: {
        "ma_7": ts.ma("close", 7),
        "ref_3": ts.ref("close", 3),
        "lead_2": ts.ref("close", -2),
        "delta_2": ts.delta("close", 2),
        "sum_5": ts.ts_sum("volume", 5),
        "max_10": ts.ts_max("high", 10),
        "min_10": ts.ts_min("low", 10),
        "std_10": ts.std("close", 10),
    },
    {
        "ma_7": full(7, "close", "avg(close) {w}"),
        "ref_3": lag("close", 3),
        "lead_2": lag("close", -2),
        "delta_2": f"close - {lag('close', 2)}",
        "sum_5": full(5, "volume", "sum(volume) {w}"),
        "max_10": full(10, "high", "max(high) {w}"),
        "min_10": full(10, "low", "min(low) {w}"),
        "std_10": full(10, "close", "stddev_samp(close) {w}"),
    },
    EXACT,
)

_rolling(
    "ts_rank",
    lambda: {"ts_rank_10": ts.ts_rank("close", 10), "ts_rank_volume_6": ts.ts_rank("volume", 6)},
    {
        f"ts_rank{tag}_{n}": full(
            n,
            x,
            f"(len(list_filter(list({x}) {{w}}, lambda v: v < {x})) + (len(list_filter(list({x}) {{w}}, lambda v: v = {x})) + 1) / 2.0) / {n}",
        )
        for tag, x, n in (("", "close", 10), ("_volume", "volume", 6))
    },
)

_rolling(
    "ts_highlow_day",
    lambda: {
        "highday_10": ts.highday("volume", 10),
        "lowday_10": ts.lowday("volume", 10),
        "highday_close_6": ts.highday("close", 6),
    },
    {
        "highday_10": full(10, "volume", "CAST(10 - list_position(list(volume) {w}, max(volume) {w}) AS DOUBLE)"),
        "lowday_10": full(10, "volume", "CAST(10 - list_position(list(volume) {w}, min(volume) {w}) AS DOUBLE)"),
        "highday_close_6": full(6, "close", "CAST(6 - list_position(list(close) {w}, max(close) {w}) AS DOUBLE)"),
    },
)


def _weighted_sql(x: str, weights: list[float]) -> str:
    n, total = len(weights), sum(weights)
    terms = [f"({x if i == n - 1 else lag(x, n - 1 - i)}) * {w / total!r}" for i, w in enumerate(weights)]
    return " + ".join(terms)


_rolling(
    "ts_weighted",
    lambda: {
        "wma_8": ts.wma("close", 8),
        "decay_8": ts.decaylinear("close", 8),
        "decay_70": ts.decaylinear("close", 70),
    },
    {
        "wma_8": _weighted_sql("close", [0.9**a for a in range(7, -1, -1)]),
        "decay_8": _weighted_sql("close", [float(i) for i in range(1, 9)]),
        "decay_70": _weighted_sql("close", [float(i) for i in range(1, 71)]),
    },
)

_rolling(
    "ts_corr_cov",
    lambda: {"corr_10": ts.corr("close", "volume", 10), "cov_10": ts.covariance("close", "volume", 10)},
    {
        "corr_10": full(
            10, "close + volume", "covar_samp(close, volume) {w} / nullif(stddev_samp(close) {w} * stddev_samp(volume) {w}, 0)"
        ),
        "cov_10": full(10, "close + volume", "covar_samp(close, volume) {w}"),
    },
    {"cov_10": 2},
)

_BETA = "covar_samp(close, volume) {w} / nullif(var_samp(volume) {w}, 0)"
_rolling(
    "ts_regression",
    lambda: {"beta_10": ts.regbeta("close", "volume", 10), "resid_10": ts.regresi("close", "volume", 10)},
    {
        "beta_10": full(10, "close + volume", _BETA),
        "resid_10": full(
            10, "close + volume", f"close - (avg(close) {{w}} - ({_BETA}) * avg(volume) {{w}}) - ({_BETA}) * volume"
        ),
    },
    5,
)

_UP = "coalesce(close > open, false)"
_rolling(
    "ts_prod_count_sumif",
    lambda: {
        "prod_4": ts.prod(elem.div("close", "open"), 4),
        "count_6": ts.count(elem.gt("close", "open"), 6),
        "sumif_6": ts.sumif("volume", elem.gt("close", "open"), 6),
    },
    {
        "prod_4": full(4, "close / open", "product(close / open) {w}"),
        "count_6": full(6, "1", f"sum(CASE WHEN {_UP} THEN 1.0 ELSE 0.0 END) {{w}}"),
        "sumif_6": full(6, "volume", f"sum(CASE WHEN {_UP} THEN volume ELSE 0.0 END) {{w}}"),
    },
)

_rolling(
    "ts_expanding",
    lambda: {"sumac": ts.sumac("volume"), "seq": ts.sequence(), "std_all": ts.std("close")},
    {
        "sumac": f"sum(volume) OVER {SO_FAR}",
        "seq": f"row_number() OVER {SERIES}",
        "std_all": f"stddev_samp(close) OVER {SO_FAR}",
    },
    {"std_all": 4},
)


DERIVED_EXACT = {"vwap": 10} | {c: 8 for c in ("prev_open", "prev_close", "prev_high", "prev_low", "dtm", "dbm", "tr", "hd", "ld")}


def derived_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = with_derived(week_panel(spark, sf_dir)).drop("open", "high", "low", "close", "volume", "turnover")
    return rounded(df, KEYS, DERIVED_EXACT)


QUERIES["derived_columns"] = derived_columns
SQL["derived_columns"] = f"""WITH {WEEK},
d AS (
  SELECT *, {lag('open')} AS po, {lag('close')} AS pc, {lag('high')} AS ph, {lag('low')} AS pl FROM w
)
""" + select(
    {
        "vwap": "turnover / nullif(volume, 0)",
        "ret": "close / nullif(pc, 0) - 1",
        "prev_open": "po",
        "prev_close": "pc",
        "prev_high": "ph",
        "prev_low": "pl",
        "dtm": "CASE WHEN po IS NULL OR open <= po THEN 0.0 ELSE greatest(high - open, open - po) END",
        "dbm": "CASE WHEN po IS NULL OR open >= po THEN 0.0 ELSE greatest(open - low, open - po) END",
        "tr": "greatest(high - low, abs(high - pc), abs(low - pc))",
        "hd": "high - ph",
        "ld": "pl - low",
        **{c: "0.0::DOUBLE" for c in ("mkt", "smb", "hml", "benchmark_open", "benchmark_close")},
    },
    "d",
    DERIVED_EXACT,
)


def elementwise(spark: SparkSession, sf_dir: str) -> DataFrame:
    o, c, v, t = (F.col(x) for x in ("open", "close", "volume", "turnover"))
    made = {
        "arith": (c - o) * v + t,
        "ratio": elem.div(c, o),
        "power_": elem.power(v, 0.5),
        "power_neg": elem.power(c - o, 0.5),
        "log_": elem.log(c),
        "abs_": elem.abs_(c - o),
        "sign_": elem.sign(c - o),
        "min_": elem.min_(o, c),
        "max_": elem.max_(o, 50),
        "if_": elem.if_(elem.gt(c, o), v, t),
        "if_num": elem.if_number(elem.sign(v - 1), c, o),
        "filter_": elem.filter_(c, elem.ge(v, 2)),
        "cmp": elem.if_(elem.lt(ts.ref("close", 1), "close"), 1, 0)
        + elem.if_(elem.ne(ts.ref("close", 1), "close"), 2, 0)
        + elem.if_(elem.le("open", "close"), 4, 0)
        + elem.if_(elem.eq("open", "close"), 8, 0),
        "logic": elem.if_(
            elem.or_(elem.and_(elem.gt(c, o), elem.gt(v, 2)), elem.not_(elem.ge(t, 100))), 1, 0
        ),
    }
    df = user_panel(spark, sf_dir)
    return rounded(df.select(*KEYS, *[x.alias(k) for k, x in made.items()]), KEYS)


QUERIES["elementwise"] = elementwise
SQL["elementwise"] = f"WITH {USER_DAY},\nd AS (SELECT *, {lag('close')} AS pc FROM u)\n" + select(
    {
        "arith": "(close - open) * volume + turnover",
        "ratio": "close / nullif(open, 0)",
        "power_": "pow(volume, 0.5)",
        "power_neg": "CASE WHEN close - open >= 0 THEN pow(close - open, 0.5) END",
        "log_": "CASE WHEN close > 0 THEN ln(close) END",
        "abs_": "abs(close - open)",
        "sign_": "CAST(sign(close - open) AS DOUBLE)",
        "min_": "least(open, close)",
        "max_": "greatest(open, 50.0)",
        "if_": "CASE WHEN close > open THEN volume ELSE turnover END",
        "if_num": "CASE WHEN volume <> 1 THEN close ELSE open END",
        "filter_": "CASE WHEN volume >= 2 THEN close END",
        "cmp": "CAST((CASE WHEN pc < close THEN 1 ELSE 0 END) + (CASE WHEN pc IS NULL OR pc <> close THEN 2 ELSE 0 END)"
        " + (CASE WHEN open <= close THEN 4 ELSE 0 END) + (CASE WHEN open = close THEN 8 ELSE 0 END) AS DOUBLE)",
        "logic": "CAST(CASE WHEN (close > open AND volume > 2) OR NOT (turnover >= 100) THEN 1 ELSE 0 END AS DOUBLE)",
    },
    "d",
)


def fwd_return(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = week_panel(spark, sf_dir)
    return df.select(*KEYS, r(ts.forward_return("close", 5)).alias("ret_5"), r(ts.forward_return("close", 1)).alias("ret_1"))


QUERIES["fwd_return"] = fwd_return
SQL["fwd_return"] = f"WITH {WEEK}\n" + select(
    {n: f"ln(nullif({lag('close', -h)} / nullif(close, 0), 0))" for n, h in (("ret_5", 5), ("ret_1", 1))}, "w"
)
