"""Rolling operators along one instrument's bars.

Every function takes columns of a panel keyed by (stock_code, trade_date) and returns a Column. A window
of n means the last n rows including the current one, and the result is NULL unless all n values are
there. ``trade_date`` is a DATE and the key is unique, so one instrument's group holds at most one row
per calendar day (about 366 a year) whatever the size of the panel: partitioning by instrument never
collects an unbounded group. All functions share one partitioning and ordering, so Spark plans a single
exchange and sort for any number of them.
"""

from __future__ import annotations

from pyspark.sql import Column, Window
from pyspark.sql import functions as F

from .elem import col, div, finite

CODE, DATE = "stock_code", "trade_date"
_LAG_TERMS = 64  # longest weighted mean written as a sum of lags; longer ones fold an array


def _series():
    return Window.partitionBy(CODE).orderBy(DATE)


def _last(n: int):
    if int(n) < 1:
        raise ValueError(f"window must be at least 1, got {n}")
    return _series().rowsBetween(-(int(n) - 1), 0)


def _so_far():
    return _series().rowsBetween(Window.unboundedPreceding, 0)


def _full(x: Column, n: int, value: Column) -> Column:
    return F.when(F.count(x).over(_last(n)) == n, value)


def _rolling(agg, x, n: int) -> Column:
    x = col(x)
    return _full(x, n, agg(x).over(_last(n)))


def ma(x, n: int) -> Column:
    """Moving average."""
    return _rolling(F.avg, x, n)


smean = ma


def ref(x, n: int) -> Column:
    """Value n rows ago; a negative n looks ahead."""
    return F.lag(col(x), int(n)).over(_series())


def delta(x, n: int) -> Column:
    return col(x) - ref(x, n)


def ts_sum(x, n: int) -> Column:
    return _rolling(F.sum, x, n)


def ts_max(x, n: int) -> Column:
    return _rolling(F.max, x, n)


def ts_min(x, n: int) -> Column:
    return _rolling(F.min, x, n)


def prod(x, n: int) -> Column:
    return _rolling(F.product, x, n)


def std(x, n: int | None = None) -> Column:
    """Sample standard deviation over n rows, or over all rows so far when n is omitted."""
    if n is None:
        return F.stddev_samp(col(x)).over(_so_far())
    return _rolling(F.stddev_samp, x, n)


def ts_rank(x, n: int) -> Column:
    """Average rank of the newest value inside its window, divided by n."""
    x = col(x)
    seen = F.collect_list(x).over(_last(n))
    below = F.size(F.filter(seen, lambda v: v < x))
    same = F.size(F.filter(seen, lambda v: v == x))
    return _full(x, n, (below + (same + 1) / 2) / n)


def _pair(x: Column, y: Column) -> Column:
    return F.when(x.isNotNull() & y.isNotNull(), F.lit(1))


def covariance(x, y, n: int) -> Column:
    """Sample covariance."""
    x, y = col(x), col(y)
    return _full(_pair(x, y), n, F.covar_samp(x, y).over(_last(n)))


def corr(x, y, n: int) -> Column:
    """Pearson correlation; NULL when either side is constant in the window."""
    x, y = col(x), col(y)
    w = _last(n)
    value = div(F.covar_samp(x, y).over(w), F.stddev_samp(x).over(w) * F.stddev_samp(y).over(w))
    return _full(_pair(x, y), n, value)


def regbeta(a, b, n: int) -> Column:
    """Slope of the regression of a on b; NULL when b is constant."""
    a, b = col(a), col(b)
    return _full(_pair(a, b), n, F.regr_slope(a, b).over(_last(n)))


def regresi(a, b, n: int) -> Column:
    """Residual of the newest row in the regression of a on b."""
    a, b = col(a), col(b)
    w = _last(n)
    fit = F.regr_intercept(a, b).over(w) + F.regr_slope(a, b).over(w) * b
    return _full(_pair(a, b), n, a - fit)


def count(cond: Column, n: int) -> Column:
    """Rows of the last n on which the condition holds."""
    w = _last(n)
    hits = F.sum(F.when(cond, 1.0).otherwise(0.0)).over(w)
    return F.when(F.count(F.lit(1)).over(w) == n, hits)


def sumif(a, cond: Column, n: int) -> Column:
    """Sum of a over the rows of the last n on which the condition holds."""
    return ts_sum(F.when(cond, col(a)).otherwise(0.0), n)


def _weighted(x, weights: list[float]) -> Column:
    """Weighted mean, weights oldest first."""
    x = col(x)
    n, total = len(weights), sum(weights)
    weights = [w / total for w in weights]
    if n <= _LAG_TERMS:
        terms = [ref(x, n - 1 - i) * w for i, w in enumerate(weights[:-1])] + [x * weights[-1]]
        out = terms[0]
        for t in terms[1:]:
            out = out + t
        return out  # one missing term makes the sum NULL
    scaled = F.zip_with(
        F.collect_list(x).over(_last(n)), F.array(*map(F.lit, weights)), lambda v, w: v * w
    )
    return _full(x, n, F.aggregate(scaled, F.lit(0.0), lambda s, v: s + v))


def wma(x, n: int) -> Column:
    """Weighted moving average, weight 0.9 ** age."""
    return _weighted(x, [0.9**age for age in range(n - 1, -1, -1)])


def decaylinear(x, n: int) -> Column:
    """Weighted moving average, weights 1 (oldest) to n (newest)."""
    return _weighted(x, [float(i) for i in range(1, n + 1)])


def _days_since(extreme, x, n: int) -> Column:
    x = col(x)
    w = _last(n)
    first = F.array_position(F.collect_list(x).over(w), extreme(x).over(w))
    return _full(x, n, (F.lit(n) - first).cast("double"))


def highday(x, n: int) -> Column:
    """Rows since the maximum of the window; the oldest one counts on ties."""
    return _days_since(F.max, x, n)


def lowday(x, n: int) -> Column:
    """Rows since the minimum of the window; the oldest one counts on ties."""
    return _days_since(F.min, x, n)


def sumac(x) -> Column:
    """Running sum over all rows so far; missing values are skipped."""
    return F.sum(col(x)).over(_so_far())


def sequence() -> Column:
    """1, 2, ... along each instrument."""
    return F.row_number().over(_series())


def ret(close="close") -> Column:
    """Simple return against the previous row."""
    return div(close, ref(close, 1)) - 1


def forward_return(close="close", horizon: int = 5) -> Column:
    """Log return from this row to the row ``horizon`` ahead; the last rows have none."""
    return finite(F.ln(div(ref(close, -int(horizon)), close)))
