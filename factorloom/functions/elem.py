"""Elementwise functions with the panel's null policy.

Missing is NULL, never NaN or infinity. Division by zero is NULL. A comparison with a missing side is
FALSE (``ne``: TRUE), so booleans are never NULL.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(x) -> Column:
    """A column name, a Python number or a Column, as a Column."""
    if isinstance(x, Column):
        return x
    return F.col(x) if isinstance(x, str) else F.lit(float(x))


def once(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often ``body`` names it."""
    return F.transform(F.array(value), body)[0]


def finite(x) -> Column:
    """NaN and both infinities become NULL."""
    x = col(x)
    return F.when(F.abs(x) < F.lit(float("inf")), x)


def significant(x, digits: int = 12) -> Column:
    """Rounded to so many significant digits, whatever its size: what differs by less ties."""
    x = col(x)
    p = F.pow(F.lit(10.0), digits - 1 - F.floor(F.log10(F.abs(x))))  # infinite for 0 and where it is too large
    # the condition names p twice, so that it is computed once a row; a scaled value is below 2^53, where floor halves up exactly
    scaled = (p > 0) & (p < F.lit(float("inf"))) & (F.abs(x) < F.lit(float("inf")))
    rounded = F.signum(x) * F.floor(F.abs(x * p) + 0.5) / p
    return F.when(scaled, rounded).otherwise(F.when(x == 0, F.lit(0.0)).otherwise(x))


def div(x, y) -> Column:
    return F.try_divide(col(x), col(y))


def power(x, y) -> Column:
    """x to the power y; results that are not finite (negative base with a fraction, 0 ** -1) are NULL."""
    return finite(F.pow(col(x), col(y)))


def log(x) -> Column:
    """Natural logarithm; NULL for values <= 0."""
    return F.ln(col(x))


def abs_(x) -> Column:
    return F.abs(col(x))


def sign(x) -> Column:
    return F.signum(col(x))


def min_(x, y) -> Column:
    """Pointwise minimum; a missing side is skipped."""
    return F.least(col(x), col(y))


def max_(x, y) -> Column:
    """Pointwise maximum; a missing side is skipped."""
    return F.greatest(col(x), col(y))


def if_(cond: Column, x, y) -> Column:
    """x where the boolean holds, else y (a NULL boolean goes to y)."""
    return F.when(cond, col(x)).otherwise(col(y))


def if_number(cond, x, y) -> Column:
    """``if_`` on a numeric condition: nonzero is true, and so is a missing number."""
    c = col(cond)
    return F.when(c.isNull() | (c != 0), col(x)).otherwise(col(y))


def filter_(x, cond: Column) -> Column:
    """x where the condition holds, else NULL."""
    return F.when(cond, col(x))


def lt(x, y) -> Column:
    return F.coalesce(col(x) < col(y), F.lit(False))


def le(x, y) -> Column:
    return F.coalesce(col(x) <= col(y), F.lit(False))


def gt(x, y) -> Column:
    return F.coalesce(col(x) > col(y), F.lit(False))


def ge(x, y) -> Column:
    return F.coalesce(col(x) >= col(y), F.lit(False))


def eq(x, y) -> Column:
    return F.coalesce(col(x) == col(y), F.lit(False))


def ne(x, y) -> Column:
    return F.coalesce(col(x) != col(y), F.lit(True))


def and_(a: Column, b: Column) -> Column:
    return a & b


def or_(a: Column, b: Column) -> Column:
    return a | b


def not_(a: Column) -> Column:
    return ~a


def return_bp(close, pre_close) -> Column:
    """Daily return in basis points x 100 (ten-thousandths); NULL when the previous close is 0 or missing."""
    return (div(close, pre_close) - 1) * 10000
