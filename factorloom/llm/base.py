"""Helpers the operators of this package share."""

from __future__ import annotations

import string
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SPACE = r"[ \x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often ``body`` names it.

    A column that a lambda names would be computed again for each element once the optimizer merges two
    projections; a lambda's own variable is not.
    """
    return F.transform(F.array(value), body)[0]


def words(text: Column) -> Column:
    """The text's words, split at ASCII white space; a NULL text has none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE), lambda w: w != "")


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, all else as it is."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def total(values: Column) -> Column:
    """Sum of an array of longs; 0 for an empty one."""
    return F.aggregate(values, F.lit(0).cast("long"), lambda a, x: a + x)


def same(left: DataFrame, right: DataFrame, *names: str) -> Column:
    """Join condition under which NULL keys agree."""
    on = None
    for n in names:
        one = left[n].eqNullSafe(right[n])
        on = one if on is None else on & one
    return on


def small_side(df: DataFrame, rows: int, limit: int) -> DataFrame:
    """``df`` marked for broadcast if its counted ``rows`` are within ``limit``, else left to a shuffle join."""
    return F.broadcast(df) if rows <= limit else df
