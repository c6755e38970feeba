"""Keyed upserts as joins of a target and a source.

The source may hold a key several times; pass ``order`` to keep its latest row. Keys of the result are
unique if the target's are.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .latest import latest_per_key

RULES = ("replace", "patch", "coalesce", "latest")


def same_keys(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Join of ``left`` with ``right`` on ``keys``, NULLs equal, with the columns of ``left`` and the others of ``right``."""
    right = right.withColumnsRenamed({k: f"_key_{k}" for k in keys})
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).eqNullSafe(F.col(f"_key_{k}"))
    return left.join(right, cond, how).drop(*[f"_key_{k}" for k in keys])


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    rule: str = "replace",
    order: Sequence[str] | None = None,
) -> DataFrame:
    """Rows of ``target`` with ``source`` merged in on ``keys``.

    replace:  a source row takes the place of the target row; columns the source lacks become NULL.
    patch:    columns the source has win, the target keeps its other columns.
    coalesce: like patch, but a NULL in the source keeps the target's value.
    latest:   of all rows of a key the latest by ``order``, so batches give the same table in any order.
    """
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}, got {rule!r}")
    if rule == "latest":
        return latest_per_key(target.unionByName(source.select(target.columns)), keys, order or ())
    if order:
        source = latest_per_key(source, keys, order)
    schema = {f.name: f.dataType for f in target.schema}
    unknown = set(source.columns) - set(schema)
    if unknown:
        raise ValueError(f"source columns not in the target: {sorted(unknown)}")
    given = {c: f"_new_{c}" for c in source.columns}
    new = source.withColumnsRenamed(given).withColumn("_found", F.lit(True))
    both = target.withColumn("_old", F.lit(True))
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).eqNullSafe(F.col(given[k]))
    both = both.join(new, cond, "full_outer")

    def merged(c: str) -> Column:
        found = F.col("_found").isNotNull()
        if c not in given:
            value = F.when(found & F.lit(rule == "replace"), None).otherwise(F.col(c))
        elif rule == "coalesce":
            value = F.coalesce(F.col(given[c]), F.col(c))
        else:
            value = F.when(found, F.col(given[c])).otherwise(F.col(c))
        return value.cast(schema[c]).alias(c)

    return both.select(*[merged(c) for c in target.columns])


def insert_if_absent(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``target`` plus the source rows whose key it lacks; existing rows are never touched."""
    new = same_keys(source, target.select(*keys), keys, "left_anti")
    return target.unionByName(new, allowMissingColumns=True)


def update_flags(target: DataFrame, decisions: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Overwrite columns of existing rows from a decision set; a NULL decision keeps the old value."""
    known = same_keys(decisions, target.select(*keys), keys, "left_semi")
    return upsert(target, known, keys, rule="coalesce")


def keep_recent(df: DataFrame, date: str, by: Sequence[str], run_date, keep_days: int) -> DataFrame:
    """Drop snapshots older than ``keep_days`` before ``run_date``, never the latest one of its group."""
    newest = df.groupBy(*by).agg(F.max(date).alias("_newest"))
    kept = F.col(date) >= F.date_sub(F.lit(run_date).cast("date"), keep_days)
    return same_keys(df, newest, by, "inner").where(kept | (F.col(date) == F.col("_newest"))).drop("_newest")
