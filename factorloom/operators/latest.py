"""First and latest rows per key.

Written as aggregations, so that each map task reduces its own rows and a key with very many rows stays cheap.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .lineage import stored


def _whole(df: DataFrame) -> Column:
    return F.struct(*df.columns)


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row with the greatest ``order`` tuple per key (later entries break ties)."""
    best = df.groupBy(*keys).agg(F.max_by(_whole(df), F.struct(*order)).alias("r"))
    return best.select(*[F.col(f"r.{c}").alias(c) for c in df.columns])


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row with the smallest ``order`` tuple per key."""
    best = df.groupBy(*keys).agg(F.min_by(_whole(df), F.struct(*order)).alias("r"))
    return best.select(*[F.col(f"r.{c}").alias(c) for c in df.columns])


def first_and_latest(df: DataFrame, key: str, metric: str, order: Sequence[str]) -> DataFrame:
    """``metric`` of the first and the latest row per key, with both order tuples' leading columns."""
    when = F.struct(*order)
    aggs = [F.min_by(metric, when).alias(f"{metric}_init"), F.max_by(metric, when).alias(f"{metric}_latest")]
    for c in order:
        aggs += [F.min_by(c, when).alias(f"{c}_init"), F.max_by(c, when).alias(f"{c}_latest")]
    return df.groupBy(key).agg(*aggs)


def latest_date_upto(df: DataFrame, date: str, wanted: Column) -> DataFrame:
    """One row ``effective_date``: the latest date not after ``wanted``, else the earliest date there is."""
    d = F.col(date)
    return df.agg(F.coalesce(F.max(F.when(d <= wanted, d)), F.min(d)).alias("effective_date"))


def asof_join(asked: DataFrame, known: DataFrame, by: Sequence[str], date: str, out: str = "asof") -> DataFrame:
    """``asked`` with ``out``: of ``known``'s rows of the same key the latest not after ``date``, else the earliest there is.

    ``out`` is a struct of the date found and ``known``'s other columns, NULL where the key has no row or the
    asked date is NULL. Of known rows of one key and date the greatest counts. Keys match if both are NULL.

    Both sides are sorted together by key and date in ranges that cut through a key, so a key of any size is spread;
    each range carries its last known row on, and what came before a range is looked up by (key, range).
    """
    by, values = list(by), [c for c in known.columns if c not in by and c != date]
    rows = known.where(F.col(date).isNotNull()).groupBy(*by, F.col(date).alias("_at")).agg(F.max(F.struct(*values)).alias("_v"))
    found = F.struct(F.col("_at").alias(date), *[F.col(f"_v.{c}").alias(c) for c in values])
    question = F.struct(*asked.columns)
    rows = rows.select(*by, "_at", F.lit(0).alias("_kind"), F.lit(0).cast("long").alias("_tie"), found.alias("_found"))
    asks = asked.select(*by, F.col(date).alias("_at"), F.lit(1).alias("_kind"), F.monotonically_increasing_id().alias("_tie"), question.alias("_row"))
    order = [*by, "_at", "_kind", "_tie"]
    both = rows.unionByName(asks, allowMissingColumns=True).repartitionByRange(*order)
    both = stored(both.withColumn("_part", F.spark_partition_id()))
    upto = Window.partitionBy("_part", *by).orderBy("_at", "_kind", "_tie").rowsBetween(Window.unboundedPreceding, 0)
    local = both.withColumn("_local", F.last("_found", ignorenulls=True).over(upto)).where("_kind = 1")
    dated = F.when(F.col("_kind") == 0, F.struct("_at", "_found"))
    parts = both.groupBy(*by, "_part").agg(F.max(dated).alias("_last"), F.min(dated).alias("_first"))
    whole = Window.partitionBy(*by)
    earlier = whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(
        *[F.col(c).alias(f"_right_{c}") for c in by], F.col("_part").alias("_right_part"),
        F.last("_last", ignorenulls=True).over(earlier).alias("_before"), F.min("_first").over(whole).alias("_earliest"),
    )
    on = F.col("_part") == F.col("_right_part")
    for c in by:
        on = on & F.col(c).eqNullSafe(F.col(f"_right_{c}"))
    answer = F.when(F.col("_at").isNotNull(), F.coalesce("_local", "_before._found", "_earliest._found"))
    return local.join(parts, on).select("_row.*", answer.alias(out))
