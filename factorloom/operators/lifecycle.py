"""Threshold decisions on evaluated factors: admit, retire, revive."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .latest import latest_per_key
from .upsert import update_flags

RUN_ORDER = ("backtest_time", "id")


def active_thresholds(config: DataFrame, scene: str) -> dict:
    """The newest active threshold row of a scene; none is an error."""
    row = (
        config.where((F.col("scene") == scene) & F.col("is_active"))
        .orderBy(F.col("created_at").desc(), F.col("id").desc())
        .limit(1)
        .first()
    )
    if row is None:
        raise ValueError(f"no active thresholds for scene {scene!r}")
    return row.asDict()


def threshold_row(config: DataFrame, scene: str) -> DataFrame:
    """The newest active threshold row of a scene as a table of one row (scene, th: struct), or of none."""
    active = config.where((F.col("scene") == scene) & F.col("is_active"))
    whole = F.struct(*[F.col(c) for c in config.columns])
    return active.groupBy("scene").agg(F.max_by(whole, F.struct("created_at", "id")).alias("th"))


def with_limits(df: DataFrame, th: Mapping | DataFrame) -> tuple[DataFrame, Mapping]:
    """``df`` and the limits to judge it by. A :func:`threshold_row` is joined in the plan (column ``_th``), so nothing is read
    to the driver; without an active row the job fails as soon as a row is judged.
    """
    if not isinstance(th, DataFrame):
        return df, th
    names = [f.name for f in th.schema["th"].dataType.fields]
    row = th.select(F.lit(1).alias("_one"), F.col("th").alias("_th"))
    met = df.withColumn("_scene", F.lit(1)).join(row, F.col("_scene") == F.col("_one"), "left").drop("_scene", "_one")
    met = met.where(F.assert_true(F.col("_th").isNotNull(), F.lit("no active thresholds for the scene")).isNull())
    return met, {n: F.col(f"_th.{n}") for n in names}


def _limit(value: float | Column | None) -> Column | None:
    return value if value is None or isinstance(value, Column) else F.lit(float(value))


def _number(metric: str) -> Column:
    return F.when(~F.isnan(F.col(metric)), F.col(metric))


def _holds(rules: list[tuple[str, str, float | Column | None]]) -> Column:
    """All configured rules hold; a missing or NaN metric fails its rule, a missing threshold has none."""
    out = F.lit(True)
    for metric, op, limit in rules:
        t = _limit(limit)
        if t is None:
            continue
        x = _number(metric)
        out = out & (t.isNull() | F.coalesce(x >= t if op == ">=" else x <= t, F.lit(False)))
    return out


def passes(th: Mapping) -> Column:
    """Whether a metrics row meets the admission thresholds. The drawdown limit is negative."""
    return _holds(
        [
            ("ic_value", ">=", th.get("ic_min")),
            ("ic_ir", ">=", th.get("ic_ir_min")),
            ("sharpe_ratio", ">=", th.get("sharpe_min")),
            ("max_drawdown", ">=", th.get("max_drawdown_max")),
            ("turnover", "<=", th.get("turnover_max")),
        ]
    )


def reactivates(th: Mapping) -> Column:
    """Whether a metrics row meets the thresholds for revival."""
    return _holds(
        [
            ("ic_value", ">=", th.get("ic_min_reactivate")),
            ("ic_ir", ">=", th.get("ic_ir_min_reactivate")),
            ("sharpe_ratio", ">=", th.get("sharpe_min_reactivate")),
            ("max_drawdown", ">=", th.get("max_drawdown_max_reactivate")),
        ]
    )


def should_deprecate(th: Mapping, init: str = "ic_value_init", latest: str = "ic_value_latest") -> Column:
    """Whether a factor's latest IC fell too far.

    From a positive first IC: the relative decay exceeds its threshold and the latest IC is below its
    floor. From a first IC at or below 0 (or within 1e-8 of it): the latest is below the floor. A missing
    IC keeps the factor.
    """
    decay_max, floor = _limit(th.get("ic_decay_threshold")), _limit(th.get("latest_ic_min"))
    a, b = _number(init), _number(latest)
    below = b < floor if floor is not None else F.lit(False)
    decayed = F.try_divide(a - b, a) > decay_max if decay_max is not None else F.lit(False)
    no_base = (a <= 0) | (F.abs(a) <= 1e-8)
    return F.coalesce(F.when(no_base, below).otherwise(decayed & below), F.lit(False))


def init_and_latest_ic(backtests: DataFrame, basic: DataFrame, per_universe: bool = False) -> DataFrame:
    """First and latest IC of every valid factor, over all universes unless ``per_universe``."""
    keys = ["factor_id", "test_universe"] if per_universe else ["factor_id"]
    valid = basic.where("is_valid").select("factor_id")
    when = F.struct(*RUN_ORDER)
    aggs = []
    for pick, tag in ((F.min_by, "init"), (F.max_by, "latest")):
        for src, dst in (("ic_value", "ic_value"), ("id", "id"), ("backtest_time", "time")):
            aggs.append(pick(src, when).alias(f"{dst}_{tag}"))
    return backtests.join(valid, "factor_id", "left_semi").groupBy(*keys).agg(*aggs)


def deprecate(basic: DataFrame, backtests: DataFrame, th: Mapping | DataFrame, now) -> DataFrame:
    """``basic`` with decayed factors made invalid; an existing reason stays."""
    judged, limits = with_limits(init_and_latest_ic(backtests, basic), th)
    gone = judged.where(should_deprecate(limits)).select("factor_id", F.lit(True).alias("_gone"))
    hit = F.col("_gone").isNotNull()
    out = basic.join(gone, "factor_id", "left").withColumns(
        {
            "is_valid": F.when(hit, False).otherwise(F.col("is_valid")),
            "deprecate_reason": F.when(hit, F.coalesce("deprecate_reason", F.lit("performance"))).otherwise(
                F.col("deprecate_reason")
            ),
            "deprecate_time": F.when(hit, F.lit(now).cast("timestamp")).otherwise(F.col("deprecate_time")),
        }
    )
    return out.select(*basic.columns)


def reactivation_candidates(basic: DataFrame, cooldown_days: int, now) -> DataFrame:
    """Factors retired for performance at least ``cooldown_days`` before ``now``."""
    limit = F.lit(now).cast("timestamp") - F.make_dt_interval(days=F.lit(cooldown_days))
    return basic.where(
        ~F.col("is_valid") & (F.col("deprecate_reason") == "performance") & (F.col("deprecate_time") <= limit)
    ).select("factor_id")


def reactivate(basic: DataFrame, backtests: DataFrame, th: Mapping | DataFrame, cooldown_days: int, now) -> DataFrame:
    """``basic`` with candidates revived whose latest run meets the thresholds."""
    candidates = reactivation_candidates(basic, cooldown_days, now)
    latest = latest_per_key(backtests.join(candidates, "factor_id", "left_semi"), ["factor_id"], RUN_ORDER)
    judged, limits = with_limits(latest, th)
    back = judged.where(reactivates(limits)).select(
        "factor_id", F.lit(True).alias("is_valid"), F.lit(now).cast("timestamp").alias("reactivated_time")
    )
    return update_flags(basic, back, ["factor_id"])


def valid_anywhere(status: DataFrame, basic: DataFrame) -> DataFrame:
    """``basic`` with is_valid true where any universe is valid, else false."""
    any_valid = status.groupBy("factor_id").agg(F.coalesce(F.bool_or("is_valid"), F.lit(False)).alias("_any"))
    out = basic.join(any_valid, "factor_id", "left").withColumn("is_valid", F.coalesce("_any", F.lit(False)))
    return out.select(*basic.columns)
