"""Universes: named sets of instruments, valid as of a date."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import codes

# Universes given by security type, and those given by index members.
TYPES = ("STOCK", "INDEX", "CSI", "ETF", "LOF", "FUTURES")
INDEXES = ("HS300", "ZZ500")


def is_stock(code="stock_code") -> Column:
    """Codes listed on the two stock exchanges."""
    c = F.col(code) if isinstance(code, str) else code
    return c.endswith(".SH") | c.endswith(".SZ")


def members_asof(membership: DataFrame, universe: str, day) -> DataFrame:
    """Codes of a universe on its latest listing date not after ``day``; ALL is the union of all types.

    ``membership`` holds (universe, stock_code, as_of); each universe has its own latest date.
    """
    wanted = TYPES if universe == "ALL" else (universe,)
    rows = membership.where(F.col("universe").isin(*wanted) & (F.col("as_of") <= F.lit(day).cast("date")))
    newest = rows.groupBy("universe").agg(F.max("as_of").alias("as_of"))
    return rows.join(newest, ["universe", "as_of"], "left_semi").select("stock_code").distinct()


def custom_members(spark, stock_codes: str) -> DataFrame:
    """Codes of a comma list, vendor codes turned into internal ones."""
    one = spark.range(1).select(F.explode(codes.split_list(F.lit(stock_codes))).alias("code"))
    return one.select(codes.source_to_internal("code").alias("stock_code")).distinct()


def filter_universe(
    panel: DataFrame, universe: str, membership: DataFrame | None = None, day=None, stock_codes: str = ""
) -> DataFrame:
    """Bars of a universe.

    ALL keeps every row and STOCK the codes of the two stock exchanges. The other names keep the members
    as of ``day`` (an empty set gives an empty result), CUSTOM the codes listed. Other names are an error.
    """
    name = (universe or "").strip().upper()
    name = "ALL" if name in ("ALL_A", "ALL") else name or "CUSTOM"
    if name == "ALL":
        return panel
    if name == "STOCK":
        return panel.where(is_stock())
    if name == "CUSTOM":
        return panel.join(custom_members(panel.sparkSession, stock_codes), "stock_code", "left_semi")
    if name not in TYPES + INDEXES:
        raise ValueError(f"unknown universe {universe!r}")
    if membership is None:
        raise ValueError(f"universe {name} needs a membership table")
    return panel.join(members_asof(membership, name, day), "stock_code", "left_semi")


def choose_ids(known: DataFrame, include: Sequence[str] = (), exclude: Sequence[str] = ()) -> DataFrame:
    """Factor ids of ``known`` on the include list (all when empty) and not on the exclude list."""
    if include:
        known = known.where(F.col("factor_id").isin(*include))
    return known.where(~F.col("factor_id").isin(*exclude)) if exclude else known


def missing_ids(requested: DataFrame, *known: DataFrame) -> DataFrame:
    """Requested factor ids that at least one of the known tables lacks."""
    present = requested.select("factor_id").distinct()
    for k in known:
        present = present.join(k, "factor_id", "left_semi")
    return requested.select("factor_id").distinct().join(present, "factor_id", "left_anti")
