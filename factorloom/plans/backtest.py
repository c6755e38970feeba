"""Evaluation jobs and what follows from them: stored results, admission, retirement, revival."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import codes
from ..operators import correlation as co
from ..operators import lifecycle as lc
from ..operators.documents import parse_documents
from ..operators.evaluate import evaluate
from ..operators.latest import latest_per_key
from ..operators.lineage import cut_lineage, stored
from ..operators.universe import filter_universe
from ..operators.upsert import insert_if_absent, update_flags, upsert
from ..schema import BATCH_KEYS, DAILY_KEYS, STATUS_KEYS
from ..sources import writers
from ..sources.readers import read_documents, scan_bars
from .factors import Factor, compute_day, compute_factors, usable_factors

RUN_KEYS = ("factor_id", "test_universe")


def registry_rows(values: DataFrame, path: str, now, span: tuple | None = None) -> DataFrame:
    """Registry entries of written values: per factor and universe with their date span, else also per day."""
    day = span is None
    keys = ["universe", "factor_id", *(["trade_date"] if day else [])]
    none = F.lit(None).cast("date")
    start, end = (none, none) if day else [F.lit(str(d)).cast("date") for d in span]
    folders = [F.concat(F.lit("universe="), "universe"), F.concat(F.lit("factor_id="), "factor_id")]
    if day:
        folders.insert(1, F.concat(F.lit("day="), F.col("trade_date").cast("string")))
    else:
        folders.append(F.lit(f"span={span[0]}_{span[1]}"))
    rows = values.select(*keys).distinct()
    return rows.select(
        F.abs(F.xxhash64(*keys, start, end)).alias("id"),
        "factor_id",
        "universe",
        F.lit("daily_csv" if day else "batch_csv").alias("artifact_type"),
        codes.rel_path(path, *folders).alias("rel_path"),
        start.alias("date_start"),
        end.alias("date_end"),
        (F.col("trade_date") if day else none).alias("trade_date"),
        F.lit(now).cast("timestamp").alias("created_at"),
        F.lit(None).cast("string").alias("comment"),
    )


def run_batch(
    bars: DataFrame,
    factors: Mapping[str, Factor],
    universe: str,
    start,
    end,
    path: str,
    registry: DataFrame,
    now,
    membership: DataFrame | None = None,
    stock_codes: str = "",
) -> tuple[DataFrame, dict[str, str]]:
    """Compute, write and register many factors over a date range and universe.

    Returns the new registry and, with their reasons, the factors left out.
    """
    panel = scan_bars(bars, start, end, universe, membership, stock_codes)
    good, bad = usable_factors(panel, factors)
    span = (str(start), str(end))
    values = compute_factors(panel, good).withColumns({"universe": F.lit(universe), "span": F.lit("_".join(span))})
    writers.write_batch_values(values, path)
    written = panel.sparkSession.read.parquet(path).where(
        (F.col("universe") == universe) & F.col("factor_id").isin(*good) & (F.col("span") == "_".join(span))
    )
    return cut_lineage(upsert(registry, registry_rows(written, path, now, span), BATCH_KEYS)), bad


def run_daily(
    bars: DataFrame,
    factors: Mapping[str, Factor],
    requested,
    universe: str,
    path: str,
    registry: DataFrame,
    now,
    days: int = 380,
    membership: DataFrame | None = None,
    stock_codes: str = "",
) -> tuple[DataFrame, dict[str, str]]:
    """Compute, write and register one day's values; other days stay as they are.

    A blank universe is ALL; any other keeps its members as of the requested day.
    """
    universe = (universe or "").strip() or "ALL"
    bars = filter_universe(bars, universe, membership, requested, stock_codes)
    good, bad = usable_factors(bars, factors)
    values = stored(compute_day(bars, good, requested, days).withColumn("universe", F.lit(universe)))
    writers.write_daily_values(values, path)
    return cut_lineage(upsert(registry, registry_rows(values, path, now), DAILY_KEYS)), bad


def registered_paths(registry: DataFrame, universe: str, factor_ids=None) -> DataFrame:
    """Newest batch file path per factor of a universe, blank paths left out."""
    rows = registry.where((F.col("artifact_type") == "batch_csv") & (F.col("universe") == universe))
    if factor_ids is not None:
        rows = rows.where(F.col("factor_id").isin(*factor_ids))
    newest = latest_per_key(rows, ["factor_id"], ["created_at", "id"])
    return newest.where(F.trim("rel_path") != "").select("factor_id", "rel_path")


def run_evaluation(
    values: DataFrame,
    bars: DataFrame,
    metadata: DataFrame,
    basic: DataFrame,
    document_path: str,
    backtest_path: str,
    now: Column,
    horizon: int = 5,
    n_quantiles: int = 10,
    test_universe: str = "ALL",
) -> DataFrame:
    """Evaluate stored values, write a document per factor, append the results; returns ``basic`` with new factors."""
    results = cut_lineage(evaluate(values, bars, horizon, n_quantiles, test_universe))
    writers.write_evaluation_documents(results, metadata, document_path, now)
    u = codes.universe_code("test_universe")
    tag = codes.file_tag(u)
    rows = results.select(
        F.abs(F.xxhash64("factor_id", "test_universe", "backtest_period", "horizon", now)).alias("id"),
        "*",
        now.alias("backtest_time"),
        codes.rel_path(document_path, F.concat(F.lit("universe="), tag), F.concat(F.lit("factor_id="), F.col("factor_id"))).alias(
            "result_json_rel_path"
        ),
        F.lit(None).cast("string").alias("comment"),
    )
    writers.append_backtests(rows, backtest_path)
    known = metadata.drop("test_universe", "is_valid", "create_time")
    new = results.select("factor_id", "test_universe").join(known, "factor_id", "left")
    new = new.select(
        "factor_id",
        F.coalesce("factor_name", "factor_id").alias("factor_name"),
        *[c for c in ("factor_type", "trading_cycle", "source_url") if c in new.columns],
        "test_universe",
        now.alias("create_time"),
        F.lit(True).alias("is_valid"),
    )
    return insert_if_absent(basic, new.select(*[c for c in new.columns if c in basic.columns]), ["factor_id"])


def document_pointers(runs: DataFrame, files: DataFrame, universe: str = "ALL", folder: str = "backtest_results") -> DataFrame:
    """Path of each factor's evaluation document that exists in the listing ``files(rel_path)``.

    First the path its latest run in the universe registered, then the conventional name by universe,
    then the old name without one.
    """
    tag = codes.file_tag(F.lit(universe))
    mine = F.max(F.when(F.col("test_universe") == universe, F.replace("result_json_rel_path", F.lit("\\"), F.lit("/"))))
    paths = runs.groupBy("factor_id").agg(mine.alias("p0"))
    tried = {
        "p0": F.col("p0"),
        "p1": F.concat(F.lit(f"{folder}/by_universe/"), tag, F.lit("/"), F.col("factor_id"), F.lit("_"), tag, F.lit("_backtest.json")),
        "p2": F.concat(F.lit(f"{folder}/"), F.col("factor_id"), F.lit("_backtest.json")),
    }
    there = files.select("rel_path").distinct()
    wanted = paths.select("factor_id", F.posexplode(F.array(*tried.values())).alias("place", "rel_path"))
    found = wanted.join(there, "rel_path", "left_semi")
    return found.groupBy("factor_id").agg(F.min_by("rel_path", "place").alias("backtest_json_path"))


def select_and_store(
    backtests: DataFrame,
    basic: DataFrame,
    status: DataFrame,
    factor_files: DataFrame,
    files: DataFrame,
    thresholds: Mapping,
    now,
    primary_universe: str = "ALL",
    documents: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """The admission step: judge the latest run per factor and universe and carry the verdict everywhere.

    Returns the new ``backtests``, ``status``, ``basic`` and ``files`` tables. Only factors with runs change.
    """
    runs = latest_per_key(backtests, RUN_KEYS, lc.RUN_ORDER)
    judged = runs.withColumn("pass_standard", lc.passes(thresholds))
    new_backtests = update_flags(backtests, judged.select("id", "pass_standard"), ["id"])
    verdicts = judged.select(
        "factor_id",
        F.coalesce("test_universe", F.lit("ALL")).alias("test_universe"),
        F.col("pass_standard").alias("is_valid"),
        F.lit(now).cast("timestamp").alias("updated_at"),
    )
    new_status = upsert(status, verdicts, STATUS_KEYS)
    touched = runs.select("factor_id").distinct()
    rolled = lc.valid_anywhere(new_status, basic.join(touched, "factor_id", "left_semi"))
    new_basic = upsert(basic, rolled.select("factor_id", "is_valid"), ["factor_id"], "patch")
    pointers = touched.join(document_pointers(runs, files, primary_universe), "factor_id", "left")
    if documents is None:
        pointers = pointers.withColumn("doc_path", F.lit(None).cast("string"))
    else:
        pointers = pointers.join(documents.select("factor_id", "doc_path"), "factor_id", "left")
    new_files = upsert(factor_files, pointers, ["factor_id"], "coalesce")
    return {"backtests": new_backtests, "status": new_status, "basic": new_basic, "files": new_files}


def run_recheck(basic: DataFrame, backtests: DataFrame, config: DataFrame, scene: str, now) -> DataFrame:
    """``basic`` after retiring factors whose IC decayed."""
    return lc.deprecate(basic, backtests, lc.threshold_row(config, scene), now)


def run_reactivation(
    basic: DataFrame, backtests: DataFrame, config: DataFrame, scene: str, cooldown_days: int, now
) -> DataFrame:
    """``basic`` after reviving factors whose latest run is good again."""
    return lc.reactivate(basic, backtests, lc.threshold_row(config, scene), cooldown_days, now)


def run_correlation(
    values: DataFrame,
    basic: DataFrame,
    universe: str,
    as_of_date,
    path: str,
    window_days: int = 252,
    min_overlap_days: int = 120,
) -> DataFrame:
    """Correlation snapshot of the valid factors over the calendar days before ``as_of_date``, written to ``path``."""
    end = F.lit(as_of_date).cast("date")
    window = values.where(F.col("trade_date").between(F.date_sub(end, window_days), end))
    window = window.join(basic.where("is_valid").select("factor_id"), "factor_id", "left_semi")
    pairs = cut_lineage(co.passing_pairs(co.correlation_pairs(window), min_overlap_days))
    writers.write_snapshot(pairs, path, universe, as_of_date)
    return pairs


def load_definitions(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Factor definitions of all documents below a folder, and the rejected documents."""
    return parse_documents(read_documents(spark, folder))
