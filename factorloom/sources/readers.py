"""Readers: bars, factor values, landed vendor files, documents, ids."""

from __future__ import annotations

import re
from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from ..functions.elem import finite
from ..operators.conform import conform_bars, rename
from ..operators.universe import filter_universe
from ..schema import FACTOR_VALUES, PANEL_COLUMNS

# Source column -> bar column.
QUOTE_COLUMNS = {
    "TradeDate": "trade_date",
    "Symbol": "stock_code",
    "Open": "open",
    "High": "high",
    "Low": "low",
    "Close": "close",
    "PreClose": "pre_close",
    "HighLimit": "high_limit",
    "LowLimit": "low_limit",
    "Volume": "volume",
    "Amount": "turnover",
    "Return": "return",
    "IsSuspend": "is_suspend",
    "Multiple": "multiple",
    "UpdateTime": "update_time",
}
VENDOR_A_COLUMNS = {
    "time": "trade_date",
    "code": "stock_code",
    "open": "open",
    "close": "close",
    "low": "low",
    "high": "high",
    "volume": "volume",
    "money": "turnover",
    "pre_close": "pre_close",
    "high_limit": "high_limit",
    "low_limit": "low_limit",
    "paused": "is_suspend",
}
VENDOR_B_COLUMNS = {
    "日期": "trade_date",
    "开盘": "open",
    "收盘": "close",
    "最高": "high",
    "最低": "low",
    "成交量": "volume",
    "成交额": "turnover",
}


def between_dates(df: DataFrame, start, end, day: str = "trade_date") -> DataFrame:
    """Rows of a closed date range; the filter reaches the scan."""
    return df.where(F.col(day).between(F.lit(start).cast("date"), F.lit(end).cast("date")))


def lookback(df: DataFrame, day: Column, days: int) -> DataFrame:
    """Rows of the last ``days`` calendar days up to ``day``, both ends included."""
    return df.where(F.col("trade_date").between(F.date_sub(day, days), day))


def scan_bars(
    bars: DataFrame, start, end, universe: str = "ALL", membership: DataFrame | None = None, stock_codes: str = ""
) -> DataFrame:
    """The eight panel columns of a date range and universe (as of the range's end), numbers made finite."""
    df = between_dates(bars.select(*PANEL_COLUMNS), start, end)
    df = filter_universe(df, universe, membership, end, stock_codes)
    return df.withColumns({c: finite(F.col(c).cast("double")) for c in PANEL_COLUMNS[2:]})


def scan_closes(bars: DataFrame, start, end, stock_codes: Sequence[str] | DataFrame | None = None) -> DataFrame:
    """Close prices of a date range, for all or the given instruments; an empty list is an error."""
    df = between_dates(bars.select("stock_code", "trade_date", "close"), start, end)
    if stock_codes is None:
        return df
    if isinstance(stock_codes, DataFrame):
        return df.join(stock_codes.select(F.trim("stock_code").alias("stock_code")).distinct(), "stock_code", "left_semi")
    wanted = sorted({str(c).strip() for c in stock_codes} - {""})
    if not wanted:
        raise ValueError("the list of instruments is empty")
    return df.where(F.col("stock_code").isin(*wanted))


def _typed_values(df: DataFrame, *extra: str) -> DataFrame:
    """Factor values out of text columns; a table without the needed columns is an error."""
    lacking = set(FACTOR_VALUES.names) - set(df.columns)
    if lacking:
        raise ValueError(f"factor files lack columns {sorted(lacking)}")
    return df.select(
        *extra,
        F.col("trade_date").cast("date").alias("trade_date"),
        "stock_code",
        finite(F.col("factor_value").try_cast("double")).alias("factor_value"),
    )


def read_values_csv(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Factor values from CSV files with a header."""
    return _typed_values(spark.read.option("header", True).csv(paths))


def file_parts(name: Column, universe: str) -> dict[str, Column]:
    """Factor id and end date out of ``<factor>_<UNIVERSE>_<start>_<end>.csv``; NULL when the name differs."""
    tag = universe.strip().upper() or "ALL"
    pattern = rf"^(.+)_(?i:\Q{tag}\E)_([^_]+)_([^_]+)\.(?i:csv)$"
    factor = F.regexp_extract(name, pattern, 1)
    return {
        "factor_id": F.when(factor != "", factor),
        "date_end": F.try_to_date(F.regexp_extract(name, pattern, 3), "yyyy-MM-dd"),
    }


def list_files(spark: SparkSession, folder: str, glob: str = "*") -> DataFrame:
    """Files below a folder as (path, modified, length, name); none of them is opened.

    Where a job wrote a folder named like a file, ``a.csv/part-...``, that name counts. A folder that is not there has none.
    """
    try:
        files = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", True).load(folder)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "path string, modified timestamp, length bigint, name string")
    named = F.regexp_extract("path", r"([^/]+)(?:/part-[^/]*)?$", 1)
    return files.select("path", F.col("modificationTime").alias("modified"), "length", named.alias("name"))


def newest_files(files: DataFrame, universe: str) -> DataFrame:
    """Of a listing the files of each factor's newest end date (the greatest name on a tie): factor_id, path.

    Names off the convention, or without a date, are left out.
    """
    known = files.withColumns(file_parts(F.col("name"), universe)).where("factor_id is not null and date_end is not null")
    best = known.groupBy("factor_id").agg(F.max_by("name", F.struct("date_end", "name")).alias("name"))
    return known.join(best, ["factor_id", "name"], "left_semi").select("factor_id", "path")


def _literal_path(path: str) -> str:
    """A path in which no character stands for others."""
    return re.sub(r"([\\\[\]{}*?])", r"\\\1", path)


def read_values_dir(spark: SparkSession, root: str, universe: str, newest_only: bool = True) -> DataFrame:
    """Factor values of all CSV files below ``root/by_universe/<U>``, with the factor id from the file name.

    Of several files of a factor the one with the newest end date counts (the greatest name on a tie): the listing
    decides, and only the files chosen are opened. Their paths, one a factor, come to the driver, which plans the scan.
    Names off the convention are left out; a row whose number cannot be read has NULL there.
    """
    files = list_files(spark, f"{root}/by_universe/{universe.strip().upper() or 'ALL'}", "*.[cC][sS][vV]")
    if newest_only:
        chosen = newest_files(files, universe)
    else:
        chosen = files.withColumns(file_parts(F.col("name"), universe)).where("factor_id is not null").select("factor_id", "path")
    paths = [_literal_path(r["path"]) for r in chosen.select("path").collect()]
    if not paths:
        return spark.createDataFrame([], "factor_id string, trade_date date, stock_code string, factor_value double")
    df = spark.read.option("header", True).csv(paths).select("*", F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B"))).alias("file_path"))
    name = F.regexp_extract("file_path", r"([^/]+)(?:/part-[^/]*)?$", 1)
    return _typed_values(df.withColumn("factor_id", file_parts(name, universe)["factor_id"]), "factor_id")


def read_jdbc_quotes(
    spark: SparkSession, options: dict, start, end, date_format: str = "date", partitions: int = 16, symbols=()
) -> DataFrame:
    """Quotes from a relational source, read in parallel date ranges.

    ``options`` holds url, dbtable, driver and credentials. With ``date_format="yyyymmdd"`` the source's
    date is text of that form; its ranges are then given as predicates, one per part of the period.
    """
    first, last = date.fromisoformat(str(start)), date.fromisoformat(str(end))
    step = max(1, -(-((last - first).days + 1) // partitions))
    text = "%Y%m%d" if date_format == "yyyymmdd" else "%Y-%m-%d"
    cuts, day = [], first
    while day <= last:
        cuts.append((day.strftime(text), (min(day + timedelta(days=step - 1), last) + timedelta(days=1)).strftime(text)))
        day += timedelta(days=step)
    # half-open, so a time of day on a range's last day is in it
    predicates = [f"TradeDate >= '{a}' AND TradeDate < '{b}'" for a, b in cuts]
    opts = dict(options)
    df = spark.read.jdbc(opts.pop("url"), opts.pop("dbtable"), predicates=predicates, properties=opts)
    df = df.where(F.col("Symbol").isin(*symbols)) if symbols else df
    return conform_bars(rename(df, QUOTE_COLUMNS))


def calendar_scan(calendar: DataFrame, start=None, end=None) -> DataFrame:
    """Calendar rows, all of them or a range."""
    df = calendar.select("trade_date", "is_trade_day")
    return df if start is None else between_dates(df, start, end)


def landed_bars(df: DataFrame, mapping: dict[str, str], **fixed: Column) -> DataFrame:
    """Bars from a landed vendor table: columns renamed by ``mapping``, ``fixed`` ones added, rows conformed."""
    return conform_bars(rename(df, mapping).withColumns(fixed) if fixed else rename(df, mapping))


def read_documents(spark: SparkSession, folder: str, glob: str = "*.{[mM][dD],txt}") -> DataFrame:
    """Whole text files below a folder as (doc_path, text)."""
    df = spark.read.text(folder, wholetext=True, recursiveFileLookup=True, pathGlobFilter=glob)
    return df.select(F.col("_metadata.file_path").alias("doc_path"), F.col("value").alias("text"))


def read_document_table(spark: SparkSession, path: str, wanted: DataFrame | None = None) -> DataFrame:
    """Documents (doc_path, text) of a document table, all or the ``wanted`` paths (doc_path)."""
    docs = spark.read.schema("doc_path string, text string").parquet(path)
    return docs if wanted is None else docs.join(wanted.select("doc_path").distinct(), "doc_path", "left_semi")


def read_pages(spark: SparkSession, folder: str) -> DataFrame:
    """Whole HTML files below a folder as (url, html)."""
    return read_documents(spark, folder, "*.htm*").select(F.col("doc_path").alias("url"), F.col("text").alias("html"))


def factor_ids(basic: DataFrame, valid_only: bool = True) -> DataFrame:
    """Ids of the valid (or all) factors in order."""
    df = basic.where("is_valid") if valid_only else basic
    return df.select("factor_id").orderBy("factor_id")
