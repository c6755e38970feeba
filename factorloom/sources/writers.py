"""Writers. Partitioned tables are rewritten one touched partition at a time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from ..functions import codes
from ..operators.documents import render_document
from ..operators.latest import latest_per_key
from ..operators.lineage import cut_lineage, stored
from ..operators.upsert import same_keys, upsert


#: Rows of a partition that go to one task, and so to one file.
FILE_ROWS = 5_000_000


def overwrite_partitions(df: DataFrame, path: str, by: Sequence[str], fmt: str = "parquet", rows: int = FILE_ROWS, **options) -> None:
    """Write ``df``, replacing exactly the partitions it has rows in, with a file for each ``rows`` rows of a partition.

    Partitions are counted map-side first. One of few rows meets in a task, so it is not scattered over a file from every
    task; a larger one is dealt by its rows' hashes, so no task holds it whole.
    """
    df = stored(df)
    counts = df.groupBy(*by).agg(F.ceil(F.count(F.lit(1)) / rows).cast("int").alias("_files"))
    dealt = same_keys(df, counts, by, "inner").withColumn("_file", F.pmod(F.xxhash64(*df.columns), F.col("_files"))).drop("_files")
    w = dealt.repartition(*by, "_file").drop("_file").write.mode("overwrite").format(fmt)
    w.option("partitionOverwriteMode", "dynamic").options(**options).partitionBy(*by).save(path)


def write_batch_values(values: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Factor values by universe, factor and date span."""
    overwrite_partitions(values, path, ["universe", "factor_id", "span"], fmt, **({"header": True} if fmt == "csv" else {}))


def write_daily_values(values: DataFrame, path: str, fmt: str = "parquet") -> None:
    """One day's factor values by universe, date and factor; other days stay."""
    day = values.withColumn("day", F.col("trade_date"))
    overwrite_partitions(day, path, ["universe", "day", "factor_id"], fmt, **({"header": True} if fmt == "csv" else {}))


def upsert_table(
    spark: SparkSession,
    path: str,
    source: DataFrame,
    keys: Sequence[str],
    by: Sequence[str],
    rule: str = "replace",
    order: Sequence[str] | None = None,
) -> None:
    """Merge ``source`` into the parquet table at ``path`` (partitioned by ``by``, which are keys or follow from them).

    Only partitions the source has rows in are read and rewritten.
    """
    if not _has_rows(spark, path):
        first = latest_per_key(source, keys, order) if order else source
        overwrite_partitions(first, path, by)
        return
    stored = spark.read.parquet(path)
    types = dict(source.dtypes)
    stored = stored.withColumns({c: F.col(c).cast(types[c]) for c in by})  # folder names come back untyped
    # folders are as many as the calendar has parts; their values as literals prune the stored table's files
    touched = source.select(*by).distinct().collect()
    here = F.lit(False)
    for t in touched:
        one = F.lit(True)
        for c in by:
            one = one & F.col(c).eqNullSafe(F.lit(t[c]))
        here = here | one
    merged = upsert(stored.where(here), source, keys, rule, order)
    overwrite_partitions(cut_lineage(merged), path, by)


def _has_rows(spark: SparkSession, path: str) -> bool:
    """False only where nothing lies at ``path``; what lies there and cannot be read is an error."""
    try:
        stored = spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return False
        raise
    return len(stored.take(1)) > 0


def append_backtests(rows: DataFrame, path: str) -> None:
    """Append evaluation rows; the universe is normalised and the pass flag not yet set."""
    rows.withColumns(
        {"test_universe": codes.universe_code("test_universe"), "pass_standard": F.lit(None).cast("boolean")}
    ).write.mode("append").parquet(path)


def evaluation_document(backtest_time: Column) -> Column:
    """JSON text of one evaluation row joined with its factor's metadata."""
    metrics = F.struct("ic_value", "ic_ir", "sharpe_ratio", "max_drawdown", "turnover")
    doc = F.struct(
        "factor_id",
        F.coalesce("factor_name", "factor_id").alias("factor_name"),
        "factor_type",
        codes.universe_code("test_universe").alias("test_universe"),
        "trading_cycle",
        "source_url",
        "backtest_period",
        "horizon",
        metrics.alias("key_metrics"),
        F.lit(None).cast("boolean").alias("pass_standard"),
        backtest_time.cast("string").alias("backtest_time"),
    )
    return F.to_json(doc, {"ignoreNullFields": "false"})


def write_evaluation_documents(results: DataFrame, metadata: DataFrame, path: str, backtest_time: Column) -> None:
    """One JSON document per factor, in a folder per universe and factor."""
    meta = metadata.select("factor_id", "factor_name", "factor_type", "trading_cycle", "source_url")
    docs = results.join(meta, "factor_id", "left").select(
        evaluation_document(backtest_time).alias("value"),
        codes.file_tag(codes.universe_code("test_universe")).alias("universe"),
        F.col("factor_id"),
    )
    overwrite_partitions(docs, path, ["universe", "factor_id"], "text")


def write_snapshot(pairs: DataFrame, path: str, universe: str, as_of_date) -> None:
    """Correlation pairs of one universe and date, and the universe's pointer to its newest snapshot.

    The pointer is a partition of its own beside the snapshots. It is written last and never moves back, so a reader
    finds a whole snapshot whenever it looks, and a date may be written again.
    """
    spark = pairs.sparkSession
    rows = pairs.withColumns({"universe": F.lit(universe), "as_of_date": F.lit(as_of_date).cast("date")})
    overwrite_partitions(rows, path, ["universe", "as_of_date"])
    mine = spark.range(1).select(F.lit(universe).alias("universe"), F.lit(as_of_date).cast("date").alias("as_of_date"))
    pointers = _pointers(path)
    if _has_rows(spark, pointers):
        before = spark.read.schema("as_of_date date, universe string").parquet(pointers).where(F.col("universe") == universe)
        mine = cut_lineage(mine.unionByName(before).groupBy("universe").agg(F.max("as_of_date").alias("as_of_date")))
    overwrite_partitions(mine, pointers, ["universe"])


def _pointers(path: str) -> str:
    return f"{path.rstrip('/')}_latest"


def read_snapshots(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_latest_snapshot(spark: SparkSession, path: str, universe: str) -> DataFrame:
    """Rows of the snapshot the pointer of a universe names; other snapshots are not opened."""
    pointer = spark.read.schema("as_of_date date, universe string").parquet(_pointers(path)).where(F.col("universe") == universe)
    day = pointer.first()  # one row
    snapshots = read_snapshots(spark, path)
    if day is None:
        return snapshots.limit(0)
    return snapshots.where((F.col("universe") == universe) & (F.col("as_of_date") == F.lit(day["as_of_date"])))


def latest_snapshot(snapshots: DataFrame, universe: str) -> DataFrame:
    """Rows of a universe's newest snapshot."""
    mine = snapshots.where(F.col("universe") == universe)
    return mine.join(mine.agg(F.max("as_of_date").alias("as_of_date")), "as_of_date", "left_semi")


def expired_snapshots(spark: SparkSession, path: str, run_date, keep_days: int) -> DataFrame:
    """Folders (universe, as_of_date, folder) of snapshots older than ``keep_days``, never a universe's latest.

    The partitions are read from file names; no row of a snapshot is.
    """
    folder = F.regexp_extract(F.col("_metadata.file_path"), "^(.*)/[^/]*$", 1)
    every = read_snapshots(spark, path).select("universe", "as_of_date", folder.alias("folder")).distinct()
    newest = F.max("as_of_date").over(Window.partitionBy("universe"))  # a row per snapshot
    old = F.col("as_of_date") < F.date_sub(F.lit(run_date).cast("date"), keep_days)
    return every.withColumn("newest", newest).where(old & (F.col("as_of_date") < F.col("newest"))).drop("newest")


def drop_snapshots(spark: SparkSession, path: str, run_date, keep_days: int) -> int:
    """Delete the folders of expired snapshots and leave all others as they are; a second run finds none. Returns how many."""
    folders = [r["folder"] for r in expired_snapshots(spark, path, run_date, keep_days).collect()]
    hadoop, conf = spark._jvm.org.apache.hadoop.fs.Path, spark._jsc.hadoopConfiguration()
    for f in folders:
        at = hadoop(spark._jvm.java.net.URI(f))
        at.getFileSystem(conf).delete(at, True)
    return len(folders)


def write_documents(factors: DataFrame, path: str, title: str = "因子说明文档") -> None:
    """Labelled text documents, which ``read_documents`` finds again, one folder per factor."""
    docs = factors.select(render_document(title).alias("value"), "factor_id")
    overwrite_partitions(docs, path, ["factor_id"], "text")


#: Bytes of text in a file of a document table.
FILE_BYTES = 128 << 20


def write_document_table(docs: DataFrame, path: str) -> None:
    """Whole documents (doc_path, text) in few files: as many as their bytes ask for, however many documents there are.

    They are sorted by path within and over the files, so the files' statistics are an index: a reader that asks for some
    paths opens only the parts that can hold them.
    """
    docs = stored(docs.select("doc_path", "text"))
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    ranged = docs.repartitionByRange(max(1, -(-total // FILE_BYTES)), "doc_path").sortWithinPartitions("doc_path")
    ranged.write.mode("overwrite").option("parquet.block.size", 8 << 20).parquet(path)


def preview(df: DataFrame, keys: Sequence[str], rows: int = 5) -> DataFrame:
    """The first rows in key order."""
    return df.orderBy(*keys).limit(rows)
