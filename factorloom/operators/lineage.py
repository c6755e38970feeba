"""Cutting lineage through the cluster's shared checkpoint folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the reliable checkpoint folder and read it back from there.

    Both users of the result then see the same rows even if executors are lost and tasks rerun. The
    folder comes from ``spark.checkpoint.dir``; only a local session without one gets a temporary folder.
    """
    _ensure_folder(df.sparkSession)
    with shuffles_dropped(df.sparkSession):
        return df.select("*").checkpoint()  # a plan of its own, made under the setting


def stored(df: DataFrame) -> DataFrame:
    """``df`` written once as a table of this run and read from there.

    As with :func:`cut_lineage` all users see the same rows; besides, later steps read only the columns they
    need, and the planner knows the table's size.
    """
    path = run_folder(df.sparkSession, "rows")
    with shuffles_dropped(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """What is written inside drops its shuffle files when it is done; else they lie on the disks until the driver's garbage is collected."""
    with _set(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true"):
        yield


@contextmanager
def batches_by_rows(spark: SparkSession) -> Iterator[None]:
    """What is written inside hands rows to Python in batches bounded by their number alone.

    With a bound in bytes Spark measures the batch after each row, which takes longer than handing the row over. Only for
    rows of a few plain columns, whose batches are small by their number already.
    """
    with _set(spark, "spark.sql.execution.arrow.maxBytesPerBatch", str(2**31 - 1)):
        yield


@contextmanager
def _set(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    before = spark.conf.get(key)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def run_folder(spark: SparkSession, name: str) -> str:
    """A new path in the checkpoint folder, for tables of one run."""
    _ensure_folder(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"


def _ensure_folder(spark: SparkSession) -> None:
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        shared = spark.conf.get("spark.checkpoint.dir", None)
        if shared is None:
            if not sc.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
            shared = tempfile.mkdtemp(prefix="factorloom-checkpoint-")
        sc.setCheckpointDir(shared)
