"""Sharding by proportional stratified interleaving.

Within each source the rows are shuffled by a seeded hash of their text and ranked; all rows are then
ordered by fractional rank, (2 * rank + 1) / (2 * rows of the source), and cut into shards whose counts
differ by one at most. Any stretch of that order, so any shard, has every source in proportion. Copies of a
text hash alike, so they stand together but for the cuts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.lineage import cut_lineage

_ROW = (1 << 33) - 1  # monotonically_increasing_id() holds the partition above 33 bits of row number


def in_order(df: DataFrame, *keys: str | Column) -> DataFrame:
    """``df`` sorted over all partitions, with ``part`` and ``nth``, its place within the partition.

    Ranges are cut through groups of equal leading keys, so no group has to fit one task. The result is
    written to the checkpoint folder: both columns stay what they are if a task is run again.
    """
    ranged = df.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("at", F.monotonically_increasing_id())
    placed = ranged.withColumn("part", F.shiftright("at", 33)).withColumn("nth", F.col("at").bitwiseAND(F.lit(_ROW)))
    return cut_lineage(placed.drop("at"))


def assign(
    docs: DataFrame,
    n_shards: int = 16,
    seed: int = 0,
    id_col: str = "doc_id",
    text_col: str = "text",
    stratum_col: str = "source",
) -> DataFrame:
    """Columns ``id_col``, size, text_crc32, law, shard, slot, grown_shard; one row per row of ``docs``.

    The law is ``rows``: shard counts differ by one at most. ``slot`` counts from 0 without gaps in each shard.
    NULL is a stratum of its own. A NULL text has size 1 and checksum 0, like the empty one. Rows that agree
    in id and text are alike: which of them takes which slot makes no difference. An empty table gives no rows. Other
    columns, whatever their names, are not read.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col).alias("key"),
        F.coalesce(F.concat(F.lit("="), F.col(stratum_col).cast("string")), F.lit("")).alias("stratum"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
        F.xxhash64(F.lit(seed), text).alias("shuffled"),
        F.xxhash64(F.lit(seed + 1), F.col(id_col)).alias("tie"),
    )
    ranked = in_order(rows, "stratum", "shuffled", "tie", "key", "text_crc32", "size")
    # a row per partition and stratum that meet: partitions plus strata at most
    blocks = ranked.groupBy("stratum", "part").agg(F.count("*").alias("n"), F.min("nth").alias("first"))
    whole = Window.partitionBy("stratum")
    before = F.sum("n").over(whole.orderBy("part").rowsBetween(Window.unboundedPreceding, 0)) - F.col("n")
    blocks = blocks.select("stratum", "part", (before - F.col("first")).alias("shift"), F.sum("n").over(whole).alias("of"))
    by_fraction = ranked.join(blocks, ["stratum", "part"]).select(
        "key", "size", "text_crc32", ((2 * (F.col("nth") + F.col("shift")) + 1) / (2 * F.col("of"))).alias("fraction"), "stratum", "shuffled", "tie"
    )
    placed = in_order(by_fraction, "fraction", "stratum", "shuffled", "tie", "key", "text_crc32", "size")
    # one row per partition
    starts = placed.groupBy("part").agg(F.count("*").alias("n"))
    all_parts = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, 0)
    starts = starts.select("part", (F.sum("n").over(all_parts) - F.col("n")).alias("start"))
    n = placed.count()
    at = F.col("nth") + F.col("start")
    out = placed.join(F.broadcast(starts), "part").withColumn("at", at).withColumn("shard", F.expr(f"at * {n_shards} div {max(n, 1)}"))
    return out.select(
        F.col("key").alias(id_col),
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        F.col("shard").cast("int").alias("shard"),
        (F.col("at") - F.expr(f"(shard * {n} + {n_shards - 1}) div {n_shards}")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def write_shards(docs: DataFrame, shards: DataFrame, path: str, id_col: str = "doc_id", files_per_shard: int = 1) -> None:
    """Write the documents, with unique ids, under ``path/shard=N`` in slot order within each file."""
    placed = docs.join(shards.select(id_col, "shard", "slot"), id_col)
    part = F.pmod(F.col("slot"), F.lit(files_per_shard))
    (placed.repartition("shard", part).sortWithinPartitions("shard", "slot").write.mode("overwrite").partitionBy("shard").parquet(path))
