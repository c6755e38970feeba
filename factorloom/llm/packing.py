"""Packing token ids into rows of one length by best-fit-decreasing with a segment tree over capacities.

A document longer than a row is cut into full rows, which need no packing, and a rest. Rests are dealt to
blocks by hash, each block is packed by itself, so a task holds one block, whatever the size of the table,
and the result does not depend on how the table is partitioned.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Tokens of the rests that a block holds, on average.
BLOCK_TOKENS = 2_000_000

COLUMNS = "block long, bin int, n_tokens int, ids binary, cu_seqlens array<int>, resets array<int>"


class Capacities:
    """How many bins have each free capacity, as a segment tree: the tightest bin that fits is found in log(length) steps."""

    def __init__(self, length: int):
        self.leaves = 1 << length.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.bins: list[list[int]] = [[] for _ in range(length + 1)]

    def add(self, capacity: int, number: int) -> None:
        self.bins[capacity].append(number)
        self._change(capacity, 1)

    def _change(self, capacity: int, by: int) -> None:
        at = capacity + self.leaves
        while at:
            self.count[at] += by
            at >>= 1

    def take(self, size: int) -> tuple[int, int] | None:
        """Remove and return a bin with the least capacity of at least ``size``: (capacity, number)."""
        at = size + self.leaves
        if not self.count[at]:
            while at > 1 and (at & 1 or not self.count[at + 1]):
                at >>= 1
            if at <= 1:
                return None
            at += 1
            while at < self.leaves:
                at = 2 * at if self.count[2 * at] else 2 * at + 1
        capacity = at - self.leaves
        self._change(capacity, -1)
        return capacity, self.bins[capacity].pop()


def best_fit(sizes: list[int], length: int) -> list[list[int]]:
    """Bins of places in ``sizes``, which are decreasing and from 1 to ``length``."""
    free, bins = Capacities(length), []
    for i, size in enumerate(sizes):
        found = free.take(size)
        if found is None:
            found = (length, len(bins))
            bins.append([])
        bins[found[1]].append(i)
        if found[0] > size:
            free.add(found[0] - size, found[1])
    return bins


def pack(
    tokens: DataFrame, length: int, width: int = 4, pad: int = 0, id_col: str = "doc_id", ids_col: str = "ids", block_tokens: int = BLOCK_TOKENS,
    size_col: str | None = None,
) -> DataFrame:
    """Rows of ``length`` ids from documents' ids (binary, ``width`` little-endian bytes each).

    Columns: block, bin (NULL both for a row cut whole out of a long document), n_tokens, ids (binary,
    padded with ``pad`` to the full length), cu_seqlens (segment bounds, from 0 to n_tokens), resets (where
    the position count returns to 0: each segment's start), doc_ids and doc_starts (each segment's document
    and its first token's place there). Every token is in one row: nothing is cut off. Documents with NULL or
    no ids are in no row. Rows of ``tokens`` that are equal are packed each; other columns are not read. ``size_col``
    names a column with the number of ids, if there is one, so that they are not read just to be counted.
    """
    kind = tokens.schema[id_col].dataType.simpleString()
    long = F.lit(length * width)
    docs = tokens.select(F.col(id_col).alias("key"), F.col(ids_col).alias("ids")).where(F.octet_length("ids") > 0)
    full = F.expr(f"cast(octet_length(ids) div {length * width} as int)")
    whole = docs.where(F.octet_length("ids") >= long).select("key", "ids", F.explode(F.sequence(F.lit(0), full - 1)).alias("part"))
    one = lambda x, t: F.array(x.cast(t))
    whole = whole.select(
        F.lit(None).cast("long").alias("block"), F.lit(None).cast("int").alias("bin"), F.lit(length).alias("n_tokens"),
        F.substring("ids", F.col("part") * length * width + 1, length * width).alias("ids"),
        F.array(F.lit(0), F.lit(length)).alias("cu_seqlens"), F.array(F.lit(0)).alias("resets"),
        one(F.col("key"), kind).alias("doc_ids"), one(F.col("part") * F.lit(length).cast("long"), "long").alias("doc_starts"),
    )
    rests = docs.where(F.octet_length("ids") % long > 0).select(
        "key", (full * F.lit(length).cast("long")).alias("start"), F.substring("ids", full * length * width + 1, length * width).alias("ids")
    )
    size = F.octet_length(ids_col) if size_col is None else F.col(size_col) * width
    n = int(tokens.agg(F.sum(size % long)).first()[0] or 0)
    blocks = max(1, -(-n // (block_tokens * width)))
    rests = rests.withColumn("block", F.pmod(F.xxhash64("key", "ids"), F.lit(blocks)))
    pad_bytes = pad.to_bytes(width, "little")

    def run(key: tuple, table: pa.Table) -> pa.Table:
        table = table.append_column("n", pc.binary_length(table.column("ids")))
        table = table.take(pc.sort_indices(table, sort_keys=[("n", "descending"), ("key", "ascending"), ("ids", "ascending"), ("start", "ascending")]))
        sizes = [x // width for x in table.column("n").to_pylist()]
        bins = best_fit(sizes, length)
        order = table.take(pa.array([i for b in bins for i in b], pa.int64()))
        ids, at, rows, cuts = order.column("ids").to_pylist(), 0, [], []
        for b in bins:
            used = np.concatenate(([0], np.cumsum([sizes[i] for i in b]))).astype(np.int32)
            rows.append(b"".join(ids[at : at + len(b)]) + pad_bytes * (length - int(used[-1])))
            cuts.append(used)
            at += len(b)
        per_row = pa.array(np.concatenate(([0], np.cumsum([len(b) for b in bins]))), pa.int32())
        listed = lambda c: pa.ListArray.from_arrays(per_row, order.column(c).combine_chunks())
        return pa.table(
            {
                "block": pa.array([key[0].as_py()] * len(bins), pa.int64()),
                "bin": pa.array(range(len(bins)), pa.int32()),
                "n_tokens": pa.array([int(c[-1]) for c in cuts], pa.int32()),
                "ids": pa.array(rows, pa.binary()),
                "cu_seqlens": pa.array(cuts, pa.list_(pa.int32())),
                "resets": pa.array([c[:-1] for c in cuts], pa.list_(pa.int32())),
                "doc_ids": listed("key"),
                "doc_starts": listed("start"),
            }
        )

    packed = rests.groupBy("block").applyInArrow(run, f"{COLUMNS}, doc_ids array<{kind}>, doc_starts array<bigint>")
    return packed.unionByName(whole)


def unpack(packed: DataFrame, width: int = 4) -> DataFrame:
    """Columns doc_id, ids: the documents' ids put together again, for documents with unique ids."""
    parts = packed.select("ids", F.posexplode("doc_ids").alias("i", "doc_id"), "cu_seqlens", "doc_starts")
    first, past = F.get("cu_seqlens", F.col("i")), F.get("cu_seqlens", F.col("i") + 1)
    parts = parts.select(
        "doc_id", F.struct(F.get("doc_starts", F.col("i")).alias("start"), F.substring("ids", first * width + 1, (past - first) * width).alias("ids")).alias("p")
    )
    back = parts.groupBy("doc_id").agg(F.array_sort(F.collect_list("p")).alias("p"))
    return back.select("doc_id", F.unhex(F.array_join(F.transform("p", lambda x: F.hex(x["ids"])), "")).alias("ids"))


def write_packed(packed: DataFrame, path: str) -> None:
    """Write the rows as Parquet; ``ids`` of one file laid end to end are its id matrix."""
    packed.write.mode("overwrite").parquet(path)
