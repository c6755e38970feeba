"""Mixing sources to target weights by balanced sampling with the cube method.

A source's rows are taken a whole number of times each and once more with an inclusion probability that is the
same for all of them. Flight: within a block of rows, three undecided rows at a time move along the null
space of the two constraints (words, documents) until one of them reaches 0 or 1, so both totals of the block
stay what they were and at most two rows of a block are left. What the blocks leave goes to new blocks, until
a source's rest fits one. Landing: that rest, and a few rows held back for it, is the small problem: of all
ways to round it the one is taken that misses the fewest words, then the fewest documents.
"""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.lineage import cut_lineage
from .base import words
from .shards import in_order

#: Weights that the sources get in turn, in the order of their names.
WEIGHTS = (5, 2, 1)
#: Rows of a block on average; rows held back for the landing; equal rows that one task writes out.
BLOCK, RESERVE, COPIES = 10_000, 14, 100_000
_NEAR = 1e-9


def _moved(x: list[float], u: tuple[float, float, float], at: list[int], chance: random.Random) -> None:
    """Rows ``at`` moved along ``u`` or against it, as chance has it, up to the first bound."""
    ahead = back = float("inf")
    for i, d in zip(at, u):
        if d > 0:
            ahead, back = min(ahead, (1 - x[i]) / d), min(back, x[i] / d)
        elif d < 0:
            ahead, back = min(ahead, x[i] / -d), min(back, (1 - x[i]) / -d)
    step = ahead if chance.random() * (ahead + back) < back else -back
    for i, d in zip(at, u):
        v = x[i] + step * d
        x[i] = 0.0 if v < _NEAR else 1.0 if v > 1 - _NEAR else v


def flight(size: list[int], x: list[float], chance: random.Random) -> None:
    """Move ``x`` in place until two rows at most are undecided; sums of x and of size times x stay."""
    held: list[int] = []
    for i in range(len(x)):
        if not 0 < x[i] < 1:
            continue
        held.append(i)
        while len(held) > 2 or len(held) == 2 and size[held[0]] == size[held[1]]:
            if len(held) == 2:
                u: tuple = (1.0, -1.0)
            else:
                a, b, c = (size[k] for k in held)
                u = (1.0, -1.0, 0.0) if a == b == c else (float(b - c), float(c - a), float(a - b))
            _moved(x, u, held, chance)
            held = [k for k in held if 0 < x[k] < 1]


def landing(size: list[int], x: list[float], open_: list[int]) -> None:
    """Round the rows ``open_`` of ``x`` in place, to the least miss of words, then of documents."""
    ways = (np.arange(1 << len(open_))[:, None] >> np.arange(len(open_)) & 1).astype(float)
    off = ways - np.array([x[i] for i in open_])
    miss = np.abs(off @ np.array([float(size[i]) for i in open_]))
    best = np.lexsort((np.abs(off.sum(1)), np.round(miss, 6)))[0]
    for i, v in zip(open_, ways[best]):
        x[i] = float(v)


def sources(sized: DataFrame, share: float = 1.5, most: float = 2.0, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """Columns source, source_size, target of rows (source, size).

    The sources share ``share`` times all sizes by weight; none gets more than ``most`` times its own size, what
    is above is shared again by weight among the others. Each round sends four sums to the driver.
    """
    summed = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    placed = in_order(summed, F.col("source").asc_nulls_last())
    parts = sorted((r[0], r[1]) for r in placed.groupBy("part").agg(F.count("*")).collect())  # a row per partition
    starts = [(p, sum(n for _, n in parts[:i])) for i, (p, _) in enumerate(parts)]
    starts = sized.sparkSession.createDataFrame(starts, "part long, start long")
    at = (F.col("nth") + F.col("start")) % len(weights)
    weight = F.get(F.array(*[F.lit(float(w)) for w in weights]), at.cast("int"))
    table = placed.join(F.broadcast(starts), "part").select("source", "source_size", weight.alias("w"), (most * F.col("source_size")).alias("most"))
    budget = share * (table.agg(F.sum("source_size")).first()[0] or 0)
    level, full = 0.0, -1
    while True:
        stopped = F.col("most") <= F.col("w") * level
        spent, n, left = table.agg(F.sum(F.when(stopped, F.col("most"))), F.count_if(stopped), F.sum(F.when(~stopped, F.col("w")))).first()
        if n == full or not left:
            break
        level, full = (budget - (spent or 0.0)) / left, n
    return table.select("source", "source_size", F.least(F.col("most"), F.col("w") * level).alias("target"))


def _flown(units: DataFrame, last: bool, seed: int, kind: str, block_rows: int) -> DataFrame:
    """The units with x after a flight in blocks; after the landing too where ``last``: then a source is one block."""
    names = ["source", "key", "size", "copies", "source_size", "target", "whole", "sure"]

    def run(key: tuple, table: pa.Table) -> pa.Table:
        order = np.lexsort((np.array(table.column("tie")), np.array(table.column("h"))))
        table = table.take(pa.array(order))
        size, x = table.column("size").to_pylist(), table.column("x").to_pylist()
        chance = random.Random(f"{seed}:{key[0].as_py()}:{key[1].as_py()}")
        kept: list[int] = []
        if last:  # sizes spread over the block, so that sums of them can fill any gap
            by_size = sorted((i for i in range(len(x)) if 0 < x[i] < 1), key=lambda i: (size[i], i))
            n = min(RESERVE, len(by_size))
            kept = sorted({by_size[(2 * k + 1) * len(by_size) // (2 * n)] for k in range(n)})
        held = {i: x[i] for i in kept}
        for i in kept:
            x[i] = 0.0
        flight(size, x, chance)
        for i, v in held.items():
            x[i] = v
        if last:
            landing(size, x, [i for i in range(len(x)) if 0 < x[i] < 1])
        return table.select(names).append_column("x", pa.array(x, pa.float64())).combine_chunks()

    h = F.xxhash64(F.lit(seed), "key", "size")
    blocks = F.greatest(F.lit(1).cast("long"), F.ceil(F.col("undecided") / block_rows))
    block = F.lit(0).cast("long") if last else F.pmod(F.xxhash64(F.lit(seed + 1), "key", "size"), blocks)
    counted = units.groupBy("source").agg(F.count("*").alias("undecided"))
    dealt = units if last else units.join(counted.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s")))
    dealt = dealt.select(*names, "x", h.alias("h"), F.xxhash64(F.lit(seed + 2), "key", "size").alias("tie"), block.alias("block"))
    return dealt.groupBy("source", "block").applyInArrow(run, f"source string, key {kind}, size long, copies long, source_size long, target double, whole long, sure long, x double")


def _undecided(x: Column) -> Column:
    return (x > 0) & (x < 1)


def mix(
    docs: DataFrame,
    share: float = 1.5,
    most: float = 2.0,
    seed: int = 0,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    block_rows: int = BLOCK,
) -> DataFrame:
    """Columns ``id_col``, size, source_size, target, taken: one row per row of ``docs``.

    Size is the number of words (a NULL text has none), target what the row's source is to give of ``share`` times
    all words, taken how many words of the row the mix takes: a whole multiple of its size, at most ``most``
    times rounded up. A source is taken evenly in words and in documents. NULL is a source of its own, last in order, and
    a NULL id is an id like others. Rows alike in source, id and size share their lot: some of them may be
    taken once more than the others. The same rows give the same result, however they are partitioned.
    An empty table gives no rows. Only the three named columns are read.
    """
    if block_rows < 8:
        raise ValueError("a flight leaves two rows of a block, so blocks need eight rows or more")
    sized = docs.select(
        F.col(source_col).cast("string").alias("source"), F.col(id_col).alias("key"), F.size(words(F.col(text_col))).cast("long").alias("size")
    )
    kind = sized.schema["key"].dataType.simpleString()
    sized = cut_lineage(sized.groupBy("source", "key", "size").agg(F.count("*").alias("copies")))
    targets = cut_lineage(sources(sized.select("source", (F.col("size") * F.col("copies")).alias("size")), share, most))
    aimed = targets.withColumnRenamed("source", "s")
    times = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    rows = sized.join(aimed, F.col("source").eqNullSafe(F.col("s"))).drop("s").withColumn("whole", F.floor(times).cast("long"))
    # of n equal rows floor(n p) are taken once more for sure; the rest of n p is one row's probability
    again = F.col("copies") * (times - F.col("whole"))
    rest = again - F.floor(again)
    rest = F.when(rest < _NEAR, 0.0).when(rest > 1 - _NEAR, 1.0).otherwise(rest)
    rows = cut_lineage(rows.withColumn("sure", F.floor(again).cast("long")).withColumn("x", rest))
    columns = ["source", "key", "size", "copies", "source_size", "target", "whole", "sure", "x"]
    units, decided = rows.where(_undecided(F.col("x"))), rows.where(~_undecided(F.col("x"))).select(*columns)
    while True:
        largest = units.groupBy("source").count().agg(F.max("count")).first()[0] or 0
        last = largest <= block_rows
        flown = cut_lineage(_flown(units, last, seed, kind, block_rows))
        decided = decided.unionByName(flown.where(~_undecided(F.col("x"))))
        if last:
            break
        units = flown.where(_undecided(F.col("x")))
    made = decided.withColumn("more", F.col("sure") + F.round("x").cast("long"))
    # equal rows are written out in runs that no task is too small for
    runs = F.expr(f"sequence(0L, (copies - 1) div {COPIES}L)")
    single = made.where("copies = 1").withColumn("nth", F.lit(0).cast("long"))
    many = made.where("copies > 1").withColumn("run", F.explode(runs)).repartition("source", "key", "size", "run")
    first = F.col("run") * COPIES
    many = many.withColumn("nth", F.explode(F.sequence(first, F.least(first + COPIES, F.col("copies")) - 1))).drop("run")
    out = single.unionByName(many)
    taken = F.col("size") * (F.col("whole") + F.when(F.col("nth") < F.col("more"), 1).otherwise(0))
    return out.select(F.col("key").alias(id_col), "size", "source_size", "target", taken.alias("taken"))
