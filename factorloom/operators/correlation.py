"""Pairwise correlation of factors, pooled over all (date, instrument) rows.

Factors are dealt to blocks and rows to chunks. A pair of blocks is a tile; a task reduces one chunk of a tile to
a Gram matrix of its factors, and a tile's matrices are summed. So nothing is as wide as all factors, a
task's matrices are of fixed size, and what is shuffled is the values, once for each block, and matrices.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .lineage import batches_by_rows, stored

#: Factors of a block on average; rows of a chunk; rows of a matrix product.
BLOCK, CHUNK_ROWS, SLICE = 128, 1_000_000, 4096
SUMS = ("n", "sx", "sy", "sxx", "syy", "sxy")
_PAIRS = "factor_a string, factor_b string, x0 double, y0 double, " + ", ".join(f"{s} double" for s in SUMS)


def _gram(factors: np.ndarray, cells: np.ndarray, x: np.ndarray, k: int, center: np.ndarray) -> np.ndarray:
    """SUMS, each k x k, of values x of factors (0..k-1) in cells, after ``center`` is subtracted."""
    order = np.argsort(cells, kind="stable")
    factors, cells, x = factors[order], cells[order], x[order] - center[factors[order]]
    cell = np.cumsum(np.append(False, cells[1:] != cells[:-1]))
    out, last = np.zeros((len(SUMS), k, k)), int(cell[-1]) + 1
    cuts = np.searchsorted(cell, np.arange(0, last + SLICE, SLICE))
    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
        rows = cell[a:b] - cell[a] if b > a else cell[a:b]
        wide, seen = np.zeros((SLICE + 1, k)), np.zeros((SLICE + 1, k))
        wide[rows, factors[a:b]], seen[rows, factors[a:b]] = x[a:b], 1.0
        sx, sxx = wide.T @ seen, (wide * wide).T @ seen
        out += np.stack([seen.T @ seen, sx, sx.T, sxx, sxx.T, wide.T @ wide])
    return out


def _moved(sums: np.ndarray, by: np.ndarray) -> np.ndarray:
    """The sums of values that are larger by ``by``, a shift for each factor."""
    n, sx, sy, sxx, syy, sxy = sums
    dx, dy = by[:, None], by[None, :]
    return np.stack([n, sx + dx * n, sy + dy * n, sxx + 2 * dx * sx + dx**2 * n, syy + 2 * dy * sy + dy**2 * n, sxy + dx * sy + dy * sx + dx * dy * n])


def gram(values: DataFrame, blocks: int, chunks: int) -> DataFrame:
    """SUMS of each pair factor_a < factor_b over the cells that hold both, of rows (factor_id, cell, x).

    They are of distances from x0 and y0, values near each factor's mean. A cell holds a factor once.
    """
    own = F.pmod(F.xxhash64("factor_id"), F.lit(blocks)).cast("int").alias("own")
    chunk = F.pmod(F.xxhash64(F.lit(1), "cell"), F.lit(chunks)).cast("int").alias("chunk")
    rows = values.select("factor_id", "cell", "x", own, chunk).withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    # one number for tile and chunk: rows are sorted by it as a number, not by comparing columns of which most are equal
    tile = F.least("own", "other").cast("long") * blocks + F.greatest("own", "other")
    rows = rows.select("factor_id", "cell", "x", "own", (tile * chunks + F.col("chunk")).alias("part"))

    def reduce(key: tuple, table: pa.Table) -> pa.Table:
        names = table.column("factor_id").combine_chunks().dictionary_encode()
        ids, at = names.dictionary.to_pylist(), names.indices.to_numpy()
        x = table.column("x").to_numpy()
        center = np.bincount(at, x, len(ids)) / np.bincount(at, minlength=len(ids))
        sums = _gram(at, table.column("cell").to_numpy(), x, len(ids), center)
        owner = np.zeros(len(ids), np.int32)
        owner[at] = table.column("own").to_numpy()
        found = [*divmod(key[0].as_py() // chunks, blocks), ids, owner.tolist(), center.tolist(), sums.tobytes()]
        return pa.table([pa.array([x], kind) for x, kind in zip(found, kinds)], names=names_)

    names_, kinds = ["a", "b", "ids", "own", "center", "sums"], [pa.int32(), pa.int32(), pa.list_(pa.string()), pa.list_(pa.int32()), pa.list_(pa.float64()), pa.binary()]
    partial = rows.groupBy("part").applyInArrow(reduce, "a int, b int, ids array<string>, own array<int>, center array<double>, sums binary")
    with batches_by_rows(values.sparkSession):
        partial = stored(partial)

    def add(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place: dict[str, int] = {}
        total, center, own = np.zeros((len(SUMS), 0, 0)), np.zeros(0), np.zeros(0, np.int32)
        for batch in batches:
            for i in range(batch.num_rows):
                ids, mine = batch.column("ids")[i].as_py(), np.array(batch.column("center")[i].as_py())
                new = [f for f in ids if f not in place]
                place.update({f: len(place) + j for j, f in enumerate(new)})
                grow = len(place) - len(center)
                total = np.pad(total, ((0, 0), (0, grow), (0, grow)))
                at = np.array([place[f] for f in ids])
                center, own = np.pad(center, (0, grow)), np.pad(own, (0, grow))
                fresh = [j for j, f in enumerate(ids) if f in set(new)]
                center[at[fresh]], own[at] = mine[fresh], batch.column("own")[i].as_py()
                sums = np.frombuffer(batch.column("sums")[i].as_py()).reshape(len(SUMS), len(ids), len(ids))
                total[:, at[:, None], at[None, :]] += _moved(sums, mine - center[at])
        ids = np.array(list(place), object)
        order = np.argsort(ids)
        ids, own, center, total = ids[order], own[order], center[order], total[:, order[:, None], order[None, :]]
        a, b = np.triu_indices(len(ids), 1)
        if key[0].as_py() != key[1].as_py():  # pairs of one block are in its own tile
            apart = own[a] != own[b]
            a, b = a[apart], b[apart]
        columns = [pa.array(ids[a], pa.string()), pa.array(ids[b], pa.string()), pa.array(center[a]), pa.array(center[b])]
        yield pa.RecordBatch.from_arrays([*columns, *(pa.array(t[a, b]) for t in total)], names=["factor_a", "factor_b", "x0", "y0", *SUMS])

    return partial.groupBy("a", "b").applyInArrow(add, _PAIRS)


def _tiling(values: DataFrame) -> tuple[int, int]:
    """Blocks and chunks by the numbers of factors and rows: two numbers for the driver."""
    n, factors = values.agg(F.count(F.lit(1)), F.approx_count_distinct("factor_id", 0.02)).first()
    return max(1, -(-factors // BLOCK)), max(int(values.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-n // CHUNK_ROWS))


def overlap_days(values: DataFrame, tiling: tuple[int, int] | None = None) -> DataFrame:
    """Dates on which both factors of a pair have a value, not necessarily for the same instrument."""
    days = values.where(F.col("factor_value").isNotNull()).select("factor_id", F.xxhash64("trade_date").alias("cell"), F.lit(1.0).alias("x")).distinct()
    blocks, chunks = tiling or _tiling(values)
    return gram(days, blocks, chunks).select("factor_a", "factor_b", F.col("n").cast("long").alias("overlap_days"))


def correlation_pairs(values: DataFrame) -> DataFrame:
    """(factor_a < factor_b, corr, overlap_days, n) for all pairs; a constant side gives a NULL correlation.

    Rows (factor_id, trade_date, stock_code, factor_value) are unique by the first three. Dates and instruments are
    known by 64-bit hashes.
    """
    known = values.where(F.col("factor_value").isNotNull())
    blocks, chunks = _tiling(values)
    cells = known.select("factor_id", F.xxhash64("trade_date", "stock_code").alias("cell"), F.col("factor_value").cast("double").alias("x"))
    sums, n = gram(cells, blocks, chunks), F.col("n")
    vx, vy = [F.col(q) - F.try_divide(F.col(s) * F.col(s), n) for q, s in (("sxx", "sx"), ("syy", "sy"))]
    # a spread this far below the size of the values is rounding noise of a constant column
    noise = lambda m: n * F.col(m) * F.col(m) * F.lit(1e-24)
    real = (vx > noise("x0")) & (vy > noise("y0"))
    cov = F.col("sxy") - F.try_divide(F.col("sx") * F.col("sy"), n)
    known = real & (n > 1)
    corr = F.try_divide(cov, F.sqrt(F.when(known, vx)) * F.sqrt(F.when(known, vy)))
    # greatest and least skip NULLs, so the bounds stand inside the condition
    corr = F.when(known, F.greatest(F.least(corr, F.lit(1.0)), F.lit(-1.0)))
    pairs = sums.select("factor_a", "factor_b", corr.alias("corr"), n.cast("long").alias("n"))
    return overlap_days(values, (blocks, chunks)).join(pairs, ["factor_a", "factor_b"], "left").select(
        "factor_a", "factor_b", "corr", "overlap_days", F.coalesce("n", F.lit(0)).cast("long").alias("n")
    )


def passing_pairs(pairs: DataFrame, min_overlap_days: int) -> DataFrame:
    """Pairs with a correlation and enough common dates, in both directions."""
    kept = pairs.where(F.col("corr").isNotNull() & (F.col("overlap_days") >= min_overlap_days))
    a, b = F.col("factor_a"), F.col("factor_b")
    both = F.array(F.struct(a.alias("a"), b.alias("b")), F.struct(b.alias("a"), a.alias("b")))
    turned = kept.select(F.explode(both).alias("p"), "corr", "overlap_days")
    return turned.select(F.col("p.a").alias("factor_a"), F.col("p.b").alias("factor_b"), "corr", "overlap_days")


def pair_counts(pairs: DataFrame, min_overlap_days: int) -> DataFrame:
    """How many ordered pairs there are, have a correlation, and also have enough common dates."""
    known = F.col("corr").isNotNull()
    return pairs.agg(
        (2 * F.count(F.lit(1))).alias("total_pairs"),
        (2 * F.count_if(known)).alias("known_pairs"),
        (2 * F.count_if(known & (F.col("overlap_days") >= min_overlap_days))).alias("passing_pairs"),
    )


def nested_document(pairs: DataFrame, as_of_date, universe: str, window_days: int, generated_at) -> DataFrame:
    """One JSON document per snapshot: factor -> factor -> correlation, with header fields."""
    inner = pairs.groupBy("factor_a").agg(
        F.map_from_entries(F.sort_array(F.collect_list(F.struct("factor_b", "corr")))).alias("row")
    )
    nested = F.map_from_entries(F.sort_array(F.collect_list(F.struct("factor_a", "row_entries"))))
    inner = inner.select("factor_a", F.map_entries("row").alias("row_entries"))
    doc = inner.agg(F.transform_values(nested, lambda _, e: F.map_from_entries(e)).alias("corr"))
    day = F.date_format(F.lit(as_of_date).cast("date"), "yyyy-MM-dd")
    return doc.select(
        F.lit(universe).alias("universe"),
        day.cast("date").alias("as_of_date"),
        F.to_json(
            F.struct(
                day.alias("as_of_date"),
                F.lit(universe).alias("test_universe"),
                F.lit(f"{window_days}d").alias("window"),
                "corr",
                F.lit(generated_at).cast("string").alias("generated_at"),
            )
        ).alias("payload"),
    )


def nested_rows(pairs: DataFrame) -> DataFrame:
    """A row per factor: its correlations as a map, factor -> correlation. Bounded by the number of factors, not of pairs."""
    entries = F.sort_array(F.collect_list(F.struct("factor_b", "corr")))
    return pairs.groupBy(F.col("factor_a").alias("factor_id")).agg(F.map_from_entries(entries).alias("corr"))
