"""Exact order statistics of groups of any size.

A date's cross-section has as many rows as there are instruments, which nothing bounds, so no group is ever
brought together. Rows are counted map-side by cell: a group's values that agree in their leading bits. A cell
of more than ``CELL`` rows and more than one value is cut again by further bits, until none is left; the bits end
at single values. Running sums over the cells give where each begins. What remains is to order the rows inside
a cell, and only of cells with more than one value: a cell of one value has its place already, however
many rows hold it.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from fractions import Fraction
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .lineage import stored

#: Rows of a cell, beyond which it is cut.
CELL = 500_000
#: Of the 53 significant bits of a double, how many are rounded away at each level of cells.
LEVELS = (50, 36, 18, 0)
#: Values beyond have one cell of their sign at the first levels, as rounding them would overflow.
HUGE = 1e290
KEYS = tuple(f"_cell{i}" for i in range(len(LEVELS)))


def join_keys(df: DataFrame, other: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Null-safe equi-join that keeps the left side's key columns only."""
    other = other.withColumnsRenamed({k: f"_right_{k}" for k in keys})
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).eqNullSafe(F.col(f"_right_{k}"))
    return df.join(other, cond, how).drop(*[f"_right_{k}" for k in keys])


def interpolate(n: Column, p: Fraction | float) -> tuple[Column, Column, Column]:
    """Lower and upper 0-based positions and the fraction between them, linear interpolation.

    Positions are computed in whole numbers, so that a position that is one stays one.
    """
    p = Fraction(p).limit_denominator(1_000_000)
    h = (n - 1) * F.lit(p.numerator)
    lo, rest = F.floor(h / p.denominator), h % p.denominator
    return lo, F.when(rest > 0, lo + 1).otherwise(lo), rest / p.denominator


def between(lo: Column, hi: Column, fraction: Column) -> Column:
    return lo + (hi - lo) * fraction


def leading_bits(x: Column, dropped: int) -> Column:
    """A double rounded to 53 - ``dropped`` significant bits, by adding and subtracting a multiple; never falls as x grows."""
    multiple = x * F.lit(float(2**dropped + 1))
    return F.when(F.abs(x) <= HUGE, multiple - (multiple - x)).otherwise(F.signum(x) * F.lit(1e300))


@dataclass(frozen=True)
class Cells:
    """Where a group's values lie. ``table``: by, keys (NULL below the level a cell was cut to), _n rows, _first and _last
    value, _start (rows of the group in lower cells), _rows of the group, a unique _id. ``cut``: the cells of each level that were cut."""

    value: str
    by: tuple[str, ...]
    table: DataFrame
    cut: tuple[DataFrame, ...]

    @property
    def keys(self) -> tuple[str, ...]:
        return KEYS[: len(self.cut) + 1]

    def met(self, df: DataFrame, cells: DataFrame, how: str = "inner") -> DataFrame:
        """``df`` with the columns of its rows' cells."""
        return join_keys(_keyed(df, self.value, self.by, self.cut), cells, [*self.by, *self.keys], how)


def _keyed(df: DataFrame, value: str, by: Sequence[str], cut: Sequence[DataFrame]) -> DataFrame:
    """``df`` with the keys of its rows' cells; all NULL where the value is."""
    x = F.col(value).cast("double")
    df = df.withColumn(KEYS[0], leading_bits(x, LEVELS[0]))
    for level, cells in enumerate(cut, 1):
        df = join_keys(df, cells.withColumn("_cut", F.lit(True)), [*by, *KEYS[:level]], "left")
        df = df.withColumn(KEYS[level], F.when(F.col("_cut"), leading_bits(x, LEVELS[level]))).drop("_cut")
    return df


def cells_of(df: DataFrame, value: str, by: Sequence[str], limit: int | None = None) -> Cells:
    """The cells of a stored table's values; read once, and once more for each level that cells are cut to."""
    by, limit, x = tuple(by), CELL if limit is None else limit, F.col(value).cast("double")

    def counted(keyed: DataFrame, keys: Sequence[str]) -> DataFrame:
        aggs = [F.count(F.lit(1)).alias("_n"), F.min(x).alias("_first"), F.max(x).alias("_last")]
        return stored(keyed.where(x.isNotNull()).groupBy(*by, *keys).agg(*aggs))

    large = (F.col("_n") > limit) & (F.col("_first") < F.col("_last"))
    cells, cut = counted(_keyed(df, value, by, ()), KEYS[:1]), []
    for level in range(1, len(LEVELS)):
        heavy = cells.where(large).select(*by, *KEYS[:level])
        if heavy.isEmpty():
            break
        cut.append(heavy)
        finer = counted(_keyed(df, value, by, cut).where(F.col(KEYS[level]).isNotNull()), KEYS[: level + 1])
        cells = stored(cells.where(~large).withColumn(KEYS[level], F.lit(None).cast("double")).unionByName(finer))
    # first over the leading key, then inside it, so that no task takes all cells of a group
    keys, start = KEYS[: len(cut) + 1], F.lit(0).cast("long")
    before = lambda w, n: F.coalesce(F.sum(n).over(w.rowsBetween(Window.unboundedPreceding, -1)), start)
    group = Window.partitionBy(*by)
    leading = (cells.groupBy(*by, KEYS[0]).agg(F.sum("_n").alias("_all")) if cut else cells.withColumn("_all", F.col("_n")))
    leading = leading.withColumns({"_start": before(group.orderBy(KEYS[0]), "_all"), "_rows": F.sum("_all").over(group)}).drop("_all")
    if cut:
        inside = Window.partitionBy(*by, KEYS[0]).orderBy(*[F.col(k).asc_nulls_first() for k in keys[1:]])
        leading = join_keys(cells.withColumn("_within", before(inside, "_n")), leading, [*by, KEYS[0]])
        leading = leading.withColumn("_start", F.col("_start") + F.col("_within")).drop("_within")
    return Cells(value, by, stored(leading.withColumn("_id", F.monotonically_increasing_id())), tuple(cut))


def with_average_rank(df: DataFrame, cells: Cells, out: str, ties: str) -> DataFrame:
    """``df`` with the average rank from 1 and the number of rows that share the value, both NULL where it is NULL.

    Only rows of cells with more than one value are ordered; all others stay spread as they came. Rows are dealt and
    sorted by the cell's number, and carry of their cell what they need.
    """
    x, alike = F.col(cells.value).cast("double"), F.col("_alike")
    one_value = F.when(F.col("_first") == F.col("_last"), F.col("_n"))
    table = cells.table.select(*cells.by, *cells.keys, "_id", "_start", one_value.alias("_alike"))
    spread = F.when(alike.isNotNull() | x.isNull(), F.spark_partition_id())
    placed = cells.met(df, table, "left").withColumn("_spread", spread)
    order = Window.partitionBy("_id", *cells.keys, "_spread").orderBy(x)
    # both frames grow with the rows; one of the ties alone would be copied row by row
    first, last = F.rank().over(order), F.count(x).over(order.rangeBetween(Window.unboundedPreceding, Window.currentRow))
    rank = F.when(alike.isNotNull(), (alike + 1) / 2).otherwise((first + last) / 2)
    columns = {out: F.when(x.isNotNull(), F.col("_start") + rank), ties: F.when(x.isNotNull(), F.coalesce(alike, last - first + 1))}
    return placed.withColumns(columns).drop("_spread", "_id", "_alike", "_start", *cells.keys)


def order_statistics(df: DataFrame, cells: Cells, positions: Callable[[Column], Sequence[Column]], out: str) -> DataFrame:
    """One row per group: by, _rows and an array of the values at 0-based ``positions(_rows)``.

    Only rows of the cells that hold such a position are read again, and ordered where they hold several values.
    """
    n = F.col("_rows")
    wanted = F.filter(F.array_distinct(F.array(*positions(n))), lambda p: (p >= F.col("_start")) & (p < F.col("_start") + F.col("_n")))
    held = cells.table.withColumn("_wanted", wanted).where(F.size("_wanted") > 0)
    single = F.col("_first") == F.col("_last")
    columns = [*cells.by, "_rows"]
    known = held.where(single).select(*columns, F.explode("_wanted").alias("_at"), F.col("_first").alias("_x"))
    x = F.col(cells.value).cast("double")
    # a row is moved and ordered as its cell's number and its value only
    rows = cells.met(df.where(x.isNotNull()).select(*cells.by, cells.value), held.where(~single).select(*cells.by, *cells.keys, "_id"))
    rows = rows.select("_id", x.alias("_x"))
    rows = rows.withColumn("_at", F.row_number().over(Window.partitionBy("_id").orderBy("_x")) - 1)
    ordered = rows.join(held.select(*columns, "_id", "_start", "_wanted"), "_id").withColumn("_at", F.col("_start") + F.col("_at"))
    ordered = ordered.where(F.array_contains("_wanted", F.col("_at"))).select(*columns, "_at", "_x")
    picks = [F.max(F.when(F.col("_at") == p, F.col("_x"))) for p in positions(n)]
    return known.unionByName(ordered).groupBy(*columns).agg(F.array(*picks).alias(out))


def group_quantiles(df: DataFrame, cells: Cells, probs: Sequence[Fraction | float], out: str = "q") -> DataFrame:
    """One row per group: its exact linear quantiles as an array."""
    ends = lambda n: [pos for p in probs for pos in interpolate(n, p)[:2]]
    found = order_statistics(df, cells, ends, "_v")
    v, n = F.col("_v"), F.col("_rows")
    q = [between(v[2 * i], v[2 * i + 1], interpolate(n, p)[2]) for i, p in enumerate(probs)]
    return found.select(*cells.by, F.array(*q).alias(out))


def ranked_statistics(ranked: DataFrame, cells: Cells, rank: str, ties: str, positions: Callable[[Column], Sequence[Column]], out: str) -> DataFrame:
    """``order_statistics`` from a stored table of rows with their ranks: a row's value fills the positions of its ties, so none is ordered."""
    groups = cells.table.select(*cells.by, "_rows").distinct()
    groups = groups.select("*", *[p.alias(f"_p{i}") for i, p in enumerate(positions(F.col("_rows")))])
    wanted = [F.col(c) for c in groups.columns if c.startswith("_p")]
    first = (F.col(rank) - (F.col(ties) + 1) / 2).cast("long")
    rows = ranked.select(*cells.by, F.col(cells.value).cast("double").alias("_x"), first.alias("_a"), (first + F.col(ties) - 1).alias("_b"))
    holds = lambda p: p.between(F.col("_a"), F.col("_b"))
    rows = join_keys(rows, groups, cells.by).where(reduce(Column.__or__, [holds(p) for p in wanted]))
    values = rows.groupBy(*cells.by, "_a", "_b").agg(F.max("_x").alias("_x"))  # a few per group from here on
    picks = [F.max(F.when(holds(p), F.col("_x"))) for p in wanted]
    return join_keys(values, groups, cells.by).groupBy(*cells.by, "_rows").agg(F.array(*picks).alias(out))


def bucket_edges(df: DataFrame, cells: Cells, n: int, ranks: tuple[str, str] | None = None) -> DataFrame:
    """One row per group: the quantile edges of ``n`` buckets as ``_gaps`` and ``_values``, and the outer buckets ``_top``, ``_low``.

    An edge that falls between two unlike rows is below a value exactly when the upper of the two is not above
    it: ``_gaps`` holds these. An edge on a value is below larger ones only, and equal ones are one: ``_values``.
    ``ranks``: the columns of ``df`` that hold rank and ties, if it has them. See ``in_outer`` for the last four columns.
    """
    ends = lambda rows: [pos for k in range(n + 1) for pos in interpolate(rows, Fraction(k, n))[:2]]
    found = order_statistics(df, cells, ends, "_v") if ranks is None else ranked_statistics(df, cells, *ranks, ends, "_v")
    v = F.col("_v")
    edges = F.array(*[F.struct(v[2 * k].alias("lo"), v[2 * k + 1].alias("hi")) for k in range(n + 1)])
    gaps = F.transform(F.filter(edges, lambda e: e["lo"] < e["hi"]), lambda e: e["hi"])
    values = F.array_distinct(F.transform(F.filter(edges, lambda e: e["lo"] == e["hi"]), lambda e: e["lo"]))
    found = found.select(*cells.by, gaps.alias("_gaps"), values.alias("_values"), v[0].alias("_least"), v[2 * n].alias("_most"))
    below = F.filter("_values", lambda e: e < F.col("_most"))
    several = F.size("_gaps") + F.size(below) > 1  # else all rows are in the first bucket, which is the last
    return found.select(
        *cells.by, "_gaps", "_values", bucket_of(F.col("_most")).alias("_top"), bucket_of(F.col("_least")).alias("_low"),
        F.when(several, F.array_max("_gaps")).alias("_top_gap"), F.when(several, F.array_max(below)).alias("_top_value"),
        F.array_min("_gaps").alias("_low_gap"), F.array_min(F.filter("_values", lambda e: e > F.col("_least"))).alias("_low_value"),
    )


EDGES = ("_gaps", "_values", "_top", "_low", "_top_gap", "_top_value", "_low_gap", "_low_value")


def in_outer(x: Column) -> tuple[Column, Column]:
    """Whether a value's bucket is its group's highest, and its lowest, without looking through all edges.

    In the highest no edge is between the value and the largest one; in the lowest at most the least value is below.
    """
    yes = F.lit(True)
    top = F.coalesce(x >= F.col("_top_gap"), yes) & F.coalesce(x > F.col("_top_value"), yes)
    low = F.coalesce(x < F.col("_low_gap"), yes) & F.coalesce(x <= F.col("_low_value"), yes)
    return F.when(x.isNotNull(), top), F.when(x.isNotNull(), low)


def bucket_of(x: Column) -> Column:
    """Bucket of a value by the columns ``_gaps`` and ``_values`` of its group."""
    below = F.size(F.filter("_gaps", lambda e: e <= x)) + F.size(F.filter("_values", lambda e: e < x))
    return F.when(x.isNotNull(), F.greatest(below - 1, F.lit(0)))
