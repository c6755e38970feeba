"""Benchmark decontamination by spaced seeds.

A seed is the tokens under the 1s of a mask. The masks are such that every way to change ``CHANGED`` of
``SPAN`` tokens leaves some mask at some place untouched (a test tries all of them), so no overlap that the
definition allows is missed. Documents and benchmark meet in an equi-join on seed hashes; around each hit
the two token runs are then compared place by place.

All masks begin with two 1s. So a document's place is first looked up by its two tokens in a filter of the pairs
that begin a seed of the benchmark; only where that pair is known are seeds made and looked up.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.lineage import cut_lineage
from .base import let, small_side

SPAN, CHANGED = 20, 4
MASKS = ("1101111", "1111011", "1100010111")
#: Benchmark seeds up to which they are broadcast, about 400 bytes each; beyond they are shuffled.
BROADCAST_SEEDS = 200_000
#: Bits of a filter: 16 for each entry, within these. A fuller filter lets more through, and the join decides all the same.
FILTER_BITS = (2**12, 2**22)
#: Tokens from which an item shorter than SPAN may have so many changed, which the masks find; fixed by the masks.
SHORTER = ((17, 3), (13, 2), (9, 1))


def tokens(text: Column) -> Column:
    """Lower-case runs of letters and digits; a NULL text has none."""
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), "")


def needed(n: Column) -> Column:
    """How many places of a stretch must agree, for an item of n tokens."""
    need = F.when(n >= SPAN, F.lit(SPAN - CHANGED))
    for least, changed in SHORTER:
        need = need.when(n >= least, n - changed)
    return need.otherwise(n)


def _seed(h: Column, at: Column, m: int, mask: str) -> Column:
    return F.xxhash64(F.lit(m), *[F.get(h, at + k) for k, bit in enumerate(mask) if bit == "1"])


def _pair(h: Column, at: Column) -> Column:
    return F.shiftleft(F.get(h, at), 1).bitwiseXOR(F.get(h, at + 1))


def _starts(h: Column, mask: str) -> Column:
    """First places of ``mask`` in a sequence; none if it is shorter."""
    n = F.size(h) - len(mask)
    return F.when(n >= 0, F.sequence(F.lit(0), n)).otherwise(F.array().cast("array<int>"))


def _around(h: Column, at: Column, reach: int) -> Column:
    """Token hashes from ``reach`` before to ``reach - 1`` after ``at``, NULL beyond the ends."""
    return F.transform(F.sequence(F.lit(-reach), F.lit(reach - 1)), lambda k: F.get(h, at + k))


def _filter(hashes: DataFrame) -> tuple[Column, Callable[[Column, Column], Column]]:
    """A bitmap of a column of distinct hashes, as one literal, and the test whether a hash is in it."""
    n, bits = hashes.count(), FILTER_BITS[0]
    while bits < min(16 * n, FILTER_BITS[1]):
        bits *= 2
    slots, h = bits // 64, F.col(hashes.columns[0])
    slot, bit = F.shiftright(h, 6).bitwiseAND(F.lit(slots - 1)).cast("int"), h.bitwiseAND(F.lit(63)).cast("int")
    filled = hashes.select(slot.alias("slot"), bit.alias("bit")).groupBy("slot").agg(F.expr("bit_or(shiftleft(1L, bit))"))
    filled = {r[0]: r[1] for r in filled.collect()}  # FILTER_BITS at most
    table = F.split(F.lit(",".join(str(filled.get(i, 0)) for i in range(slots))), ",").cast("array<long>")  # folded to one literal

    def known(t: Column, h: Column) -> Column:
        word = F.get(t, F.shiftright(h, 6).bitwiseAND(F.lit(slots - 1)).cast("int"))
        return F.call_function("shiftright", word, h.bitwiseAND(F.lit(63)).cast("int")).bitwiseAND(F.lit(1)) == 1

    return table, known


def overlaps(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    masks: Sequence[str] = MASKS,
) -> DataFrame:
    """Columns id, item, matches, doc_start, item_start: one row per document and item that overlap.

    They overlap if some ``SPAN`` consecutive tokens of the item agree, place by place, with the document's in
    ``SPAN - CHANGED`` places or more; places beyond the document's ends do not agree. An item of fewer
    tokens must occur whole, with 3 changed of 17 or more, 2 of 13 or more, 1 of 9 or more, else none; one
    without tokens overlaps nothing, nor does a NULL text. The row tells the best such stretch: most matches,
    then first in the document, then in the item (a start below 0 lies before the document). Rows that share an
    id count as one document or item; NULL is an id like others. Texts are judged whole, however long; empty
    tables give no rows. Other columns, whatever their names, are not read.
    """
    hashed = lambda text: F.transform(tokens(text), lambda w: F.xxhash64(w))
    items = benchmark.select(F.col(item_col).alias("item"), hashed(F.col(item_text_col)).alias("h")).where(F.size("h") > 0)
    items = cut_lineage(items)
    least = SHORTER[-1][0]
    short = [r[0] for r in items.select(F.size("h").alias("n")).where(F.col("n") < least).distinct().collect()]  # < least values
    every = [*masks, *("1" * n for n in sorted(short))]
    seeds = None
    for m, mask in enumerate(every):
        own = items if m < len(masks) else items.where(F.size("h") == len(mask))
        one = own.select("item", "h", F.lit(m).alias("mask"), F.explode(_starts(F.col("h"), mask)).alias("at"))
        one = one.withColumn("seed", _seed(F.col("h"), F.col("at"), m, mask))
        seeds = one if seeds is None else seeds.unionByName(one)
    pair = F.when(F.size("h") > 1, _pair(F.col("h"), F.col("at")))
    around = _around(F.col("h"), F.col("at"), SPAN).alias("item_h")
    seeds = cut_lineage(seeds.select("item", "seed", pair.alias("pair"), F.col("at").alias("item_at"), F.size("h").alias("item_n"), around))
    n_seeds = seeds.count()
    seed_table, seed_known = _filter(seeds.select("seed").distinct())
    pair_table, pair_known = _filter(seeds.select("pair").where(F.col("pair").isNotNull()).distinct())
    seeds = seeds.drop("pair")

    def of_mask(t: Column, h: Column, starts: Column, m: int) -> Column:
        mask, n = every[m], F.size(h) - len(every[m])
        pair = lambda at: F.struct(at.alias("at"), F.when(at <= n, _seed(h, at, m, mask)).alias("seed"))
        at = starts if mask.startswith("11") else _starts(h, mask)
        return F.filter(F.transform(at, pair), lambda x: x["seed"].isNotNull() & seed_known(t, x["seed"]))

    def hits(t: Column, h: Column, starts: Column) -> Column:
        found = [of_mask(t, h, starts, m) for m in range(len(every))]
        full = lambda x: F.struct(x["at"].alias("at"), x["seed"].alias("seed"), _around(h, x["at"], SPAN).alias("doc_h"))
        return F.transform(F.concat(*found), full)

    def of_text(h: Column) -> Column:
        starts = let(pair_table, lambda t: F.filter(_starts(h, "11"), lambda at: pair_known(t, _pair(h, at))))
        return let(starts, lambda s: let(seed_table, lambda t: hits(t, h, s)))

    met = docs.select(F.col(id_col).alias("id"), F.explode(let(hashed(F.col(text_col)), of_text)).alias("x"))
    met = met.select("id", "x.seed", F.col("x.at").alias("doc_at"), "x.doc_h")
    met = met.join(small_side(seeds, n_seeds, BROADCAST_SEEDS), "seed")
    # stretches of the item that hold the hit's first place, by their start relative to it
    span = F.least(F.lit(SPAN), F.col("item_n"))
    need = needed(F.col("item_n"))
    low, high = F.greatest(1 - span, -F.col("item_at")), F.least(F.lit(0), F.col("item_n") - span - F.col("item_at"))
    agree = F.zip_with("doc_h", "item_h", lambda d, i: F.coalesce((d == i).cast("int"), F.lit(0)))
    matches = lambda e, o: F.aggregate(F.slice(e, o + SPAN + 1, span), F.lit(0), lambda a, x: a + x)
    best = let(
        agree,
        lambda e: F.array_max(
            F.transform(
                F.when(low <= high, F.sequence(low, high)),
                lambda o: F.struct(
                    matches(e, o).alias("matches"),
                    (-(F.col("doc_at") + o)).alias("doc"),
                    (-(F.col("item_at") + o)).alias("item"),
                ),
            )
        ),
    )
    sure = met.select("id", "item", need.alias("need"), best.alias("best")).where(F.col("best.matches") >= F.col("need"))
    out = sure.groupBy("id", "item").agg(F.max("best").alias("best"))
    return out.select(
        "id", "item", "best.matches", (-F.col("best.doc")).alias("doc_start"), (-F.col("best.item")).alias("item_start")
    )


def clean(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **names: str) -> DataFrame:
    """The rows of documents that overlap no benchmark item, with their columns.

    A document is its id and its text's hash, so rows that share an id, or have none, are judged each by its text;
    equal rows stay or go together. Rows of NULL and empty texts stay, and columns of any names with them.
    """
    th = F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))
    keyed = docs.select(F.struct(F.col(id_col).alias("id"), th.alias("th")).alias("doc"), F.col(text_col).alias("text"))
    leaked = overlaps(keyed, benchmark, "doc", "text", **names).select("id").distinct()
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.struct(F.col(id_col).alias("id"), th.alias("th")).alias("doc"))
    on = rows["doc"]["id"].eqNullSafe(leaked["id"]["id"]) & (rows["doc"]["th"] == leaked["id"]["th"])
    return rows.join(leaked, on, "left_anti").select("row.*")
