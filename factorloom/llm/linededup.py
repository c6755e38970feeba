"""Line dedup: repeated runs of lines, found by prefix doubling over line ids, lose their later copies.

A document is its sequence of line ids; lines without a word are no part of it. Level 0 ranks the suffixes
of all sequences by their first line, level k + 1 by the pairs (rank of the first 2^k lines, rank of the
next 2^k), each rank being a place in sorted order. Suffixes of one rank at level k are an interval of the
suffix array whose common prefix is 2^k lines or longer. A suffix that is alone in its interval is dropped:
no longer run that starts there repeats. A run of m lines belongs to the interval that is named by the
level-k ranks at its start and 2^k before its end, with 2^k <= m < 2^(k + 1).

A run counts if it has ``min_words`` words. The shortest such run from each line on, and up to each line,
together cover every longer one, so their intervals reveal the maximal repeated runs, and no level is needed
beyond the one where 2^k reaches ``min_words`` lines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.lineage import cut_lineage
from .base import let, small_side, words

#: Documents with deletions up to which their line numbers are broadcast (a few hundred bytes each at most
#: times ``MARKS`` lines in all); beyond either the documents are shuffled.
BROADCAST_DOCS, BROADCAST_LINES = 500_000, 8_000_000


def _filled(text: Column) -> Column:
    return F.filter(F.split(text, "\n", -1), lambda x: x.rlike(r"[^ \x09-\x0D]"))


def _sequences(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """A row per line with a word: id, th (the text's hash), i (its number in the sequence), a, b (its id), n (words)."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    line = lambda x: F.struct(
        F.xxhash64(x).alias("a"), F.xxhash64(F.lit("line"), x).alias("b"), F.size(words(x)).cast("long").alias("n")
    )
    lines = F.transform(_filled(text), line)
    return docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("th"), F.posexplode(lines).alias("i", "x")).select(
        "id", "th", "i", "x.a", "x.b", "x.n"
    )


def _ranked(rows: DataFrame, *keys: str) -> DataFrame:
    """The values of ``keys`` that two or more rows have, with their rank in sorted order (with gaps)."""
    repeated = rows.groupBy(*keys).agg(F.count("*").alias("copies")).where("copies > 1").select(*keys)
    return cut_lineage(repeated.orderBy(*keys).withColumn("rank", F.monotonically_increasing_id()))


def _runs(active: DataFrame, min_words: int) -> DataFrame:
    """The shortest runs of ``min_words`` words from each line on and up to each line: id, th, s (start), m (lines)."""
    by_line = Window.partitionBy("id", "th").orderBy("i")
    counted = active.withColumn("upto", F.sum("n").over(by_line.rowsBetween(Window.unboundedPreceding, 0)))
    counted = counted.withColumn("before", F.col("upto") - F.col("n"))
    forward = Window.partitionBy("id", "th").orderBy("before").rangeBetween(0, min_words - 1)
    backward = Window.partitionBy("id", "th").orderBy("upto").rangeBetween(1 - min_words, 0)
    sized = counted.select(
        "id", "th", "i", F.count("*").over(forward).alias("fm"), F.sum("n").over(forward).alias("fw"),
        F.count("*").over(backward).alias("bm"), F.sum("n").over(backward).alias("bw"),
    )
    runs = F.array_compact(
        F.array(
            F.when(F.col("fw") >= min_words, F.struct(F.col("i").alias("s"), F.col("fm").alias("m"))),
            F.when(F.col("bw") >= min_words, F.struct((F.col("i") - F.col("bm") + 1).alias("s"), F.col("bm").alias("m"))),
        )
    )
    return sized.select("id", "th", F.explode(F.array_distinct(runs)).alias("r")).select(
        "id", "th", F.col("r.s").cast("int").alias("s"), F.col("r.m").cast("int").alias("m")
    )


def repeats(docs: DataFrame, min_words: int = 50, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Lines to delete: id, th and an array ``gone`` of line numbers among the lines with a word.

    A row per document, known by its id and the hash ``th`` of its text, that has any. Of equal runs the
    first by (id, NULL first; hash; place) stays. Runs may overlap, so of a stretch that repeats itself
    the beginning stays.
    """
    every = _sequences(docs, id_col, text_col)
    lines = _ranked(every, "a", "b")
    # rows stored twice are one document
    active = every.join(lines, ["a", "b"]).select("id", "th", "i", "n", F.col("rank").alias("r")).dropDuplicates(["id", "th", "i"])
    active = cut_lineage(active)
    runs = _runs(active, min_words)
    level, state = 0, active.select("id", "th", "i", "r")
    levels = state.withColumn("k", F.lit(0))
    ahead = Window.partitionBy("id", "th").orderBy("i")
    while 2 ** (level + 1) <= min_words:
        h = 2**level
        second = F.when(F.lead("i", h).over(ahead) == F.col("i") + h, F.lead("r", h).over(ahead))
        pairs = cut_lineage(state.withColumn("r2", second).where(F.col("r2").isNotNull()))
        names = _ranked(pairs, "r", "r2")
        state = cut_lineage(pairs.join(names, ["r", "r2"]).select("id", "th", "i", F.col("rank").alias("r")))
        if state.isEmpty():
            break
        level += 1
        levels = levels.unionByName(state.withColumn("k", F.lit(level)))
    k = F.floor(F.log2(F.col("m") + F.lit(0.5))).cast("int")
    runs = runs.withColumn("k", k).withColumn("e", F.col("s") + F.col("m") - F.expr("shiftleft(1, k)"))
    head, tail = levels.withColumnRenamed("r", "r1").withColumnRenamed("i", "s"), levels.withColumnRenamed("i", "e")
    for x, at in ((head, "s"), (tail, "e")):
        x = x.withColumnsRenamed({c: f"{c}_" for c in ("id", "th", "k", at)})
        runs = runs.join(x, runs["id"].eqNullSafe(x["id_"]) & (runs["th"] == x["th_"]) & (runs["k"] == x["k_"]) & (runs[at] == x[f"{at}_"]))
        runs = runs.drop("id_", "th_", "k_", f"{at}_")
    runs = cut_lineage(runs.select("id", "th", "s", "m", "r1", "r"))
    place = F.struct("id", "th", "s")
    first = runs.groupBy("m", "r1", "r").agg(F.count("*").alias("copies"), F.min(place).alias("first")).where("copies > 1")
    later = runs.join(first, ["m", "r1", "r"]).where(~place.eqNullSafe(F.col("first")))
    gone = later.select("id", "th", F.explode(F.sequence("s", F.col("s") + F.col("m") - 1)).alias("line"))
    return gone.groupBy("id", "th").agg(F.array_sort(F.collect_set("line")).alias("gone"))


def _kept(text: Column, gone: Column) -> Column:
    """The text without the lines that ``gone`` numbers among those with a word."""

    def cut(lines: Column) -> Column:
        filled = F.filter(
            F.transform(lines, lambda x, i: F.when(x.rlike(r"[^ \x09-\x0D]"), i)), lambda i: i.isNotNull()
        )
        at = let(filled, lambda f: F.transform(gone, lambda g: F.get(f, g)))
        # true at the numbers of deleted lines, up to the last of them
        flags = let(
            at,
            lambda a: F.flatten(
                F.transform(
                    a,
                    lambda x, i: F.concat(
                        F.array_repeat(F.lit(False), x - F.coalesce(F.get(a, i - 1), F.lit(-1)) - 1), F.array(F.lit(True))
                    ),
                )
            ),
        )
        return let(flags, lambda f: F.filter(lines, lambda x, i: ~F.coalesce(F.get(f, i), F.lit(False))))

    return F.array_join(let(F.split(text, "\n", -1), cut), "\n")


def dedup(docs: DataFrame, min_words: int = 50, id_col: str = "doc_id", text_col: str = "text", deleted_col: str = "n_deleted") -> DataFrame:
    """``docs`` with repeated line runs cut out of the text, and a count of the lines deleted.

    Lines without a word are never deleted; a NULL text stays NULL, a text none of whose lines goes stays as
    it is. Rows equal in id and text are one document: all are cut alike. ``deleted_col`` replaces a column
    of that name; other columns stay, whatever their names. An empty table gives no rows.
    """
    gone = cut_lineage(repeats(docs, min_words, id_col, text_col))
    n, lines = gone.agg(F.count("*"), F.coalesce(F.sum(F.size("gone")), F.lit(0))).first()
    side = small_side(gone, max(n, lines * BROADCAST_DOCS // BROADCAST_LINES), BROADCAST_DOCS)
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != deleted_col]).alias("row")
    keyed = docs.select(row, F.col(id_col).alias("key"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("hash"))
    met = keyed.join(side, keyed["key"].eqNullSafe(side["id"]) & (keyed["hash"] == side["th"]), "left")
    text, cut = F.col(f"row.`{text_col}`"), F.col("gone")
    columns = {text_col: F.when(cut.isNull(), text).otherwise(_kept(text, cut))}
    kept = [columns.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns if c != deleted_col]
    return met.select(*kept, F.coalesce(F.size(cut), F.lit(0)).cast("long").alias(deleted_col))
