"""Quality rules as a short-circuit cascade, ordered by rejection per cost as measured on a sample.

A rule looks at a text and its words. Which documents fall does not depend on the order, only the work does.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .base import let, total, words

SYMBOLS, SPACES = "#*$%&|<>", " \t\n\x0b\f\r"
WINDOW = 8


@dataclass(frozen=True)
class Rule:
    """``fails(text, words)`` is true, never NULL, where a document is to be rejected."""

    name: str
    fails: Callable[[Column, Column], Column]


def n_symbols(text: Column) -> Column:
    return (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long")


def word_chars(text: Column) -> Column:
    return F.length(F.translate(text, SPACES, "")).cast("long")


def filled_lines(text: Column) -> Column:
    return F.filter(F.split(text, "\n", -1), lambda x: x.rlike(r"[^ \x09-\x0D]"))


def n_dup_lines(text: Column) -> Column:
    return let(filled_lines(text), lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long"))


def _covered(windows: Column) -> Column:
    """Words inside the windows (hashes by position) that occur twice or more."""
    pairs = F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    again = let(
        pairs,
        lambda s: F.filter(
            s,
            lambda x, k: F.coalesce(F.get(s, k - 1)["h"] == x["h"], F.lit(False))
            | F.coalesce(F.get(s, k + 1)["h"] == x["h"], F.lit(False)),
        ),
    )
    starts = F.array_sort(F.transform(again, lambda x: x["i"]))
    reach = lambda p: F.transform(
        p, lambda x, k: F.least(F.lit(WINDOW), F.coalesce(F.get(p, k + 1) - x, F.lit(WINDOW))).cast("long")
    )
    return let(starts, lambda p: total(reach(p)))


def n_repeat_words(words_: Column) -> Column:
    """Words in windows of WINDOW words that the text holds twice or more, found by 64-bit hashes."""

    def of_hashes(h: Column) -> Column:
        window = lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(WINDOW)])
        every = F.transform(F.sequence(F.lit(0), F.size(h) - WINDOW), window)
        return F.when(F.size(h) < WINDOW + 1, F.lit(0).cast("long")).otherwise(
            let(every, lambda w: F.when(F.size(F.array_distinct(w)) == F.size(w), F.lit(0).cast("long")).otherwise(_covered(w)))
        )

    return let(F.transform(words_, lambda w: F.xxhash64(w)), of_hashes)


def shouted(words_: Column) -> Column:
    """Words with upper-case and no lower-case letters, of two letters or more."""
    return F.size(F.filter(words_, lambda w: (F.lower(w) != w) & (F.upper(w) == w) & (F.length(w) > 1))).cast("long")


def echoes(words_: Column) -> Column:
    """Words equal to the one before them."""
    return F.size(F.filter(words_, lambda w, i: F.coalesce(F.get(words_, i - 1) == w, F.lit(False)))).cast("long")


#: Rules that the first two features decide; a document that fails one fails whatever else holds.
BASE = (
    Rule("few_words", lambda t, w: F.size(w) < 20),
    Rule("repeats", lambda t, w: 100 * n_repeat_words(w) > 30 * F.size(w)),
)
RULES = BASE + (
    Rule("symbols", lambda t, w: 10 * n_symbols(t) > F.size(w)),
    Rule("shouting", lambda t, w: 2 * shouted(w) > F.size(w)),
    Rule("echoes", lambda t, w: 10 * echoes(w) > 3 * F.size(w)),
    Rule("word_length", lambda t, w: (word_chars(t) < 2 * F.size(w)) | (word_chars(t) > 15 * F.size(w))),
    Rule("dup_lines", lambda t, w: let(filled_lines(t), lambda x: 10 * (F.size(x) - F.size(F.array_distinct(x))) > 6 * F.size(x))),
)


def cascade(rules: Sequence[Rule], text: Column, words_: Column) -> Column:
    """Name of the first rule that fails, NULL if none; a later rule is not evaluated once one has failed."""
    verdict = None
    for r in rules:
        verdict = F.when(r.fails(text, words_), F.lit(r.name)) if verdict is None else verdict.when(r.fails(text, words_), F.lit(r.name))
    return F.lit(None).cast("string") if verdict is None else verdict


def order_rules(
    docs: DataFrame, rules: Sequence[Rule] = RULES, text_col: str = "text", sample_rows: int = 500, sample_chars: int = 20_000, runs: int = 3
) -> list[Rule]:
    """``rules`` by rejected rows per second, best first, measured on at most ``sample_rows`` rows of up to ``sample_chars`` characters.

    The sample decides only the order of evaluation, so it may be any rows: the first ones found, for which Spark reads
    as few partitions as hold them. Each rule is run once unmeasured, for its code to be compiled, then ``runs`` times over the
    sample alone; the least time counts, less what splitting the texts takes. An empty table leaves the order.
    """
    some = docs.select(F.coalesce(F.col(text_col), F.lit("")).alias("text")).where(F.length("text") <= sample_chars)
    some = some.limit(sample_rows).collect()  # sample_rows * sample_chars at most
    if not some:
        return list(rules)
    sample = docs.sparkSession.createDataFrame(some, "text string").coalesce(1)

    def timed(fails: Callable[[Column, Column], Column]) -> tuple[float, int]:
        judged = sample.agg(F.count_if(let(words(F.col("text")), lambda w: fails(F.col("text"), w))))
        least, rejected = float("inf"), judged.first()[0]
        for _ in range(runs):
            began = time.perf_counter()
            judged.first()
            least = min(least, time.perf_counter() - began)
        return least, rejected

    idle, worth = timed(lambda t, w: F.size(w) < 0)[0], {}
    for r in rules:
        took, rejected = timed(r.fails)
        worth[r.name] = rejected / max(took - idle, 0.001)
    return sorted(rules, key=lambda r: -worth[r.name])


def judge(docs: DataFrame, rules: Sequence[Rule] = RULES, text_col: str = "text", out_col: str = "rejected_by") -> DataFrame:
    """``docs`` with the name of a rule that rejects the row, NULL if it stays.

    A NULL text is judged as the empty one. Which of several failing rules is named depends on the order of
    ``rules``; whether one is does not. ``out_col`` replaces a column of that name.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.withColumn(out_col, let(text, lambda t: let(words(t), lambda w: cascade(rules, t, w))))


def keep_good(docs: DataFrame, rules: Sequence[Rule] = RULES, text_col: str = "text", sample_rows: int = 500) -> DataFrame:
    """The rows that no rule rejects, with their columns as they were."""
    text, best = F.coalesce(F.col(text_col), F.lit("")), order_rules(docs, rules, text_col, sample_rows)
    return docs.where(let(text, lambda t: let(words(t), lambda w: cascade(best, t, w))).isNull())


def features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", extra: Sequence[Rule] = RULES[len(BASE) :]) -> DataFrame:
    """One row per row: n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed and kept.

    ``kept`` is false where ``base_failed`` is, else where one of ``extra`` rejects. A NULL or empty text has
    no words and fails. Only the two named columns are read.
    """

    def of(t: Column) -> Column:
        return let(words(t), lambda w: let(n_repeat_words(w), lambda r: row(t, w, r)))

    def row(t: Column, w: Column, repeated: Column) -> Column:
        failed = (F.size(w) < 20) | (100 * repeated > 30 * F.size(w))
        return F.struct(
            F.size(w).cast("long").alias("n_words"),
            word_chars(t).alias("word_chars"),
            n_symbols(t).alias("n_symbols"),
            n_dup_lines(t).alias("n_dup_lines"),
            repeated.alias("n_repeat_words"),
            failed.alias("base_failed"),
            F.when(failed, F.lit(False)).otherwise(cascade(extra, t, w).isNull()).alias("kept"),
        )

    made = docs.select(F.col(id_col).alias("key"), let(F.coalesce(F.col(text_col), F.lit("")), of).alias("f"))
    return made.select(F.col("key").alias(id_col), "f.*")
