"""Phrase collocations from weighted acyclic automata.

Phrases are counted length by length. A task counts the n-grams of its texts, sorts them and builds of each
prefix range a count transducer: a minimal acyclic automaton whose arcs read words and carry the n-gram's
count on the last one. The transducers of a range are united, counts of equal n-grams summed, in one task a
range. Only n-grams whose two shorter n-grams are frequent can be; a filter of fixed size over the frequent
ones of the length before lets a task pass over nearly all others. Where it is full it lets through more and
the result stays the same.

The parts of a candidate are looked up by composition: the parts asked for are an automaton themselves, walked
together with the count transducer of their range.

A word of a language is a 64-bit symbol; the symbols' words come back from a table of the frequent ones.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.lineage import cut_lineage
from .shingles import _STEP, _bytes, _powers, mixed, text_slices

#: Bytes of text at a time; distinct n-grams, and words, a task holds before it hands them on.
SLICE, HELD, WORDS = 1_000_000, 1_000_000, 150_000
#: Words of the corpus for each prefix range, so that a range's n-grams fit a task at any size.
RANGE_WORDS = 2_500_000
#: Bits of the filter of frequent n-grams, and the parts it is merged in.
FILTER_BITS, FILTER_PARTS = 1 << 25, 64
#: Salts of a language's candidates, which are cut to the limit in each before they meet.
SALTS = 32

_CLASS = np.zeros(256, np.uint8)  # 1 white space inside a piece, 2 the end of a piece
_CLASS[[32, 9]] = 1
_CLASS[[ord(c) for c in ".,;:!?"] + [10, 11, 12, 13]] = 2


class Transducer:
    """Counts of sequences of one length, as a minimal acyclic automaton.

    ``alphabet`` holds the symbols, sorted; for each depth there are the arcs, sorted by state and symbol: ``arcs``
    (state * 2^32 + place of the symbol), ``to`` (state of the next depth) and ``weight`` (only arcs of the last
    depth count). States whose arcs agree in symbols, targets and weights are one.
    """

    def __init__(self, alphabet: np.ndarray, arcs: list[np.ndarray], to: list[np.ndarray], weight: np.ndarray):
        self.alphabet, self.arcs, self.to, self.weight = alphabet, arcs, to, weight

    @classmethod
    def of(cls, rows: np.ndarray, counts: np.ndarray) -> Transducer:
        """Of sorted distinct ``rows`` (one sequence each): those that share a prefix share its states."""
        alphabet, places = np.unique(rows, return_inverse=True)
        places = places.reshape(rows.shape).astype(np.int64)
        n, length = rows.shape
        new = np.zeros((n, length), bool)  # whether a row's symbol at a depth is an arc not seen in the row before
        new[0] = True
        new[1:] = np.logical_or.accumulate(rows[1:] != rows[:-1], axis=1)
        arcs, to, target, weight = [], [], None, None
        for d in range(length - 1, -1, -1):
            first = np.flatnonzero(new[:, d])
            labels = places[first, d]
            state = (np.cumsum(new[:, d - 1]) - 1)[first] if d else np.zeros(len(first), np.int64)
            if target is None:
                target, weight = np.zeros(len(first), np.int64), counts[first]
                own = weight
            else:
                own = np.zeros(len(first), np.int64)
            # the register: a state is known by its arcs, so equal ones are kept once
            begin = np.flatnonzero(np.r_[True, state[1:] != state[:-1]])
            word = mixed(mixed(mixed(labels.astype(np.uint64)) + target.astype(np.uint64)) + own.astype(np.uint64))
            known = np.add.reduceat(word, begin) + np.uint64(_STEP) * np.diff(np.r_[begin, len(first)]).astype(np.uint64)
            _, kept, number = np.unique(known, return_index=True, return_inverse=True)
            size = np.diff(np.r_[begin, len(first)])
            chosen = np.zeros(len(begin), bool)
            chosen[kept] = True
            keep = np.repeat(chosen, size)
            renamed = number[state[keep]]
            order = np.lexsort((labels[keep], renamed))
            arcs.append((renamed[order] << 32) | labels[keep][order])
            to.append(target[keep][order])
            if d == length - 1:
                weight = weight[keep][order]
            target = number
        return cls(alphabet, arcs[::-1], to[::-1], weight)

    def rows(self) -> tuple[np.ndarray, np.ndarray]:
        """The sequences, sorted, and their counts."""
        state, path = np.zeros(1, np.int64), np.zeros((1, 0), np.uint64)
        arc = np.zeros(0, np.int64)
        for arcs, to in zip(self.arcs, self.to):
            low, high = np.searchsorted(arcs, state << 32), np.searchsorted(arcs, (state + 1) << 32)
            n = high - low
            arc = np.repeat(low - np.r_[0, np.cumsum(n)[:-1]], n) + np.arange(n.sum())
            path = np.column_stack((np.repeat(path, n, axis=0), self.alphabet[arcs[arc] & 0xFFFFFFFF]))
            state = to[arc]
        return path, self.weight[arc]

    def composed(self, asked: Transducer) -> tuple[np.ndarray, np.ndarray]:
        """The sequences of ``asked`` that this one knows, and this one's counts: both are walked side by side."""
        here = np.searchsorted(self.alphabet, asked.alphabet)
        here = np.where(self.alphabet[np.minimum(here, len(self.alphabet) - 1)] == asked.alphabet, here, -1)
        mine, theirs, path = np.zeros(1, np.int64), np.zeros(1, np.int64), np.zeros((1, 0), np.uint64)
        at = np.zeros(0, np.int64)
        for arcs, to, other, other_to in zip(self.arcs, self.to, asked.arcs, asked.to):
            low, high = np.searchsorted(other, theirs << 32), np.searchsorted(other, (theirs + 1) << 32)
            n = high - low
            arc = np.repeat(low - np.r_[0, np.cumsum(n)[:-1]], n) + np.arange(n.sum())
            label = here[other[arc] & 0xFFFFFFFF]
            wanted = (np.repeat(mine, n) << 32) | np.maximum(label, 0)
            at = np.minimum(np.searchsorted(arcs, wanted), len(arcs) - 1)
            met = (label >= 0) & (arcs[at] == wanted)
            at = at[met]
            path = np.column_stack((np.repeat(path, n, axis=0), asked.alphabet[other[arc] & 0xFFFFFFFF]))[met]
            mine, theirs = to[at], other_to[arc][met]
        return path, self.weight[at]

    def dump(self) -> bytes:
        parts = [self.alphabet]
        for arcs, to in zip(self.arcs, self.to):  # arcs a state, symbol of each, target of each
            parts += [np.bincount(arcs >> 32).astype("<u4"), (arcs & 0xFFFFFFFF).astype("<u4"), to.astype("<u4")]
        parts.append(self.weight)
        head = np.array([len(parts), *map(len, parts)], "<i8").tobytes()
        # bytes of one rank lie together: most of the high ones are 0
        planes = (x.view(np.uint8).reshape(-1, x.itemsize).T.tobytes() for x in parts)
        return zlib.compress(head + b"".join(planes), 1)

    @classmethod
    def load(cls, data: bytes) -> Transducer:
        raw = zlib.decompress(data)
        n = int(np.frombuffer(raw, "<i8", 1)[0])
        at, out = 8 * (n + 1), []
        for i, size in enumerate(np.frombuffer(raw, "<i8", n, 8).tolist()):
            kind = np.dtype("<u8" if i == 0 else "<i8" if i == n - 1 else "<u4")
            planes = np.frombuffer(raw, np.uint8, size * kind.itemsize, at).reshape(kind.itemsize, size)
            out.append(np.ascontiguousarray(planes.T).view(kind).ravel())
            at += size * kind.itemsize
        arcs = [(np.repeat(np.arange(len(d)), d) << 32) | label.astype(np.int64) for d, label in zip(out[1:-1:3], out[2:-1:3])]
        return cls(out[0], arcs, [x.astype(np.int64) for x in out[3:-1:3]], out[-1])


def summed(rows: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct rows, sorted, and the sums of their counts."""
    order = np.lexsort(rows.T[::-1])
    rows, counts = rows[order], counts[order]
    new = np.flatnonzero(np.r_[True, (rows[1:] != rows[:-1]).any(1)]) if len(rows) else np.zeros(0, np.int64)
    return rows[new], np.add.reduceat(counts, new) if len(new) else counts


def union(parts: list[Transducer]) -> Transducer:
    """One transducer of all sequences of the parts, with summed counts."""
    rows, counts = zip(*(p.rows() for p in parts))
    return Transducer.of(*summed(np.concatenate(rows), np.concatenate(counts)))


def _chain(symbols: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    """A hash of the n symbols from each place."""
    h = np.full(len(at), n, np.uint64)
    for j in range(n):
        h = mixed(h * _STEP + symbols[at + j])
    return h


def ranges(rows: np.ndarray, n: int) -> np.ndarray:
    """The prefix range, of n, of each row: rows that agree in all but the last word, or in two words, share one."""
    prefix = max(min(2, rows.shape[1]), rows.shape[1] - 1)
    h = np.full(len(rows), prefix, np.uint64)
    for j in range(prefix):
        h = mixed(h * _STEP + rows[:, j])
    return (h % np.uint64(n)).astype(np.int64)


def _lang_hash(lang: str) -> int:
    return int.from_bytes(hashlib.blake2b(lang.encode(), digest_size=8).digest(), "little")


def _symbols(raw: np.ndarray, at: np.ndarray, langs: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of all words of a slice: symbol, number of its piece, row, first byte, past the last byte."""
    value, _ = _bytes()
    kind = _CLASS[raw]
    inside = np.r_[False, kind == 0, False]
    edge = inside[1:] != inside[:-1]
    starts, ends = np.flatnonzero(edge & inside[1:]), np.flatnonzero(edge & inside[:-1])
    cut = np.unique(at)
    both = cut[inside[cut] & inside[cut + 1]]  # rows that touch without white space between
    if len(both):
        starts, ends = np.sort(np.r_[starts, both]), np.sort(np.r_[ends, both])
    up, down = _powers(1 << max(20, int(len(raw)).bit_length()))
    sums = np.r_[np.uint64(0), np.cumsum(value[raw] * up[: len(raw)], dtype=np.uint64)]
    row = np.searchsorted(at, starts, "right") - 1
    symbol = mixed(mixed((sums[ends] - sums[starts]) * down[starts]) ^ langs[row])
    piece = np.cumsum(kind == 2)[starts] + row if len(starts) else row
    return symbol, piece, row, starts, ends


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[str], np.ndarray, tuple[np.ndarray, ...]]]:
    """Languages of a slice's rows, its bytes and its words."""
    known: dict[str, int] = {}
    for batch in batches:
        for rows, raw, at in text_slices(batch.column(1), SLICE):
            langs = batch.column(0)[rows].to_pylist()
            for x in set(langs) - known.keys():
                known[x] = _lang_hash(x)
            yield langs, raw, _symbols(raw, at, np.array([known[x] for x in langs], np.uint64))


def word_counts(docs: DataFrame) -> DataFrame:
    """Columns lang, word, f of rows (lang, text); word NULL has the sum of a language's words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, list] = {}
        total: dict[str, int] = {}

        def out(langs: list, words: list, f: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(words, pa.string()), pa.array(f, pa.int64())], names=["lang", "word", "f"])

        for langs, raw, (symbol, _, row, starts, ends) in _slices(batches):
            distinct, first, n = np.unique(symbol, return_index=True, return_counts=True)
            data = raw.tobytes()
            for s, r, a, b, c in zip(distinct.tolist(), row[first].tolist(), starts[first].tolist(), ends[first].tolist(), n.tolist()):
                if s in found:
                    found[s][2] += c
                else:
                    found[s] = [langs[r], data[a:b].lower().decode(), c]
            for x, c in zip(langs, np.bincount(row, minlength=len(langs)).tolist()):
                total[x] = total.get(x, 0) + c
            if len(found) >= WORDS:
                yield out(*map(list, zip(*found.values())))
                found.clear()
        if found:
            yield out(*map(list, zip(*found.values())))
        yield out(list(total), [None] * len(total), list(total.values()))

    return docs.mapInArrow(run, "lang string, word string, f long").groupBy("lang", "word").agg(F.sum("f").alias("f"))


def with_symbols(words: DataFrame) -> DataFrame:
    """Rows (lang, word, f) with the word's symbol."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, raw, at in text_slices(batch.column(1), SLICE):
                langs = np.array([_lang_hash(x) for x in batch.column(0)[rows].to_pylist()], np.uint64)
                symbol = pa.array(_symbols(raw, at, langs)[0].view(np.int64))
                yield pa.RecordBatch.from_arrays([*(batch.column(i)[rows] for i in range(3)), symbol], names=["lang", "word", "f", "symbol"])

    return words.select("lang", "word", "f").mapInArrow(run, "lang string, word string, f long, symbol long")


def shard_transducers(docs: DataFrame, length: int, frequent: object, n_ranges: int) -> DataFrame:
    """Columns range, fst: the n-grams of ``length`` words whose two shorter n-grams pass the filter (a broadcast)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(frequent.value, np.uint8)

        def passes(h: np.ndarray) -> np.ndarray:
            h = (h & np.uint64(FILTER_BITS - 1)).astype(np.int64)
            return (bits[h >> 3] >> (h & 7).astype(np.uint8) & 1).astype(bool)

        parts: list[tuple] = []
        held = 0

        def merged() -> tuple:
            h, r, c = (np.concatenate(x) for x in zip(*parts))
            h, first, which = np.unique(h, return_index=True, return_inverse=True)
            return h, r[first], np.bincount(which, c, len(h)).astype(np.int64)

        def out(r: np.ndarray, c: np.ndarray) -> pa.RecordBatch:
            of = ranges(r, n_ranges)
            order = np.lexsort((*r.T[::-1], of))
            r, c, of = r[order], c[order], of[order]
            cuts = np.r_[np.flatnonzero(np.r_[True, of[1:] != of[:-1]]), len(of)]
            fst = [Transducer.of(r[a:b], c[a:b]).dump() for a, b in zip(cuts[:-1], cuts[1:])]
            return pa.RecordBatch.from_arrays([pa.array(of[cuts[:-1]]), pa.array(fst, pa.binary())], names=["range", "fst"])

        for _, _, (symbol, piece, *_rest) in _slices(batches):
            n = len(symbol) - length + 1
            if n <= 0:
                continue
            at = np.flatnonzero(piece[:n] == piece[length - 1 :])
            shorter = passes(_chain(symbol, np.arange(n + 1), length - 1))
            at = at[shorter[at] & shorter[at + 1]]
            if not len(at):
                continue
            h, first, c = np.unique(_chain(symbol, at, length), return_index=True, return_counts=True)
            parts.append((h, np.column_stack([symbol[at[first] + j] for j in range(length)]), c))
            held += len(h)
            if held >= HELD:
                parts = [merged()]
                held = len(parts[0][0])
                if held >= HELD // 2:
                    yield out(*parts[0][1:])
                    parts, held = [], 0
        if parts:
            yield out(*merged()[1:])

    return docs.mapInArrow(run, "range long, fst binary")


def united(shards: DataFrame, least: int) -> DataFrame:
    """Columns range, fst: the union of a range's transducers, of sequences counted ``least`` times or more."""

    def run(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, counts, held = [], [], 0
        for batch in batches:
            for x in batch.column("fst"):
                r, c = Transducer.load(x.as_py()).rows()
                rows.append(r)
                counts.append(c)
                held += len(r)
                if held >= 2 * HELD:
                    r, c = summed(np.concatenate(rows), np.concatenate(counts))
                    rows, counts, held = [r], [c], 0
        r, c = summed(np.concatenate(rows), np.concatenate(counts))
        r, c = r[c >= least], c[c >= least]
        if len(r):
            yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int64()), pa.array([Transducer.of(r, c).dump()], pa.binary())], names=["range", "fst"])

    return shards.groupBy("range").applyInArrow(run, "range long, fst binary")


def sequences(transducers: DataFrame) -> DataFrame:
    """Columns phrase (array of symbols), f."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for x in batch.column(0):
                r, c = Transducer.load(x.as_py()).rows()
                cuts = pa.array(np.arange(len(r) + 1, dtype=np.int32) * r.shape[1])
                yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(cuts, pa.array(r.ravel().view(np.int64))), pa.array(c)], names=["phrase", "f"])

    return transducers.select("fst").mapInArrow(run, "phrase array<long>, f long")


def _unigrams(words: DataFrame, n_ranges: int) -> DataFrame:
    """Columns range, fst of rows symbol, f."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            r, c = summed(batch.column(0).to_numpy().view(np.uint64).reshape(-1, 1), batch.column(1).to_numpy())
            of = ranges(r, n_ranges)
            some = np.unique(of)
            fst = [Transducer.of(r[of == x], c[of == x]).dump() for x in some]
            yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(fst, pa.binary())], names=["range", "fst"])

    return united(words.select("symbol", "f").mapInArrow(run, "range long, fst binary"), 1)


def _filter(transducers: DataFrame) -> bytes:
    """FILTER_BITS bits: those of the hashes of all sequences."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        on = np.zeros(FILTER_BITS, bool)
        for batch in batches:
            for x in batch.column(0):
                r, _ = Transducer.load(x.as_py()).rows()
                on[(_chain(r.ravel(), np.arange(len(r)) * r.shape[1], r.shape[1]) & np.uint64(FILTER_BITS - 1)).astype(np.int64)] = True
        parts = np.packbits(on, bitorder="little").reshape(FILTER_PARTS, -1)
        some = [p for p in range(FILTER_PARTS) if parts[p].any()]
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array([zlib.compress(parts[p].tobytes(), 1) for p in some], pa.binary())], names=["part", "bits"])

    def add(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(FILTER_BITS // 8 // FILTER_PARTS, np.uint8)
        for batch in batches:
            for x in batch.column("bits"):
                total |= np.frombuffer(zlib.decompress(x.as_py()), np.uint8)
        yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int32()), pa.array([zlib.compress(total.tobytes(), 1)], pa.binary())], names=["part", "bits"])

    bits = transducers.select("fst").mapInArrow(run, "part int, bits binary").groupBy("part").applyInArrow(add, "part int, bits binary")
    found = {r[0]: zlib.decompress(r[1]) for r in bits.collect()}  # FILTER_BITS in all
    return b"".join(found.get(p, bytes(FILTER_BITS // 8 // FILTER_PARTS)) for p in range(FILTER_PARTS))


def _asked(parts: DataFrame, n_ranges: int) -> DataFrame:
    """The distinct ``phrase`` arrays with their length and range."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            phrases = batch.column(0)
            length = np.asarray(pa.compute.list_value_length(phrases), np.int64)
            flat = phrases.flatten().to_numpy().view(np.uint64)
            at = np.r_[0, np.cumsum(length)[:-1]]
            of = np.zeros(len(length), np.int64)
            for n in np.unique(length).tolist():
                some = np.flatnonzero(length == n)
                of[some] = ranges(np.column_stack([flat[at[some] + j] for j in range(n)]), n_ranges)
            yield pa.RecordBatch.from_arrays([phrases, pa.array(length), pa.array(of)], names=["phrase", "length", "range"])

    return parts.distinct().mapInArrow(run, "phrase array<long>, length long, range long")


def part_counts(parts: DataFrame, transducers: DataFrame, n_ranges: int) -> DataFrame:
    """Columns phrase, f of those of ``parts`` (phrase) that the transducers (length, range, fst) know."""

    def run(key: tuple, asked: pa.Table, known: pa.Table) -> pa.Table:
        rows, counts = np.zeros((0, 1), np.uint64), np.zeros(0, np.int64)
        if asked.num_rows and known.num_rows:
            n = key[0].as_py()
            flat = asked.column("phrase").combine_chunks().flatten().to_numpy().view(np.uint64).reshape(-1, n)
            query = Transducer.of(*summed(flat, np.ones(len(flat), np.int64)))
            rows, counts = Transducer.load(known.column("fst")[0].as_py()).composed(query)
        cuts = pa.array(np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1])
        return pa.table({"phrase": pa.ListArray.from_arrays(cuts, pa.array(rows.ravel().view(np.int64))), "f": pa.array(counts)})

    asked = _asked(parts, n_ranges).groupBy("length", "range")
    return asked.cogroup(transducers.groupBy("length", "range")).applyInArrow(run, "phrase array<long>, f long")


def _first(df: DataFrame, n: int, order: list[Column], *by: str) -> DataFrame:
    """The first n rows of each group; a group is cut in salted parts first."""
    salted = Window.partitionBy(*by, "salt").orderBy(*order)
    cut = df.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS))).withColumn("rank", F.row_number().over(salted)).where(F.col("rank") <= n)
    return cut.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("rank") <= n).drop("salt")


def collocations(
    docs: DataFrame,
    longest: int = 4,
    least: int = 30,
    covered_percent: int = 80,
    top: int = 2000,
    text_col: str = "text",
    lang_col: str = "lang",
    unknown: str = "und",
) -> DataFrame:
    """Columns lang, rank, phrase, a, l, r, n, score: each language's ``top`` phrases of 2 to ``longest`` words.

    Texts, A-Z lowered, are pieces between ``.,;:!?`` and line ends, pieces are words between spaces and tabs. a is how
    often a phrase occurs within pieces, overlaps included, ``least`` times or more. Its score is the lowest of
    floor(2000000 a / (l + r)) over its cuts into two parts, which occur l and r times; the first such cut counts.
    A phrase inside a longer candidate that occurs in ``covered_percent`` of its places or more is dropped.
    n is the number of words of the language. Order: score and a descending, then the phrase's bytes.

    A NULL text is empty, a NULL language is ``unknown``; texts of any length and repeated rows count whole. An empty
    table gives no rows. Only the two named columns are read.
    """
    spark = docs.sparkSession
    docs = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit(unknown)).alias("lang"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    counted = cut_lineage(word_counts(docs).where(F.col("word").isNull() | (F.col("f") >= least)))
    sums = counted.where(F.col("word").isNull()).select("lang", F.col("f").alias("n"))
    n_words = sums.agg(F.sum("n")).first()[0] or 0
    n_ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n_words // RANGE_WORDS))
    vocabulary = cut_lineage(with_symbols(counted.where(F.col("word").isNotNull())))
    level = cut_lineage(_unigrams(vocabulary, n_ranges))
    known, found = level.withColumn("length", F.lit(1).cast("long")), None
    for length in range(2, longest + 1):
        frequent = spark.sparkContext.broadcast(_filter(level))
        level = cut_lineage(united(shard_transducers(docs, length, frequent, n_ranges), least))
        frequent.unpersist()
        known = known.unionByName(level.withColumn("length", F.lit(length).cast("long")))
        found = sequences(level) if found is None else found.unionByName(sequences(level))
    found = cut_lineage(found.withColumnRenamed("f", "a"))

    size = F.size("phrase")
    k = F.explode(F.sequence(F.lit(1), size - 1)).alias("k")
    cuts = found.select("phrase", "a", k).select("phrase", "a", "k", F.slice("phrase", F.lit(1), F.col("k")).alias("first"), F.slice("phrase", F.col("k") + 1, size - F.col("k")).alias("rest"))
    parts = cut_lineage(part_counts(cuts.select(F.explode(F.array("first", "rest")).alias("phrase")), known, n_ranges))
    cuts = cuts.join(parts.select(F.col("phrase").alias("first"), F.col("f").alias("l")), "first").join(parts.select(F.col("phrase").alias("rest"), F.col("f").alias("r")), "rest")
    score = F.expr("cast(2000000 as decimal(7,0)) * cast(a as decimal(20,0)) div (cast(l as decimal(20,0)) + r)").cast("long")
    best = cuts.withColumn("score", score).groupBy("phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("x"))

    inner = F.flatten(F.transform(F.sequence(F.lit(2), size - 1), lambda m: F.transform(F.sequence(F.lit(1), size - m + 1), lambda i: F.slice("phrase", i, m))))
    covers = found.where(size > 2).select(F.explode(F.array_distinct(inner)).alias("phrase"), "a").groupBy("phrase").agg(F.max("a").alias("longer"))
    share = F.expr(f"cast(100 as decimal(3,0)) * cast(longer as decimal(20,0)) >= cast({covered_percent} as decimal(3,0)) * cast(a as decimal(20,0))")
    best = best.join(covers, "phrase", "left").where(F.col("longer").isNull() | ~share).select("phrase", "a", "x.*")

    spelled = best.select("*", F.posexplode("phrase").alias("at", "symbol")).join(vocabulary.select("symbol", "lang", "word"), "symbol")
    spelled = spelled.groupBy("phrase", "a", "l", "r", "score", "lang").agg(F.array_sort(F.collect_list(F.struct("at", "word"))).alias("w"))
    named = spelled.select("lang", F.array_join(F.col("w.word"), " ").alias("phrase"), "a", "l", "r", "score")
    ranked = _first(named, top, [F.desc("score"), F.desc("a"), F.asc("phrase")], "lang")
    return ranked.join(sums, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
