"""Importance resampling towards a target distribution, on hashed features found by an Aho-Corasick dictionary.

The distinct words of a slice of texts, each between two delimiters, are the patterns of an automaton; a
word's payload is its CRC and its length. One scan of the slice emits the payloads of all words in order. The
CRC of two adjacent words joined by a space follows from their payloads alone, so no feature's text is ever
put together or hashed again. A slice's dictionary ends with the slice: memory does not grow with the corpus.

Counts by bucket of all documents and of the target give each bucket a gain; a document's weight is the mean
gain of its features; seeded Gumbel noise turns the highest scores into a sample without replacement.
"""

from __future__ import annotations

import functools
import zlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.lineage import cut_lineage
from .shards import in_order
from .shingles import text_slices

BUCKETS = 10_000
#: Bytes of text under one dictionary; a longer text is handled alone.
SLICE = 2_000_000
#: A-Z lowered; of ASCII all but letters and digits to the delimiter.
_PLAIN = bytes(b if chr(b).isalnum() and b < 128 or b >= 128 else 32 for b in bytes(range(256)).lower())


def _columns(step: np.ndarray, by: np.ndarray) -> np.ndarray:
    """A 32 x 32 bit matrix (a word per column) times each of ``by``."""
    out = np.zeros(len(by), np.uint32)
    for i in range(32):
        out ^= np.where(by >> np.uint32(i) & np.uint32(1), step[i], np.uint32(0))
    return out


@functools.lru_cache(maxsize=1)
def _byte_table() -> np.ndarray:
    """What the low byte of a CRC register turns into, by the reversed polynomial of zlib's CRC-32."""
    c = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        c = np.where(c & np.uint32(1), np.uint32(0xEDB88320) ^ (c >> np.uint32(1)), c >> np.uint32(1))
    return c


@functools.lru_cache(maxsize=64)
def _doubled(k: int) -> np.ndarray:
    """The matrix that moves a CRC past 2^k bytes."""
    if k:
        return _columns(_doubled(k - 1), _doubled(k - 1))
    bits = np.uint32(1) << np.arange(32, dtype=np.uint32)
    return _byte_table()[bits & np.uint32(255)] ^ (bits >> np.uint32(8))


@functools.lru_cache(maxsize=4096)
def _past(length: int) -> np.ndarray:
    """Moves a CRC past ``length`` bytes: a table for each byte of the CRC, 4 x 256."""
    m = np.uint32(1) << np.arange(32, dtype=np.uint32)
    for k in range(length.bit_length()):
        if length >> k & 1:
            m = _columns(_doubled(k), m)
    out = np.zeros((4, 256), np.uint32)
    for p in range(4):
        for i in range(8):
            out[p, 1 << i : 2 << i] = out[p, : 1 << i] ^ m[8 * p + i]
    return out


def joined_crc(left: np.ndarray, right: np.ndarray, right_length: np.ndarray) -> np.ndarray:
    """CRC-32 of each left word, a space and the right word, from the words' CRCs."""
    inner = ~left
    left = ~(_byte_table()[(inner ^ np.uint32(32)) & np.uint32(255)] ^ (inner >> np.uint32(8)))
    lengths, which = np.unique(right_length, return_inverse=True)
    tables = np.stack([_past(int(n)) for n in lengths]) if len(lengths) else np.zeros((1, 4, 256), np.uint32)
    moved = np.zeros(len(left), np.uint32)
    for p in range(4):
        moved ^= tables[which, p, left >> np.uint32(8 * p) & np.uint32(255)]
    return moved ^ right


def dictionary(words: list[str]) -> tuple[ahocorasick.Automaton, np.ndarray, np.ndarray]:
    """An automaton of the words (a character per UTF-8 byte) between spaces, and the payloads by place: CRCs and lengths.

    The automaton's own values have 32 bits, so they are places in the payloads.
    """
    found = ahocorasick.Automaton(ahocorasick.STORE_INTS)
    for i, w in enumerate(words):
        found.add_word(f" {w} ", i)
    if words:
        found.make_automaton()
    crc = np.fromiter((zlib.crc32(w.encode("latin-1")) for w in words), np.uint32, len(words))
    return found, crc, np.fromiter(map(len, words), np.int64, len(words))


def slice_buckets(texts: list[bytes], buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all features, text by text (words, then pairs), and where each text's begin."""
    plain = (b" " + b"  ".join(texts) + b" ").translate(_PLAIN).decode("latin-1")
    words = list(set(plain.split(" ")) - {""})
    automaton, crc, length = dictionary(words)
    hits = np.array(list(automaton.iter(plain)) if words else [], np.int64).reshape(-1, 2)
    ends, crc, length = hits[:, 0], crc[hits[:, 1]], length[hits[:, 1]]
    bounds = np.cumsum([len(t) + 2 for t in texts])  # past each text's last delimiter
    text = np.searchsorted(bounds, ends, "right")
    beside = np.flatnonzero(text[1:] == text[:-1])
    pairs = joined_crc(crc[beside], crc[beside + 1], length[beside + 1])
    owner = np.concatenate((text, text[beside]))
    order = np.argsort(owner, kind="stable")
    out = (np.concatenate((crc, pairs)) % np.uint32(buckets)).astype("<u4")[order]
    return out, np.concatenate(([0], np.cumsum(np.bincount(owner, minlength=len(texts)))))


def features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", buckets: int = BUCKETS) -> DataFrame:
    """Columns key, n (words and pairs of words), buckets (binary, little-endian, 2 bytes each up to 65,536 buckets, else 4).

    Words are runs of ASCII letters and digits and of all other than ASCII, A-Z lowered. One row per row; a NULL or empty
    text has none. A text is scanned whole, however long. Only the two named columns are read.
    """
    kind = "<u2" if buckets <= 1 << 16 else "<u4"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, raw, at in text_slices(batch.column(1), SLICE):
                raw, cuts = raw.tobytes(), at.tolist()
                found, where = slice_buckets([raw[a:b] for a, b in zip(cuts, cuts[1:])], buckets)
                found = found.astype(kind)
                lists = pa.array([found[a:b].tobytes() for a, b in zip(where[:-1].tolist(), where[1:].tolist())], pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column(0)[rows], pa.array(np.diff(where)), lists], names=["key", "n", "buckets"])

    two = docs.select(F.col(id_col).alias("key"), F.col(text_col).cast("string").alias("text"))
    return two.mapInArrow(run, f"key {two.schema['key'].dataType.simpleString()}, n long, buckets binary")


def _numbers(column: pa.Array, buckets: int) -> np.ndarray:
    kind = "<u2" if buckets <= 1 << 16 else "<u4"
    return np.frombuffer(b"".join(column.to_pylist()), kind)


def counts(found: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """Columns bucket, n of :func:`features`' rows: each task counts all it reads and hands on a row per bucket at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            total += np.bincount(_numbers(batch.column(0), buckets), minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["bucket", "n"])

    return found.select("buckets").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(source: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """Columns bucket, gain: floor(1000 ln((t + 1)(S + buckets) / ((s + 1)(T + buckets)))) of counts s and t and their sums."""
    every = source.sparkSession.range(buckets).select(F.col("id").alias("bucket"))
    both = every.join(source.withColumnRenamed("n", "s"), "bucket", "left").join(target.withColumnRenamed("n", "t"), "bucket", "left")
    both = both.select("bucket", *[F.coalesce(c, F.lit(0)).cast("double").alias(c) for c in "st"])
    all_s, all_t = (side.agg(F.sum("n")).first()[0] or 0 for side in (source, target))
    ratio = (F.col("t") + 1) * F.lit(float(all_s + buckets)) / ((F.col("s") + 1) * F.lit(float(all_t + buckets)))
    return both.select("bucket", F.floor(1000 * F.ln(ratio)).cast("long").alias("gain"))


def weights(found: DataFrame, gain: np.ndarray, buckets: int = BUCKETS) -> DataFrame:
    """Columns key, n, weight: the floored mean gain of a row's features, 0 without any."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.column(1).to_numpy()
            upto = np.concatenate(([0], np.cumsum(gain[_numbers(batch.column(2), buckets)])))
            ends = np.cumsum(n)
            weight = np.where(n > 0, (upto[ends] - upto[ends - n]) // np.maximum(n, 1), 0)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(weight)], names=["key", "n", "weight"])

    return found.mapInArrow(run, f"key {found.schema['key'].dataType.simpleString()}, n long, weight long")


def gumbel(seed: int, key: Column) -> Column:
    """floor(-1000 ln(-ln u)) of a uniform u that seed and key determine; a NULL key counts as the empty string."""
    hashed = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256)
    u = (F.conv(F.substring(hashed, 1, 8), 16, 10).cast("double") + 0.5) / 4294967296.0
    return F.floor(-1000 * F.ln(-F.ln(u))).cast("long")


def resample(
    docs: DataFrame,
    target: DataFrame,
    percent: int = 25,
    min_words: int = 20,
    seed: int = 7,
    buckets: int = BUCKETS,
    id_col: str = "doc_id",
    text_col: str = "text",
    target_text_col: str = "text",
) -> DataFrame:
    """Columns ``id_col``, n_features, weight, score, rank: one row per row of ``docs``.

    Of the N rows with ``min_words`` words or more the floor(percent N / 100) of highest score are drawn and
    numbered from 1, ties to the smaller id (NULL last); rank is NULL for all others. A NULL or empty text has no features and
    weight 0. Rows that agree in id and text are scored alike and ranked one after the other. Empty tables
    give no rows, or gains from the other table alone. Other columns, whatever their names, are not read.
    """
    found = cut_lineage(features(docs, id_col, text_col, buckets))
    aimed = features(target.select(F.lit(0).alias("id"), F.col(target_text_col).alias("text")), "id", "text", buckets)
    gain = np.zeros(buckets, np.int64)
    for bucket, g in gains(cut_lineage(counts(found, buckets)), cut_lineage(counts(aimed, buckets)), buckets).collect():  # a row per bucket
        gain[bucket] = g
    scored = weights(found, gain, buckets).withColumn("score", F.col("weight") + gumbel(seed, F.col("key")))
    scored = cut_lineage(scored)
    enough = scored.where(F.col("n") >= 2 * min_words - 1)
    # the row's place parts rows that are alike, so that no range holds all copies of a row
    order = [F.desc("score"), F.asc_nulls_last("key"), F.col("place")]
    placed = in_order(enough.withColumn("place", F.monotonically_increasing_id()), *order)
    sizes = {r[0]: r[1] for r in placed.groupBy("part").agg(F.count("*")).collect()}  # a row per partition
    drawn, before, starts = percent * sum(sizes.values()) // 100, 0, []
    for part in sorted(sizes):
        starts.append((part, before))
        before += sizes[part]
    starts = docs.sparkSession.createDataFrame(starts, "part long, start long")
    rank = F.col("nth") + F.col("start") + 1
    ranked = placed.join(F.broadcast(starts), "part").withColumn("rank", F.when(rank <= drawn, rank))
    rest = scored.where(F.col("n") < 2 * min_words - 1).withColumn("rank", F.lit(None).cast("long"))
    names = ["key", "n", "weight", "score", "rank"]
    out = ranked.select(*names).unionByName(rest.select(*names))
    return out.withColumnsRenamed({"key": id_col, "n": "n_features"})
