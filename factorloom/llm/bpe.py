"""Byte-level BPE: encoding with character offsets, decoding from the byte table.

The merges come from a rank file: a token's parts are what the lower ranks make of its bytes. The
``tokenizers`` library applies them to each match of the split pattern; a worker keeps the ids of short
matches it has seen, as words repeat far more often than new ones turn up. Matches of the pattern ``SPLIT``
are found for many texts at once by the classes of their characters, and each distinct one is looked up once.
"""

from __future__ import annotations

import base64
import functools
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows encoded at a time at most, and the characters after which no more are taken; the same of an output batch.
ROWS, CHARS = 4096, 4_000_000
BATCH_ROWS, BATCH_CHARS = 512, 1_000_000
#: Characters of a batch that are split at a time, so that arrays stay small.
SPLIT_CHARS = 250_000
#: Matches and characters of a text encoded at a time if the text is longer; it makes a batch of its own.
MATCHES, PART = 200_000, 1_000_000
#: Matches whose ids are held as lists at a time.
CACHED = 1024
#: The pattern whose matches are found by classes of characters; any other is left to the ``regex`` library.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
OTHER, LETTER, NUMBER, SPACE = range(4)


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def byte_characters() -> list[str]:
    """The printable character that stands for each byte: itself if it is printable, else one from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return [chr(dict(zip(shown + hidden, shown + list(range(256, 256 + len(hidden)))))[b]) for b in range(256)]


@functools.cache
def character_classes() -> np.ndarray:
    """The class of each code point, as the ``regex`` library has it."""
    import regex

    classes = np.full(0x110000, OTHER, np.uint8)
    characters = "".join(map(chr, itertools.chain(range(0xD800), range(0xE000, 0x110000))))
    for kind, pattern in ((LETTER, r"\p{L}"), (NUMBER, r"\p{N}"), (SPACE, r"\s")):
        classes[list(map(ord, regex.findall(pattern, characters)))] = kind
    return classes


def match_starts(points: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """Where the matches of ``SPLIT`` start in texts laid end to end: their code points, and the place where each begins.

    Matches leave nothing out, so each ends where the next one starts.
    """
    n, kind = len(points), character_classes()[points]
    opens = np.zeros(n + 2, bool)  # a text begins here, or all have ended
    opens[firsts] = opens[n:] = True
    change = opens[: n + 1].copy()
    change[1:n] |= kind[1:] != kind[:-1]
    starts = change[:n].copy()
    # white space that something follows leaves its last character, which joins what follows if it is a blank
    last = np.flatnonzero((kind == SPACE) & change[1:] & ~opens[1 : n + 1])
    starts[last] = True
    starts[last[points[last] == ord(" ")] + 1] = False
    # a contraction counts only where a match starts with its apostrophe; the letters after it are a match of their own
    at = np.flatnonzero(starts & (points == ord("'")))
    at = at[~opens[at + 1]]
    one, two = points[at + 1], np.where(opens[at + 2], 0, points[np.minimum(at + 2, n - 1)])
    pair = ((one == ord("r")) | (one == ord("v"))) & (two == ord("e")) | (one == ord("l")) & (two == ord("l"))
    hit = pair | np.isin(one, [ord(c) for c in "stmd"])
    starts[at[hit] + 1] = False
    past = (at + 2 + pair)[hit]
    starts[past[past < n]] = True
    return np.flatnonzero(starts)


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), "<u4")


class Codec:
    """Encoder and decoder of one rank file; ids are little-endian unsigned 32-bit integers."""

    def __init__(self, path: str, pattern: str):
        import regex
        import tiktoken

        ranks = read_ranks(path)
        self.char = byte_characters()
        shown = lambda token: "".join(map(self.char.__getitem__, token))
        core = tiktoken.Encoding("ranks", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={})._core_bpe
        self.merged = core.encode_single_piece  # the ids of one match
        self.pattern = regex.compile(pattern)
        self.matches = self.pattern.findall
        back = {c: b for b, c in enumerate(self.char)}  # the byte table reversed
        self.bytes = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.bytes[rank] = bytes(map(back.__getitem__, shown(token)))
        self.lengths = np.array([len(t) for t in self.bytes], np.int64)

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text."""
        return self.encode_column(pa.array(texts, pa.string())).to_pylist()

    def encode_column(self, texts: pa.Array) -> pa.Array:
        """The ids of each text of a column of strings without NULLs."""
        if len(texts) == 1 and len(text := texts[0].as_py()) > PART:
            return pa.array([self.encode_long(text)], pa.binary())
        if self.pattern.pattern == SPLIT:
            return self.encode_split(texts)
        return pa.array(self.joined([self.matches(t) for t in texts.to_pylist()]), pa.binary())

    def encode_long(self, text: str) -> bytes:
        """The ids of one text, some matches at a time."""
        if self.pattern.pattern != SPLIT:
            found = (m.group() for m in self.pattern.finditer(text))
            return b"".join(self.joined([list(p)])[0] for p in itertools.batched(found, MATCHES))
        out, at, size = [], 0, PART
        while at < len(text):
            part = text[at : at + size]
            if at + size < len(text):
                points = code_points(part)
                cuts = match_starts(points, np.zeros(1, np.int64))[1:-1]  # what follows may change the last two matches
                cuts = cuts[character_classes()[points[cuts - 1]] != SPACE]  # and white space before the cut
                if not len(cuts):
                    size *= 2
                    continue
                part = part[: cuts[-1]]
            out.append(self.encode_split(pa.array([part], pa.string()))[0].as_py())
            at, size = at + len(part), PART
        return b"".join(out)

    def split(self, texts: pa.Array) -> tuple[pa.StringArray, np.ndarray]:
        """The matches of ``SPLIT`` in texts laid end to end, and how many there are before each text and in all."""
        ends = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1]
        if ends[0] == ends[-1]:
            return pa.array([], pa.string()), np.zeros(len(ends), np.int64)
        data, ends = texts.buffers()[2].slice(int(ends[0]), int(ends[-1] - ends[0])), ends - ends[0]
        character = np.flatnonzero((np.frombuffer(data, np.uint8) & 0xC0) != 0x80)  # the first byte of each
        firsts = np.searchsorted(character, ends[:-1][ends[:-1] < ends[1:]])
        starts = character[match_starts(code_points(data.to_pybytes().decode()), firsts)]
        bounds = np.append(starts, ends[-1]).astype(np.int32)
        return pa.StringArray.from_buffers(len(starts), pa.py_buffer(bounds), data), np.searchsorted(bounds, ends)

    def encode_split(self, texts: pa.Array) -> pa.Array:
        """The ids of each text by the matches of ``SPLIT``, each distinct match looked up once."""
        if not len(texts):
            return pa.array([], pa.binary())
        sizes = pc.utf8_length(texts).to_numpy(zero_copy_only=False)
        words, cuts = zip(*[self.split(texts[s]) for s in pieces(texts, sizes, len(texts), SPLIT_CHARS)])
        # distinct in each part first, whose hash table is small, then in all
        coded = pa.chunked_array([w.dictionary_encode() for w in words]).unify_dictionaries()
        known, out = self.looked_up(coded.chunk(0).dictionary), []
        for chunk, cut in zip(coded.chunks, cuts):
            ids = known.take(chunk.indices)
            past = np.frombuffer(ids.buffers()[1], np.int32)[ids.offset + cut] if len(ids) else np.zeros(len(cut), np.int32)
            out.append(pa.BinaryArray.from_buffers(pa.binary(), len(cut) - 1, [None, pa.py_buffer(past), ids.buffers()[2]]))
        return pa.concat_arrays(out)

    def looked_up(self, matches: pa.Array) -> pa.Array:
        """The ids of each of distinct matches."""
        sizes, ids = [np.zeros(1, np.int32)], [np.zeros(0, np.uint32)]
        for part in itertools.batched(matches.cast(pa.binary()).to_numpy(zero_copy_only=False).tolist(), CACHED):
            found = list(map(self.merged, part))
            sizes.append(np.fromiter(map(len, found), np.int32, len(found)))
            ids.append(np.fromiter(itertools.chain.from_iterable(found), "<u4", int(sizes[-1].sum())))
        ends = (4 * np.cumsum(np.concatenate(sizes))).astype(np.int32)
        return pa.BinaryArray.from_buffers(pa.binary(), len(matches), [None, pa.py_buffer(ends), pa.py_buffer(np.concatenate(ids))])

    def joined(self, parts: list[list[str]]) -> list[bytes]:
        """The ids of each list of matches."""
        distinct = list(set().union(*parts))
        ids = dict(zip(distinct, self.looked_up(pa.array(distinct, pa.string())).to_pylist()))
        return [b"".join(map(ids.__getitem__, p)) for p in parts]

    def decode(self, ids: bytes) -> bytes:
        """The bytes the ids stand for; characters split over tokens come out whole as their bytes meet."""
        return b"".join(map(self.bytes.__getitem__, np.frombuffer(ids, "<u4").tolist()))

    def offsets(self, ids: bytes) -> tuple[np.ndarray, np.ndarray]:
        """First and past-the-last character of each token; a token with a part of a character spans it."""
        length = self.lengths[np.frombuffer(ids, "<u4")]
        ends = np.cumsum(length)
        raw = np.frombuffer(self.decode(ids), np.uint8)
        character = np.cumsum((raw & 0xC0) != 0x80) - 1  # of each byte
        return character[ends - length].astype(np.int32), (character[ends - 1] + 1).astype(np.int32)


@functools.lru_cache(maxsize=2)
def codec(path: str, pattern: str) -> Codec:
    return Codec(path, pattern)


def pieces(column: pa.Array, sizes: np.ndarray, rows: int, chars: int) -> Iterator[slice]:
    """Slices of a batch that stay within so many rows and, beyond the first row, characters; a row longer than PART is alone."""
    start = held = last = 0
    for i, n in enumerate(sizes.tolist()):
        if i > start and (i - start >= rows or held + n > chars or max(last, n) > PART):
            yield slice(start, i)
            start, held = i, 0
        held, last = held + n, n
    if start < len(column):
        yield slice(start, len(column))


def encode(
    docs: DataFrame,
    path: str,
    pattern: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    offsets: bool = False,
    decoded: bool = False,
) -> DataFrame:
    """Columns ``id_col``, n_tokens, ids (binary, uint32 little-endian); with ``offsets`` also starts, ends.

    With ``decoded`` also the bytes that the ids decode to, made by the same worker.

    One row out for each row in, repeated or not. A NULL text encodes as the empty one: no tokens, empty
    ``ids``. Special tokens are not recognised: their strings are ordinary text. Other columns are not
    read, so their names cannot clash. ``path`` must be readable on every executor.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    more = ", starts array<int>, ends array<int>" * offsets + ", decoded binary" * decoded
    names = ["key", "n_tokens", "ids", *["starts", "ends"] * offsets, *["decoded"] * decoded]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path, pattern)
        for batch in batches:
            key, text = batch.column(0), batch.column(1)
            sizes = pc.utf8_length(text).to_numpy(zero_copy_only=False)
            for group in pieces(text, sizes, ROWS, CHARS):
                coded, keys = c.encode_column(text[group]), key[group]
                for s in pieces(coded, sizes[group], BATCH_ROWS, BATCH_CHARS):
                    yield rows(c, keys[s], coded[s])

    def rows(c: Codec, key: pa.Array, coded: pa.Array) -> pa.RecordBatch:
        out = [key, pc.divide(pc.binary_length(coded).cast(pa.int64()), 4), coded]
        ids = coded.to_pylist() if offsets or decoded else []
        if offsets:
            spans = [c.offsets(x) for x in ids]
            out += [pa.array([x[k] for x in spans], pa.list_(pa.int32())) for k in (0, 1)]
        if decoded:
            out.append(pa.array(map(c.decode, ids), pa.binary()))
        return pa.RecordBatch.from_arrays(out, names=names)

    narrow = docs.select(F.col(id_col).alias("key"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    done = narrow.mapInArrow(run, f"key {kind}, n_tokens long, ids binary{more}")
    return done.withColumnRenamed("key", id_col)


def decode(encoded: DataFrame, path: str, pattern: str, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """``encoded`` with one more column of the bytes that its ids stand for (NULL ids: NULL).

    Bytes, not text: ids cut inside a character decode to a part of it. ``out_col`` replaces a column of that name.
    """

    @F.pandas_udf("binary")
    def back(ids):
        c = codec(path, pattern)
        return ids.map(c.decode, na_action="ignore")

    return encoded.withColumn(out_col, back(F.col(ids_col)))
