"""Source mixing, collocations and importance resampling against plain Python and on odd rows."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from brute import LONG, LOWER, ODD, WORD
from pyspark.sql import functions as F

from factorloom.llm import collocations as col
from factorloom.llm import mixing, resampling


def rows(df, *names):
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=repr)


# --- mixing ---


def targets(sizes: dict, share: float = 1.5, most: float = 2.0) -> dict:
    """Target of each source, by sharing what is above again and again."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    out, open_, left = {}, list(names), share * sum(sizes.values())
    while open_:
        level = left / sum(weight[s] for s in open_)
        above = [s for s in open_ if level * weight[s] >= most * sizes[s]]
        if not above:
            return out | {s: level * weight[s] for s in open_}
        for s in above:
            out[s] = most * sizes[s]
            left -= out[s]
        open_ = [s for s in open_ if s not in above]
    return out


def mixed(docs, **more):
    return mixing.mix(docs, **more).collect()


@pytest.mark.parametrize("block_rows", [10_000, 16])
def test_mix(make, block_rows):
    rng = random.Random(4)
    docs = [(i, " ".join("w" * rng.choice([1, 5, 5, 20, 200])), f"s{min(rng.randint(0, 9), 6)}" if i % 11 else None) for i in range(700)]
    size = {d: len(t.split()) for d, t, _ in docs}
    sums = Counter()
    for d, _, s in docs:
        sums[s] += size[d]
    want, source = targets(sums), {d: s for d, _, s in docs}
    out = mixed(make(docs), block_rows=block_rows)
    assert Counter(r.doc_id for r in out) == Counter(size.keys())
    taken, times = Counter(), Counter()
    for r in out:
        s = source[r.doc_id]
        assert (r.size, r.source_size) == (size[r.doc_id], sums[s]) and math.isclose(r.target, want[s])
        assert r.taken in (0, r.size, 2 * r.size)
        taken[s] += r.taken
        times[s] += r.taken / r.size
    n = Counter(source.values())
    for s in want:
        assert abs(taken[s] - want[s]) <= (40 if block_rows > 1000 else 200)  # a text has up to 200 words
        assert abs(times[s] - n[s] * want[s] / sums[s]) <= 8  # balanced in documents too
    names = ("doc_id", "taken")
    assert rows(mixing.mix(make(docs[::-1], 5), block_rows=block_rows), *names) == sorted(((r.doc_id, r.taken) for r in out), key=repr)


def test_flight_keeps_both_totals():
    rng = random.Random(1)
    for _ in range(20):
        size = [rng.choice([1, 3, 3, 50, rng.randint(1, 1000)]) for _ in range(200)]
        x = [rng.choice([0.3, 0.75])] * 200
        before = sum(x), sum(s * v for s, v in zip(size, x))
        mixing.flight(size, x, rng)
        assert sum(0 < v < 1 for v in x) <= 2
        assert np.allclose(before, (sum(x), sum(s * v for s, v in zip(size, x))))


def test_landing_is_the_best_rounding():
    rng = random.Random(2)
    size, x = [rng.randint(1, 99) for _ in range(9)], [rng.random() for _ in range(9)]
    goal, y = sum(s * v for s, v in zip(size, x)), list(x)
    mixing.landing(size, y, list(range(9)))
    ways = (sum(s for i, s in enumerate(size) if m >> i & 1) for m in range(512))
    assert math.isclose(abs(sum(s * v for s, v in zip(size, y)) - goal), min(abs(w - goal) for w in ways))


def test_mix_odd(make, odd, none, monkeypatch):
    assert mixed(none) == []
    sums = Counter()
    for _, t, s in ODD:
        sums[s] += len(WORD.findall(t or ""))
    want = targets(sums)
    out = mixed(odd)
    got = Counter((r.doc_id, r.size, r.source_size, round(r.target, 6)) for r in out)
    assert got == Counter((d, len(WORD.findall(t or "")), sums[s], round(want[s], 6)) for d, t, s in ODD)
    assert all(r.taken % max(r.size, 1) == 0 and r.taken <= 2 * r.size for r in out)
    # one row stored very often is written out in many runs, and is taken in proportion
    monkeypatch.setattr(mixing, "COPIES", 7)
    out = mixed(make([(1, "a b c", "s")] * 100 + [(2, "a b", "t")] * 50))
    assert Counter(r.doc_id for r in out) == {1: 100, 2: 50}
    assert abs(sum(r.taken for r in out if r.doc_id == 2) - next(r.target for r in out if r.doc_id == 2)) <= 1
    assert all(r.taken == 0 for r in mixed(make([(1, None, "s"), (2, "", None)])))


# --- collocations ---


def phrases(docs, longest=4, least=30, top=2000):
    f, n = Counter(), Counter()
    for text, lang in docs:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\n-\r]", (text or "").translate(LOWER)):
            w = re.findall(r"[^ \t]+", piece)
            n[lang] += len(w)
            f.update((lang, tuple(w[i : i + m])) for m in range(1, longest + 1) for i in range(len(w) - m + 1))
    found = {k: a for k, a in f.items() if len(k[1]) > 1 and a >= least}
    inside = {(g, w[i : i + m]) for (g, w), a in found.items() for m in range(2, len(w)) for i in range(len(w) - m + 1) if 100 * a >= 80 * f[g, w[i : i + m]]}
    out = []
    for (g, w), a in found.items():
        if (g, w) not in inside:
            score, _, l, r = min((2_000_000 * a // (f[g, w[:k]] + f[g, w[k:]]), k, f[g, w[:k]], f[g, w[k:]]) for k in range(1, len(w)))
            out.append((g, -score, -a, " ".join(w).encode(), l, r))
    ranks, kept = Counter(), []
    for g, score, a, w, l, r in sorted(out):
        ranks[g] += 1
        if ranks[g] <= top:
            kept.append((g, ranks[g], w.decode(), -a, l, r, n[g], -score))
    return kept


def tagged(make, docs):
    """Of (text, lang): documents whose column source is the language."""
    return make([(i, t, g) for i, (t, g) in enumerate(docs)])


PHRASE = "lang rank phrase a l r n score".split()


@pytest.mark.parametrize("held,least,top", [(2_000_000, 3, 2000), (400, 3, 2000), (400, 2, 5)])
def test_collocations(spark, make, monkeypatch, held, least, top):
    rng = random.Random(held + least)
    words = ["the", "of", "New", "new", "york", "city", "Straße", "漢字", "a b", "x"]
    docs = []
    for _ in range(120):
        w = [rng.choice(words) for _ in range(rng.randint(0, 40))]
        docs.append(("".join(x + rng.choice([" ", "  ", "\t", ", ", ".", "\n", " "]) for x in w), rng.choice(["en", "de", None, "und"])))
    monkeypatch.setattr(col, "HELD", held)
    monkeypatch.setattr(col, "SLICE", 300)
    got = col.collocations(tagged(make, docs), least=least, top=top, lang_col="source")
    assert got.columns == PHRASE
    want = phrases(docs, least=least, top=top)
    assert rows(got, *PHRASE) == sorted(want, key=repr) and len(want) > 10


def test_collocations_odd(make, odd, none):
    for docs in (none, odd, make([(1, None, None)])):
        got = col.collocations(docs, lang_col="source", least=5)
        assert rows(got, *PHRASE) == (sorted(phrases([(t, s) for _, t, s in ODD], least=5), key=repr) if docs is odd else [])
    deep = [("one two three four five " * 40, "en")] * 3 + [("one. two three; four", "en")]
    got = col.collocations(tagged(make, deep), lang_col="source", least=30)
    assert rows(got, *PHRASE) == sorted(phrases(deep), key=repr)


def test_transducers():
    rng = np.random.default_rng(3)
    for length in (1, 2, 3, 4):
        parts, want = [], Counter()
        for _ in range(5):
            r = rng.integers(0, 6, (300, length)).astype(np.uint64) * np.uint64(2**61 + 3)
            for x in r.tolist():
                want[tuple(x)] += 1
            parts.append(col.Transducer.load(col.Transducer.of(*col.summed(r, np.ones(300, np.int64))).dump()))
        whole = col.union(parts)
        r, c = whole.rows()
        assert {tuple(x): n for x, n in zip(r.tolist(), c.tolist())} == want
        assert r.tolist() == sorted(r.tolist())
        asked = col.Transducer.of(*col.summed(rng.integers(0, 9, (40, length)).astype(np.uint64) * np.uint64(2**61 + 3), np.ones(40, np.int64)))
        r, c = whole.composed(asked)
        assert {tuple(x): n for x, n in zip(r.tolist(), c.tolist())} == {tuple(x): want[tuple(x)] for x in asked.rows()[0].tolist() if tuple(x) in want}


def test_equal_states_are_one():
    grid = np.array([(a, b, c) for a in range(10) for b in range(10) for c in range(10)], np.uint64)
    t = col.Transducer.of(grid, np.ones(1000, np.int64))
    assert [len(a) for a in t.arcs] == [10, 10, 10]  # not 10, 100, 1000


# --- importance resampling ---


def resampled(docs, target, percent=25, min_words=20, seed=7, buckets=10_000):
    def features(text):
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
        return w + [f"{a} {b}" for a, b in zip(w, w[1:])], len(w)

    def bucket(f):
        return zlib.crc32(f.encode()) % buckets

    every = [features(t) for _, t in docs]
    s, t = Counter(bucket(f) for x, _ in every for f in x), Counter(bucket(f) for x in target for f in features(x)[0])
    all_s, all_t = sum(s.values()), sum(t.values())
    out = []
    for (d, _), (x, n) in zip(docs, every):
        gains = [math.floor(1000 * math.log((t[b] + 1) * (all_s + buckets) / ((s[b] + 1) * (all_t + buckets)))) for b in map(bucket, x)]
        weight = sum(gains) // len(x) if x else 0
        h = int(hashlib.sha256(f"{seed}:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        out.append([d, len(x), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, n])
    enough = sorted((r for r in out if r[5] >= min_words), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for i, r in enumerate(enough[: percent * len(enough) // 100]):
        r[4] = i + 1
    return sorted((tuple(r[:5]) for r in out), key=repr)


SCORED = "doc_id n_features weight score rank".split()


def test_resample(spark, make, monkeypatch):
    monkeypatch.setattr(resampling, "SLICE", 2000)
    rng = random.Random(8)
    words = ["alpha", "Beta", "gamma", "ÄÖ", "漢字", "x1", "y" * 300, "don't", "a_b"]
    docs = [(i % 150, "".join(rng.choice(words) + rng.choice([" ", "  ", "-", "\n", ", "]) for _ in range(rng.choice([0, 5, 19, 20, 21, 80]))), "s") for i in range(160)]
    target = ["alpha beta gamma. Alpha", None, "", "ÄÖ 漢字 " * 20]
    aims = spark.createDataFrame([(i, t) for i, t in enumerate(target)], "item_id long, text string")
    for percent, buckets in ((25, 10_000), (60, 100_000)):
        got = resampling.resample(make(docs), aims, percent=percent, buckets=buckets)
        assert got.columns == SCORED and rows(got, *SCORED) == resampled([(d, t) for d, t, _ in docs], target, percent, buckets=buckets)


def test_resample_odd(spark, odd, none):
    aims = spark.createDataFrame([("same word1x1", "?")], "text string, doc_id string")
    assert resampling.resample(none, aims).count() == 0
    for target in (aims, aims.limit(0)):
        got = rows(resampling.resample(odd, target, percent=50), *SCORED)
        assert got == resampled([(d, t) for d, t, _ in ODD], [r.text for r in target.collect()], 50)


def test_joined_crc():
    words = ["a", "hello", "ü" * 20, LONG]
    for a in words:
        for b in words:
            x, y = a.encode(), b.encode()
            got = resampling.joined_crc(np.array([zlib.crc32(x)], np.uint32), np.array([zlib.crc32(y)], np.uint32), np.array([len(y)]))
            assert int(got[0]) == zlib.crc32(x + b" " + y)
