"""Plain Python versions of what the operators compute, for small inputs."""

from __future__ import annotations

import re
from collections import defaultdict

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def quality(text: str | None) -> tuple:
    text = text or ""
    w = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    at = defaultdict(list)
    for i in range(len(w) - 7):
        at[tuple(w[i : i + 8])].append(i)
    covered = {i + k for places in at.values() if len(places) > 1 for i in places for k in range(8)}
    symbols = sum(c in "#*$%&|<>" for c in text)
    failed = len(w) < 20 or 100 * len(covered) > 30 * len(w)
    return len(w), sum(map(len, w)), symbols, len(lines) - len(set(lines)), len(covered), failed


def shingles(text: str | None, k: int) -> frozenset:
    w = WORD.findall((text or "").translate(LOWER))
    return frozenset() if not w else frozenset([tuple(w)]) if len(w) < k else frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1))


def components(rows: list[tuple], k: int, percent: int) -> list[tuple]:
    """(id, set size, component id) of (id, text) rows."""
    sets = [shingles(t, k) for _, t in rows]
    root = list(range(len(rows)))

    def find(i: int) -> int:
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return [(d, len(s), least.get(find(i)) if s else d) for i, ((d, _), s) in enumerate(zip(rows, sets))]


def kept_lines(rows: list[tuple], min_words: int) -> list[str]:
    """Texts of (id, text) rows, in the order of ids, without later copies of line runs."""
    lines = [[x for x in t.split("\n") if WORD.search(x)] for _, t in rows]
    seen, gone = set(), [set() for _ in rows]
    for d, mine in enumerate(lines):
        for s in range(len(mine)):
            for e in range(s + 1, len(mine) + 1):
                if sum(len(WORD.findall(x)) for x in mine[s:e]) >= min_words:
                    run = tuple(mine[s:e])
                    if run in seen:
                        gone[d].update(range(s, e))
                    seen.add(run)
    out = []
    for (_, t), g in zip(rows, gone):
        i, left = -1, []
        for x in t.split("\n"):
            i += bool(WORD.search(x))
            if not (WORD.search(x) and i in g):
                left.append(x)
        out.append("\n".join(left))
    return out


def tokens(text: str | None) -> list[str]:
    return re.findall(r"[^\W_]+", (text or "").lower())


def overlap(text: str | None, item: str | None, span: int = 20, changed: int = 4) -> tuple | None:
    """(matches, doc_start, item_start) of the best stretch."""
    d, b = tokens(text), tokens(item)
    n = min(span, len(b))
    need = span - changed if len(b) >= span else len(b) - (len(b) >= 9) - (len(b) >= 13) - (len(b) >= 17)
    best = None
    for s in range(len(b) - n + 1 if b else 0):
        for at in range(-n, len(d)):
            m = sum(0 <= at + k < len(d) and d[at + k] == b[s + k] for k in range(n))
            if m >= need and (best is None or (m, -at, -s) > best):
                best = (m, -at, -s)
    return best and (best[0], -best[1], -best[2])


LONG = " ".join(f"word{i % 977}x{i}" for i in range(30_000))

#: NULLs, empty and long texts, ties, repeated rows.
ODD = [
    (1, None, None), (2, "", "a"), (3, " \n\t ", "a"), (4, LONG, "b"), (5, LONG, "b"), (5, LONG, "b"), (6, "one", None),
    (None, "two words", None), (None, None, None), (7, "Ünïcode 漢字 \U0001f600 " * 30, "b"), (8, "same " * 40, "a"), (8, "other text of one id", "a"),
]
