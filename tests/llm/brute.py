"""Plain Python versions to compare with."""

from __future__ import annotations

import re
from collections import Counter


def repeats(texts: list[bytes], length: int) -> list[tuple[int, int, int, bytes]]:
    """Per text: bytes, bytes removed, maximal runs removed, what is left."""
    seen = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        kept = bytes(b for b, g in zip(t, gone, strict=True) if not g)
        runs = sum(1 for i, g in enumerate(gone) if g and (not i or not gone[i - 1]))
        out.append((len(t), sum(gone), runs, kept))
    return out


def word_repeats(texts: list[bytes], words: int, length: int) -> list[bytes]:
    """What is left of each text without repeated strings and repeated runs of words."""
    runs = []
    for t in texts:
        at = [m.span() for m in re.finditer(rb"[^\x20\x09-\x0D]+", t)]
        runs.append([(a, b) for (a, _), (_, b) in zip(at, at[words - 1 :], strict=False)])
    seen = Counter(t[a:b] for t, r in zip(texts, runs, strict=True) for a, b in r)
    strings = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t, r in zip(texts, runs, strict=True):
        gone = {i for a, b in r if seen[t[a:b]] > 1 for i in range(a, b)}
        for i in range(len(t) - length + 1):
            if strings[t[i : i + length]] > 1:
                gone.update(range(i, i + length))
        out.append(bytes(b for i, b in enumerate(t) if i not in gone))
    return out


def shingles(text: str | None, n: int) -> frozenset:
    words = (text or "").encode().lower().split()
    if not words:
        return frozenset()
    n = min(n, len(words))
    return frozenset(tuple(words[i : i + n]) for i in range(len(words) - n + 1))


def groups(rows: list[tuple], n: int, percent: int) -> list[tuple]:
    """Per row (key, text): key, shingles, smallest key that links reach."""
    sets = [shingles(text, n) for _, text in rows]
    parent = list(range(len(rows)))

    def root(i: int) -> int:
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if common and 100 * common >= percent * (len(sets[i]) + len(sets[j]) - common):
                parent[root(i)] = root(j)
    least: dict[int, int] = {}
    for i, (key, _) in enumerate(rows):
        if key is not None:
            least[root(i)] = min(least.get(root(i), key), key)
    return [(key, len(sets[i]), least.get(root(i), key)) for i, (key, _) in enumerate(rows)]


def best_fit(items: list[tuple], capacity: int) -> list[int]:
    """Bin of each (size, source, cluster): the fullest one that fits and has neither."""
    bins: list[tuple[int, set, set]] = []
    out = []
    for size, source, cluster in items:
        fits = [
            (rest, number)
            for number, (rest, sources, clusters) in enumerate(bins)
            if rest >= size and source not in sources and cluster not in clusters
        ]
        if fits:
            _, number = min(fits)
        else:
            number = len(bins)
            bins.append((capacity, set(), set()))
        rest, sources, clusters = bins[number]
        bins[number] = (
            rest - size,
            sources | ({source} if source >= 0 else set()),
            clusters | ({cluster} if cluster >= 0 else set()),
        )
        out.append(number)
    return out


def repeat_words(words: list) -> int:
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    counts = Counter(windows)
    inside = {i + k for i, w in enumerate(windows) if counts[w] > 1 for k in range(3)}
    return len(inside)
