"""Removal of long repeated byte strings by a distributed merge sort of suffixes.

A start is *repeated* when the ``length`` bytes from it also start anywhere else; every byte that
such a string covers goes. Sorting all suffixes would move hundreds of times the input, so the
sort takes one suffix for each *anchor*: of all ``GRAM``-byte grams in a string of ``length``
bytes, the one with the smallest hash, leftmost on ties. Equal strings have their anchors at the
same place, so repeated starts are found among the suffixes whose grams are equal, and those lie
together in sorted order. An anchor owns the starts whose strings choose it.

1. ``anchor_sieve``: anchors whose gram occurs once are dropped (by hash: nothing else is lost).
2. ``_write_runs``: each task sorts the suffixes of its anchors and writes front-coded runs.
3. ``_exchange``: runs are cut at splitters from a bounded sample and shuffled, still front-coded.
4. ``merge_runs``: a loser tree joins the runs of a range. It keeps each head's common prefix with
   the last winner, and so never compares a known prefix again.
5. ``_resolve``: in each stretch of suffixes that share a gram, equal strings are found. Hashes
   offer them and their bytes decide; across ranges a digest of 128 bits does.

``remove_passages`` also takes repeated runs of many words that are shorter than ``length``: the
anchors are then grams of words, and the runs at repeated ones are counted by hash.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from promolens.llm.common import map_batches, mix, text_bytes
from promolens.session import release_shuffles, remove_staged, stage

LENGTH = 400
GRAM = 128
WORDS = 51
WORD_GRAM = 8
PIECE = 1 << 17  # bytes hashed at once
RUN_BYTES = 24 << 20
PART_ENTRIES = 6_000
MAX_PARTS = 50_000
_BASE = np.uint64(0x9E3779B97F4A7C15)
_UNBASE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


class Hasher:
    """Rolling hashes of fixed-length strings, from running sums modulo 2**64."""

    def __init__(self):
        self.letters = mix(np.arange(1, 257, dtype=np.uint64))
        self.up = self.down = np.ones(1, np.uint64)

    def sums(self, data: np.ndarray) -> np.ndarray:
        if len(self.up) <= len(data):
            n = max(2 * len(data), 2 * PIECE)
            self.up, self.down = np.full(n, _BASE), np.full(n, _UNBASE)
            self.up[0] = self.down[0] = 1
            self.up, self.down = np.cumprod(self.up), np.cumprod(self.down)
        out = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.letters[data] * self.up[: len(data)], out=out[1:])
        return out

    def windows(self, sums: np.ndarray, size: int) -> np.ndarray:
        """Hashes of the strings of ``size`` bytes from each place."""
        n = max(len(sums) - size, 0)
        return mix((sums[size:] - sums[:n]) * self.down[:n])

    def at(self, sums: np.ndarray, starts: np.ndarray, size: int) -> np.ndarray:
        return mix((sums[starts + size] - sums[starts]) * self.down[starts])


def _sliding_min(values: np.ndarray, size: int) -> np.ndarray:
    """Minimum of each ``size`` neighbours, by doubling."""
    reach, low = 1, values
    while 2 * reach <= size:
        low = np.minimum(low[:-reach], low[reach:])
        reach *= 2
    if reach < size:
        rest = size - reach
        low = np.minimum(low[: len(low) - rest], low[rest:])
    return low


def _pieces(texts: list[bytes], length: int):
    """(text numbers, their offsets, bytes): short texts together, long ones in parts.

    Parts of a long text overlap by ``length`` - 1 bytes, so each start lies in one part whole.
    """
    group: list[tuple[int, int, bytes]] = []
    size = 0
    for number, text in enumerate(texts):
        for at in range(0, max(len(text) - length + 1, 0), PIECE):
            part = text[at : at + PIECE + length - 1]
            group.append((number, at, part))
            size += len(part)
            if size >= PIECE:
                yield group
                group, size = [], 0
    if group:
        yield group


def anchors(texts: list[bytes], hasher: Hasher, length: int, gram: int):
    """Arrays (text, anchor, first start, last start, gram hash), in order of text and start."""
    found = []
    for group in _pieces(texts, length):
        data = np.frombuffer(b"".join(p for _, _, p in group), np.uint8)
        hashes = hasher.windows(hasher.sums(data), gram)
        # High bits of the hash, then the place: the leftmost of equal hashes is the smallest.
        places = np.arange(len(hashes), dtype=np.uint64)
        ranked = (hashes & ~np.uint64((1 << 20) - 1)) | places
        best = _sliding_min(ranked, length - gram + 1) & np.uint64((1 << 20) - 1)
        sizes = np.array([len(p) for _, _, p in group])
        begin = np.cumsum(sizes) - sizes
        counts = sizes - length + 1
        member = np.repeat(np.arange(len(group)), counts)
        start = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        start += begin[member]
        anchor = best[start].astype(np.int64)
        new = np.ones(len(start), bool)
        new[1:] = (anchor[1:] != anchor[:-1]) | (member[1:] != member[:-1])
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(start)) - 1
        owner = member[first]
        shift = np.array([at for _, at, _ in group])[owner] - begin[owner]
        found.append((
            np.array([n for n, _, _ in group])[owner],
            anchor[first] + shift,
            start[first] + shift,
            start[last] + shift,
            hashes[anchor[first]],
        ))
    if not found:
        return (np.empty(0, np.int64),) * 4 + (np.empty(0, np.uint64),)
    return tuple(np.concatenate(c) for c in zip(*found, strict=True))


def word_runs(data: bytes, hasher: Hasher, words: int, gram: int, below: int):
    """Arrays (from, to, string hash, anchor, gram hash) of the runs of ``words`` words.

    A run goes from the first byte of a word to the last of another, whitespace between them
    included; runs of ``below`` bytes or more are left out. The anchor is the ``gram``-word gram
    with the smallest hash, leftmost on ties.
    """
    raw = np.frombuffer(data, np.uint8)
    word = (raw != 0x20) & ((raw < 0x09) | (raw > 0x0D))
    edges = np.diff(np.concatenate(([0], word.view(np.int8), [0])))
    begin, end = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    n = max(len(begin) - words + 1, 0)
    short = end[words - 1 :] - begin[:n] < below
    found = []
    cuts = np.searchsorted(begin[:n], np.arange(0, len(raw) + PIECE, PIECE)).tolist()
    for i, j in zip(cuts, cuts[1:], strict=False):
        if not short[i:j].any():
            continue
        # No run that counts goes beyond ``hi``; of others only the hashes are cut off there.
        lo = int(begin[i])
        hi = min(len(raw), lo + PIECE + below)
        first = np.minimum(begin[i : j + words - 1], hi) - lo
        last = np.minimum(end[i : j + words - 1], hi) - lo
        sums = hasher.sums(raw[lo:hi])
        leading = first[: len(first) - gram + 1]
        grams = hasher.at(sums, leading, last[gram - 1 :] - leading)
        leading = first[: j - i]
        strings = hasher.at(sums, leading, last[words - 1 :] - leading)
        places = np.arange(len(grams), dtype=np.uint64)
        ranked = (grams & ~np.uint64((1 << 20) - 1)) | places
        best = _sliding_min(ranked, words - gram + 1) & np.uint64((1 << 20) - 1)
        some = np.flatnonzero(short[i:j])
        best = best[some].astype(np.int64)
        found.append(
            (begin[i:j][some], end[i + words - 1 : j + words - 1][some], strings[some], best + i,
             grams[best])
        )
    if not found:
        return (np.empty(0, np.int64),) * 2 + (np.empty(0, np.uint64), np.empty(0, np.int64),
                                               np.empty(0, np.uint64))
    return tuple(np.concatenate(c) for c in zip(*found, strict=True))


def word_anchors(texts: list[bytes], hasher: Hasher, words: int, gram: int, below: int):
    """Arrays like those of ``anchors``, for runs of words; places are numbers of runs."""
    found = []
    for number, data in enumerate(texts):
        _, _, _, anchor, hashes = word_runs(data, hasher, words, gram, below)
        first = np.flatnonzero(np.append(True, anchor[1:] != anchor[:-1])[: len(anchor)])
        last = np.append(first[1:], len(anchor))[: len(first)] - 1
        found.append((np.full(len(first), number), anchor[first], first, last, hashes[first]))
    if not found:
        return (np.empty(0, np.int64),) * 4 + (np.empty(0, np.uint64),)
    return tuple(np.concatenate(c) for c in zip(*found, strict=True))


_FIRST, _KNOWN, _MARKER = 0, 1, 2


def anchor_sieve(
    rows: DataFrame, length: int, gram: int, find: Callable[..., tuple] = anchors
) -> DataFrame:
    """(_key, _hash, _grams): per row the grams at its anchors that occur elsewhere too.

    A task routes the first row that it has for a gram by the gram. Later ones are known to be
    repeated: they are routed by row, and one marker by the gram tells of them. So a gram that a
    third of all rows have costs its own partition two rows a task.
    """
    kind = dict(rows.dtypes)["_key"]
    names = ("_route", "_kind", "_key", "_hash", "_gram")

    def emit(batches: Iterator[dict]) -> Iterator[dict]:
        hasher, seen, marked = Hasher(), set(), set()
        for batch in batches:
            text, _, _, _, hashes = find(batch["_data"], hasher, length, gram)
            if len(seen) > 500_000:
                seen.clear()
                marked.clear()
            sent = []
            signed = hashes.view(np.int64).tolist()
            for number, value in zip(text.tolist(), signed, strict=True):
                key, own = batch["_key"][number], batch["_hash"][number]
                if value not in seen:
                    seen.add(value)
                    sent.append((value, _FIRST, key, own, value))
                    continue
                sent.append((hash((value, own)), _KNOWN, key, own, value))
                if value not in marked:
                    marked.add(value)
                    sent.append((value, _MARKER, None, None, value))
            columns = zip(*sent, strict=True) if sent else [[]] * len(names)
            yield dict(zip(names, map(list, columns), strict=True))

    sent = map_batches(
        rows, emit, f"_route long, _kind int, _key {kind}, _hash long, _gram long"
    )
    met = F.count_if(F.col("_kind") != _KNOWN).over(Window.partitionBy("_route"))
    repeated = sent.withColumn("_met", met).where(
        ((F.col("_met") > 1) & (F.col("_kind") == _FIRST)) | (F.col("_kind") == _KNOWN)
    )
    return repeated.groupBy("_key", "_hash").agg(F.collect_set("_gram").alias("_grams"))


def lcp_from(a: bytes, b: bytes, start: int) -> int:
    """Length of the common prefix of two strings known to agree up to ``start``."""
    end = min(len(a), len(b))
    if start >= end or a[start] != b[start]:
        return min(start, end)
    x, y = a[start:end], b[start:end]
    if x == y:
        return end
    differ = int.from_bytes(x, "big") ^ int.from_bytes(y, "big")
    return start + (8 * len(x) - differ.bit_length()) // 8


class Entries:
    """Sorted suffixes with their common prefixes, and where each comes from.

    A key is the text from the anchor to the end of its last string, then what is left of the
    anchor, reversed. ``left`` bytes of it lie before the anchor; ``weight`` is 2 if the same
    key occurred more than once in its run.
    """

    FIELDS = (("lcp", "<u4"), ("left", "<u4"), ("weight", "<u4"), ("row", "<i8"), ("at", "<i8"))

    def __init__(self, keys: list[bytes], **columns):
        self.keys = keys
        for name, kind in self.FIELDS:
            setattr(self, name, np.asarray(columns[name], kind))

    def pack(self, begin: int = 0, end: int | None = None) -> bytes:
        """Front-coded bytes of a range of entries."""
        keys = self.keys[begin:end]
        lcp = self.lcp[begin:end].copy()
        lcp[:1] = 0
        rest = [k[n:] for k, n in zip(keys, lcp.tolist(), strict=True)]
        parts = [np.array([len(keys)], "<u4"), lcp, np.array([len(r) for r in rest], "<u4")]
        parts += [getattr(self, name)[begin:end] for name, _ in self.FIELDS[1:]]
        blob = b"".join(p.tobytes() for p in parts) + b"".join(rest)
        return zstandard.ZstdCompressor(level=1).compress(blob)

    @classmethod
    def unpack(cls, data: bytes) -> Entries:
        blob = zstandard.ZstdDecompressor().decompress(data)
        n = int(np.frombuffer(blob, "<u4", 1)[0])
        at, columns = 4, {}
        for name, kind in (("lcp", "<u4"), ("size", "<u4"), *cls.FIELDS[1:]):
            columns[name] = np.frombuffer(blob, kind, n, at)
            at += columns[name].nbytes
        keys, key = [], b""
        for lcp, size in zip(columns["lcp"].tolist(), columns.pop("size").tolist(), strict=True):
            key = key[:lcp] + blob[at : at + size]
            at += size
            keys.append(key)
        return cls(keys, **columns)


def merge_runs(runs: list[list[bytes]], prefixes: list[list[int]]) -> Iterator[tuple]:
    """(run, index, common prefix with the one before) of all keys in order: a loser tree.

    ``prefixes`` has each key's common prefix with its predecessor in its run. A head that
    shares more with the last winner than another is the smaller one, without a look at bytes;
    heads that share equally much are compared from there on. Equal keys come by run.
    """
    k = len(runs)
    if not k:
        return
    heads = [run[0] if run else None for run in runs]
    index, shared = [0] * k, [0] * k
    losers = [-1] * k  # of the match at each inner node; 0 holds the winner

    def beats(a: int, b: int) -> bool:
        x, y = heads[a], heads[b]
        if x is None or y is None:
            return y is None and (x is not None or a < b)
        if shared[a] != shared[b]:
            return shared[a] > shared[b]
        common = lcp_from(x, y, shared[a])
        wins = a < b if common == len(x) == len(y) else x[common:] < y[common:]
        shared[b if wins else a] = common
        return wins

    def replay(player: int, node: int) -> None:
        while node:
            other = losers[node]
            if other < 0:  # the first at this node waits for an opponent
                losers[node] = player
                return
            if not beats(player, other):
                losers[node], player = player, other
            node >>= 1
        losers[0] = player

    for run in range(k):
        replay(run, (run + k) >> 1)
    while heads[winner := losers[0]] is not None:
        yield winner, index[winner], shared[winner]
        index[winner] = at = index[winner] + 1
        run = runs[winner]
        heads[winner] = run[at] if at < len(run) else None
        shared[winner] = prefixes[winner][at] if at < len(run) else 0
        replay(winner, (winner + k) >> 1)


_RUN = "_n int, _run binary, _sample array<binary>, _row long, _from long, _to long"


def _write_runs(length: int, gram: int, run_bytes: int):
    """Sorted, front-coded runs of the anchors' suffixes.

    Of equal keys in a run the first goes on; the strings of the others are repeated for sure,
    and their spans are written beside the runs.
    """

    def run(batches: Iterator[dict]) -> Iterator[dict]:
        hasher = Hasher()
        found: dict[tuple[bytes, int], list[int]] = {}
        size = 0

        def flush() -> dict:
            order = sorted(found)
            keys = [key for key, _ in order]
            lcps = [0, *(lcp_from(a, b, 0) for a, b in zip(keys, keys[1:], strict=False))]
            columns = zip(*(found[k] for k in order), strict=True)
            left, weight, row, at = map(list, columns)
            entries = Entries(keys, lcp=lcps, left=left, weight=weight, row=row, at=at)
            return {"_n": [len(keys)], "_run": [entries.pack()], "_sample": [keys[32::64]],
                    "_row": [None], "_from": [None], "_to": [None]}

        for batch in batches:
            text, anchor, first, last, hashes = anchors(batch["_data"], hasher, length, gram)
            begin = np.searchsorted(text, np.arange(len(batch["_data"]) + 1))
            spans: list[tuple[int, int, int]] = []
            for number, data in enumerate(batch["_data"]):
                part = slice(begin[number], begin[number + 1])
                wanted = np.array(batch["_grams"][number], np.int64)
                keep = np.isin(hashes[part].view(np.int64), wanted)
                row = batch["_row"][number]
                for x, lo, hi in zip(*(c[part][keep].tolist() for c in (anchor, first, last)),
                                     strict=True):
                    key = data[x : hi + length] + data[lo:x][::-1]
                    known = found.get((key, x - lo))
                    if known is None:
                        found[key, x - lo] = [x - lo, 1, row, x]
                        size += len(key)
                    else:
                        known[1] = 2
                        spans.append((row, lo, hi + length))
                if size >= run_bytes:
                    yield flush()
                    found.clear()
                    size = 0
            if spans:
                row, start, stop = map(list, zip(*spans, strict=True))
                none = [None] * len(spans)
                yield {"_n": none, "_run": none, "_sample": none, "_row": row, "_from": start,
                       "_to": stop}
        if found:
            yield flush()

    return run


def choose_splitters(sample: list[bytes], parts: int, gram: int) -> list[bytes]:
    """Keys that cut the sample evenly: between grams, or inside one that fills several parts."""
    sample, out = sorted(sample), []
    for i in range(1, parts):
        key = sample[i * len(sample) // parts] if sample else b""
        short = key[:gram]
        splitter = short if not out or out[-1][:gram] != short else key
        if splitter > (out[-1] if out else b""):
            out.append(splitter)
    return out


def _exchange(splitters):
    def run(batches: Iterator[dict]) -> Iterator[dict]:
        cuts = splitters.value
        for batch in batches:
            for data in batch["_run"]:
                entries = Entries.unpack(data)
                out, begin = {"_part": [], "_run": []}, 0
                while begin < len(entries.keys):
                    part = bisect_right(cuts, entries.keys[begin])
                    end = len(entries.keys)
                    if part < len(cuts):
                        lo, hi = begin, end  # first key at or above the next splitter
                        while lo < hi:
                            middle = (lo + hi) // 2
                            if entries.keys[middle] < cuts[part]:
                                lo = middle + 1
                            else:
                                hi = middle
                        end = lo
                    out["_part"].append(part)
                    out["_run"].append(entries.pack(begin, end))
                    begin = end
                yield out

    return run


def _resolve(merged: Entries, hasher: Hasher, length: int, gram: int, parts: int, part: int):
    """Spans (row, from, to) of repeated starts, and what open stretches leave undecided.

    A stretch of suffixes that share a gram is open if it reaches the edge of its range, since it
    may go on in the next: strings found once there are left to ``_open_starts``.
    """
    n = len(merged.keys)
    group = np.cumsum(merged.lcp < gram)
    sizes = np.bincount(group, minlength=group[-1] + 1)
    is_open = np.zeros(n, bool)
    if part > 0:
        is_open |= group == group[0]
    if part < parts - 1:
        is_open |= group == group[-1]
    chosen = np.flatnonzero((sizes[group] > 1) | (merged.weight > 1) | is_open)
    if not len(chosen):
        return [], []
    hashes, members, starts, places, texts = [], [], [], [], []
    held = 0
    for at in range(0, len(chosen), 2000):
        blocks, some = [], chosen[at : at + 2000]
        for i in some.tolist():
            key, left = merged.keys[i], int(merged.left[i])
            blocks.append(key[len(key) - left :][::-1] + key[: len(key) - left])
        size = np.array([len(b) for b in blocks])
        texts.append(b"".join(blocks))
        sums = hasher.sums(np.frombuffer(texts[-1], np.uint8))
        counts = size - length + 1
        member = np.repeat(np.arange(len(some), dtype=np.int32), counts)
        offset = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        place = (np.cumsum(size) - size)[member] + offset
        hashes.append(hasher.at(sums, place, length))
        places.append((held + place).astype(np.int32))  # a range holds some MB
        held += len(texts[-1])
        members.append(some[member].astype(np.int32))
        starts.append((merged.at[some] - merged.left[some])[member] + offset)
    value, member, start, place = map(np.concatenate, (hashes, members, starts, places))
    text = b"".join(texts)
    del hashes, members, starts, places, texts
    value = told_apart(value, place, text, length)
    order = np.argsort(value, kind="stable")
    first = np.flatnonzero(np.concatenate(([True], value[order][1:] != value[order][:-1])))
    weight = np.add.reduceat(merged.weight[member][order].astype(np.int64), first)
    repeated = np.empty(len(value), bool)
    repeated[order] = np.repeat(weight > 1, np.diff(np.append(first, len(value))))
    # Runs of neighbouring repeated starts of one suffix are one span.
    hit = np.flatnonzero(repeated)
    spans = []
    if len(hit):
        new = np.concatenate(([True], (np.diff(hit) > 1) | (np.diff(member[hit]) != 0)))
        begin = np.flatnonzero(new)
        end = np.append(begin[1:], len(hit)) - 1
        spans = list(zip(merged.row[member[hit[begin]]].tolist(), start[hit[begin]].tolist(),
                         (start[hit[end]] + length).tolist(), strict=True))
    left = np.flatnonzero(is_open[member] & ~repeated)
    undecided = [
        (digest(text[p : p + length]), row, at)
        for p, row, at in zip(place[left].tolist(), merged.row[member[left]].tolist(),
                              start[left].tolist(), strict=True)
    ]
    known = np.flatnonzero(is_open[member] & repeated)
    _, one = np.unique(value[known], return_index=True)
    told = [digest(text[p : p + length]) for p in place[known[one]].tolist()]
    return spans, undecided + [(d, -1, -1) for d in told]


def digest(string: bytes) -> bytes:
    """What stands for a string where its bytes do not travel."""
    return hashlib.blake2b(string, digest_size=16).digest()


def told_apart(value: np.ndarray, place: np.ndarray, text: bytes, length: int) -> np.ndarray:
    """``value``, the hashes of the strings at the places, made to differ where the bytes do.

    Every string is compared with the first one of its hash. Where both follow strings that are
    equal, one byte more has to be. Only hashes that lie are then replaced, by numbers of the bytes.
    """
    order = np.argsort(value, kind="stable").astype(np.int32)
    ranked = value[order]
    new = np.concatenate(([True], ranked[1:] != ranked[:-1]))
    del ranked
    first = np.where(new, np.arange(len(order), dtype=np.int32), np.int32(0))
    model = np.empty_like(place)
    model[order] = place[order[np.maximum.accumulate(first)]]
    del order, new, first
    letters = np.frombuffer(text, np.uint8)
    goes_on = np.zeros(len(place), bool)
    goes_on[1:] = (np.diff(place) == 1) & (np.diff(model) == 1)
    same = letters[place + length - 1] == letters[model + length - 1]
    for i in np.flatnonzero(~goes_on & (model != place)).tolist():
        p, m = int(place[i]), int(model[i])
        same[i] = text[p : p + length] == text[m : m + length]
    # A string that goes on from one that differs tells nothing by its last byte.
    fresh = np.flatnonzero(~goes_on)
    run = np.cumsum(~goes_on) - 1
    alike = same if not len(fresh) else np.logical_and.reduceat(same, fresh)[run]
    if alike.all():
        return value
    liars = np.isin(value, value[~alike])
    numbers: dict[bytes, int] = {}
    value = np.unique(value, return_inverse=True)[1].astype(np.uint64)
    for i in np.flatnonzero(liars).tolist():
        string = text[place[i] : place[i] + length]
        value[i] = len(place) + numbers.setdefault(string, len(numbers))
    return value


_FOUND = "_row long, _from long, _to long, _string binary"


def _merge(length: int, gram: int, parts: int):
    """Merge the pieces of each range, which come together, and resolve what they hold."""

    def finish(part: int, pieces: list[Entries], hasher: Hasher) -> Iterator[dict]:
        keys, lcp, picks = [], [], []
        offset = np.cumsum([0, *(len(p.keys) for p in pieces)])
        runs = [p.keys for p in pieces]
        for run, at, shared in merge_runs(runs, [p.lcp.tolist() for p in pieces]):
            keys.append(runs[run][at])
            lcp.append(shared)
            picks.append(offset[run] + at)
        picks = np.array(picks)
        columns = {
            name: np.concatenate([getattr(p, name) for p in pieces])[picks]
            for name in ("left", "weight", "row", "at")
        }
        merged = Entries(keys, lcp=lcp, **columns)
        spans, undecided = _resolve(merged, hasher, length, gram, parts, part)
        rows = [(*s, None) for s in spans] + [(r, p, None, v) for v, r, p in undecided]
        for at in range(0, len(rows), 50_000):
            columns = map(list, zip(*rows[at : at + 50_000], strict=True))
            yield dict(zip(("_row", "_from", "_to", "_string"), columns, strict=True))

    def run(batches: Iterator[dict]) -> Iterator[dict]:
        hasher, part, pieces = Hasher(), None, []
        for batch in batches:
            for number, data in zip(batch["_part"], batch["_run"], strict=True):
                if number != part and pieces:
                    yield from finish(part, pieces, hasher)
                    pieces = []
                part = number
                pieces.append(Entries.unpack(data))
        if pieces:
            yield from finish(part, pieces, hasher)

    return run


def _hashed(docs: DataFrame, key: str, text: str) -> DataFrame:
    return docs.select(F.col(key).alias("_key"), text_bytes(text).alias("_data")).withColumn(
        "_hash", F.xxhash64("_data")
    )


def _of_texts(rows: DataFrame, found: DataFrame, column: str) -> DataFrame:
    """The rows whose key and hash ``found`` has, with its column."""
    joined = rows.alias("d").join(
        found.alias("s"),
        F.col("d._key").eqNullSafe(F.col("s._key")) & (F.col("d._hash") == F.col("s._hash")),
    )
    return joined.select("d._key", "d._hash", "_data", column)


def _candidates(docs: DataFrame, key: str, text: str, length: int, gram: int) -> DataFrame:
    rows = _hashed(docs, key, text).where(F.octet_length("_data") >= length)
    chosen = _of_texts(rows, anchor_sieve(rows, length, gram), "_grams")
    texts = stage(chosen.withColumn("_row", F.monotonically_increasing_id()), "suffix-texts")
    release_shuffles(docs.sparkSession)  # whole texts
    return texts


def _spans(texts: DataFrame, length: int, gram: int, run_bytes: int, part_entries: int):
    """(_row, _from, _to): spans of repeated strings in the staged texts; they may overlap."""
    spark = texts.sparkSession
    runs = stage(
        map_batches(
            texts.select("_row", "_data", "_grams"), _write_runs(length, gram, run_bytes), _RUN
        ),
        "suffix-runs",
    )
    total = runs.agg(F.sum("_n")).first()[0] or 0
    parts = min(max(1, -(-total // part_entries), min(64, total // 100)), MAX_PARTS)
    # Each run offers one key in 64; of those about 10 for each range reach the driver.
    rate = max(1, total // 64 // (10 * parts))
    sample = [
        bytes(r[0])
        for r in runs.select(F.explode("_sample").alias("k"))
        .where(F.pmod(F.xxhash64("k"), F.lit(rate)) == 0)
        .collect()
    ]
    splitters = choose_splitters(sample, parts, gram)
    cuts = spark.sparkContext.broadcast(splitters)  # at most MAX_PARTS keys
    pieces = map_batches(
        runs.where("_run is not null").select("_run"), _exchange(cuts), "_part int, _run binary"
    )
    found = stage(
        map_batches(
            pieces.repartition("_part").sortWithinPartitions("_part"),
            _merge(length, gram, len(splitters) + 1),
            _FOUND,
        ),
        "suffix-found",
    )
    met = F.count(F.lit(1)).over(Window.partitionBy("_string"))
    across = (
        found.where("_string is not null").withColumn("_met", met).where("_met > 1 and _row >= 0")
    )
    columns = ("_row", "_from", "_to")
    return (
        runs.where("_run is null").select(*columns)
        .unionByName(found.where("_string is null").select(*columns))
        .unionByName(across.select("_row", "_from", (F.col("_from") + length).alias("_to")))
    )


def _word_spans(rows: DataFrame, words: int, gram: int, below: int) -> DataFrame:
    """(_key, _hash, _from, _to): repeated runs of ``words`` words, shorter than ``below`` bytes."""
    kind = dict(rows.dtypes)["_key"]
    find = partial(word_anchors, below=below)
    rows = rows.where(F.octet_length("_data") >= 2 * words - 1)
    sieve = anchor_sieve(rows, words, gram, find)

    def emit(batches: Iterator[dict]) -> Iterator[dict]:
        hasher = Hasher()
        for batch in batches:
            for row, own, data, grams in zip(
                *(batch[c] for c in ("_key", "_hash", "_data", "_grams")), strict=True
            ):
                start, stop, _, _, value = word_runs(data, hasher, words, gram, below)
                keep = np.isin(value.view(np.int64), np.array(grams, np.int64))
                start, stop = start[keep], stop[keep]
                strings = [digest(data[a:b]) for a, b in zip(start.tolist(), stop.tolist(),
                                                             strict=True)]
                yield {"_key": [row] * len(start), "_hash": [own] * len(start), "_from": start,
                       "_to": stop, "_string": strings}

    runs = stage(
        map_batches(
            _of_texts(rows, sieve, "_grams"),
            emit,
            f"_key {kind}, _hash long, _from long, _to long, _string binary",
        ),
        "suffix-words",
    )
    release_shuffles(rows.sparkSession)  # whole texts
    # Counted with a map-side combine: a run that a third of all rows have costs one row a task.
    repeated = runs.groupBy("_string").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    return runs.join(repeated, "_string", "left_semi").drop("_string")


def cut(data: bytes, spans: list[tuple[int, int]]) -> tuple[bytes, int, int]:
    """What is left of ``data``, the bytes removed, and the maximal runs removed."""
    kept, at, removed, runs, reach = [], 0, 0, 0, -1
    for start, stop in sorted(spans):
        if start > reach:
            runs += 1
        if stop > reach:
            kept.append(data[at : max(start, at)])
            removed += stop - max(start, at)
            at = reach = stop
    kept.append(data[at:])
    return b"".join(kept), removed, runs


def removals(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    length: int = LENGTH,
    gram: int = GRAM,
    run_bytes: int = RUN_BYTES,
    part_entries: int = PART_ENTRIES,
) -> DataFrame:
    """(key, text_hash, n_removed, n_spans, kept, clean_text) for the texts that lose bytes.

    ``text_hash`` is xxhash64 of the UTF-8 bytes; rows that agree in it and the key give one row.
    ``kept`` is what is left; ``clean_text`` leaves out code points cut apart, so it is valid.
    """
    if not 0 < gram <= length or length - gram >= 1 << 20:
        raise ValueError("gram must be at most length, and not shorter by a million")
    texts = _candidates(docs, key, text, length, gram)
    spans = _spans(texts, length, gram, run_bytes, part_entries)
    by_row = spans.groupBy(F.col("_row").alias("_of")).agg(
        F.collect_list(F.struct("_from", "_to")).alias("_spans")
    )
    hit = texts.join(by_row, texts["_row"] == by_row["_of"]).select(
        "_key", "_hash", "_data", "_spans"
    )
    return _cut_rows(hit, key)


def _cut_rows(hit: DataFrame, key: str) -> DataFrame:
    """What ``removals`` returns, from rows (_key, _hash, _data, _spans)."""
    names = ("_key", "text_hash", "n_removed", "n_spans", "kept", "clean_text")

    def apply(batches: Iterator[dict]) -> Iterator[dict]:
        for batch in batches:
            rows = []
            for row, own, data, found in zip(
                *(batch[c] for c in ("_key", "_hash", "_data", "_spans")), strict=True
            ):
                kept, removed, runs = cut(data, [(s["_from"], s["_to"]) for s in found])
                rows.append((row, own, removed, runs, kept, kept.decode("utf-8", "ignore")))
            columns = zip(*rows, strict=True) if rows else [[]] * len(names)
            yield dict(zip(names, map(list, columns), strict=True))

    kind = dict(hit.dtypes)["_key"]
    done = map_batches(
        hit.dropDuplicates(["_key", "_hash"]),
        apply,
        f"_key {kind}, text_hash long, n_removed long, n_spans long, kept binary, "
        "clean_text string",
    )
    return done.withColumnRenamed("_key", key)


def _joined(docs: DataFrame, gone: DataFrame, key: str):
    return docs.alias("d").join(
        gone.alias("g"),
        F.col(f"d.{key}").eqNullSafe(F.col(f"g.{key}"))
        & (F.col("d._text_hash") == F.col("g.text_hash")),
        "left",
    )


def remove_repeats(
    docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH, **settings
) -> DataFrame:
    """Every row of ``docs`` with ``clean_text``, ``n_removed`` and ``n_spans``.

    Matches are judged on the bytes of the input, never cross rows, and may overlap; a repeated
    row is a copy like any other. NULL texts stay NULL and lose nothing, as do texts shorter than
    ``length``. Texts of any length are read whole, and an empty table gives an empty one. Columns
    of the added names are replaced; no other column is read.
    """
    return _with_removals(docs, removals(docs, key, text, length, **settings), key, text)


def remove_passages(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    words: int = WORDS,
    length: int = LENGTH,
    gram: int = GRAM,
    word_gram: int = WORD_GRAM,
) -> DataFrame:
    """``remove_repeats``, and repeated runs of ``words`` words go whatever their bytes.

    A run of words is repeated when its bytes, whitespace between the words included, are a run
    of whole words anywhere else. Repeated strings below both limits stay.
    """
    if not 0 < word_gram <= words:
        raise ValueError("word_gram must be at most words")
    spark = docs.sparkSession
    texts = _candidates(docs, key, text, length, gram)
    spans = _spans(texts, length, gram, RUN_BYTES, PART_ENTRIES)
    found = texts.select("_row", "_key", "_hash").join(spans, "_row").drop("_row")
    strings = stage(found, "suffix-strings")
    # What the spans were found in goes before the next part writes and shuffles as much.
    remove_staged(spark, found)
    del texts, spans, found
    release_shuffles(spark)
    # Runs of ``length`` bytes or more are among the strings already.
    words_too = _word_spans(_hashed(docs, key, text), words, word_gram, length)
    both = strings.unionByName(words_too)
    by_text = stage(
        both.groupBy("_key", "_hash").agg(
            F.collect_set(F.struct("_from", "_to")).alias("_spans")
        ),
        "suffix-spans",
    )
    remove_staged(spark, both)
    del strings, words_too, both
    release_shuffles(spark)
    return _with_cuts(docs, by_text, key, text)


def _cut_text(data: pa.Array, spans: pa.Array) -> pa.Array:
    """What is left of each text, as ``removals`` has it; NULL where there are no spans."""
    rows = []
    for text, found in zip(data.to_pylist(), spans.to_pylist(), strict=True):
        if found is None:
            rows.append(None)
            continue
        kept, removed, runs = cut(text, [(s["_from"], s["_to"]) for s in found])
        rows.append({"clean_text": kept.decode("utf-8", "ignore"), "n_removed": removed,
                     "n_spans": runs})
    return pa.array(rows, pa.struct({"clean_text": pa.string(), "n_removed": pa.int64(),
                                     "n_spans": pa.int64()}))


def _with_cuts(docs: DataFrame, spans: DataFrame, key: str, text: str) -> DataFrame:
    """``_with_removals`` from rows (_key, _hash, _spans), one for each text: texts move once."""
    plain = docs.drop("clean_text", "n_removed", "n_spans", "_text_hash")
    hashed = plain.withColumn("_text_hash", F.xxhash64(text_bytes(text)))
    joined = hashed.alias("d").join(
        spans.alias("g"),
        F.col(f"d.{key}").eqNullSafe(F.col("g._key"))
        & (F.col("d._text_hash") == F.col("g._hash")),
        "left",
    )
    data = F.when(F.col("g._spans").isNotNull(), text_bytes(f"d.{text}"))
    # Else a filter on the clean text would be pushed below, and every text be cut twice.
    names = "clean_text string, n_removed long, n_spans long"
    once = F.arrow_udf(_cut_text, names).asNondeterministic()
    done = joined.select(
        *(F.col(f"d.{c}") for c in plain.columns), once(data, F.col("g._spans")).alias("_text_hash")
    )
    return done.select(
        *plain.columns,
        F.coalesce("_text_hash.clean_text", F.col(text)).alias("clean_text"),
        F.coalesce("_text_hash.n_removed", F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("_text_hash.n_spans", F.lit(0)).cast("long").alias("n_spans"),
    )


def _with_removals(docs: DataFrame, gone: DataFrame, key: str, text: str) -> DataFrame:
    plain = docs.drop("clean_text", "n_removed", "n_spans", "_text_hash")
    hashed = plain.withColumn("_text_hash", F.xxhash64(text_bytes(text)))
    return _joined(hashed, gone, key).select(
        *(F.col(f"d.{c}") for c in plain.columns),
        F.coalesce("clean_text", F.col(f"d.{text}")).alias("clean_text"),
        F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("n_spans", F.lit(0)).cast("long").alias("n_spans"),
    )


def repeat_digests(
    docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH, **settings
) -> DataFrame:
    """(key, n_bytes, n_removed, n_spans, kept_sha256, n_kept) of every row.

    See ``remove_repeats``, also for NULLs, repeated rows and very long texts. Texts that lose
    nothing are hashed where they are read.
    """
    gone = removals(docs, key, text, length, **settings).withColumn(
        "_kept_sha256", F.sha2("kept", 256)
    ).drop("kept", "clean_text")
    hashed = docs.select(
        F.col(key),
        F.xxhash64(text_bytes(text)).alias("_text_hash"),
        F.octet_length(text_bytes(text)).cast("long").alias("n_bytes"),
        F.sha2(text_bytes(text), 256).alias("_whole_sha256"),
    )
    return _joined(hashed, gone, key).select(
        F.col(f"d.{key}"),
        "n_bytes",
        F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("n_spans", F.lit(0)).cast("long").alias("n_spans"),
        F.coalesce("_kept_sha256", "_whole_sha256").alias("kept_sha256"),
        (F.col("n_bytes") - F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_kept"),
    )
