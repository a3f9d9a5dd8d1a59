"""Ranked lexical search over K2-treaps of the term-document grid.

Documents are indexed in blocks. The grid of a block has its terms as rows, the most frequent first,
and its documents as columns, the shortest first, so that like values lie together; a point holds
the impact of the term in the document. The grid is halved in both directions until single points
remain. A level of this quadtree stores four bits a cell for the quadrants that hold points, and how
far the largest impact of each quadrant stays below that of its parent.

A search takes all items through a block side by side. An item's state is a range of documents with
the cell of each of its rows; weights times largest impacts bound every score in the range. The
ranges with the highest bounds are halved first, in rounds that double, until no bound reaches the
item's last place. So all documents are ranked exactly, and most are never looked at.
"""

from __future__ import annotations

import itertools
import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from promolens.llm.common import map_batches, text_bytes
from promolens.session import stage

TOP = 20
BLOCK_BYTES = 8 << 20
BATCH_ITEMS = 2000  # items that go through the blocks together
BATCH_BYTES = 4 << 20
SIDE_BY_SIDE = 25  # items in one search: bounds its memory
FIRST_ROUND = 64
SPREAD = 256  # groups of blocks whose best documents are ranked before all are
# A-Z to a-z; other ASCII than letters and digits ends a term.
_READ = bytes(
    b + 32 if 0x41 <= b <= 0x5A
    else b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A
    else 0x20
    for b in range(256)
)
_BITS = np.array([bin(i).count("1") for i in range(16)], np.int64)


def terms(data: bytes) -> list[bytes]:
    """The terms of a text, in order."""
    return data.translate(_READ).split()


def _squeeze(values: np.ndarray) -> bytes:
    """Numbers from 0 to 2**32 - 1 by byte plane; planes of zeros cost nothing worth naming."""
    planes = np.ascontiguousarray(values.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def _widen(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    return np.ascontiguousarray(planes.reshape(4, -1).T).view("<u4").ravel().astype(np.int64)


def _spread_bits(values: np.ndarray) -> np.ndarray:
    """Bit ``i`` of each number (below 2**31) moved to bit ``2 i``."""
    v = values.astype(np.uint64)
    for shift, keep in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF),
                        (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333),
                        (1, 0x5555555555555555)):
        v = (v | (v << np.uint64(shift))) & np.uint64(keep)
    return v.astype(np.int64)


@dataclass
class Treap:
    """Levels from the whole grid to single points: quadrant bits and largest impacts."""

    quadrants: list[np.ndarray]  # of each cell of a level, but the last
    largest: list[np.ndarray]  # of each cell of a level
    first: list[np.ndarray] = field(init=False)  # cell of a level that is a cell's first quadrant

    def __post_init__(self) -> None:
        self.first = [
            np.cumsum(_BITS[q], dtype=np.int32) - _BITS[q].astype(np.int32) for q in self.quadrants
        ]

    @property
    def depth(self) -> int:
        return len(self.quadrants)

    @classmethod
    def build(cls, row: np.ndarray, column: np.ndarray, impact: np.ndarray) -> Treap:
        """From points, each (row, column) once."""
        side = max(int(row.max(initial=0)), int(column.max(initial=0))) + 1
        depth = max(1, (side - 1).bit_length())
        code = (_spread_bits(row) << 1) | _spread_bits(column)
        order = np.argsort(code)
        code, largest = code[order], [impact[order]]
        quadrants: list[np.ndarray] = []
        for _ in range(depth):
            parent = code >> 2
            new = np.ones(len(code), bool)
            new[1:] = parent[1:] != parent[:-1]
            starts = np.flatnonzero(new)
            bits = np.left_shift(1, code & 3)
            if len(starts):
                quadrants.append(np.add.reduceat(bits, starts))
                largest.append(np.maximum.reduceat(largest[-1], starts))
            else:
                quadrants.append(bits)
                largest.append(largest[-1])
            code = parent[starts]
        return cls(quadrants[::-1], largest[::-1])

    def pack(self) -> list[bytes]:
        """The top's impact, then for each level its quadrants and the drops to the next one."""
        out = [_squeeze(self.largest[0])]
        for level, quadrants in enumerate(self.quadrants):
            held = quadrants.astype(np.uint8)
            held = np.append(held, np.zeros(len(held) % 2, np.uint8))
            above = np.repeat(self.largest[level], _BITS[quadrants])
            pairs = (held[::2] | (held[1::2] << 4)).tobytes()
            out.append(len(quadrants).to_bytes(8, "little")
                       + zstandard.ZstdCompressor(level=1).compress(pairs))
            out.append(_squeeze(above - self.largest[level + 1]))
        return out

    @classmethod
    def unpack(cls, parts: list[bytes]) -> Treap:
        largest, quadrants = [_widen(parts[0])], []
        for held, drops in zip(parts[1::2], parts[2::2], strict=True):
            size = int.from_bytes(held[:8], "little")
            pairs = np.frombuffer(zstandard.ZstdDecompressor().decompress(held[8:]), np.uint8)
            both = np.stack([pairs & 15, pairs >> 4], axis=1).ravel()[:size]
            quadrants.append(both)
            largest.append(np.repeat(largest[-1], _BITS[both]) - _widen(drops))
        return cls(quadrants, largest)


@dataclass
class _Ranges:
    """Ranges of documents on one level: item, range, bound, and the cells of the item's rows."""

    level: int
    item: np.ndarray
    number: np.ndarray
    bound: np.ndarray
    start: np.ndarray  # of its cells; one more than there are ranges
    entry: np.ndarray
    cell: np.ndarray

    def take(self, some: np.ndarray) -> _Ranges:
        sizes = np.diff(self.start)
        held = np.repeat(some, sizes)
        ends = np.concatenate(([0], np.cumsum(sizes[some])))
        return _Ranges(self.level, self.item[some], self.number[some], self.bound[some], ends,
                       self.entry[held], self.cell[held])


def _halve(
    ranges: _Ranges, treap: Treap, row: np.ndarray, weight: np.ndarray
) -> _Ranges:
    """Both halves of every range that hold a point of one of the rows."""
    level = ranges.level
    bit = (row[ranges.entry] >> (treap.depth - level - 1)) & 1
    quadrants = treap.quadrants[level][ranges.cell].astype(np.int64)
    first = treap.first[level][ranges.cell]
    of = np.repeat(np.arange(len(ranges.item)), np.diff(ranges.start))
    half, entry, cell = [], [], []
    for side in (0, 1):
        at = 2 * bit + side
        here = (quadrants >> at) & 1 == 1
        below = quadrants[here] & (np.left_shift(1, at[here]) - 1)
        half.append(2 * of[here] + side)
        entry.append(ranges.entry[here])
        cell.append(first[here] + _BITS[below].astype(np.int32))
    half, entry, cell = (np.concatenate(x) for x in (half, entry, cell))
    order = np.argsort(half, kind="stable")
    half, entry, cell = half[order], entry[order], cell[order]
    new = np.ones(len(half), bool)
    new[1:] = half[1:] != half[:-1]
    starts = np.flatnonzero(new)
    worth = weight[entry] * treap.largest[level + 1][cell]
    bound = np.add.reduceat(worth, starts) if len(starts) else worth
    parent = half[starts] // 2
    return _Ranges(level + 1, ranges.item[parent], 2 * ranges.number[parent] + half[starts] % 2,
                   bound, np.append(starts, len(half)), entry, cell)


def _best(item: np.ndarray, order: list[np.ndarray], limit: int) -> np.ndarray:
    """The first ``limit`` places of each item when sorted by ``order``."""
    by = np.lexsort((*order[::-1], item))
    sorted_items = item[by]
    new = np.ones(len(by), bool)
    new[1:] = sorted_items[1:] != sorted_items[:-1]
    starts = np.flatnonzero(new)
    place = np.arange(len(by)) - np.repeat(starts, np.diff(np.append(starts, len(by))))
    return by[place < limit]


def search_block(
    treap: Treap,
    keys: np.ndarray,
    item: np.ndarray,
    row: np.ndarray,
    weight: np.ndarray,
    n_items: int,
    top: int = TOP,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(item, column, score) of each item's best documents: highest score, then smallest key.

    Entry ``i`` is a term of ``item[i]``, sorted by item: its row of the grid and its weight.
    """
    starts = np.searchsorted(item, np.arange(n_items + 1))
    some = np.flatnonzero(np.diff(starts) > 0)
    root = _Ranges(0, some, np.zeros(len(some), np.int64), np.full(len(some), np.iinfo(np.int64).max),
                   np.append(starts[some], len(item)), np.arange(len(item), dtype=np.int32),
                   np.zeros(len(item), np.int32))
    waiting = [root] if len(some) and len(treap.largest[-1]) else []
    best = (np.empty(0, np.int64),) * 3
    least = np.zeros(n_items, np.int64)  # score of the last place
    limit = FIRST_ROUND
    while waiting:
        items = np.concatenate([r.item for r in waiting])
        bounds = np.concatenate([r.bound for r in waiting])
        chosen = np.zeros(len(items), bool)
        chosen[_best(items, [-bounds], limit)] = True
        following, at = [], 0
        for ranges in waiting:
            now = chosen[at : at + len(ranges.item)]
            at += len(ranges.item)
            if not now.all():
                following.append(ranges.take(~now))
            if not now.any():
                continue
            halves = _halve(ranges.take(now), treap, row, weight)
            if halves.level == treap.depth:
                found = (halves.item, halves.number, halves.bound)
                merged = [np.concatenate(x) for x in zip(best, found, strict=True)]
                kept = _best(merged[0], [-merged[2], keys[merged[1]]], top)
                kept = kept[merged[2][kept] > 0]
                best = tuple(x[kept] for x in merged)
                full = np.bincount(best[0], minlength=n_items) >= top
                lowest = np.full(n_items, np.iinfo(np.int64).max)
                np.minimum.at(lowest, best[0], best[2])
                least = np.where(full, lowest, 0)
            else:
                following.append(halves)
        waiting = []
        for level in range(treap.depth):
            same = [r for r in following if r.level == level]
            if same:
                joined = _join(same)
                # An equal bound may hide an equal score with a smaller key.
                reach = joined.bound >= np.maximum(least[joined.item], 1)
                if reach.any():
                    waiting.append(joined if reach.all() else joined.take(reach))
        limit *= 2
    return best


def _join(parts: list[_Ranges]) -> _Ranges:
    if len(parts) == 1:
        return parts[0]
    sizes = np.concatenate([np.diff(p.start) for p in parts])
    whole = [np.concatenate([getattr(p, c) for p in parts])
             for c in ("item", "number", "bound", "entry", "cell")]
    return _Ranges(parts[0].level, *whole[:3], np.concatenate(([0], np.cumsum(sizes))), *whole[3:])


class _Numbers(dict):
    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        return number


def _read_blocks(block_bytes: int):
    def run(batches: Iterator[dict]) -> Iterator[dict]:
        blocks = itertools.count(TaskContext.get().partitionId() << 32)
        words, docs = _Numbers(), []
        size = 0

        def flush() -> dict:
            docs.sort(key=lambda d: d[1])
            held = np.concatenate([d[2] for d in docs])
            df = np.bincount(held, minlength=len(words))
            order = np.argsort(-df, kind="stable")
            row = np.empty(len(words), np.int64)
            row[order] = np.arange(len(words))
            listed = list(words)
            lengths = [d[1] for d in docs]
            out = {
                "block": [next(blocks)],
                "keys": [[d[0] for d in docs]],
                "lengths": [lengths],
                "n_docs": [sum(n > 0 for n in lengths)],
                "n_terms": [sum(lengths)],
                "words": [[listed[i] for i in order.tolist()]],
                "df": [df[order]],
                "row": [_squeeze(row[held])],
                "times": [_squeeze(np.concatenate([d[3] for d in docs]))],
                "points": [np.array([len(d[2]) for d in docs], np.int64)],
            }
            words.clear()
            docs.clear()
            return out

        for batch in batches:
            for key, data in zip(batch["_key"], batch["_data"], strict=True):
                found = terms(data)
                numbers = np.fromiter(map(words.__getitem__, found), np.int64, len(found))
                held, times = np.unique(numbers, return_counts=True)
                docs.append((key, len(found), held, times))
                size += len(data)
                if size >= block_bytes:
                    yield flush()
                    size = 0
        if docs:
            yield flush()

    return run


def impacts(times: np.ndarray, length: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """What a term that occurs so often in a document of that length is worth, without weight."""
    m = 100 - 25 + (25 * length * n_docs) // n_terms
    return (1_000_000_000 * times) // (1000 * times + 12 * m)


def _build(n_docs: int, n_terms: int):
    def run(batches: Iterator[dict]) -> Iterator[dict]:
        for batch in batches:
            treaps = []
            for lengths, points, row, times in zip(
                batch["lengths"], batch["points"], batch["row"], batch["times"], strict=True
            ):
                column = np.repeat(np.arange(len(points)), points)
                length = np.repeat(np.array(lengths, np.int64), points)
                worth = impacts(_widen(times), length, n_docs, n_terms)
                treaps.append(Treap.build(_widen(row), column, worth).pack())
            yield {c: batch[c] for c in ("block", "keys", "words", "df")} | {"treap": treaps}

    return run


@dataclass
class Index:
    """``blocks`` is a staged table of treaps over all documents; the counts are the corpus'."""

    blocks: DataFrame
    n_docs: int
    n_terms: int


def build_index(
    docs: DataFrame, key: str = "doc_id", text: str = "text", block_bytes: int = BLOCK_BYTES
) -> Index:
    """Index whole texts, with all their terms.

    A block holds about ``block_bytes`` of text, and one very long text by itself; documents do not
    move, so nothing is shuffled. NULL texts have no terms; repeated rows are documents of their
    own; only the named columns are read.
    """
    rows = docs.select(F.col(key).cast("long").alias("_key"), text_bytes(text).alias("_data"))
    read = stage(
        map_batches(
            rows,
            _read_blocks(block_bytes),
            "block long, keys array<long>, lengths array<long>, n_docs long, n_terms long, "
            "words array<binary>, df array<long>, row binary, times binary, points array<long>",
        ),
        "treap-read",
    )
    total = read.agg(F.sum("n_docs").alias("d"), F.sum("n_terms").alias("t")).first()
    n_docs, n_terms = total["d"] or 0, total["t"] or 0
    blocks = stage(
        map_batches(
            read.drop("n_docs", "n_terms"),
            _build(n_docs, max(n_terms, 1)),
            "block long, keys array<long>, words array<binary>, df array<long>, "
            "treap array<binary>",
        ),
        "treap-blocks",
    )
    return Index(blocks, n_docs, n_terms)


def term_weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def _search(items: list[Counter], weights: dict[bytes, int], top: int):
    """The best documents of every item in each block."""

    def run(batches: Iterator[dict]) -> Iterator[dict]:
        wanted = sorted(weights)
        for batch in batches:
            for block, keys, words, parts in zip(
                *(batch[c] for c in ("block", "keys", "words", "treap")), strict=True
            ):
                needed = set(wanted)
                row_of = {w: i for i, w in enumerate(words) if w in needed}
                treap = Treap.unpack(parts)
                last = np.iinfo(np.int64).max  # no key comes after all keys
                order = np.array([last if k is None else k for k in keys], np.int64)
                for at in range(0, len(items), SIDE_BY_SIDE):
                    some = items[at : at + SIDE_BY_SIDE]
                    entries = [
                        (i, row_of[t], n * weights[t])
                        for i, item in enumerate(some)
                        for t, n in item.items()
                        if t in row_of and weights[t] > 0
                    ]
                    flat = np.array(entries, np.int64).reshape(-1, 3)
                    item, column, score = search_block(
                        treap, order, flat[:, 0], flat[:, 1], flat[:, 2], len(some), top
                    )
                    yield {
                        "block": [block] * len(item),
                        "item": item + at,
                        "doc_id": [keys[c] for c in column.tolist()],
                        "score": score,
                    }

    return run


def _ranks(index: Index, batch: DataFrame, top: int) -> DataFrame:
    """The ranked documents of a bounded set of items."""
    spark = batch.sparkSession
    rows = batch.collect()
    items = [Counter(terms(bytes(r["_data"]))) for r in rows]
    vocabulary = sorted(set().union(*items)) if items else []
    words = spark.createDataFrame([(bytearray(w),) for w in vocabulary], "word binary")
    held = (
        index.blocks.select(F.inline(F.arrays_zip(F.col("words").alias("word"), "df")))
        .join(F.broadcast(words), "word")  # terms of at most BATCH_BYTES of items
        .groupBy("word").agg(F.sum("df").alias("df"))
    )
    weights = {
        bytes(r["word"]): term_weight(index.n_docs, r["df"]) for r in held.collect()
    }
    names = spark.createDataFrame(
        [(i, r["_item"]) for i, r in enumerate(rows)], f"item long, item_id {_kind(batch)}"
    )
    found = map_batches(
        index.blocks.select("block", "keys", "words", "treap"),
        _search(items, weights, top),
        "block long, item long, doc_id long, score long",
    )
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    part = F.pmod(F.xxhash64("block"), F.lit(SPREAD))
    within = Window.partitionBy("item", "_part").orderBy(*order)
    first = (
        found.withColumn("_part", part).withColumn("rank", F.row_number().over(within))
        .where(F.col("rank") <= top)
    )
    last = first.withColumn(
        "rank", F.row_number().over(Window.partitionBy("item").orderBy(*order))
    ).where(F.col("rank") <= top)
    return last.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")


def _kind(batch: DataFrame) -> str:
    return batch.schema["_item"].dataType.simpleString()


def search(
    index: Index,
    items: DataFrame,
    key: str = "item_id",
    text: str = "text",
    top: int = TOP,
    batch_items: int = BATCH_ITEMS,
) -> DataFrame:
    """(item_id, rank, doc_id, score): each item's ``top`` documents of score above 0, from rank 1.

    Items are the query set: they go through all blocks in batches of bounded size. Equal scores go
    by ascending document id, documents without id last, so ranks are unique. Items without terms,
    or with none that occurs, have no rows, and neither has an empty index; each of two equal items
    is ranked by itself.
    """
    asked = items.select(F.col(key).alias("_item"), text_bytes(text).alias("_data"))
    total = asked.agg(F.count("*").alias("n"), F.sum(F.length("_data")).alias("b")).first()
    parts = max(-(-total["n"] // batch_items), -(-(total["b"] or 0) // BATCH_BYTES), 1)
    if parts == 1:
        return _ranks(index, asked, top)
    asked = stage(asked.withColumn("_in", F.pmod(F.xxhash64("_item", "_data"), F.lit(parts))),
                  "treap-items")
    done = [_ranks(index, asked.where(F.col("_in") == i), top) for i in range(parts)]
    out = done[0]
    for other in done[1:]:
        out = out.unionAll(other)
    return out
