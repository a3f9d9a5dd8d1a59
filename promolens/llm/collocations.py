"""Collocations: counted phrases of up to four words, mined from tiles of frequency-ranked ids.

Texts are read once, in blocks that hold their distinct words and the text as word numbers. Words
get ids by descending frequency. A block counts the pairs of neighbouring ids by direct address: the
grid of (left, right) is cut into square tiles, and low ids make the first tiles the full ones. A
tile with many pairs is counted in a dense array, all others as sorted coordinates. The blocks'
counts meet by pair; pairs that are frequent are ranked again and take the place of the ids, so that
the next round counts pairs of overlapping pairs, which are phrases of one word more. A phrase can
only be frequent if both its halves of a round are, so nothing is lost.

No task sees more than a block or its share of the pairs, and no table is sent to all.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from promolens.llm.common import map_batches, text_bytes
from promolens.session import release_shuffles, remove_staged, stage

MIN_COUNT = 30
MAX_WORDS = 4
TOP = 2000
CONTAINED_PERCENT = 80
UNKNOWN = "und"
BLOCK_BYTES = 12 << 20
TILE = 1024  # ids a side
DENSE = TILE * TILE // 8  # pairs that make a tile worth an array
CHUNK = 1 << 16  # rows of a batch that goes back to Spark
SPREAD = 64  # parts of a language that are cut to the top before the last ranking
# What ends a piece, and A-Z to a-z; a tab is a space.
_ENDS = b".,;:!?\n\x0b\x0c\r"
_READ = bytes.maketrans(
    _ENDS + b"\t" + bytes(range(0x41, 0x5B)), b"\n" * len(_ENDS) + b" " + bytes(range(0x61, 0x7B))
)
_BREAK, _NOTHING = -1, -2


def words_and_breaks(data: bytes) -> list[bytes]:
    """The words of a text, a line break between pieces, and empty strings without meaning."""
    return data.translate(_READ).replace(b"\n", b" \n ").split(b" ")


def pack(values: np.ndarray) -> bytes:
    """Whole numbers, byte plane by byte plane."""
    planes = np.ascontiguousarray(values.astype("<i8").view(np.uint8).reshape(-1, 8).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpack(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    return np.ascontiguousarray(planes.reshape(8, -1).T).view("<i8").ravel()


def count_pairs(
    left: np.ndarray, right: np.ndarray, size: int, tile: int = TILE, dense: int = DENSE
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct pairs of numbers below ``size`` and their counts, tile by tile."""
    side = -(-size // tile)
    number = (left // tile) * side + right // tile
    inside = (left % tile) * tile + right % tile
    tiles, held = np.unique(number, return_counts=True)
    full = tiles[held >= dense]
    found: list[tuple[np.ndarray, np.ndarray]] = []
    rest = np.ones(len(number), bool)
    for t in full.tolist():
        here = number == t
        rest &= ~here
        counts = np.bincount(inside[here], minlength=tile * tile)
        cells = np.flatnonzero(counts)
        found.append((t * tile * tile + cells, counts[cells]))
    some = number[rest] * (tile * tile) + inside[rest]
    del number, inside, rest
    found.append(np.unique(some, return_counts=True))
    at, counts = (np.concatenate(x) for x in zip(*found, strict=True))
    number, inside = at // (tile * tile), at % (tile * tile)
    return (
        number // side * tile + inside // tile,
        number % side * tile + inside % tile,
        counts.astype(np.int64),
    )


def neighbours(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Where a known symbol follows another, and both as places among the distinct symbols.

    Those are in order of the ids, so the order by frequency holds among them too.
    """
    at = np.flatnonzero((symbols[:-1] >= 0) & (symbols[1:] >= 0))
    distinct = np.unique(np.concatenate([np.unique(symbols[i]) for i in (at, at + 1)]))
    left, right = (np.searchsorted(distinct, symbols[i]) for i in (at, at + 1))
    return at, left, right, distinct


def pair_columns(symbols: np.ndarray) -> dict[str, np.ndarray]:
    left, right, distinct = neighbours(symbols)[1:]
    a, b, n = count_pairs(left, right, max(len(distinct), 1))
    return {"left": distinct[a], "right": distinct[b], "n": n}


def _read_blocks(block_bytes: int):
    def run(batches: Iterator[dict]) -> Iterator[dict]:
        numbers = itertools.count(TaskContext.get().partitionId() << 32)
        by_lang: dict[str, _Words] = {}
        taken = itertools.count()
        parts: list[np.ndarray] = []
        size = 0

        def flush() -> dict:
            symbols = np.concatenate(parts)
            symbols = symbols[symbols != _NOTHING]
            total = next(taken)
            counts = np.bincount(symbols[symbols >= 0], minlength=total)
            out = {c: [] for c in ("block", "symbols", "lang", "word", "number", "n", "total")}
            block = next(numbers)

            def add(*row) -> None:
                for c, v in zip(out, row, strict=True):
                    out[c].append(v)

            add(block, pack(symbols), None, [], [], [], 0)
            for lang, words in by_lang.items():
                known = [(w, i) for w, i in words.items() if i >= 0]
                at = np.array([i for _, i in known], np.int64)
                add(block, None, lang, [w for w, _ in known], at, counts[at],
                    int(counts[at].sum()))
            by_lang.clear()
            parts.clear()
            return out

        for batch in batches:
            for lang, data in zip(batch["_lang"], batch["_data"], strict=True):
                words = by_lang.get(lang)
                if words is None:
                    words = by_lang[lang] = _Words(taken)
                text = words_and_breaks(data)
                parts.append(np.fromiter(map(words.__getitem__, text), np.int64, len(text)))
                parts.append(np.array([_BREAK], np.int64))
                size += len(data)
                if size >= block_bytes:
                    yield flush()
                    taken, size = itertools.count(), 0
        if parts:
            yield flush()

    return run


class _Words(dict):
    """Numbers of the words of a language in a block."""

    def __init__(self, numbers: Iterator[int]):
        super().__init__({b"": _NOTHING, b"\n": _BREAK})
        self.numbers = numbers

    def __missing__(self, word: bytes) -> int:
        number = self[word] = next(self.numbers)
        return number


def ranked(counted: DataFrame, keys: list[str], name: str) -> DataFrame:
    """``counted`` with ``id``: its place by descending ``n``, then by the keys.

    Sorted by ranges; only the number of rows of each range is gathered.
    """
    rows = stage(
        counted.repartitionByRange(F.desc("n"), *keys)
        .sortWithinPartitions(F.desc("n"), *keys)
        .withColumn("_at", F.monotonically_increasing_id()),
        f"collocations-{name}",
    )
    part = F.shiftrightunsigned("_at", 33)
    sizes = sorted(rows.groupBy(part.alias("part")).count().collect())
    ends = list(itertools.accumulate(r["count"] for r in sizes))
    before = [(r["part"], e - r["count"]) for r, e in zip(sizes, ends, strict=True)]
    offsets = rows.sparkSession.createDataFrame(before, "_part long, _before long")
    return (
        rows.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")  # one row a range
        .withColumn("id", F.col("_before") + F.col("_at").bitwiseAND((1 << 33) - 1))
        .drop("_part", "_before", "_at")
    )


# A row with the symbols of a block, and one for each distinct pair.
_BLOCK = "block long, symbols binary, left long, right long, n long"


def _block_table(block: int, symbols: np.ndarray) -> pa.Table:
    columns = {c: pa.array(v, pa.int64()) for c, v in pair_columns(symbols).items()}
    size = len(columns["n"])
    none = pa.array([None], pa.int64())
    table = pa.table(
        {
            "block": pa.array(np.full(size + 1, block), pa.int64()),
            "symbols": pa.concat_arrays(
                [pa.array([pack(symbols)], pa.binary()), pa.nulls(size, pa.binary())]
            ),
            **{c: pa.concat_arrays([none, v]) for c, v in columns.items()},
        }
    )
    # Each chunk is a batch of its own, so that Spark never holds a block's pairs at once.
    return pa.Table.from_batches(table.to_batches(max_chunksize=CHUNK))


def _name_words(key: tuple, block: pa.Table, words: pa.Table) -> pa.Table:
    """Put ids in the place of a block's word numbers; words that are not frequent go."""
    symbols = unpack(block.column("symbols")[0].as_py())
    ids = np.full(max(int(symbols.max(initial=_BREAK)) + 1, 1), _BREAK, np.int64)
    ids[words.column("number").to_numpy()] = words.column("id").to_numpy()
    return _block_table(key[0].as_py(), np.where(symbols >= 0, ids[symbols], _BREAK))


def _name_pairs(key: tuple, block: pa.Table, pairs: pa.Table) -> pa.Table:
    """Put the ids of frequent pairs at the place of their first symbol."""
    symbols = unpack(block.column("symbols")[0].as_py())
    at, left, right, distinct = neighbours(symbols)
    out = np.full(len(symbols), _BREAK, np.int64)
    size = max(len(distinct), 1)
    known = np.searchsorted(distinct, pairs.column("left").to_numpy()) * size
    known += np.searchsorted(distinct, pairs.column("right").to_numpy())
    order = np.argsort(known)
    known, ids = known[order], pairs.column("id").to_numpy()[order]
    if len(known):
        wanted = left * size + right
        place = np.minimum(np.searchsorted(known, wanted), len(known) - 1)
        out[at] = np.where(known[place] == wanted, ids[place], _BREAK)
        del wanted, place
    del symbols, at, left, right, distinct, known, order, ids
    return _block_table(key[0].as_py(), out)


def _level(df: DataFrame, side: str) -> DataFrame:
    """The table of the shorter phrases, as it is joined to one side of the longer ones."""
    kept = ["lang", "phrase", "pre"] if side == "left" else ["phrase", "suf"]
    return df.select(
        F.col("id").alias(side), F.col("n").alias(f"n_{side}"),
        *(F.col(c).alias(f"{side}_{c}") for c in kept),
    )


def _last_word(phrase: Column) -> Column:
    return F.substring_index(phrase, " ", -1)


def phrases(
    docs: DataFrame,
    min_count: int = MIN_COUNT,
    max_words: int = MAX_WORDS,
    text: str = "text",
    lang: str = "lang",
    block_bytes: int = BLOCK_BYTES,
) -> tuple[list[DataFrame], DataFrame]:
    """Frequent phrases by number of words, from one, and the number of words of each language.

    (id, lang, phrase, n, pre, suf, left, right): ``n`` occurrences; ``pre`` and ``suf`` are the
    occurrences of the first and last 1, 2, ... words; ``left`` and ``right`` the ids of the phrases
    without the last and without the first word. All are staged tables.
    """
    rows = docs.select(
        F.coalesce(F.col(lang).cast("string"), F.lit(UNKNOWN)).alias("_lang"),
        text_bytes(text).alias("_data"),
    )
    read = stage(
        map_batches(
            rows,
            _read_blocks(block_bytes),
            "block long, symbols binary, lang string, word array<binary>, number array<long>, "
            "n array<long>, total long",
        ),
        "collocations-read",
    )
    totals = stage(
        read.where("lang IS NOT NULL").groupBy("lang").agg(F.sum("total").alias("total")),
        "collocations-totals",
    )
    words = read.where("lang IS NOT NULL").select(
        "block", "lang", F.inline(F.arrays_zip("word", "number", "n"))
    )
    counted = words.groupBy("lang", "word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)
    none = F.array().cast("array<long>")
    level = stage(
        ranked(counted, ["lang", "word"], "words").select(
            "id", "lang", "word", F.col("word").cast("string").alias("phrase"), "n",
            none.alias("pre"), none.alias("suf"), F.lit(None).cast("long").alias("left"),
            F.lit(None).cast("long").alias("right"),
        ),
        "collocations-1",
    )
    named = words.join(level.select("lang", "word", "id"), ["lang", "word"])
    blocks = stage(
        read.where("lang IS NULL").select("block", "symbols").groupBy("block")
        .cogroup(named.select(F.col("block").alias("_block"), "number", "id").groupBy("_block"))
        .applyInArrow(_name_words, _BLOCK),
        "collocations-blocks",
    )
    remove_staged(docs.sparkSession, read)
    release_shuffles(docs.sparkSession)
    levels = [level.drop("word")]
    for size in range(2, max_words + 1):
        pairs = blocks.where("n IS NOT NULL").select("block", "left", "right", "n")
        if size < max_words:
            # The rows of a pair, one a block at most, meet once; only those of frequent pairs,
            # which are few, are written and meet their ids.
            total = F.sum("n").over(Window.partitionBy("left", "right"))
            often = stage(
                pairs.withColumn("n", total).where(F.col("n") >= min_count), "collocations-often"
            )
            release_shuffles(docs.sparkSession)
            counted = often.select("left", "right", "n").distinct()
        else:
            counted = (
                pairs.groupBy("left", "right").agg(F.sum("n").alias("n"))
                .where(F.col("n") >= min_count)
            )
        found = stage(ranked(counted, ["left", "right"], "pairs"), "collocations-ids")
        if size < max_words:
            named = often.select("block", "left", "right").join(
                found.select("left", "right", "id"), ["left", "right"]
            )
            following = stage(
                blocks.where("symbols IS NOT NULL").select("block", "symbols").groupBy("block")
                .cogroup(
                    named.select(F.col("block").alias("_block"), "left", "right", "id")
                    .groupBy("_block")
                )
                .applyInArrow(_name_pairs, _BLOCK),
                "collocations-blocks",
            )
            remove_staged(docs.sparkSession, blocks)
            remove_staged(docs.sparkSession, often)
            release_shuffles(docs.sparkSession)
            blocks = following
        level = stage(
            found.join(_level(level, "left"), "left")
            .join(_level(level, "right"), "right")
            .select(
                "id", F.col("left_lang").alias("lang"),
                F.concat_ws(" ", "left_phrase", _last_word(F.col("right_phrase"))).alias("phrase"),
                "n", F.concat("left_pre", F.array("n_left")).alias("pre"),
                F.concat("right_suf", F.array("n_right")).alias("suf"), "left", "right",
            ),
            f"collocations-{size}",
        )
        levels.append(level)
    remove_staged(docs.sparkSession, blocks)
    release_shuffles(docs.sparkSession)
    return levels, totals


def _cuts(size: int) -> Column:
    """(score, k, l, r) of the lowest-scoring cut, the smallest ``k`` of equal ones."""

    def cut(k: int) -> Column:
        sides = f"CAST(pre[{k - 1}] AS DECIMAL(20,0)) + CAST(suf[{size - k - 1}] AS DECIMAL(20,0))"
        return F.struct(
            F.expr(f"CAST(2000000 AS DECIMAL(7,0)) * CAST(n AS DECIMAL(20,0)) DIV ({sides})")
            .alias("score"),
            F.lit(k).alias("k"),
            F.expr(f"pre[{k - 1}]").alias("l"),
            F.expr(f"suf[{size - k - 1}]").alias("r"),
        )

    return F.array_min(F.array(*(cut(k) for k in range(1, size))))


def _without_contained(shorter: DataFrame, longer: DataFrame | None, percent: int) -> DataFrame:
    """Phrases whose words are not nearly always part of one longer phrase.

    Phrases of one word more suffice: they occur at least as often as any longer one around them.
    """
    if longer is None:
        return shorter
    around = (
        longer.select(F.col("left").alias("id"), "n")
        .unionAll(longer.select(F.col("right").alias("id"), "n"))
        .groupBy("id").agg(F.max("n").alias("around"))
    )
    wide = "CAST({} AS DECIMAL(20,0)) * {}"
    often = F.expr(f"{wide.format('around', 100)} >= {wide.format('n', percent)}")
    return shorter.join(around, "id", "left").where(F.col("around").isNull() | ~often)


def collocations(
    docs: DataFrame,
    min_count: int = MIN_COUNT,
    max_words: int = MAX_WORDS,
    top: int = TOP,
    contained_percent: int = CONTAINED_PERCENT,
    text: str = "text",
    lang: str = "lang",
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``top`` phrases of each language.

    NULL languages count as ``und``; NULL and empty texts have no words and a table without rows
    gives none. Texts are read whole, whatever their length; repeated rows count each time. Equal
    scores go by occurrences, then by the bytes of the phrase, so ranks are unique. Only the named
    columns are read, so others cannot clash.
    """
    levels, totals = phrases(docs, min_count, max_words, text, lang)
    scored = None
    for at, level in enumerate(levels[1:], 1):
        longer = levels[at + 1] if at + 1 < len(levels) else None
        some = _without_contained(level, longer, contained_percent).select(
            "lang", "phrase", F.col("n").alias("a"), _cuts(at + 1).alias("cut")
        )
        scored = some if scored is None else scored.unionAll(some)
    rows = scored.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    part = F.pmod(F.xxhash64("phrase"), F.lit(SPREAD))
    within = Window.partitionBy("lang", "_part").orderBy(*order)
    first = (
        rows.withColumn("_part", part).withColumn("rank", F.row_number().over(within))
        .where(F.col("rank") <= top)
    )
    whole = Window.partitionBy("lang").orderBy(*order)
    last = first.withColumn("rank", F.row_number().over(whole)).where(F.col("rank") <= top)
    return last.join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r",
        F.col("total").alias("n"), "score",
    )
