"""Quality rules: per-text statistics and cross-document line frequency."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from promolens.llm.common import WordHashes, map_batches, text_bytes, word_codes
from promolens.session import stage

SYMBOLS = b"#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MIN_DOCS = 10
MAX_SHARE = 0.01
MIN_LEFT_PERCENT = 30

_BLANK = xxhash.xxh3_64_intdigest(b"") - (1 << 63)  # lines without a word, never removed
_STATS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"


def repeat_words(codes: np.ndarray) -> int:
    """Words inside 3-word windows that the text holds twice or more, first ones included."""
    n = len(codes)
    if n < 4:
        return 0
    _, ids = np.unique(codes, return_inverse=True)
    ids = ids.astype(np.int64)
    _, pairs = np.unique(ids[:-1] * (ids.max() + 1) + ids[1:], return_inverse=True)
    _, windows, counts = np.unique(
        pairs[:-1].astype(np.int64) * (ids.max() + 1) + ids[2:],
        return_inverse=True,
        return_counts=True,
    )
    twice = counts[windows] > 1
    covered = np.zeros(n, bool)
    for i in range(3):
        covered[i : n - 2 + i] |= twice
    return int(covered.sum())


def text_stats(data: bytes, cache: WordHashes) -> tuple[int, int, int, int, int]:
    """n_words, word_chars (code points), n_symbols, n_dup_lines, n_repeat_words of a text."""
    codes = word_codes(data, cache)
    raw = np.frombuffer(data, np.uint8)
    space = (raw == 0x20) | ((raw >= 0x09) & (raw <= 0x0D))
    follow = (raw & 0xC0) == 0x80
    symbols = int(np.isin(raw, np.frombuffer(SYMBOLS, np.uint8)).sum())
    seen: set[bytes] = set()
    repeated = 0
    for line in data.split(b"\n"):
        if line in seen:
            repeated += 1
        elif line.strip():
            seen.add(line)
    chars = len(raw) - int(space.sum()) - int(follow.sum())
    return len(codes), chars, symbols, repeated, repeat_words(codes)


def normalise_line(line: bytes) -> bytes:
    """A-Z in lower case, digits as 0, words joined by single spaces."""
    folded = line.lower().translate(bytes.maketrans(b"123456789", b"000000000"))
    return b" ".join(folded.split())


def _measure(batches: Iterator[dict], carried: tuple[str, ...]) -> Iterator[dict]:
    cache = WordHashes()
    for batch in batches:
        stats, lines, words = [], [], []
        for data in batch["_data"]:
            stats.append(text_stats(data, cache))
            keys = [normalise_line(line) for line in data.split(b"\n")]
            lines.append([xxhash.xxh3_64_intdigest(k) - (1 << 63) for k in keys])
            words.append([k.count(b" ") + 1 if k else 0 for k in keys])
        names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
        yield {
            **{c: batch[c] for c in carried},
            **{name: [s[i] for s in stats] for i, name in enumerate(names)},
            "_lines": lines,
            "_line_words": words,
        }


def quality_rules(
    docs: DataFrame,
    key: str = "doc_id",
    host: str = "source",
    text: str = "text",
    min_words: int = MIN_WORDS,
    max_repeat_percent: int = MAX_REPEAT_PERCENT,
    min_docs: int = MIN_DOCS,
    max_share: float = MAX_SHARE,
    min_left_percent: int = MIN_LEFT_PERCENT,
    with_text: bool = False,
) -> DataFrame:
    """Per row: key, text statistics, ``base_failed``, removed lines, words left and ``kept``.

    A normalised line is above the limits of a host when at least ``min_docs`` of its documents
    hold it and they are more than ``max_share`` of all its documents. Such lines are removed:
    ``removed_lines`` has their places among the lines of the text, from 0, and ``with_text``
    adds ``clean_text``, the text without them. A document with fewer than ``min_left_percent``
    of its words left is depleted and rejected. Both limits read all documents. NULL text counts
    as empty (and fails the base rule; its clean text is empty), a NULL host is a host of its
    own, repeated rows are judged one by one, texts of any length are read whole, and an empty
    table gives an empty one. Other columns of ``docs`` are not read, so their names cannot clash.
    """
    rows = docs.select(
        F.col(key).alias("_key"), F.col(host).alias("_host"), text_bytes(text).alias("_data")
    )
    types = dict(rows.dtypes)
    carried = ("_key", "_host", "_data") if with_text else ("_key", "_host")
    measured = stage(
        map_batches(
            rows,
            lambda batches: _measure(batches, carried),
            f"{', '.join(f'{c} {types[c]}' for c in carried)}, {_STATS}, "
            "_lines array<long>, _line_words array<long>",
        ),
        "quality",
    )
    above = _lines_above(measured, min_docs, max_share)
    # Only lines that some host repeats too often cost a row here; words per (key, host) add up
    # over distinct lines, so identical rows of one key are one group with the same sum.
    lines = measured.select(
        "_key", "_host", F.explode(F.arrays_zip("_lines", "_line_words")).alias("l")
    ).select("_key", "_host", F.col("l._lines").alias("line"), F.col("l._line_words").alias("w"))
    removed = (
        lines.alias("d")
        .join(
            above.alias("a"),
            (F.col("d.line") == F.col("a.line"))
            & F.col("d._host").eqNullSafe(F.col("a._host")),
            "left_semi",
        )
        .groupBy("_key", "_host")
        .agg(F.collect_set("line").alias("_gone"))
    )
    stats = measured.alias("m").join(
        removed.alias("r"),
        F.col("m._key").eqNullSafe(F.col("r._key"))
        & F.col("m._host").eqNullSafe(F.col("r._host")),
        "left",
    )
    lost = F.expr(
        "coalesce(aggregate(filter(arrays_zip(_lines, _line_words), "
        "x -> array_contains(_gone, x._lines)), 0L, (s, x) -> s + x._line_words), 0L)"
    )
    places = F.expr(
        "coalesce(filter(sequence(0, size(_lines) - 1), i -> array_contains(_gone, _lines[i])), "
        "cast(array() as array<int>))"
    )
    left = F.expr(
        "array_join(filter(split(cast(_data as string), '\n'), "
        "(x, i) -> not coalesce(array_contains(_gone, _lines[i]), false)), '\n')"
    )
    failed = (F.col("n_words") < min_words) | (
        100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words")
    )
    return stats.select(
        F.col("m._key").alias(key),
        *(F.col(c.split()[0]) for c in _STATS.split(", ")),
        failed.alias("base_failed"),
        places.alias("removed_lines"),
        *([left.alias("clean_text")] if with_text else []),
        (F.col("n_words") - lost).alias("n_words_left"),
    ).withColumn(
        "kept",
        ~F.col("base_failed")
        & (100 * F.col("n_words_left") >= min_left_percent * F.col("n_words")),
    )


def _lines_above(measured: DataFrame, min_docs: int, max_share: float) -> DataFrame:
    hosts = measured.groupBy("_host").agg(F.count(F.lit(1)).alias("host_docs"))
    counted = (
        measured.select("_host", F.explode(F.array_distinct("_lines")).alias("line"))
        .where(F.col("line") != _BLANK)
        .groupBy("_host", "line")
        .agg(F.count(F.lit(1)).alias("n_docs"))
        .where(F.col("n_docs") >= min_docs)
    )
    return counted.alias("c").join(
        hosts.alias("h"), F.col("c._host").eqNullSafe(F.col("h._host"))
    ).where(F.col("n_docs") > F.lit(max_share) * F.col("host_docs")).select("c._host", "line")
