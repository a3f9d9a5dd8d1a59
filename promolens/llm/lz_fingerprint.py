"""Lempel-Ziv phrase fingerprints: minimum hashes over the phrases of a dictionary parse."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from promolens.llm.common import map_batches, mix, text_bytes

SIZE = 64  # minimum hashes in a signature, 16 bits of each are kept
_MULTIPLIER, _MASK = 0x9E3779B97F4A7C15, (1 << 64) - 1


class Parse:
    """A growing Lempel-Ziv (1978) dictionary: each phrase is a known phrase and one more byte."""

    __slots__ = ("hashes", "node", "table")

    def __init__(self):
        # Phrase number times 256, or with the next byte -> number of the longer phrase times 256.
        self.table: dict[int, int] = {}
        self.hashes = [0]
        self.node = 0

    def fork(self) -> Parse:
        other = Parse()
        other.table, other.hashes, other.node = self.table.copy(), [*self.hashes], self.node
        return other

    def feed(self, data: bytes) -> np.ndarray:
        """Go on with ``data``; the hashes of the phrases that it completes."""
        table, hashes, node = self.table, self.hashes, self.node
        get, first = table.get, len(hashes)
        for byte in data:
            longer = get(node | byte)
            if longer is None:
                table[node | byte] = len(hashes) << 8
                hashes.append((hashes[node >> 8] * _MULTIPLIER + byte + 1) & _MASK)
                node = 0
            else:
                node = longer
        self.node = node
        return np.array(hashes[first:], np.uint64)


def signature(phrases: np.ndarray, size: int) -> np.ndarray:
    """Smallest value of each of ``size`` hash functions; all ones without a phrase."""
    low = np.full(size, np.uint64(_MASK))
    salts = mix(np.arange(1, size + 1, dtype=np.uint64))[:, None]
    for at in range(0, len(phrases), 4096):
        v = (mix(phrases[at : at + 4096]) ^ salts) * np.uint64(0xD6E8FEB86659FD93)
        v ^= v >> np.uint64(29)
        np.minimum(low, v.min(axis=1), out=low)
    return low


def fingerprint_string(low: np.ndarray) -> str:
    """16 bits of each minimum, mixed first: the high bits of a minimum of many are all zeros."""
    return (mix(low) >> np.uint64(48)).astype(">u2").tobytes().hex()


def likeness(a: str, b: str) -> float:
    """Share of the minimum hashes in which two fingerprints agree."""
    size = len(a) // 4
    return sum(a[i : i + 4] == b[i : i + 4] for i in range(0, 4 * size, 4)) / size


def fingerprint(text: str | None, size: int = SIZE) -> str:
    return fingerprint_string(signature(Parse().feed((text or "").encode()), size))


def edited_text(text: str, following: str) -> str:
    """The last half of the code points replaced by the first as many of the next text."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def both_fingerprints(text: str, following: str, size: int) -> tuple[str, str, str]:
    """Fingerprint, edited text's fingerprint and SHA-256. The common first half is parsed once."""
    half = len(text) // 2
    start, end, other = text[: len(text) - half], text[len(text) - half :], following[:half]
    parse = Parse()
    head = signature(parse.feed(start.encode()), size)
    fork = parse.fork()
    own = np.minimum(head, signature(parse.feed(end.encode()), size))
    edited = np.minimum(head, signature(fork.feed(other.encode()), size))
    digest = hashlib.sha256((start + other).encode()).hexdigest()
    return fingerprint_string(own), fingerprint_string(edited), digest


def _key_buckets(rows: DataFrame, buckets: int) -> tuple[list[float], DataFrame]:
    """Bounds that cut the keys into even ranges, and rows with their range number."""
    shares = [i / buckets for i in range(1, buckets)]
    bounds = sorted(set(rows.approxQuantile("_key", shares, 0.25 / buckets)) if shares else ())
    number = F.size(F.filter(F.array(*(F.lit(b) for b in bounds)), lambda b: b <= F.col("_key")))
    at = F.when(F.col("_key").isNull(), F.lit(0)).otherwise(number) if bounds else F.lit(0)
    return bounds, rows.withColumn("_bucket", at.cast("int"))


def compare_with_next(
    docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = SIZE
) -> DataFrame:
    """Fingerprints of every text and of its edited form, compared; see ``edited_text``.

    Returns key, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited and
    near_next. The next document is the next row by key (NULL keys first, equal keys by text);
    after the last comes the first, and a single row follows itself. NULL texts are empty; the
    fingerprint of an empty text agrees only with that of texts without a phrase. Texts of any
    length are parsed whole, and an empty table gives an empty one. Only the named
    columns are read, so others cannot clash. Keys are integers.

    Rows are dealt into even key ranges with one shuffle of the texts. Each range also gets the
    first row of the range after it, so the only rows moved twice are one per range.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(key).alias("_key"), text_bytes(text).alias("_data"))
    buckets = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    _, placed = _key_buckets(rows, buckets)
    # One row per range: which range needs a copy of the first row of which other.
    firsts = sorted(
        (r["_bucket"], r["low"], r["nulls"])
        for r in placed.groupBy("_bucket")
        .agg(F.min("_key").alias("low"), F.count_if(F.col("_key").isNull()).alias("nulls"))
        .collect()
    )
    # NULL keys lead the first range.
    lows = [(b, None if nulls else low) for b, low, nulls in firsts]
    tails = [(lows[(i + 1) % len(lows)][1], lows[i][0]) for i in range(len(lows))]
    kind = dict(rows.dtypes)["_key"]
    wanted = spark.createDataFrame(tails, f"_low {kind}, _to int")
    copies = rows.join(
        F.broadcast(wanted), F.col("_key").eqNullSafe(F.col("_low"))
    ).select("_key", "_data", F.col("_to").alias("_bucket"), F.lit(True).alias("_tail"))
    dealt = (
        placed.withColumn("_tail", F.lit(False))
        .unionByName(copies)
        .repartition("_bucket")
        .sortWithinPartitions("_bucket", "_tail", "_key", "_data")
    )
    names = ("_key", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
             "near_edited", "near_next")

    def run(batches: Iterator[dict]) -> Iterator[dict]:
        held = None  # the row before: key, text, range
        waiting = None  # its results without near_next
        out = {c: [] for c in names}

        def close(next_fingerprint: str) -> None:
            for c, v in zip(names, (*waiting, likeness(waiting[3], next_fingerprint)), strict=True):
                out[c].append(v)

        for batch in batches:
            for row, data, bucket, tail in zip(
                batch["_key"], batch["_data"], batch["_bucket"], batch["_tail"], strict=True
            ):
                value = data.decode()
                if held and held[2] == bucket:
                    own, edited, digest = both_fingerprints(held[1], value, size)
                    if waiting:
                        close(own)
                    waiting = (held[0], len(held[1]), digest, own, edited, likeness(own, edited))
                    if tail:
                        close(fingerprint(value, size))
                        waiting = None
                held = None if tail else (row, value, bucket)
            yield out
            out = {c: [] for c in names}

    result = map_batches(
        dealt,
        run,
        f"_key {kind}, n_chars long, edited_sha256 string, fingerprint string, "
        "edited_fingerprint string, near_edited double, near_next double",
    )
    return result.withColumnRenamed("_key", key)
