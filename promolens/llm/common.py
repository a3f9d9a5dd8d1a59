"""Helpers shared by the operators: word hashes, shingles, Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from promolens.session import tune

EMPTY = np.empty(0, np.uint64)


def prepared(spark: SparkSession) -> SparkSession:
    """The session with the library's settings, and Arrow batches that fit long texts."""
    conf = tune(spark).conf
    conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "16777216")
    return spark


class WordHashes(dict):
    """64-bit hash of a word, remembered. Forgets everything at a million words."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 1_000_000:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def word_codes(data: bytes | None, cache: WordHashes) -> np.ndarray:
    """Hashes of the words ``[^\\x20\\x09-\\x0D]+`` of UTF-8 bytes, in order."""
    words = (data or b"").split()
    return np.fromiter(map(cache.__getitem__, words), np.uint64, len(words))


def mix(values: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    v = values ^ (values >> np.uint64(32))
    v = v * np.uint64(0xD6E8FEB86659FD93)
    v = v ^ (v >> np.uint64(32))
    v = v * np.uint64(0xD6E8FEB86659FD93)
    return v ^ (v >> np.uint64(32))


def window_codes(codes: np.ndarray, n: int) -> np.ndarray:
    """One hash for each window of ``n`` words; for fewer words, one of the whole sequence."""
    if not len(codes):
        return EMPTY
    n = min(n, len(codes))
    size = len(codes) - n + 1
    out = np.full(size, np.uint64(n))
    for i in range(n):
        out = mix(out + codes[i : i + size])
    return out


def shingle_set(data: bytes | None, n: int, cache: WordHashes) -> np.ndarray:
    """Sorted distinct hashes of the ``n``-word windows of a text, A-Z in lower case."""
    return np.unique(window_codes(word_codes((data or b"").lower(), cache), n))


def map_batches(
    df: DataFrame, function: Callable[[Iterator[dict]], Iterator[dict]], schema: str
) -> DataFrame:
    """``mapInArrow`` on columns as Python lists: a dict of lists in, a dict of sequences out."""
    fields = StructType.fromDDL(schema)
    arrow = to_arrow_schema(fields)

    def run(batches):
        for out in function(b.to_pydict() for b in batches):
            yield pa.RecordBatch.from_arrays(
                [pa.array(out[f.name], f.type) for f in arrow], schema=arrow
            )

    return df.mapInArrow(run, fields)


def text_bytes(name: str = "text"):
    """A text column as its UTF-8 bytes, NULL as empty."""
    return F.coalesce(F.col(name).cast("binary"), F.lit(b""))
