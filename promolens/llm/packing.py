"""Best-fit packing of documents into fixed-size training sequences, with conflicts."""

from __future__ import annotations

from bisect import bisect_left, insort

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from promolens.session import stage

CAPACITY = 2048
SHARD_ROWS = 4096


def pack(
    sizes: list[int], sources: list[int], clusters: list[int], capacity: int
) -> tuple[list[int], list[int]]:
    """Bin number and offset of each item, taken in the given order.

    Open bins are ordered by what is left in them. The search starts at the successor of the
    item's size and goes on to the next larger rest until a bin has neither the item's source
    nor its cluster (negative: no such conflict); ties take the oldest bin. Bins carry both
    sets as bitmaps.
    """
    open_bins: list[tuple[int, int]] = []
    source_bits: list[int] = []
    cluster_bits: list[int] = []
    placed, offsets = [], []
    for size, source, cluster in zip(sizes, sources, clusters, strict=True):
        source_bit = 1 << source if source >= 0 else 0
        cluster_bit = 1 << cluster if cluster >= 0 else 0
        at = bisect_left(open_bins, (size, -1))
        while at < len(open_bins):
            number = open_bins[at][1]
            if not (source_bits[number] & source_bit or cluster_bits[number] & cluster_bit):
                break
            at += 1
        if at < len(open_bins):
            rest, number = open_bins.pop(at)
        else:
            rest, number = capacity, len(source_bits)
            source_bits.append(0)
            cluster_bits.append(0)
        source_bits[number] |= source_bit
        cluster_bits[number] |= cluster_bit
        insort(open_bins, (rest - size, number))
        placed.append(number)
        offsets.append(capacity - rest)
    return placed, offsets


def _codes(values: pd.Series, only_repeated: bool) -> list[int]:
    """Small numbers for equal values; -1 for NULL, and for single values if asked."""
    codes = pd.Series(pd.factorize(values, use_na_sentinel=True)[0])
    if only_repeated:
        codes = codes.where(codes.map(codes.value_counts()) > 1, -1)
        codes = pd.Series(pd.factorize(codes.where(codes >= 0))[0])
    return codes.tolist()


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def copy_cluster(text: Column) -> Column:
    """Equal for texts with the same words up to the case of letters; NULL for NULL."""
    return F.xxhash64(F.lower(F.regexp_replace(F.trim(text), r"[\x20\x09-\x0D]+", " ")))


def pack_documents(
    docs: DataFrame,
    size: Column,
    cluster: Column,
    key: str = "doc_id",
    source: str = "source",
    capacity: int = CAPACITY,
    shard_rows: int = SHARD_ROWS,
) -> DataFrame:
    """One row per piece: key, piece, bin_id, bin_offset, size, source, cluster.

    A document longer than ``capacity`` is cut into full pieces, which have bins of their own,
    and a rest. No bin holds two pieces of one source or of one cluster. Rows are dealt evenly
    over shards of about ``shard_rows`` (by row, so one source, cluster or key cannot fill a
    shard), and each shard is packed by itself, largest piece first, ties by key.

    NULL or negative sizes count as 0; NULL sources and clusters conflict with nothing; repeated
    rows are packed once each. Only the named columns are read, so others cannot clash.
    """
    if capacity < 1:
        raise ValueError("capacity must be positive")
    rows = stage(
        docs.select(
            F.col(key).alias("key"),
            F.col(source).cast("string").alias("source"),
            F.greatest(F.coalesce(size, F.lit(0)), F.lit(0)).cast("long").alias("total"),
            cluster.cast("string").alias("cluster"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "packing",
    )
    shards = max(1, -(-rows.count() // shard_rows))
    key_type = dict(rows.dtypes)["key"]
    schema = (
        f"key {key_type}, piece long, bin_id long, bin_offset long, size long, source string, "
        "cluster string"
    )

    def one_shard(rows: pd.DataFrame) -> pd.DataFrame:
        shard = int(rows["shard"].iloc[0])
        rows = rows.assign(rest=rows["total"] % capacity, full=rows["total"] // capacity)
        rows = rows.sort_values(["rest", "key", "row"], ascending=[False, True, True])
        rows = rows.reset_index(drop=True)
        partly = rows[(rows["rest"] > 0) | (rows["full"] == 0)].reset_index(drop=True)
        bins, offsets = pack(
            partly["rest"].tolist(),
            _codes(partly["source"], only_repeated=False),
            _codes(partly["cluster"], only_repeated=True),
            capacity,
        )
        rests = partly.assign(piece=partly["full"], bin=bins, bin_offset=offsets)
        rests = rests.assign(size=rests["rest"])
        whole = rows.loc[rows.index.repeat(rows["full"])].copy()
        whole["piece"] = whole.groupby("row").cumcount()
        first = max(bins, default=-1) + 1
        whole = whole.assign(bin=range(first, first + len(whole)), bin_offset=0, size=capacity)
        out = pd.concat([rests, whole], ignore_index=True)
        out["bin_id"] = (shard << 32) + out["bin"]
        return out[["key", "piece", "bin_id", "bin_offset", "size", "source", "cluster"]]

    dealt = rows.withColumn("shard", F.pmod(F.xxhash64("row"), F.lit(shards)))
    return dealt.groupBy("shard").applyInPandas(one_shard, schema).withColumnRenamed("key", key)
