"""Byte-level BPE over a global word dictionary: each distinct word is encoded once."""

from __future__ import annotations

import base64
import heapq
import itertools
import re
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import ArrayType, IntegerType, StructType

from promolens.llm.common import map_batches, text_bytes
from promolens.llm.warc import open_store
from promolens.session import stage, staging_path

# Fixed value: the pattern of the byte-level vocabularies.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
BLOCK_BYTES = 16 << 20
CACHE_WORDS = 500_000
ROWS = 64  # texts packed into one row
_NONE = 1 << 62


def load_ranks(path: str) -> dict[bytes, int]:
    """A rank file: a base64 token and its rank on each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(t): int(r) for t, r in (x.split() for x in lines if x.strip())}


def encode_word(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Join the neighbours of lowest rank, leftmost first, until no join has a rank."""
    whole = ranks.get(word)
    if whole is not None:
        return [whole]
    if len(word) > 64:
        return _encode_long(word, ranks)
    get = ranks.get
    parts = [word[i : i + 1] for i in range(len(word))]
    joins = [get(word[i : i + 2], _NONE) for i in range(len(word) - 1)]
    while joins:
        rank = min(joins)
        if rank == _NONE:
            break
        i = joins.index(rank)
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
        del joins[i]
        if i < len(joins):
            joins[i] = get(parts[i] + parts[i + 1], _NONE)
        if i:
            joins[i - 1] = get(parts[i - 1] + parts[i], _NONE)
    return [ranks[part] for part in parts]


def _encode_long(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same with a heap of joins, for words of any length."""
    end = [i + 1 for i in range(len(word))]  # of the part that starts here; 0: joined away
    before = [i - 1 for i in range(len(word))]
    heap: list[tuple[int, int, int]] = []

    def offer(start: int) -> None:
        if start >= 0 and end[start] < len(word):
            stop = end[end[start]]
            rank = ranks.get(word[start:stop])
            if rank is not None:
                heapq.heappush(heap, (rank, start, stop))

    for start in range(len(word) - 1):
        offer(start)
    while heap:
        _, start, stop = heapq.heappop(heap)
        middle = end[start]
        # Stale unless both parts are as they were when this join was offered.
        if not middle or middle >= len(word) or not end[middle] or end[middle] != stop:
            continue
        end[start], end[middle] = stop, 0
        if stop < len(word):
            before[stop] = start
        offer(before[start])
        offer(start)
    out, at = [], 0
    while at < len(word):
        out.append(ranks[word[at : end[at]]])
        at = end[at]
    return out


def pack_numbers(values: np.ndarray) -> bytes:
    """Numbers below 2**32 - 1, byte planes compressed one by one, without the empty ones.

    One is added to each, so that no value is all zeros and the planes tell the length.
    """
    more = (np.asarray(values) + 1).astype("<u4")
    planes = np.ascontiguousarray(more.view(np.uint8).reshape(-1, 4).T)
    squeeze = zstandard.ZstdCompressor(level=1).compress
    parts = [squeeze(p.tobytes()) if p.any() else b"" for p in planes]
    return b"".join(len(p).to_bytes(4, "little") for p in parts) + b"".join(parts)


def unpack_numbers(data: bytes) -> np.ndarray:
    sizes = [int.from_bytes(data[4 * i : 4 * i + 4], "little") for i in range(4)]
    at, planes = 16, []
    for size in sizes:
        part = data[at : at + size]
        at += size
        planes.append(zstandard.ZstdDecompressor().decompress(part) if size else None)
    out = np.zeros((max((len(p) for p in planes if p is not None), default=0), 4), np.uint8)
    for i, plane in enumerate(planes):
        if plane is not None:
            out[:, i] = np.frombuffer(plane, np.uint8)
    return out.view("<u4").ravel() - np.uint32(1)


def gather(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The runs ``flat[start : start + size]`` one after another."""
    total = int(sizes.sum())
    shift = np.repeat(starts - np.concatenate(([0], np.cumsum(sizes)[:-1])), sizes)
    return flat[shift + np.arange(total)] if total else flat[:0]


def _offsets(sizes: np.ndarray) -> np.ndarray:
    return np.concatenate(([0], np.cumsum(sizes)[:-1])) if len(sizes) else sizes


class _Units(dict):
    """Word numbers of a unit, remembered for a block; new pre-tokens get the next number."""

    def __init__(self, find, words: dict[str, int]):
        super().__init__()
        self.find, self.words = find, words

    def __missing__(self, unit: str) -> tuple[int, ...]:
        words = self.words
        found = tuple(words.setdefault(w, len(words)) for w in self.find(unit))
        self[unit] = found
        return found


def _units(pattern: str):
    """A splitter of texts into parts whose pre-tokens do not depend on what is around them.

    No match of PATTERN goes on after a run of other characters when a space or line break
    follows, unless there is other white space; for any other pattern the text is one unit.
    """
    if pattern != PATTERN:
        return lambda text: [text]
    unit, odd = re.compile(r"[ \n]*[^ \n]+|[ \n]+"), regex.compile(r"[^\S \n]")
    return lambda text: [text] if odd.search(text) else unit.findall(text)


def _split_blocks(pattern: str, parts: int, block_bytes: int):
    """Explode texts to pre-tokens: block dictionaries, and each text as word numbers."""

    def run(batches: Iterator[dict]) -> Iterator[dict]:
        split, find = _units(pattern), regex.compile(pattern).findall
        numbers = itertools.count(TaskContext.get().partitionId() << 32)
        words: dict[str, int] = {}
        units = _Units(find, words)
        rows: list[tuple] = []
        size = 0

        def flush() -> dict:
            block = next(numbers)
            sizes = np.array([len(at) for _, at in rows], np.int64)
            flat = np.concatenate([at for _, at in rows])
            # Frequent words get small numbers, which compress better.
            order = np.empty(len(words), np.int64)
            ranked = np.argsort(-np.bincount(flat, minlength=len(words)), kind="stable")
            order[ranked] = np.arange(len(words))
            flat = order[flat]
            by_part: list[list[tuple[int, bytes]]] = [[] for _ in range(parts)]
            listed = [word.encode() for word in words]
            for number, at in enumerate(ranked.tolist()):
                raw = listed[at]
                by_part[zlib.crc32(raw) % parts].append((number, raw))
            out = {c: [] for c in ("_block", "_part", "_keys", "_words", "_numbers", "_sizes")}

            def add(*row) -> None:
                for c, v in zip(out, row, strict=True):
                    out[c].append(v)

            for part, entries in enumerate(by_part):
                if entries:
                    lengths = np.array([len(w) for _, w in entries])
                    blob = zstandard.ZstdCompressor(level=3).compress(
                        b"".join(w for _, w in entries)
                    )
                    gaps = np.diff(np.array([n for n, _ in entries]), prepend=0)
                    add(block, part, None, blob, pack_numbers(gaps), pack_numbers(lengths))
            ends = np.cumsum(sizes)
            for at in range(0, len(rows), ROWS):
                some = slice(at, at + ROWS)
                begin, end = ends[at] - sizes[at], ends[some][-1]
                keys = [key for key, _ in rows[some]]
                add(block, -1, keys, None, pack_numbers(flat[begin:end]),
                    pack_numbers(sizes[some]))
            words.clear()
            units.clear()
            rows.clear()
            return out

        for batch in batches:
            for key, data in zip(batch["_key"], batch["_data"], strict=True):
                text = data.decode("utf-8", "replace")
                found = itertools.chain.from_iterable(map(units.__getitem__, split(text)))
                rows.append((key, np.fromiter(found, np.int64)))
                size += len(data)
                if size >= block_bytes:
                    yield flush()
                    size = 0
        if rows:
            yield flush()

    return run


def _encode_words(ranks):
    """Encode the words of dictionary rows; equal words of all blocks meet in one task."""

    def run(batches: Iterator[dict]) -> Iterator[dict]:
        table, known = ranks.value, {}
        for batch in batches:
            out = {c: [] for c in ("_block", "_ids", "_sizes", "_numbers")}
            for block, packed, lengths, numbers in zip(
                *(batch[c] for c in ("_block", "_words", "_sizes", "_numbers")), strict=True
            ):
                blob = zstandard.ZstdDecompressor().decompress(packed)
                ids, sizes, at = [], [], 0
                for length in unpack_numbers(lengths).tolist():
                    word = blob[at : at + length]
                    at += length
                    found = known.get(word)
                    if found is None:
                        if len(known) >= CACHE_WORDS:
                            known.clear()
                        found = known[word] = encode_word(word, table)
                    ids += found
                    sizes.append(len(found))
                row = (block, pack_numbers(np.array(ids)), pack_numbers(np.array(sizes)), numbers)
                for c, v in zip(out, row, strict=True):
                    out[c].append(v)
            yield out

    return run


def _write_dictionaries(folder: str):
    """One file for each block, whose rows come together: the ids of its words, by number."""

    def run(batches: Iterator[dict]) -> Iterator[dict]:
        store, root = open_store(folder)
        store.create_dir(root, recursive=True)
        block, pieces = None, []

        def finish() -> dict:
            number = np.concatenate([p[2] for p in pieces])
            sizes = np.concatenate([p[1] for p in pieces])
            order = np.argsort(number)
            flat = gather(np.concatenate([p[0] for p in pieces]), _offsets(sizes)[order],
                          sizes[order])
            # A repeated task writes the same bytes; the name appears when they are all there.
            name = f"{root}/.{block}-{uuid.uuid4().hex}"
            with store.open_output_stream(name, compression=None) as out:
                head, body = pack_numbers(sizes[order]), pack_numbers(flat)
                out.write(len(head).to_bytes(8, "little") + head + body)
            store.move(name, f"{root}/{block}")
            return {"_block": [block], "_words": [len(sizes)]}

        for batch in batches:
            for row in zip(*(batch[c] for c in ("_block", "_ids", "_sizes", "_numbers")),
                           strict=True):
                if row[0] != block and pieces:
                    yield finish()
                    pieces = []
                block = row[0]
                ids, sizes, gaps = (unpack_numbers(x).astype(np.int64) for x in row[1:])
                pieces.append((ids, sizes, np.cumsum(gaps)))
        if pieces:
            yield finish()

    return run


def _join_ids(folder: str, kind: pa.DataType):
    """Put ids in the place of word numbers, with the dictionary of each text's block."""

    def run(batches):
        store, root = open_store(folder)
        block, flat, start, size = None, None, None, None
        for batch in batches:
            for row in batch.to_pylist():
                numbers = unpack_numbers(row["_numbers"])
                if row["_block"] != block and len(numbers):
                    block = row["_block"]
                    with store.open_input_stream(f"{root}/{block}", compression=None) as file:
                        data = file.read()
                    head = 8 + int.from_bytes(data[:8], "little")
                    size = unpack_numbers(data[8:head]).astype(np.int64)
                    flat, start = unpack_numbers(data[head:]).astype(np.int32), _offsets(size)
                sizes = unpack_numbers(row["_sizes"]).astype(np.int64)
                ends = np.concatenate(([0], np.cumsum(sizes)))
                if len(numbers):
                    ids = gather(flat, start[numbers], size[numbers])
                    ends = np.concatenate(([0], np.cumsum(size[numbers])))[ends]
                else:
                    ids = np.empty(0, np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row["_keys"], kind), lists], ["_key", "ids"]
                )

    return run


def encode(
    docs: DataFrame,
    ranks: dict[bytes, int],
    pattern: str,
    key: str = "doc_id",
    text: str = "text",
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """(key, ids): the token ids of every text, ``array<int>``.

    Each match of ``pattern`` is encoded by itself. Texts are split once, in blocks of about
    ``block_bytes``: a block holds its distinct words and each text as word numbers in order of
    position. Words are shuffled by hash, so that equal words of all blocks meet in one task and
    are encoded once (a task that meets more than CACHE_WORDS forgets and encodes some again).
    Their ids go to a dictionary file of each block in the shared folder, from which they replace
    the word numbers; texts themselves are not shuffled. A frequent word costs one entry a block.
    NULL and empty texts give no ids; repeated rows are encoded each; texts of any length are
    encoded whole (one longer than a block is a block); an empty table gives an empty one; only the named columns are
    read, so others cannot clash.
    """
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(key).alias("_key"), text_bytes(text).alias("_data"))
    kind = rows.schema["_key"].dataType
    split = stage(
        map_batches(
            rows,
            _split_blocks(pattern, parts, block_bytes),
            f"_block long, _part int, _keys array<{kind.simpleString()}>, _words binary, "
            "_numbers binary, _sizes binary",
        ),
        "bpe-blocks",
    )
    table = spark.sparkContext.broadcast(ranks)  # a vocabulary, whatever the input's size
    encoded = map_batches(
        split.where("_part >= 0")
        .select("_block", "_part", "_words", "_sizes", "_numbers")
        .repartition("_part"),
        _encode_words(table),
        "_block long, _ids binary, _sizes binary, _numbers binary",
    )
    folder = staging_path(spark, "bpe-dictionaries")
    together = encoded.repartition("_block").sortWithinPartitions("_block")
    stage(
        map_batches(together, _write_dictionaries(folder), "_block long, _words long"),
        "bpe-dictionaries",
    )
    texts = split.where("_part < 0").select("_block", "_keys", "_numbers", "_sizes")
    schema = StructType().add("_key", kind).add("ids", ArrayType(IntegerType()))
    joined = texts.mapInArrow(_join_ids(folder, to_arrow_type(kind)), schema)
    return joined.withColumnRenamed("_key", key)


def token_table(ranks: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bytes of all tokens, and start and size of each by id."""
    tokens = sorted(ranks.items(), key=lambda item: item[1])
    sizes = np.zeros(max(ranks.values(), default=-1) + 1, np.int64)
    for token, rank in tokens:
        sizes[rank] = len(token)
    return np.frombuffer(b"".join(t for t, _ in tokens), np.uint8), _offsets(sizes), sizes


def decode_lists(lists: pa.ListArray, table: tuple) -> list[bytes]:
    """The bytes of each list of ids; NULL gives none."""
    flat, starts, lengths = table
    ids = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    data = gather(flat, starts[ids], lengths[ids]).tobytes()
    counts = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
    ends = np.concatenate(([0], np.cumsum(lengths[ids])))[np.cumsum(counts)]
    begins = np.concatenate(([0], ends[:-1])) if len(ends) else ends
    return [data[a:b] for a, b in zip(begins.tolist(), ends.tolist(), strict=True)]


def decode(encoded: DataFrame, ranks: dict[bytes, int], key: str = "doc_id") -> DataFrame:
    """(key, ids, decoded): the bytes that the ids stand for; NULL ids give no bytes."""
    table = encoded.sparkSession.sparkContext.broadcast(token_table(ranks))

    def run(batches):
        for batch in batches:
            decoded = decode_lists(batch.column("ids"), table.value)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(decoded, pa.binary())], [*batch.schema.names, "decoded"]
            )

    rows = encoded.select(F.col(key).alias("_key"), "ids")
    done = rows.mapInArrow(run, StructType([*rows.schema.fields]).add("decoded", "binary"))
    return done.withColumnRenamed("_key", key)
