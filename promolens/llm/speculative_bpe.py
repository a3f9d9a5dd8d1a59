"""Byte-level BPE by speculation: propose longest matches, verify neighbours, merge the rest exactly.

A token sequence is the exact encoding of a word if every token encodes to itself and no two
neighbours would have been joined across their border. So a longest-match cut of all new words of a
batch is proposed at once, all pairs of neighbours are checked together in numpy, and only words
with a pair that fails go through the merges one by one.

The check undoes the merges of a pair in reverse order. The parts that touch the border at a time
are the last part of the left token and the first of the right one; a merge that joins these two
parts while both are there (``merge rank`` below the rank at which either is itself joined) would
have crossed the border. That needs merges whose parts have lower ranks than their result; a table
without this order sends every word of several tokens to the merges.
"""

from __future__ import annotations

import heapq
import itertools
import json
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import cached_property

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StructType

from promolens.llm.byte_bpe import PATTERN, decode_lists, gather
from promolens.llm.common import text_bytes

CACHE_UNITS = 600_000
PIECE_CHARS = 1 << 20
SIDE_BYTES, SIDE_ROWS = 40, 8192  # longer words are merged one by one
_NEVER = np.int64(1 << 40)
_BORDER = "Ā"  # no byte: ends every match


def byte_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte in vocabulary files, and the byte."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


@dataclass(frozen=True)
class MergeTable:
    """A vocabulary with its ordered merges; ``added`` are strings that are tokens as they are."""

    tokens: dict[bytes, int]
    merges: list[tuple[int, int, int]]  # left, right, result, by rank
    added: dict[str, int]

    def __getstate__(self) -> dict:  # derived tables are built where they are used
        return {"tokens": self.tokens, "merges": self.merges, "added": self.added}

    def __setstate__(self, state: dict) -> None:
        self.__dict__.update(state)

    @cached_property
    def size(self) -> int:
        return 1 + max([*self.tokens.values(), *self.added.values()], default=-1)

    @cached_property
    def joins(self) -> dict[tuple[int, int], tuple[int, int]]:
        return {(a, b): (rank, c) for rank, (a, b, c) in enumerate(self.merges)}

    @cached_property
    def by_result(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Rank of the merge that makes each token (-1: none), its left and right part."""
        rank, left, right = (np.full(self.size, -1, np.int64) for _ in range(3))
        for r, (a, b, c) in enumerate(self.merges):
            rank[c], left[c], right[c] = r, a, b
        return rank, left, right

    @cached_property
    def by_pair(self) -> tuple[np.ndarray, np.ndarray]:
        pairs = np.array([a * self.size + b for a, b, _ in self.merges], np.int64)
        order = np.argsort(pairs)
        return pairs[order], order

    @cached_property
    def ordered(self) -> bool:
        """Every token has one merge, later than the merges of its parts."""
        rank, left, right = self.by_result
        made = np.flatnonzero(rank >= 0)
        parts = np.maximum(rank[left[made]], rank[right[made]])
        return len(made) == len(self.merges) and bool((parts < rank[made]).all())

    def join_rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The rank of the merge of each pair, ``_NEVER`` where there is none."""
        pairs, ranks = self.by_pair
        if not len(pairs):
            return np.full(len(a), _NEVER)
        wanted = a * self.size + b
        place = np.minimum(np.searchsorted(pairs, wanted), len(pairs) - 1)
        return np.where((pairs[place] == wanted) & (a >= 0) & (b >= 0), ranks[place], _NEVER)

    @cached_property
    def results(self) -> np.ndarray:
        return np.array([c for _, _, c in self.merges], np.int64)

    @cached_property
    def byte_ids(self) -> np.ndarray:
        return np.array([self.tokens.get(bytes([b]), -1) for b in range(256)], np.int64)

    def crossed(self, a: np.ndarray, b: np.ndarray, until: np.ndarray | None = None) -> np.ndarray:
        """Whether a merge of rank below ``until`` would join each left token with its right one."""
        rank, left, right = self.by_result
        bad = np.zeros(len(a), bool)
        at = np.arange(len(a))
        end_a = np.full(len(a), _NEVER) if until is None else until.copy()
        end_b = end_a.copy()
        while len(at):
            join = self.join_rank(a, b)
            # Of equal merges the left one comes first: the left part is taken before the border.
            now = (join < end_a) & (join <= end_b) & (join < _NEVER)
            bad[at[now]] = True
            made_a, made_b = rank[a], rank[b]
            more = ~now & ((made_a >= 0) | (made_b >= 0))
            at, a, b, made_a, made_b = at[more], a[more], b[more], made_a[more], made_b[more]
            undo_a = made_a > made_b
            end_a = np.where(undo_a, made_a, end_a[more])
            end_b = np.where(undo_a, end_b[more], made_b)
            a, b = np.where(undo_a, right[a], a), np.where(undo_a, b, left[b])
        return bad

    @cached_property
    def itself(self) -> np.ndarray:
        """Whether each token is the encoding of its own bytes."""
        rank, left, right = self.by_result
        good = np.zeros(self.size, bool)
        good[[i for t, i in self.tokens.items() if len(t) == 1]] = True
        made = np.flatnonzero(rank >= 0)
        made = made[np.argsort(rank[made])]
        bad = self.crossed(left[made], right[made], rank[made])
        for c, a, b, x in zip(*(v.tolist() for v in (made, left[made], right[made], bad)),
                              strict=True):
            good[c] = not x and good[a] and good[b]
        return good

    @cached_property
    def matcher(self) -> ahocorasick.Automaton:
        automaton = ahocorasick.Automaton()
        for token, i in self.tokens.items():
            if self.itself[i]:
                automaton.add_word(token.decode("latin-1"), i)
        automaton.make_automaton()
        return automaton

    @cached_property
    def token_bytes(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The bytes of all tokens, and start and size of each by id."""
        by_id = {i: t for t, i in self.tokens.items()}
        by_id |= {i: s.encode() for s, i in self.added.items()}
        sizes = np.array([len(by_id.get(i, b"")) for i in range(self.size)], np.int64)
        blob = b"".join(by_id.get(i, b"") for i in range(self.size))
        return np.frombuffer(blob, np.uint8), np.cumsum(sizes) - sizes, sizes


def load_table(path: str) -> MergeTable:
    """A byte-level BPE file of the tokenizers library.

    Fails on settings that this encoder does not have, so that no other result can come out.
    """
    with open(path, encoding="utf-8") as file:
        data = json.load(file)
    model, before = data["model"], data.get("pre_tokenizer") or {}
    odd = [k for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix",
                       "fuse_unk", "byte_fallback", "ignore_merges") if model.get(k)]
    odd += [t["content"] for t in data.get("added_tokens", ())
            if t["single_word"] or t["lstrip"] or t["rstrip"]]
    plain = before.get("type") == "ByteLevel" and not before.get("add_prefix_space")
    if odd or data.get("normalizer") or not plain or not before.get("use_regex", True):
        raise ValueError(f"not a plain byte-level BPE: {odd or before}")
    alphabet = byte_alphabet()
    added = {t["content"]: t["id"] for t in data.get("added_tokens", ())}
    ids = model["vocab"]
    tokens = {bytes(alphabet[c] for c in t): i for t, i in ids.items() if t not in added}
    pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    return MergeTable(tokens, [(ids[a], ids[b], ids[a + b]) for a, b in pairs], added)


def merge_exactly(word: bytes, table: MergeTable) -> list[int]:
    """Join neighbours by lowest rank, leftmost first, until no join is left."""
    joins, first = table.joins, table.tokens
    ids = [first[word[i : i + 1]] for i in range(len(word))]
    after = list(range(1, len(ids) + 1))
    before = list(range(-1, len(ids) - 1))
    heap: list[tuple[int, int, int, int]] = []

    def offer(i: int) -> None:
        j = after[i]
        if j < len(ids) and (found := joins.get((ids[i], ids[j]))):
            heapq.heappush(heap, (found[0], i, ids[i], ids[j]))

    for i in range(len(ids) - 1):
        offer(i)
    while heap:
        _, i, a, b = heapq.heappop(heap)
        j = after[i]
        if ids[i] != a or j >= len(ids) or ids[j] != b:
            continue  # one of the two was joined otherwise
        ids[i], ids[j] = joins[a, b][1], -1
        after[i] = after[j]
        if after[j] < len(ids):
            before[after[j]] = i
        offer(i)
        if before[i] >= 0:
            offer(before[i])
    return [i for i in ids if i >= 0]


def merge_side_by_side(words: list[bytes], table: MergeTable) -> list[list[int]]:
    """``merge_exactly`` for words of like length: one row each, one join a row at a time."""
    width = max(map(len, words))
    raw = np.frombuffer(b"".join(w.ljust(width, b"\0") for w in words), np.uint8)
    left = np.array([len(w) for w in words])
    ids = np.where(
        np.arange(width) < left[:, None], table.byte_ids[raw].reshape(-1, width), -1
    )
    ranks = table.join_rank(ids[:, :-1].ravel(), ids[:, 1:].ravel()).reshape(-1, width - 1)
    rows = np.arange(len(words))  # with a join left
    done = ids.copy()
    while len(rows):
        at = ranks.argmin(axis=1)  # the leftmost of the lowest
        each = np.arange(len(rows))
        lowest = ranks[each, at]
        more = lowest < _NEVER
        done[rows[~more], : ids.shape[1]] = ids[~more]
        done[rows[~more], ids.shape[1] :] = -1
        rows, ids, ranks = rows[more], ids[more], ranks[more]
        at, lowest, each = at[more], lowest[more], np.arange(int(more.sum()))
        if not len(rows):
            break
        ids[each, at] = table.results[lowest]
        span = np.arange(ids.shape[1] - 1)
        ids = np.where(span > at[:, None], ids[:, 1:], ids[:, :-1])
        span = span[:-1]
        ranks = np.where(span >= at[:, None], ranks[:, 1:], ranks[:, :-1])
        if not ids.shape[1] - 1:
            ranks = np.full((len(rows), 1), _NEVER)
            continue
        after = at < ids.shape[1] - 1
        ranks[each[after], at[after]] = table.join_rank(
            ids[each[after], at[after]], ids[each[after], at[after] + 1]
        )
        before = at > 0
        ranks[each[before], at[before] - 1] = table.join_rank(
            ids[each[before], at[before] - 1], ids[each[before], at[before]]
        )
    sizes = (done >= 0).sum(axis=1).tolist()
    return [row[:n] for row, n in zip(done.tolist(), sizes, strict=True)]


def merge_words(words: list[bytes], table: MergeTable) -> list[list[int]]:
    """The exact merges of many words, short ones side by side."""
    out: list[list[int]] = [[]] * len(words)
    order = sorted((i for i, w in enumerate(words) if 1 < len(w) <= SIDE_BYTES),
                   key=lambda i: len(words[i]))
    for at in range(0, len(order), SIDE_ROWS):
        some = order[at : at + SIDE_ROWS]
        for i, ids in zip(some, merge_side_by_side([words[i] for i in some], table), strict=True):
            out[i] = ids
    for i, word in enumerate(words):
        if not 1 < len(word) <= SIDE_BYTES:
            out[i] = merge_exactly(word, table)
    return out


def propose(words: list[bytes], table: MergeTable) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Longest matches from the left: ids of all words, the word of each, and its matched bytes."""
    found = list(table.matcher.iter_long(_BORDER.join(w.decode("latin-1") for w in words)))
    flat = np.fromiter(itertools.chain.from_iterable(found), np.int64, 2 * len(found))
    ends, ids = flat[::2], flat[1::2]
    starts = np.cumsum([0] + [len(w) + 1 for w in words])[:-1]
    word = np.searchsorted(starts, ends, side="right") - 1
    matched = np.bincount(word, table.token_bytes[2][ids], len(words)).astype(np.int64)
    return ids, word, matched


def encode_words(words: list[bytes], table: MergeTable) -> tuple[list[list[int]], int]:
    """The ids of each word, and how many words needed the merges."""
    if not words:
        return [], 0
    ids, word, matched = propose(words, table)
    failed = matched != np.array([len(w) for w in words])
    together = word[1:] == word[:-1]
    if table.ordered:
        a, b = ids[:-1][together], ids[1:][together]
        pairs, back = np.unique(a * table.size + b, return_inverse=True)
        bad = table.crossed(pairs // table.size, pairs % table.size)[back]
        failed[word[1:][together][bad]] = True
    else:
        failed[word[1:][together]] = True
    ends = np.searchsorted(word, np.arange(len(words)), side="right").tolist()
    listed, out, at = ids.tolist(), [], 0
    for end in ends:
        out.append(listed[at:end])
        at = end
    wrong = np.flatnonzero(failed).tolist()
    for i, exact in zip(wrong, merge_words([words[i] for i in wrong], table), strict=True):
        out[i] = exact
    return out, len(wrong)


class Encoder:
    """Encodes texts; what one batch learned of words serves the next ones."""

    def __init__(self, table: MergeTable, pattern: str = PATTERN, cache_units: int = CACHE_UNITS):
        self.table, self.pattern, self.cache_units = table, pattern, cache_units
        self.find = regex.compile(pattern).findall
        # Strings that PATTERN never joins with what is around them, if no other space occurs:
        # letters end before a mark, and marks before a space.
        self.units_of = re.compile(
            r"[ \n]*[a-zA-ZÀ-ÖØ-öø-ÿ]+(?![^ \n.,;:!?])|[ \n]*[^ \n]+|[ \n]+"
        ).findall
        self.odd = regex.compile(r"[^\S \n]").search
        self.cut = re.compile(r"(?<=[^\s]) ")
        longest = sorted(map(re.escape, table.added), key=len, reverse=True)
        self.added = re.compile(f"({'|'.join(longest)})") if longest else None
        self._forget()

    def _forget(self) -> None:
        self.number: dict[str, int] = {}
        self.flat = np.empty(0, np.int32)
        self.start = self.size = np.empty(0, np.int64)

    def _pieces(self, text: str) -> Iterator[str | int]:
        """Added tokens as ids, and between them strings that are split by themselves."""
        parts = self.added.split(text) if self.added else [text]
        for i, part in enumerate(parts):
            if i % 2:
                yield self.table.added[part]
                continue
            while len(part) > PIECE_CHARS and self.pattern == PATTERN:
                border = self.cut.search(part, PIECE_CHARS)
                if not border:
                    break
                yield part[: border.start()]
                part = part[border.start() :]
            if part:
                yield part

    def _units(self, piece: str) -> list[str]:
        if self.pattern == PATTERN and not self.odd(piece):
            return self.units_of(piece)
        return self.find(piece)

    def _learn(self, units: Iterable[str]) -> None:
        new = list(dict.fromkeys(itertools.filterfalse(self.number.__contains__, units)))
        split = list(map(self.find, new))
        words = list(dict.fromkeys(itertools.chain.from_iterable(split)))
        encoded, _ = encode_words([w.encode() for w in words], self.table)
        ids = dict(zip(words, encoded, strict=True))
        lists = [
            ids[ws[0]] if len(ws) == 1 else list(itertools.chain.from_iterable(ids[w] for w in ws))
            for ws in split
        ]
        sizes = np.fromiter(map(len, lists), np.int64, len(lists))
        fresh = np.fromiter(itertools.chain.from_iterable(lists), np.int32, int(sizes.sum()))
        self.number.update(zip(new, itertools.count(len(self.size)), strict=False))
        self.start = np.concatenate([self.start, len(self.flat) + np.cumsum(sizes) - sizes])
        self.size = np.concatenate([self.size, sizes])
        self.flat = np.concatenate([self.flat, fresh])

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text."""
        out: list[list[np.ndarray]] = [[] for _ in texts]
        waiting: list[tuple[int, list[str] | int]] = []
        chars = 0

        def finish() -> None:
            if len(self.number) > self.cache_units:
                self._forget()
            self._learn(itertools.chain.from_iterable(u for _, u in waiting if type(u) is list))
            for at, units in waiting:
                if type(units) is int:
                    out[at].append(np.array([units], np.int32))
                else:
                    n = np.fromiter(map(self.number.__getitem__, units), np.int64, len(units))
                    out[at].append(gather(self.flat, self.start[n], self.size[n]))
            waiting.clear()

        for at, text in enumerate(texts):
            for piece in self._pieces(text):
                waiting.append((at, piece if type(piece) is int else self._units(piece)))
                chars += 1 if type(piece) is int else len(piece)
                if chars >= 4 * PIECE_CHARS:
                    finish()
                    chars = 0
        finish()
        none = np.empty(0, np.int32)
        return [np.concatenate(parts) if parts else none for parts in out]


def encode(
    docs: DataFrame,
    table: MergeTable,
    pattern: str = PATTERN,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """(key, ids): the token ids of every text, ``array<int>``, as the tokenizers library has them.

    Texts stay where they are: no shuffle, nothing staged. A task knows up to ``CACHE_UNITS`` words,
    then forgets them. Strings of ``table.added`` are one token each. NULL and empty texts give no
    ids; repeated rows are encoded each; a very long text is worked in pieces of about
    ``PIECE_CHARS`` characters, cut where the pattern always cuts; an empty table gives no rows;
    only the named columns are read, so others cannot clash.
    """
    shared = docs.sparkSession.sparkContext.broadcast(table)  # a vocabulary: the input has no part

    def run(batches):
        encoder = Encoder(shared.value, pattern)
        for batch in batches:
            texts = [d.decode("utf-8", "replace") for d in batch.column("_data").to_pylist()]
            ids = encoder.encode(texts)
            ends = np.cumsum([0] + [len(i) for i in ids])
            flat = np.concatenate(ids) if ids else np.empty(0, np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column("_key"), lists], ["_key", "ids"])

    rows = docs.select(F.col(key).alias("_key"), text_bytes(text).alias("_data"))
    schema = StructType([rows.schema["_key"]]).add("ids", ArrayType(IntegerType()))
    return rows.mapInArrow(run, schema).withColumnRenamed("_key", key)


def decode_texts(lists: pa.ListArray, table: MergeTable) -> list[str]:
    """The text of each list of ids; bytes that are no UTF-8 become U+FFFD."""
    return [b.decode("utf-8", "replace") for b in decode_lists(lists, table.token_bytes)]


def decode(encoded: DataFrame, table: MergeTable, key: str = "doc_id") -> DataFrame:
    """(key, ids, decoded): the text of the ids; NULL ids give an empty one."""
    shared = encoded.sparkSession.sparkContext.broadcast(table)

    def run(batches):
        for batch in batches:
            decoded = decode_texts(batch.column("ids"), shared.value)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(decoded, pa.string())], [*batch.schema.names, "decoded"]
            )

    rows = encoded.select(F.col(key).alias("_key"), "ids")
    done = rows.mapInArrow(run, StructType([*rows.schema.fields]).add("decoded", "string"))
    return done.withColumnRenamed("_key", key)
