"""Treap search against scoring every document of every item."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from promolens.llm import treap_search as treaps

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def words(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def brute(docs, items, top=20):
    held = [(key, Counter(words(text))) for key, text in docs]
    lengths = [sum(c.values()) for _, c in held]
    n_docs, n_terms = sum(n > 0 for n in lengths), sum(lengths)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item, text in items:
        asked = Counter(words(text))
        weight = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) for t in asked}
        scored = []
        for (key, c), n in zip(held, lengths, strict=True):
            m = 100 - 25 + (25 * n * n_docs) // max(n_terms, 1)
            score = sum(
                k * weight[t] * ((10**9 * c[t]) // (1000 * c[t] + 12 * m))
                for t, k in asked.items() if c[t]
            )
            if score > 0:
                scored.append((-score, key is None, key))
        out += [
            (item, rank, key, -score)
            for rank, (score, _, key) in enumerate(sorted(scored, key=str_last)[:top], 1)
        ]
    return out


def str_last(row):
    return (row[0], row[1], row[2] or 0)


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def random_points(seed, rows, columns, share):
    pick = np.random.default_rng(seed)
    grid = np.where(pick.random((rows, columns)) < share, pick.integers(1, 1 << 20), 0)
    row, column = np.nonzero(grid)
    return grid, row, column, grid[row, column]


@pytest.mark.parametrize(("rows", "columns", "share"),
                         [(1, 1, 1), (5, 3, 0.5), (37, 200, 0.1), (300, 9, 0.02), (8, 8, 0)])
def test_treap_holds_the_points(rows, columns, share):
    grid, row, column, worth = random_points(1, rows, columns, share)
    built = treaps.Treap.build(row, column, worth)
    back = treaps.Treap.unpack(built.pack())
    for a, b in zip(built.largest, back.largest, strict=True):
        assert a.tolist() == b.tolist()
    # Walk to every point by its quadrants: the way's largest impacts never rise.
    for r, c in zip(row.tolist(), column.tolist(), strict=True):
        cell, above = 0, math.inf
        for level in range(back.depth):
            assert back.largest[level][cell] <= above
            above = back.largest[level][cell]
            shift = back.depth - level - 1
            at = 2 * ((r >> shift) & 1) + ((c >> shift) & 1)
            bits = int(back.quadrants[level][cell])
            assert bits >> at & 1
            cell = int(back.first[level][cell]) + bin(bits & ((1 << at) - 1)).count("1")
        assert back.largest[-1][cell] == grid[r, c]


@pytest.mark.parametrize("first_round", [1, 64])
@pytest.mark.parametrize("share", [0.01, 0.2, 0.9])
def test_best_first_finds_the_best(monkeypatch, share, first_round):
    monkeypatch.setattr(treaps, "FIRST_ROUND", first_round)
    grid, row, column, worth = random_points(2, 40, 150, share)
    grid = grid % 7  # ties
    row, column = np.nonzero(grid)
    treap = treaps.Treap.build(row, column, grid[row, column])
    keys = np.random.default_rng(4).permutation(150)
    pick = random.Random(3)
    asked = [sorted(pick.sample(range(40), pick.randrange(9))) for _ in range(30)]
    entries = np.array([(i, r, 1 + r % 3) for i, rows in enumerate(asked) for r in rows])
    item, at, score = treaps.search_block(treap, keys, *entries.T, len(asked), 5)
    got = sorted(zip(item.tolist(), (-score).tolist(), keys[at].tolist(), strict=True))
    expected = []
    for i, rows in enumerate(asked):
        total = sum((grid[r] * (1 + r % 3) for r in rows), np.zeros(150, np.int64))
        order = sorted((-int(t), int(k)) for t, k in zip(total, keys, strict=True) if t > 0)
        expected += [(i, s, k) for s, k in order[:5]]
    assert got == sorted(expected)


@pytest.mark.parametrize("block_bytes", [500, 1 << 20])
def test_search_equals_scoring_all(spark, block_bytes):
    pick = random.Random(11)
    some = ["Aa", "aa", "b", "Ébc", "x7", "q_r", "日本", "n", "o", "zz"]
    text = lambda n: "".join(pick.choice(some) + pick.choice(" ,\x1c\n-") for _ in range(n))
    docs = [(i, text(pick.randrange(40))) for i in range(300)] + [(900, None), (901, "")]
    docs += [(7, docs[7][1])] * 4 + [(None, docs[8][1])] * 2
    items = [(i, text(pick.randrange(1, 9))) for i in range(12)]
    items += [(50, None), (51, "absent"), (52, "aa aa AA b"), (52, "aa"), (None, "n o")]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    asked = spark.createDataFrame(items, "item_id long, text string")
    index = treaps.build_index(df, block_bytes=block_bytes)
    expected = sorted(brute(docs, items), key=repr)
    assert found(treaps.search(index, asked)) == expected
    assert found(treaps.search(index, asked, batch_items=4)) == expected


def test_search_on_odd_rows(spark, odd, empty):
    docs = [tuple(r) for r in odd.select("doc_id", "text").collect()]
    items = [(1, "line that many pages have"), (2, "größe 17 wort3"), (3, None)]
    asked = spark.createDataFrame(items, "item_id long, text string")
    assert found(treaps.search(treaps.build_index(odd), asked)) == sorted(
        brute(docs, items), key=repr
    )
    assert treaps.search(treaps.build_index(empty), asked).collect() == []
    assert treaps.search(treaps.build_index(odd), asked.where("false")).collect() == []
