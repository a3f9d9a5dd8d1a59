"""Collocations against a count of all phrases in plain Python."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from promolens.llm import collocations as mining
from promolens.llm import queries as llm

SF = "/root/testdata/sf0.001"


def brute(rows, min_count, top=2000, percent=80, longest=4):
    """(lang, rank, phrase, a, l, r, n, score) from the definition alone."""
    counts: dict[str, Counter] = {}
    words_of: Counter = Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        here = counts.setdefault(lang, Counter())
        low = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", low):
            words = re.findall(r"[^\x20\x09]+", piece)
            words_of[lang] += len(words)
            here.update(
                tuple(words[i : i + k])
                for k in range(1, longest + 1)
                for i in range(len(words) - k + 1)
            )
    out = []
    for lang, f in counts.items():
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= min_count}
        inside = {
            y[i : i + k]
            for y, often in candidates.items()
            for k in range(2, len(y))
            for i in range(len(y) - k + 1)
            if 100 * often >= percent * f[y[i : i + k]]
        }
        ranked = []
        for p, a in candidates.items():
            if p not in inside:
                score, k = min(
                    (2_000_000 * a // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p))
                )
                ranked.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for i, (s, a, p, left, right) in enumerate(sorted(ranked)[:top], 1):
            out.append((lang, i, p.decode(), -a, left, right, words_of[lang], -s))
    return sorted(out)


def found(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize(("tile", "dense"), [(4, 3), (8, 10**9), (1024, 1)])
def test_tiles_count_every_pair(tile, dense):
    pick = np.random.default_rng(1)
    left, right = (np.minimum(pick.geometric(0.15, 3000), 40) - 1 for _ in range(2))
    a, b, n = mining.count_pairs(left, right, 40, tile, dense)
    got = dict(zip(zip(a.tolist(), b.tolist(), strict=True), n.tolist(), strict=True))
    assert len(got) == len(a)
    assert got == Counter(zip(left.tolist(), right.tolist(), strict=True))


def test_no_pairs():
    none = np.empty(0, np.int64)
    assert [len(x) for x in mining.count_pairs(none, none, 1)] == [0, 0, 0]


def test_packed_numbers_come_back():
    for values in ([], [-1], [5, -1, 1 << 40, 0]):
        assert mining.unpack(mining.pack(np.array(values, np.int64))).tolist() == values


@pytest.mark.parametrize("block_bytes", [300, 1 << 20])
def test_phrases_of_random_text(spark, monkeypatch, block_bytes):
    monkeypatch.setattr(mining, "BLOCK_BYTES", block_bytes)
    monkeypatch.setattr(mining.phrases, "__defaults__",
                        (*mining.phrases.__defaults__[:-1], block_bytes))
    pick = random.Random(7)
    words = ["Aa", "aa", "b", "Ébc", "ébc", "x\x1cy", "d'e", " ", "f"]
    ends = [" ", " ", " ", "\t", "  ", ". ", ",", "\n", "!?", "\r\n"]
    rows = [
        (pick.choice(["en", "de", None, "und", ""]),
         "".join(pick.choice(words) + pick.choice(ends) for _ in range(pick.randrange(60))))
        for _ in range(200)
    ] + [("en", None), ("en", ""), ("zz", ".,"), (None, None)]
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(3)
    got = found(mining.collocations(docs, min_count=4, top=25))
    assert got == brute(rows, 4, 25)
    assert got


def test_phrases_on_odd_rows(spark, odd, empty):
    rows = [(r["lang"], r["text"]) for r in odd.select("lang", "text").collect()]
    got = found(mining.collocations(odd, min_count=3))
    assert got == brute(rows, 3)
    assert {r[0] for r in got} == {"en", "de"}
    assert mining.collocations(empty).collect() == []


def test_one_phrase_in_a_third_of_the_text(spark):
    rows = [("en", "the hot pair " * 400)] * 20 + [("en", f"the w{i % 50} pair") for i in range(3000)]
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(8)
    assert found(mining.collocations(docs)) == brute(rows, 30)


def test_only_frequent_pairs_meet_their_ids(spark, monkeypatch):
    written = []

    def stage(df, name):
        out = kept(df, name)
        if name == "collocations-often":
            written.append(out.groupBy("left", "right").agg(F.max("n"), F.count("n")).collect())
        return out

    kept = mining.stage
    monkeypatch.setattr(mining, "stage", stage)
    rows = [("en", "the hot pair of words")] * 40 + [("en", f"w{i} w{i % 7}") for i in range(200)]
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(4)
    assert found(mining.collocations(docs)) == brute(rows, 30)
    assert [len(w) for w in written] == [4, 3]  # of two words, and of three
    assert all(n == 40 and 1 <= blocks <= 4 for w in written for _, _, n, blocks in w)


def test_op13_equals_plain_python(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("lang", "text").collect()
    got = found(llm.QUERIES["op13_collocations"](spark, SF))
    assert got == brute([tuple(r) for r in docs], 30)
    assert got
