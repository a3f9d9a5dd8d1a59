"""Speculative BPE against the tokenizers library and against the merges one by one."""

import hashlib
import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from promolens.llm import queries as llm
from promolens.llm import speculative_bpe as bpe

PATH = public_tokenizers.path("byte_bpe_50k.json")
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def table():
    return bpe.load_table(PATH)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def odd_texts():
    pick = random.Random(3)
    letters = "abctheing 's\n\t   'é日<|endoftext|>0129!?-.,"
    made = ["".join(pick.choices(letters, k=pick.randrange(120))) for _ in range(1500)]
    runs = ["".join(pick.choices("aab", k=pick.randrange(80))) for _ in range(1000)]
    return made + runs + [
        "", " ", "a" * 3000, "the" * 2000, " " * 500, "<|endoftext|>x<|endoftext|>", "\x1c\x85 x",
        "word, " * 50_000, "x" * 100 + " " + "ß" * 100,
    ]


def test_texts_equal_the_library(table, library):
    texts = odd_texts()
    expected = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert [i.tolist() for i in bpe.Encoder(table).encode(texts)] == expected


def test_forgetting_and_cutting_change_nothing(table, library, monkeypatch):
    monkeypatch.setattr(bpe, "PIECE_CHARS", 300)
    texts = odd_texts()
    expected = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert [i.tolist() for i in bpe.Encoder(table, cache_units=50).encode(texts)] == expected


def test_words_with_bad_pairs_alone_are_merged(table):
    pick = random.Random(5)
    words = ["".join(pick.choices("etaoinshr", k=pick.randrange(1, 60))).encode()
             for _ in range(4000)]
    exact = [bpe.merge_exactly(w, table) for w in words]
    assert bpe.merge_words(words, table) == exact
    ids, word, matched = bpe.propose(words, table)
    assert matched.tolist() == [len(w) for w in words]
    proposed = [ids[word == i].tolist() for i in range(len(words))]
    encoded, failed = bpe.encode_words(words, table)
    assert encoded == exact
    assert failed == sum(p != e for p, e in zip(proposed, exact, strict=True))
    assert 0 < failed < len(words)


def test_table_without_order_is_merged_in_full():
    # "ab" is joined first; "abc" wants "bc", whose merge comes later than the one that uses it.
    first = {bytes([c]): i for i, c in enumerate(b"abc")}
    tokens = first | {b"bc": 3, b"abc": 4, b"ab": 5}
    table = bpe.MergeTable(tokens, [(0, 3, 4), (1, 2, 3), (0, 1, 5)], {})
    assert not table.ordered
    words = [b"abc", b"ab", b"bcabc", b"cab"]
    assert bpe.encode_words(words, table)[0] == [bpe.merge_exactly(w, table) for w in words]


def test_other_kinds_of_files_are_refused():
    with pytest.raises(ValueError, match="byte-level"):
        bpe.load_table(public_tokenizers.path("word_bpe_49k.json"))


def test_round_trip_on_odd_rows(spark, odd, empty, table, library):
    encoded = bpe.encode(odd, table)
    assert encoded.columns == ["doc_id", "ids"]
    rows = bpe.decode(encoded, table).collect()
    texts = [(r["doc_id"], r["text"] or "") for r in odd.select("doc_id", "text").collect()]
    expected = [(d, library.encode(t, add_special_tokens=False).ids, t) for d, t in texts]
    assert sorted(map(str, expected)) == sorted(str((r[0], r[1], r[2])) for r in rows)
    assert bpe.decode(bpe.encode(empty, table), table).collect() == []


def test_text_of_some_megabytes(spark, table, library):
    text = " ".join(f"wort{i * 7919 % 65_537} é{i}," for i in range(250_000))
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    (row,) = bpe.encode(docs, table).collect()
    assert row["ids"] == library.encode(text, add_special_tokens=False).ids


def test_op11_equals_the_library(spark, library):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    rows = {r["doc_id"]: r for r in llm.QUERIES["op11_speculative_bpe"](spark, SF).collect()}
    assert set(rows) == {d["doc_id"] for d in docs}
    for doc_id, text in docs:
        ids = library.encode(text or "", add_special_tokens=False).ids
        back = library.decode(ids, skip_special_tokens=False)
        r = rows[doc_id]
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(back.encode()).hexdigest()
