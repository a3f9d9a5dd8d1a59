"""Registered queries against their SQL, and the others against plain Python, on driver tables."""

import hashlib
import zlib

import public_tokenizers
import pytest
import tiktoken
from compare import difference, duckdb_over

from brute import repeats
from promolens.llm import byte_bpe, license_scan, lz_fingerprint
from promolens.llm import queries as llm

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return duckdb_over(SF)


@pytest.fixture(scope="module")
def texts(duck):
    return dict(duck.execute("SELECT doc_id, text FROM documents ORDER BY doc_id").fetchall())


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


@pytest.mark.parametrize("name", sorted(llm.SQL))
def test_query_equals_sql(spark, duck, name):
    assert difference(llm.QUERIES[name](spark, SF), duck, llm.SQL[name]) is None


def test_every_operator_has_one_query():
    assert sorted(int(n[2:].split("_")[0]) for n in llm.QUERIES) == list(range(1, 14))


def test_op2_finds_the_planted_lines(spark, texts):
    lines = {name: text for name, text in license_scan.TEMPLATES}
    found = {(r["doc_id"], r["license"]) for r in llm.QUERIES["op2_license_scan"](spark, SF).collect()}
    for name in ("MIT", "Apache-2.0", "GPL-3.0", "CC-BY-NC-4.0"):
        planted = {d for d, t in texts.items() if f"\n{lines[name]}\n" in f"\n{t}\n"}
        assert planted <= {d for d, n in found if n == name}
    assert {d for d, _ in found} <= {d for d, t in texts.items() if "icense" in t}


def test_op3_equals_plain_python(spark, texts):
    rows = by_id(llm.QUERIES["op3_lz_fingerprint"](spark, SF))
    ids = sorted(texts)
    assert sorted(rows) == ids
    for doc, following in zip(ids, ids[1:] + ids[:1], strict=True):
        text, after = texts[doc], texts[following]
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        r = rows[doc]
        assert r["n_chars"] == len(text)
        assert r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert r["fingerprint"] == lz_fingerprint.fingerprint(text)
        assert r["edited_fingerprint"] == lz_fingerprint.fingerprint(edited)
        assert r["near_next"] == lz_fingerprint.likeness(
            r["fingerprint"], lz_fingerprint.fingerprint(after)
        )


def test_op5_keeps_its_rules(spark, texts):
    rows = llm.QUERIES["op5_packing"](spark, SF).collect()
    assert {r["doc_id"] for r in rows} == set(texts)
    bins = {}
    for r in rows:
        bins.setdefault(r["bin_id"], []).append(r)
    for held in bins.values():
        assert len({r["source"] for r in held}) == len({r["cluster"] for r in held}) == len(held)
        held.sort(key=lambda r: r["bin_offset"])
        assert held[0]["bin_offset"] == 0
        for a, b in zip(held, held[1:], strict=False):
            assert a["bin_offset"] + a["size"] == b["bin_offset"]
        assert held[-1]["bin_offset"] + held[-1]["size"] <= 2048
    words = {d: 0 for d in texts}
    for r in rows:
        words[r["doc_id"]] += r["size"]
    assert words == {d: len(t.encode().split()) for d, t in texts.items()}


def test_op8_is_right_on_held_out_documents(spark, duck):
    truth = dict(duck.execute("SELECT doc_id, lang FROM documents").fetchall())
    rows = by_id(llm.QUERIES["op8_language_id"](spark, SF))
    assert set(rows) == set(truth)
    for doc, r in rows.items():
        assert r["held_out"] == (zlib.crc32(str(doc).encode()) % 3 == 1)
        assert 0 <= r["score"] <= 1
    held = [(r["lang_pred"], truth[d]) for d, r in rows.items() if r["held_out"] and truth[d]]
    assert sum(a == b for a, b in held) >= 0.95 * len(held)


def test_op9_equals_the_tokenizer_library(spark, texts):
    ranks = byte_bpe.load_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    library = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )
    rows = by_id(llm.QUERIES["op9_byte_bpe"](spark, SF))
    assert set(rows) == set(texts)
    for doc, text in texts.items():
        ids = library.encode_ordinary(text)
        packed = b"".join(i.to_bytes(4, "little") for i in ids)
        assert rows[doc]["n_tokens"] == len(ids)
        assert rows[doc]["ids_sha256"] == hashlib.sha256(packed).hexdigest()
        assert rows[doc]["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()


def test_op10_equals_brute_force(spark, texts):
    rows = by_id(llm.QUERIES["op10_suffix_dedup"](spark, SF))
    expected = repeats([t.encode() for t in texts.values()], 400)
    for doc, (size, removed, runs, kept) in zip(texts, expected, strict=True):
        r = rows[doc]
        assert (r["n_bytes"], r["n_removed"], r["n_spans"]) == (size, removed, runs)
        assert r["kept_sha256"] == hashlib.sha256(kept).hexdigest()
