"""Each operator on odd, empty and random input, against plain Python."""

import hashlib
import math
import os
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from conftest import odd_rows
from brute import best_fit, groups, repeat_words, repeats, word_repeats
from pyspark.sql import functions as F

from promolens.llm import (
    byte_bpe,
    jaccard_join,
    language_id,
    license_scan,
    line_dedup,
    lz_fingerprint,
    packing,
    quality,
    suffix_dedup,
    warc,
)
from promolens.llm.common import WordHashes, prepared, word_codes
from promolens.llm.components import connected_components
from promolens.session import staging_root

ODD = [(r[0], r[1]) for r in odd_rows()]


def rows(df, *columns):
    return Counter(map(tuple, df.select(*columns).collect()))


# 1 quality rules


def test_repeat_words_on_random_text():
    draw = random.Random(1)
    for _ in range(200):
        words = [draw.choice("abc") for _ in range(draw.randint(0, 30))]
        codes = word_codes(" ".join(words).encode(), WordHashes())
        assert quality.repeat_words(codes) == repeat_words(words)


def test_quality_on_odd_rows(spark, odd, empty):
    prepared(spark)
    found = quality.quality_rules(odd, min_docs=3, max_share=0.2, min_left_percent=50)
    got = found.collect()
    assert len(got) == len(ODD)
    by_id = {r["doc_id"]: r for r in got}
    assert by_id[4]["n_words"] == 0 and by_id[4]["base_failed"] and not by_id[4]["kept"]
    assert by_id[9]["n_symbols"] == 6 and by_id[9]["word_chars"] == 12
    assert by_id[3]["n_dup_lines"] == 1
    assert by_id[3]["n_words_left"] == 1
    assert by_id[7]["kept"] and by_id[10]["n_repeat_words"] == 3000
    assert by_id[8]["word_chars"] == 1
    assert quality.quality_rules(empty).count() == 0


def test_depleted_document_is_rejected(spark):
    prepared(spark)
    boiler = " ".join(f"b{i}" for i in range(60))
    own = " ".join(f"o{i}" for i in range(60))
    data = [(i, f"{boiler}\nx{i}" if i else f"{boiler}\n{own}", "h") for i in range(12)]
    data += [(100, f"{boiler}\nalone", "other")]
    df = spark.createDataFrame(data, "doc_id long, text string, source string")
    kept = {r["doc_id"]: r["kept"] for r in quality.quality_rules(df).collect()}
    assert kept == {**{i: i == 0 for i in range(12)}, 100: True}


def test_quality_returns_the_text_without_its_removed_lines(spark):
    prepared(spark)
    data = [(i, f"Boiler {i % 3}\n\nown {chr(97 + i)}  words\n BOILER  1", "h") for i in range(12)]
    data += [(20, "Boiler 0", "other"), (21, None, "h"), (22, "", "h"), (23, "boiler 7", "h")]
    data += [(24, "\n\r\n" * 50_000 + "boiler 1\nend", "h")]
    df = spark.createDataFrame(data, "doc_id long, text string, source string")
    found = quality.quality_rules(df, with_text=True).collect()
    got = {r["doc_id"]: (r["removed_lines"], r["clean_text"], r["n_words_left"]) for r in found}
    for i in range(12):
        assert got[i] == ([0, 3], f"\nown {chr(97 + i)}  words", 3)
    # Digits count as 0, so all the boiler lines are one line.
    assert got[20] == ([], "Boiler 0", 2)
    assert got[21] == got[22] == ([], "", 0) and got[23] == ([0], "", 0)
    assert got[24] == ([100_000], "\n\r\n" * 50_000 + "end", 1)
    plain = quality.quality_rules(df)
    assert "clean_text" not in plain.columns
    assert {r["doc_id"]: r["removed_lines"] for r in plain.collect()} == {
        d: r[0] for d, r in got.items()
    }


# 2 license scan


def test_license_scan_finds_near_copies_only(spark, odd, empty):
    prepared(spark)
    notice = dict(license_scan.TEMPLATES)["Apache-2.0-header"]
    filler = " ".join(f"f{i}" for i in range(500))
    changed = notice.replace("You may obtain a copy of the License at", "you may get it at")
    data = [
        (1, f"{filler} {notice.upper()} {filler}"), (2, f"{filler} {changed}"), (3, filler),
        (4, None), (5, f"{notice}\n{filler}\n{notice}"), (5, f"{notice}\n{filler}\n{notice}"),
        (6, "Released under the MIT License."), (7, "under the"),
    ]
    df = spark.createDataFrame(data, "doc_id long, text string")
    got = sorted(
        (r["doc_id"], r["license"], r["n_spans"], r["first_word"])
        for r in license_scan.scan_licenses(df).collect()
    )
    header = "Apache-2.0-header"
    assert got == [
        (1, header, 1, 500), (5, header, 2, 0), (5, header, 2, 0), (6, "MIT", 1, 0)
    ]
    assert license_scan.scan_licenses(odd).count() == 0
    assert license_scan.scan_licenses(empty).count() == 0
    with pytest.raises(ValueError):
        license_scan.scan_licenses(df, [("x", "y z")] * 10_001)


def test_license_scan_against_all_windows():
    draw = random.Random(5)
    templates = [(f"t{i}", " ".join(draw.choice("pqrstuvw") + str(draw.randint(0, 9))
                 for _ in range(n))) for i, n in enumerate((5, 9, 20, 40))]
    classes = license_scan._classes(templates, 3, 0.8, 1e-4)
    cache = license_scan._Words()
    for _ in range(60):
        words = [f"n{draw.randint(0, 99)}" for _ in range(draw.randint(0, 300))]
        _, wanted = templates[draw.randrange(4)]
        at = draw.randint(0, len(words))
        words[at:at] = wanted.split()[: None if draw.random() < 0.7 else 3]
        codes = license_scan._codes(" ".join(words).encode(), cache, 3)
        spans = license_scan.find_templates([codes], classes, 0.8)[0]
        expected = set()
        for c in classes:
            for number, shingles in c.templates:
                for w in range(0, max(len(codes), 1), c.block):
                    inside = np.isin(shingles, codes[w : w + 2 * c.block]).sum()
                    if inside >= 0.8 * len(shingles):
                        expected.add(number)
        assert {s[0] for s in spans} == expected


def plain_containment(text, template, n=3):
    """Share of the template's shingles in the text, words compared without case or stops."""

    def shingles(t):
        words = [w.lower().strip(".,;:!?\"'()[]{}<>*#|") or w for w in t.split()]
        n_ = min(n, len(words))
        return {tuple(words[i : i + n_]) for i in range(len(words) - n_ + 1)}

    wanted = shingles(template)
    return len(wanted & shingles(text)) / len(wanted)


def test_whole_licenses_and_all_their_places(spark):
    prepared(spark)
    whole = dict(license_scan.LICENSE_TEXTS)
    filler = " ".join(f"f{i}" for i in range(700))
    mit, isc = whole["MIT-text"], whole["ISC-text"]
    bsd = whole["BSD-3-Clause-text"]
    half = " ".join(mit.split()[:80])
    data = [
        (1, f"{filler} {mit} {filler} {bsd}"), (2, f"{mit} {mit}\n{mit}"), (3, half),
        (4, f"{filler} {isc.lower()}"), (5, "/*" + "\n * ".join(mit.split("\n")) + " */"),
        (6, f"{filler}\n" * 300 + whole["Zlib-text"]),
    ]
    found = {}
    rows = spark.createDataFrame(data, "doc_id long, text string")
    for r in license_scan.scan_licenses(rows).collect():
        assert r["n_spans"] == len(r["spans"]) and r["first_word"] == r["spans"][0]["first_word"]
        assert r["containment"] == max(s["containment"] for s in r["spans"]) >= 0.8
        found[r["doc_id"], r["license"]] = [(s["first_word"], s["last_word"]) for s in r["spans"]]
    n = len(mit.split())
    assert found[1, "MIT-text"] == [(700, 700 + n - 1)]
    assert found[1, "BSD-3-Clause-text"] == [(1400 + n, 1400 + n + len(bsd.split()) - 1)]
    assert found[2, "MIT-text"] == [(0, n - 1), (n, 2 * n - 1), (2 * n, 3 * n - 1)]
    assert (3, "MIT-text") not in found and (3, "MIT-permission") in found
    assert found[4, "ISC-text"] == [(700, 700 + len(isc.split()) - 1)]
    assert found[6, "Zlib-text"][0][0] == 210_000
    for doc, text in data:
        for name, template in license_scan.TEMPLATES:
            if (doc, name) in found:
                assert plain_containment(text, template) >= 0.8
            elif doc != 2:
                assert plain_containment(text, template) < 0.8


def test_copies_side_by_side_are_several():
    places = np.array([0, 1, 2, 3, 4])
    wanted = np.arange(10, 15, dtype=np.uint64)

    def copies(*values):
        return license_scan.copies_in(np.array(values, np.uint64), wanted, places, 0.8)

    one = (10, 11, 12, 13, 14)
    assert copies(*one, 7, *one) == [(0, 4, 1.0), (6, 10, 1.0)]
    assert copies(*one, 10, 11) == [(0, 4, 1.0)]
    assert copies(13, 14, 7, 10, 11) == [(0, 4, 0.8)]
    assert copies(10, 11, 12) == []
    single = license_scan.copies_in(
        np.array([5, 5], np.uint64), np.array([5], np.uint64), np.array([0]), 0.8
    )
    assert single == [(0, 0, 1.0), (1, 1, 1.0)]


def test_bands_reach_the_wanted_probability():
    for j in (0.2, 0.375, 0.8):
        bands = license_scan.bands_needed(j, 1e-4)
        assert (1 - j) ** bands <= 1e-4 < (1 - j) ** (bands - 1)


# 3 phrase fingerprints


def test_parse_makes_the_phrases_of_the_text():
    draw = random.Random(2)
    for _ in range(50):
        data = bytes(draw.choice(b"ab") for _ in range(draw.randint(0, 200)))
        phrases, word = set(), b""
        for b in data:
            word += bytes([b])
            if word not in phrases:
                phrases.add(word)
                word = b""
        found = lz_fingerprint.Parse().feed(data)
        assert len(found) == len(set(found.tolist())) == len(phrases)


def test_fingerprints_on_odd_rows(spark, odd, empty):
    prepared(spark)
    got = lz_fingerprint.compare_with_next(odd).collect()
    order = sorted(ODD, key=lambda r: (r[0] is not None, r[0] or 0, (r[1] or "").encode()))
    texts = [t or "" for _, t in order]
    expected = Counter()
    for (key, _), text, after in zip(order, texts, texts[1:] + texts[:1], strict=True):
        edited = lz_fingerprint.edited_text(text, after)
        own, other = map(lz_fingerprint.fingerprint, (text, edited))
        digest = hashlib.sha256(edited.encode()).hexdigest()
        near = lz_fingerprint.likeness(own, lz_fingerprint.fingerprint(after))
        expected[
            key, len(text), digest, own, other, lz_fingerprint.likeness(own, other), near
        ] += 1
    assert Counter(map(tuple, got)) == expected
    assert lz_fingerprint.compare_with_next(empty).count() == 0


def plain_fingerprint(text):
    """Phrases of a dictionary parse as strings; 64 minimum hashes, by whole-number arithmetic."""
    full = (1 << 64) - 1

    def scramble(v):
        for _ in range(2):
            v = ((v ^ (v >> 32)) * 0xD6E8FEB86659FD93) & full
        return v ^ (v >> 32)

    known, phrase = set(), b""
    for byte in text.encode():
        phrase += bytes([byte])
        if phrase not in known:
            known.add(phrase)
            phrase = b""
    values = []
    for p in known:
        number = 0
        for byte in p:
            number = (number * 0x9E3779B97F4A7C15 + byte + 1) & full
        values.append(scramble(number))
    out = ""
    for i in range(1, 65):
        hashed = [((v ^ scramble(i)) * 0xD6E8FEB86659FD93) & full for v in values]
        low = min((v ^ (v >> 29) for v in hashed), default=full)
        out += f"{scramble(low) >> 48:04x}"
    return out


def test_fingerprint_equals_a_plain_one():
    draw = random.Random(8)
    for n in (0, 1, 2, 7, 100, 3000):
        text = "".join(draw.choices("abcé ü\n", k=n))
        assert lz_fingerprint.fingerprint(text) == plain_fingerprint(text)
        following = "".join(draw.choices("abz", k=n // 2 + 3))
        half = n // 2
        edited = text[: n - half] + following[:half]
        own, other, _ = lz_fingerprint.both_fingerprints(text, following, 64)
        assert (own, other) == (plain_fingerprint(text), plain_fingerprint(edited))
        a, b = ([p[i : i + 4] for i in range(0, 256, 4)] for p in (own, other))
        same = sum(x == y for x, y in zip(a, b, strict=True)) / 64
        assert lz_fingerprint.likeness(own, other) == same


def test_single_document_follows_itself(spark):
    one = spark.createDataFrame([(1, "abcabcabc")], "doc_id long, text string")
    row = lz_fingerprint.compare_with_next(one).first()
    assert row["near_next"] == 1
    assert row["edited_sha256"] == hashlib.sha256(b"abcababca").hexdigest()


@pytest.mark.parametrize("phrases", [10_000, 200_000, 2_000_000])
def test_unrelated_signatures_of_any_size_differ(phrases):
    draw = np.random.default_rng(phrases)
    one, other = (
        lz_fingerprint.fingerprint_string(
            lz_fingerprint.signature(draw.integers(0, 1 << 63, phrases, np.uint64), 64)
        )
        for _ in range(2)
    )
    assert lz_fingerprint.likeness(one, other) < 0.05


def test_unrelated_texts_of_some_megabytes_differ():
    # Other letters, so that no phrase is in both.
    one, other = ("".join(random.Random(6).choices(a, k=2_500_000)) for a in ("abcdefgh", "ABCDEFGH"))
    first = lz_fingerprint.fingerprint(one)
    assert lz_fingerprint.likeness(first, lz_fingerprint.fingerprint(other)) < 0.05
    assert lz_fingerprint.likeness(first, lz_fingerprint.fingerprint(one + "ab")) > 0.9


# 4 line dedup


def test_line_dedup_on_odd_rows(spark, odd, empty):
    prepared(spark)
    out = line_dedup.dedup_lines(odd, min_pages=4, max_ratio=0.3)
    assert out.columns[-3:] == ["clean_text", "n_lines", "n_dropped"]
    got = out.collect()
    assert len(got) == len(ODD)
    by_id = {r["doc_id"]: r for r in got}
    assert by_id[1]["clean_text"] == "The first own text of this table with some words in it."
    assert by_id[3]["clean_text"] == "\n  \nfin" and by_id[3]["n_dropped"] == 2
    assert by_id[4]["clean_text"] is None and by_id[4]["n_lines"] == 0
    assert by_id[5]["clean_text"] == "" and by_id[6]["clean_text"] == " \t\n\n "
    assert [r["clean_text"] for r in got if r["doc_id"] == 11] == ["repeated row"] * 3
    assert all("no key here" in r["clean_text"] for r in got if r["doc_id"] is None and r["text"])
    assert line_dedup.dedup_lines(empty).count() == 0
    with pytest.raises(ValueError):
        line_dedup.dedup_lines(odd, min_pages=1)


# 5 packing


def test_pack_is_best_fit():
    draw = random.Random(4)
    for _ in range(100):
        items = [
            (draw.randint(0, 20), draw.randint(-1, 4), draw.randint(-1, 6))
            for _ in range(draw.randint(0, 60))
        ]
        sizes, sources, clusters = map(list, zip(*items, strict=True)) if items else ([], [], [])
        got, offsets = packing.pack(sizes, sources, clusters, 20)
        assert got == best_fit(items, 20)
        ends = Counter()
        for b, at, size in zip(got, offsets, sizes, strict=True):
            assert at == ends[b]
            ends[b] += size
        assert max(ends.values(), default=0) <= 20


def test_packing_on_odd_rows(spark, odd, empty):
    prepared(spark)

    def run(df):
        return packing.pack_documents(
            df, packing.word_count(F.col("text")), packing.copy_cluster(F.col("text")),
            capacity=100, shard_rows=5,
        )

    got = run(odd).collect()
    words = Counter()
    for r in got:
        words[r["doc_id"]] += r["size"]
    expected = Counter()
    for key, text in ODD:
        expected[key] += len((text or "").encode().split())
    assert words == expected
    held = {}
    for r in got:
        held.setdefault(r["bin_id"], []).append(r)
    for b in held.values():
        named = [r["source"] for r in b if r["source"] is not None]
        assert len(set(named)) == len(named)
        assert sum(r["size"] for r in b) <= 100
    assert run(empty).count() == 0


# 6 WARC


def test_warc_on_odd_pages(spark):
    prepared(spark)
    same = "<p>" + "gleich " * 40
    data = [
        (5, "http://a/1", same, 1), (3, "http://a/2", same, 1), (9, None, same, 1),
        (3, "http://a/2", same, 1), (None, "http://n", same, 1), (1, "http://b\r\nX: y", "kurz", 2),
        (2, "u", "kurz", 2), (4, "u", None, 3), (6, "u", "", None), (7, "ü", "é" * 100_000, 1),
    ]
    schema = "page_id long, url string, html string, _digest int"
    df = spark.createDataFrame(data, schema).repartition(3)
    got = rows(warc.archive_round_trip(spark, df), "page_id", "payload_bytes", "payload_digest",
               "record_type", "refers_to")
    expected = Counter()
    for page, _, html, _ in data:
        payload = (html or "").encode()
        again = html == same and page != 3
        expected[
            page, len(payload), hashlib.sha256(payload).hexdigest(),
            "revisit" if again else "response", 3 if again else None,
        ] += 1
    assert got == expected
    assert warc.archive_round_trip(spark, df.where("false")).count() == 0


def test_warc_keeps_every_url(spark):
    prepared(spark)
    urls = ["http://a/%C3%BC?q=100%25", "http://a/50%", "http://b\r\nX: y", "http://b%0D%0Ac\n%25",
            "http://b%0A", "ü: é", "", " u ", None]
    df = spark.createDataFrame(
        [(i, u, f"p{i}") for i, u in enumerate(urls)], "page_id long, url string, html string"
    )
    got = rows(warc.archive_round_trip(spark, df), "page_id", "target_uri")
    assert got == Counter(enumerate(urls))
    record = warc.record_bytes(1, urls[0], b"", "", None, False)
    assert f"WARC-Target-URI: {urls[0]}\r\n".encode() in record


def test_records_follow_the_standard():
    """Mandatory fields, an HTTP head, and revisits that name their response."""
    date = "2024-05-01T00:00:00Z"
    payload = b"a\r\n\r\nb" * 30
    digest = hashlib.sha256(payload).hexdigest()
    for page in (0, 7, -3, 2**63 - 1, -(2**63)):
        assert warc.page_of(warc.page_record_id(page)) == page
        response = warc.record_bytes(page, "http://a", payload, digest, page, False, date)
        again = warc.record_bytes(1, "http://b", payload, digest, page, True, date)
        heads = [warc.parse_head(r[: r.index(b"\r\n\r\n")]) for r in (response, again)]
        for head in heads:
            assert head["WARC-Date"] == date and head["Content-Type"].startswith("application/http")
        assert heads[1]["WARC-Refers-To"] == heads[0]["WARC-Record-ID"] != heads[1]["WARC-Record-ID"]
        assert heads[1]["WARC-Profile"] == warc.REVISIT_PROFILE and "WARC-Profile" not in heads[0]
        assert response.split(b"\r\n\r\n", 2)[2] == payload + b"\r\n\r\n"
        assert warc.read_record(warc.deflate_member(again))["refers_to"] == page
    one, other = (warc.record_bytes(3, "u", b"", "", None, False) for _ in "ab")
    assert one != other  # repeated rows have ids of their own
    info, record = warc.split_records([warc.info_bytes("x.warc.gz", date) + response])
    assert info[0]["WARC-Type"] == "warcinfo" and record[1] == response


def test_heads_with_folded_lines_and_without_blanks():
    head = b"WARC/1.1\r\nA:1\r\nB:  two\r\n\tand three \r\nC:\r\nD: x:y"
    assert warc.parse_head(head) == {"A": "1", "B": "two and three", "C": "", "D": "x:y"}


class Pieces:
    def __init__(self, data, step):
        self.parts = [data[i : i + step] for i in range(0, len(data), step)]

    def read(self, _):
        return self.parts.pop(0) if self.parts else b""


def test_inflate_reads_single_and_many_members():
    data = bytes(random.Random(1).choices(b"abc", k=3_000_000))
    one = warc.deflate_member(data)
    many = b"".join(warc.deflate_member(data[i : i + 70_000]) for i in range(0, len(data), 70_000))
    for packed in (one, many, one + b"\0" * 20, one + b"\0" * 5000):
        for step in (997, 1 << 20):
            assert b"".join(warc.inflate(Pieces(packed, step))) == data
    with pytest.raises(ValueError):
        list(warc.inflate(Pieces(one[:-20], 4096)))


def test_folders_of_s3_are_known_by_one_scheme():
    assert [warc.store_uri(f"{s}://bucket/a") for s in ("s3", "s3a", "s3n", "hdfs")] == [
        "s3://bucket/a", "s3://bucket/a", "s3://bucket/a", "hdfs://bucket/a"]


def test_normalised_file_has_a_member_per_record(tmp_path):
    store, root = warc.open_store(f"file:{tmp_path}")
    bodies = [b"", b"x" * 10, b"a\r\n\r\nWARC/1.1\r\n" * 50_000]
    records = [
        warc.record_bytes(i, f"u{i}", b, hashlib.sha256(b).hexdigest(), None, False)
        for i, b in enumerate(bodies)
    ]
    (tmp_path / "in.gz").write_bytes(warc.deflate_member(b"".join(records)))
    assert warc.normalise_file(store, f"{root}/in.gz", f"{root}/out.gz") == 3
    packed = (tmp_path / "out.gz").read_bytes()
    for line, record in zip((tmp_path / "out.gz.idx").read_text().splitlines(), records,
                            strict=True):
        offset, length = map(int, line.split("\t")[:2])
        assert zlib.decompress(packed[offset : offset + length], 31) == record
    assert zlib.decompress(packed[: len(packed)], 31, len(records[0])) == records[0]


# 7 n-gram Jaccard join


def near_copies(seed):
    draw = random.Random(seed)
    words = [f"w{i}" for i in range(300)] + ["É", "é", "A", "a"]
    data = []
    for _ in range(25):
        size = draw.choice((0, 1, 2, 3, 5, 8, 12, 20, 40, 100, 300))
        base = [draw.choice(words) for _ in range(size)]
        for _ in range(draw.randint(1, 8)):
            text = list(base)
            for _ in range(draw.randint(0, max(1, len(text) // 40)) if text else 0):
                i, kind = draw.randrange(len(text)), draw.random()
                if kind < 0.4:
                    text[i] = draw.choice(words)
                elif kind < 0.7:
                    text.insert(i, draw.choice(words))
                elif len(text) > 1:
                    del text[i]
            data.append((len(data), " ".join(text)))
    return data


@pytest.mark.parametrize(("seed", "n", "percent"), [(1, 3, 90), (2, 5, 80), (3, 2, 60)])
def test_join_equals_all_pairs(spark, seed, n, percent):
    prepared(spark)
    data = near_copies(seed)
    df = spark.createDataFrame(data, "doc_id long, text string").repartition(4)
    got = jaccard_join.near_duplicates(df, n=n, percent=percent)
    assert rows(got, "doc_id", "n_shingles", "component_id") == Counter(groups(data, n, percent))


def test_join_on_odd_rows(spark, odd, empty):
    prepared(spark)
    got = jaccard_join.near_duplicates(odd)
    assert rows(got, "doc_id", "n_shingles", "component_id") == Counter(groups(ODD, 3, 90))
    kept = jaccard_join.keep_one(odd)
    assert kept.columns == odd.columns
    left = [r["doc_id"] for r in kept.collect()]
    assert left.count(11) == 1 and 12 in left and not {13, 14, 15, 16, 17} & set(left)
    assert {4, 5, 6} <= set(left)
    assert jaccard_join.near_duplicates(empty).count() == 0
    assert jaccard_join.keep_one(empty).count() == 0


def test_similar_sets_share_an_entry_in_every_allocation():
    draw = np.random.default_rng(3)
    for size in (3, 10, 19, 40, 200):
        for percent in (60, 80, 90):
            bounds = jaccard_join.size_bands(percent)
            for _ in range(20):
                a = draw.integers(0, 1 << 63, size, np.int64).astype(np.uint64)
                change = jaccard_join.most_different(size, size, percent) // 2
                b = a.copy()
                b[:change] = draw.integers(0, 1 << 63, change)
                label = sum(x <= size for x in bounds)
                top = bounds[label] - 1
                need = jaccard_join.most_different(top, top, percent) + 1
                for segments in (need, need + 3, 2 * need):
                    for tolerant in (0, segments // 2, segments):
                        one, two = (
                            jaccard_join.index_entries(s, label, segments, tolerant, need)
                            for s in (np.unique(a), np.unique(b))
                        )
                        assert np.intersect1d(one, two).size


def test_allocation_reaches_the_budget_and_follows_the_costs():
    for records in (10, 10**6, 10**12):
        for size, budget in ((4, 2), (10, 3), (100, 14), (100, 35), (5000, 1700)):
            segments, tolerant = jaccard_join.allocate(records, size, budget)
            assert segments + tolerant >= budget
    # Entries of one element cost comparisons when there are many records.
    assert jaccard_join.allocate(100, 400, 160)[1] == 0
    assert jaccard_join.allocate(10**9, 400, 160)[1] > 0


def near_family(seed, replaced):
    """Near copies of near copies: most links are there, many pairs just miss one."""
    draw = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    data = []
    for _ in range(4):
        family = [[draw.choice(words) for _ in range(draw.choice((60, 90, 150)))]]
        for _ in range(50):
            text = list(draw.choice(family))
            for _ in range(draw.randint(0, 5)):
                i, kind = draw.randrange(len(text)), draw.random()
                if kind < 0.4:
                    text[i] = draw.choice(words[:replaced])
                elif kind < 0.7:
                    text.insert(i, draw.choice(words))
                else:
                    del text[i : i + draw.randint(1, 3)]
            if draw.random() < 0.1:
                family.append(text)
            data.append((len(data), " ".join(text)))
    return data


@pytest.mark.parametrize(("seed", "percent", "replaced"), [(5, 90, 400), (6, 80, 20)])
def test_join_misses_no_link_of_a_large_group(spark, seed, percent, replaced):
    prepared(spark)
    data = near_family(seed, replaced)
    df = spark.createDataFrame(data, "doc_id long, text string").repartition(4)
    got = jaccard_join.near_duplicates(df, percent=percent)
    assert rows(got, "doc_id", "n_shingles", "component_id") == Counter(groups(data, 3, percent))


@pytest.mark.parametrize(
    ("seed", "percent", "limits"),
    [(5, 90, {"RUN": 3, "FEW": 3}), (6, 80, {"RUN": 20, "FEW": 5}), (7, 80, {"RUN_ELEMENTS": 500})],
)
def test_join_misses_no_link_of_spread_heads(spark, monkeypatch, seed, percent, limits):
    prepared(spark)
    for name, value in limits.items():
        monkeypatch.setattr(jaccard_join, name, value)
    data = near_family(seed, 40)
    df = spark.createDataFrame(data, "doc_id long, text string").repartition(4)
    got = jaccard_join.near_duplicates(df, percent=percent)
    assert rows(got, "doc_id", "n_shingles", "component_id") == Counter(groups(data, 3, percent))


def test_differences_that_meet_nothing_are_not_stored(spark, monkeypatch):
    prepared(spark)
    draw = random.Random(4)
    passage = " ".join(f"p{i}" for i in range(40))
    data = [(i, passage + " " + " ".join(f"w{draw.randrange(10**6)}" for _ in range(120)))
            for i in range(80)]
    data += [(80, data[7][1] + " end"), (81, "start " + data[9][1])]
    stored, across = [], jaccard_join._across

    def counted(stars, *args):
        stored.append((stars.count(), stars.where("size(prefix) > 0").count()))
        return across(stars, *args)

    monkeypatch.setattr(jaccard_join, "_across", counted)
    df = spark.createDataFrame(data, "doc_id long, text string").repartition(4)
    got = jaccard_join.near_duplicates(df, n=5, percent=80)
    assert rows(got, "doc_id", "n_shingles", "component_id") == Counter(groups(data, 5, 80))
    # Unlike texts that share a passage are compared with its heads, but have nothing to meet on.
    assert stored[0][0] > 100 and stored[0][1] < 20


def test_packed_longs_come_back():
    draw = np.random.default_rng(1)
    for n in (1, 7, 1000):
        values = draw.integers(0, 1 << 63, n).astype(np.uint64)
        assert np.array_equal(jaccard_join.unpack_longs(jaccard_join.pack_longs(values)), values)


def test_components_of_a_path_and_a_star(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(50)] + [(7, 7)]
    df = spark.createDataFrame(links, "a long, b long")
    got = dict(map(tuple, connected_components(df).collect()))
    assert got == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(50)}}


# 8 language identification


def test_gradients_match_differences():
    draw = np.random.default_rng(1)
    net = language_id.new_network(["a", "b"], 3, 2)
    for name in ("byte_in", "state_in", "bias", "out", "out_bias"):
        setattr(net, name, getattr(net, name).astype(np.float64))
    window = draw.integers(0, 256, (2, 5)).astype(np.uint8)
    used = np.array([[True] * 5, [True] * 3 + [False] * 2])
    labels = np.array([0, 1])
    _, grads = language_id.gradients(net, window, labels, used)
    for weight, grad in zip(net.weights(), grads, strict=True):
        for _ in range(4):
            at = tuple(draw.integers(0, n) for n in weight.shape)
            if weight is net.byte_in:
                at = (at[0], int(window[0, 1]), at[2])
            old = weight[at]
            weight[at] = old + 1e-3
            up, _ = language_id.gradients(net, window, labels, used)
            weight[at] = old - 1e-3
            down, _ = language_id.gradients(net, window, labels, used)
            weight[at] = old
            assert abs((up - down) / 2e-3 - grad[at]) < 2e-3


def test_language_on_odd_rows(spark, odd, empty):
    prepared(spark)
    net = language_id.fit(odd, min_steps=20)
    out = language_id.predict(odd, net)
    got = out.collect()
    assert len(got) == len(ODD)
    assert out.columns[-3:] == ["held_out", "lang_pred", "score"]
    for r in got:
        letters = any(c.isalpha() for c in r["text"] or "")
        assert (r["lang_pred"] == "und") == (not letters)
        assert 0 <= r["score"] <= 1
    nothing = language_id.predict(odd, language_id.fit(empty))
    assert {r["lang_pred"] for r in nothing.collect()} == {"und"}
    assert language_id.predict(empty, net).count() == 0


def test_network_equals_a_plain_forward_pass():
    net = language_id.new_network(["a", "b", "c"], 3, 4)
    text = "Grüße!".encode()
    h, n = 3, len(text)
    read = text.ljust(language_id.WINDOW, b"\0")

    def sigmoid(x):
        return 1 / (1 + math.exp(-x))

    sides = []
    for side in (0, 1):
        state, states = [0.0] * h, [None] * len(read)
        for t in range(len(read)) if side == 0 else reversed(range(len(read))):
            fed = [float(x) for x in net.byte_in[side][read[t]]]
            rec = [
                float(net.bias[side][j]) + sum(
                    state[i] * float(net.state_in[side][i][j]) for i in range(h)
                )
                for j in range(3 * h)
            ]
            update = [sigmoid(fed[j] + rec[j]) for j in range(h)]
            reset = [sigmoid(fed[h + j] + rec[h + j]) for j in range(h)]
            new = [math.tanh(fed[2 * h + j] + reset[j] * rec[2 * h + j]) for j in range(h)]
            state = [update[j] * state[j] + (1 - update[j]) * new[j] for j in range(h)]
            states[t] = state
        sides.append(states)
    pooled = [0.0] * 3
    for forwards, backwards in list(zip(*sides, strict=True))[:n]:
        both = [*forwards, *backwards]
        logits = [
            float(net.out_bias[k]) + sum(both[i] * float(net.out[i][k]) for i in range(2 * h))
            for k in range(3)
        ]
        total = sum(map(math.exp, logits))
        pooled = [p + math.exp(x) / total / n for p, x in zip(pooled, logits, strict=True)]
    assert np.allclose(language_id.document_probabilities(net, [text])[0], pooled, atol=1e-5)


def test_training_reads_all_of_a_text(spark, monkeypatch):
    prepared(spark)
    taken = []
    monkeypatch.setattr(language_id, "train", lambda samples: taken.append(samples))
    key = next(k for k in range(9) if zlib.crc32(str(k).encode()) % 3 != 1)
    whole = "".join(f"{i:05d} äöü " for i in range(3000))
    rows = [(key, whole, "de"), (key, "", "de"), (key, None, "de"), (key, "x", None), (None, "x", "d")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    language_id.fit(df)
    data = whole.encode()
    pieces = [data[i : i + 256] for i in range(0, len(data), 256)]
    assert Counter(taken[0]) == Counter((p, "de") for p in pieces)
    language_id.fit(df, sample_rows=40)
    few = [p for p, _ in taken[1]]
    assert len(few) == 40 and set(few) <= set(pieces)
    at = [pieces.index(p) for p in few]
    assert min(at) < len(pieces) / 4 and max(at) > 3 * len(pieces) / 4


def test_every_position_counts():
    net = language_id.new_network(["a", "b"], 4, 1)
    text = bytes(range(256)) * 3
    whole = language_id.document_probabilities(net, [text, text[:200], b"x"])
    alone = [language_id.document_probabilities(net, [t])[0] for t in (text, text[:200], b"x")]
    assert np.allclose(whole, alone, atol=1e-5)
    changed = language_id.document_probabilities(net, [text[:-1] + b"\0"])[0]
    assert not np.array_equal(whole[0], changed)


# 9 byte-level BPE


def test_bpe_round_trip_on_odd_rows(spark, odd, empty):
    import public_tokenizers

    prepared(spark)
    ranks = byte_bpe.load_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    coded = byte_bpe.encode(odd, ranks, public_tokenizers.PATTERN, block_bytes=3000)
    got = byte_bpe.decode(coded, ranks).collect()
    assert Counter((r["doc_id"], bytes(r["decoded"])) for r in got) == Counter(
        (k, (t or "").encode()) for k, t in ODD
    )
    none = byte_bpe.encode(empty, ranks, public_tokenizers.PATTERN)
    assert byte_bpe.decode(none, ranks).count() == 0


def test_encode_word_equals_the_library():
    import public_tokenizers
    import regex
    import tiktoken

    ranks = byte_bpe.load_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    library = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )
    draw = random.Random(1)
    for _ in range(500):
        text = "".join(draw.choices("abcde  \n\t12é漢字!?'s", k=draw.randint(0, 60)))
        text += draw.choice(("a" * 200, " " * 300, "", "の" * 50))
        words = regex.findall(public_tokenizers.PATTERN, text)
        ids = [i for w in words for i in byte_bpe.encode_word(w.encode(), ranks)]
        assert ids == library.encode_ordinary(text)


# 10 suffix-array dedup


def test_loser_tree_merges_with_right_prefixes():
    draw = random.Random(3)
    for _ in range(200):
        runs = [
            sorted(bytes(draw.choices(b"ab", k=draw.randint(0, 8)))
                   for _ in range(draw.randint(0, 12)))
            for _ in range(draw.randint(1, 9))
        ]
        prefixes = [
            [0, *(suffix_dedup.lcp_from(a, b, 0) for a, b in zip(r, r[1:], strict=False))]
            for r in runs
        ]
        out = list(suffix_dedup.merge_runs(runs, prefixes))
        keys = [runs[r][i] for r, i, _ in out]
        assert keys == sorted(sum(runs, []))
        for a, b, (_, _, shared) in zip(keys, keys[1:], out[1:], strict=False):
            assert shared == suffix_dedup.lcp_from(a, b, 0)


def passages(seed, letters, length):
    draw = random.Random(seed)
    words = ["".join(draw.choices(letters, k=draw.randint(1, 9))) for _ in range(300)]
    base = [" ".join(draw.choices(words, k=draw.randint(0, 60))) for _ in range(40)]
    texts = list(base)
    for _ in range(40):
        t, i, j = draw.choice(base), draw.randint(0, 200), draw.randint(0, 200)
        texts.append(draw.choice(base)[:i] + t[min(i, j) : max(i, j)] + draw.choice(words))
    texts += [base[0]] * 10 + ["", "a" * 500, "ab" * 200, "x" * (length - 1), "x" * (length - 1)]
    return [*enumerate(texts), (None, base[1]), (5, None), (3, texts[3])]


@pytest.mark.parametrize(
    ("seed", "letters", "length", "gram", "part_entries"),
    [(1, "abcdefgh é", 20, 8, 12_000), (2, "ab", 12, 5, 50), (3, "abc", 30, 10, 20),
     (4, "abcd", 20, 20, 30)],
)
def test_removal_equals_brute_force(spark, seed, letters, length, gram, part_entries):
    prepared(spark)
    data = passages(seed, letters, length)
    df = spark.createDataFrame(data, "doc_id long, text string").repartition(5)
    got = suffix_dedup.repeat_digests(
        df, length=length, gram=gram, part_entries=part_entries, run_bytes=3000
    )
    expected = repeats([(t or "").encode() for _, t in data], length)
    assert rows(got, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == Counter(
        (key, n, removed, runs, hashlib.sha256(kept).hexdigest())
        for (key, _), (n, removed, runs, kept) in zip(data, expected, strict=True)
    )


def test_texts_of_equal_hashes_stay(spark):
    """Sums modulo 2**64 meet on Thue-Morse patterns whatever their base; bytes must decide."""
    bits = [bin(i).count("1") % 2 for i in range(1024)]
    one, two = ("".join("ab"[b ^ flip] for b in bits) for flip in (0, 1))
    hasher = suffix_dedup.Hasher()
    hashes = [
        hasher.windows(hasher.sums(np.frombuffer(t.encode(), np.uint8)), 1024) for t in (one, two)
    ]
    assert hashes[0] == hashes[1] and one != two
    texts = [one, two, one[:-1] + "x", "y" + two[1:], f"some {one[:1000]}", f"more {two[:1000]}"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for parts in (12_000, 2):
        got = suffix_dedup.repeat_digests(df, length=1024, part_entries=parts).collect()
        assert [r["n_removed"] for r in got] == [0] * len(texts)
    again = spark.createDataFrame([*enumerate([*texts, two])], "doc_id long, text string")
    got = {r["doc_id"]: r for r in suffix_dedup.repeat_digests(again, length=1024).collect()}
    assert [got[i]["n_removed"] for i in range(7)] == [0, 1024, 0, 0, 0, 0, 1024]
    assert got[1]["n_kept"] == 0 and got[0]["n_kept"] == 1024


@pytest.mark.parametrize("seed", range(4))
def test_lying_hashes_are_told_apart(seed):
    draw = np.random.default_rng(seed)
    text = bytes(draw.choice(list(b"ab"), 300).astype(np.uint8))
    place = np.concatenate([np.arange(a, a + n) for a, n in ((0, 90), (100, 80), (220, 60))])
    strings = [text[p : p + 6] for p in place]
    for lies in (1, 3, 1 << 30):
        hashes = np.array([zlib.crc32(x) % lies for x in strings], np.uint64)
        told = suffix_dedup.told_apart(hashes, place, text, 6)
        assert len(set(zip(told.tolist(), strings, strict=True))) == len(set(strings))
        assert len(set(told.tolist())) == len(set(strings))


def test_suffix_dedup_on_odd_rows(spark, odd, empty):
    prepared(spark)
    out = suffix_dedup.remove_repeats(odd, length=100, gram=30)
    got = out.collect()
    assert len(got) == len(ODD)
    expected = repeats([(t or "").encode() for _, t in ODD], 100)
    assert Counter((r["doc_id"], r["n_removed"], r["n_spans"]) for r in got) == Counter(
        (k, removed, runs) for (k, _), (_, removed, runs, _) in zip(ODD, expected, strict=True)
    )
    texts = {r["doc_id"]: r["clean_text"] for r in got}
    assert texts[4] is None and texts[5] == "" and texts[8] == "é"
    assert suffix_dedup.remove_repeats(empty).count() == 0


@pytest.mark.parametrize(("seed", "letters", "length", "words", "word_gram"),
                         [(1, "abcdefgh é", 60, 6, 2), (2, "ab", 40, 5, 5), (3, "abc", 30, 4, 1)])
def test_passages_equal_brute_force(spark, seed, letters, length, words, word_gram):
    prepared(spark)
    data = passages(seed, letters, length)
    df = spark.createDataFrame(data, "doc_id long, text string").repartition(5)
    got = suffix_dedup.remove_passages(
        df, length=length, gram=length // 3, words=words, word_gram=word_gram
    )
    left = word_repeats([(t or "").encode() for _, t in data], words, length)
    assert rows(got, "doc_id", "clean_text") == Counter(
        (key, t if t is None else kept.decode("utf-8", "ignore"))
        for (key, t), kept in zip(data, left, strict=True)
    )


def test_passages_leave_the_spans_alone_staged(spark):
    """What the parts stage goes before the next, and the result moves each text once."""
    prepared(spark)
    before = set(staged_folders(spark))
    df = spark.createDataFrame(passages(4, "abcdefgh é", 60), "doc_id long, text string")
    got = suffix_dedup.remove_passages(df, length=60, gram=20, words=6, word_gram=2)
    left = {f.rsplit("-", 1)[0] for f in set(staged_folders(spark)) - before}
    assert left == {"suffix-spans"}
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join") == 1 and plan.count("_cut_text(") == 1


def staged_folders(spark):
    folder = os.path.join(staging_root(spark), "promolens")
    return os.listdir(folder) if os.path.isdir(folder) else []


def test_runs_of_words_across_pieces(monkeypatch):
    draw = random.Random(8)
    text = b" ".join(bytes(draw.choices(b"abc", k=draw.randint(1, 9))) for _ in range(3000))
    text += b" " + b"x" * 5000 + b" " + text[:4000]
    whole = suffix_dedup.word_runs(text, suffix_dedup.Hasher(), 51, 8, 400)
    monkeypatch.setattr(suffix_dedup, "PIECE", 700)
    parts = suffix_dedup.word_runs(text, suffix_dedup.Hasher(), 51, 8, 400)
    assert all(np.array_equal(a, b) for a, b in zip(whole, parts, strict=True))
    assert all(len(text[a:b].split()) == 51 for a, b in zip(whole[0], whole[1], strict=True))


def test_long_texts_are_hashed_in_parts():
    draw = random.Random(9)
    text = bytes(draw.choices(b"abcdefgh", k=400_000))
    _, anchor, first, last, _ = suffix_dedup.anchors([text], suffix_dedup.Hasher(), 400, 128)
    starts = np.concatenate([np.arange(a, b + 1) for a, b in zip(first, last, strict=True)])
    assert np.array_equal(starts, np.arange(len(text) - 399))
    assert (anchor >= first).all() or (anchor >= last).all()
    assert ((last <= anchor) & (anchor <= first + 272)).all()


def test_splitters_cut_inside_a_gram_only_if_it_fills_parts():
    sample = [b"aaaa" + bytes([i]) for i in range(100)] + [bytes([98 + i]) * 5 for i in range(20)]
    cuts = suffix_dedup.choose_splitters(sample, 12, 4)
    assert cuts == sorted(set(cuts)) and len(cuts) > 8
    assert any(len(c) > 4 and c[:4] == b"aaaa" for c in cuts)
    assert suffix_dedup.choose_splitters([], 5, 4) == []
