from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    # Names that the operators use themselves or add.
    "_key string, k string, host int, kept string, clean_text int, text_hash string, "
    "component double, _row date, ids string, score string, size string, piece string"
)


def odd_rows() -> list[tuple]:
    """NULLs in every column, empty and long texts, ties, repeated rows."""
    long = " ".join(f"wort{i % 977} größe {i}" for i in range(20_000))
    line = "A line that many pages have, word for word, and which says nothing at all."
    rows = [
        (1, f"{line}\nThe first own text of this table with some words in it.", "en", "s0", 5),
        (2, f"{line}\nDer zweite Text mit anderen Wörtern, und so weiter.", "de", "s0", 5),
        (3, f"{line}\n{line}\n\n  \nfin", "fr", "s0", None),
        (4, None, "en", "s0", 0),
        (5, "", "en", None, 0),
        (6, " \t\n\n ", None, "s1", 3),
        (7, long, "de", "s1", len(long)),
        (8, "é", "fr", "s1", 1),
        (9, "123 !!! %%% ###", "en", "s1", 15),
        (10, "a " * 3000, "en", "s0", 6000),
        (None, f"{line}\nno key here", "en", None, 1),
        (None, None, None, None, None),
    ]
    rows += [(11, f"{line}\nrepeated row", "en", "s0", 1)] * 3
    rows += [(12 + i, f"{line}\ncopy of a text {'word ' * 60}", "en", "s0", 1) for i in range(6)]
    return rows


@pytest.fixture(scope="session")
def odd(spark):
    extra = ("x",) + ("y", 1, "z", 2, "h", 0.5, None, "i", "s", "t", "u")
    return spark.createDataFrame([(*r, *extra) for r in odd_rows()], SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def empty(odd):
    return odd.where("false")
