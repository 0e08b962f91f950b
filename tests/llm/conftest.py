"""Small frames with the rows that operators meet only now and then."""
from __future__ import annotations

import pytest

SF = "/root/testdata/sf0.001"
LONG = " ".join(f"w{i % 977}" for i in range(40_000))
#: (doc_id, text): nulls, empty, blank, repeated, tied, very long, odd characters.
AWKWARD = [
    (None, "no id at all"), (1, None), (2, ""), (3, " \n\t "), (4, "one"),
    (5, "The same text, twice over here."), (6, "The same text, twice over here."),
    (7, "a b c d e f g"), (7, "a b c d e f g"), (7, "another text of the same id"),
    (8, LONG), (9, "ünï çödé 漢字 🙂 \x00 ▁ x"), (10, "  two  blanks \n\n and lines\n"),
]


@pytest.fixture(scope="session")
def awkward(spark):
    return spark.createDataFrame(
        [(i, t, "en", None if i == 4 else "s", 0, "clash") for i, t in AWKWARD],
        "doc_id long, text string, lang string, source string, n_chars long, node string")


@pytest.fixture(scope="session")
def empty(awkward):
    return awkward.limit(0)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def texts(documents):
    return {r["doc_id"]: r["text"] for r in documents.collect()}
