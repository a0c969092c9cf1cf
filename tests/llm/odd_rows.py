"""Rows that every operator must bear, as fixtures for the tests of this folder."""

import pytest

EXTRA = (
    "doc_id long, text string, lang string, source string, n_chars long, kept string, file string, row string, key string, "
    "score string, ids string, position string, fp string, _raw string, held_out string, units string"
)
LONG = "lorem ipsum dolor sit amet " * 60_000


def rows():
    """Nulls in any column, empty and very long texts, ties, repeated rows, and columns with clashing names."""
    texts = [None, "", "   \n\t ", "a", "Wort für Wort, über alles.", LONG, LONG, "x" * 200_000, "1 2 3", "\u00e9\u00df\U0001f4a5 'll"]
    made = [(i, t, "en" if i % 2 else None, None if i % 3 else "s", None) for i, t in enumerate(texts)]
    made += [made[4], made[4], (None, "no id", "de", "s", 3), (None, None, None, None, None)]
    return [(*r, *"abcdefghijk") for r in made]


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(rows(), EXTRA)


@pytest.fixture(scope="session")
def none(spark, odd):
    return spark.createDataFrame([], odd.schema)


@pytest.fixture(scope="session")
def real(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
