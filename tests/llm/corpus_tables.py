"""Fixtures of the corpus tests; a second conftest would hide the first."""

import pytest
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

SCHEMA = StructType([
    StructField("doc_id", LongType()), StructField("text", StringType()), StructField("lang", StringType()),
    StructField("source", StringType()), StructField("n_chars", LongType()),
    # names that operators use themselves
    *[StructField(c, IntegerType()) for c in ("id", "row", "size", "node", "copies", "score", "host", "rest", "n")],
])


@pytest.fixture(scope="session")
def docs(spark):
    """Builds a documents table with extra columns from ``(doc_id, text, lang, source)`` rows."""

    def build(rows):
        return spark.createDataFrame([(*r, len(r[1] or ""), *range(9)) for r in rows], SCHEMA)

    return build


def prose(start, n):
    """``n`` words that no other start gives within its range."""
    return " ".join(f"w{start + i}" for i in range(n))


@pytest.fixture(scope="session")
def odd_rows():
    long_text = prose(10_000, 30_000)
    return [
        (1, None, "en", "a"), (2, "", None, "a"), (3, " \t\n ", "en", None), (4, "one two three", "en", "b"),
        (5, "one two three", "de", "b"), (6, long_text, "en", "a"), (7, prose(0, 120), "en", "a"),
        (7, prose(0, 120), "en", "a"), (None, "nameless text of a few words", "fr", "c"), (None, None, None, None),
        (8, "the the the the " * 30, "en", "b"), (9, "größe straße\n漢字 かな!!!", "de", "ü"),
    ]
