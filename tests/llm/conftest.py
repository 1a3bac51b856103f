from __future__ import annotations

import pytest

from tests.conftest import SF0001

DOCS = "doc_id long, text string, lang string, source string, n_chars long"

#: Nulls in every column, empty, blank and odd texts, repeated rows.
ODD = [
    (1, "one two three four five six", "en", "a", 27), (2, "", "en", "a", 0), (3, None, None, None, None),
    (4, "  \t\n ", "de", "b", 5), (5, "ONE TWO three four five six", "en", "a", 27), (5, "ONE TWO three four five six", "en", "a", 27),
    (None, "no id here at all", "en", None, 17), (7, "word " * 3000, "fr", "b", 15000),
    (8, "a  b\r\n\n c d \U0001f600 ▁x <|endoftext|> it's", None, "c", 30), (9, "12 34 -- !!", "es", "c", 11),
]


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(ODD, DOCS).cache()


@pytest.fixture(scope="session")
def odd_extra(odd):
    """Extra columns whose names clash with those the operators use inside."""
    from pyspark.sql import functions as F
    names = ("fp", "key", "component_id", "rate", "weight", "n_copies", "rate_source", "kept", "score", "held_out", "root")
    return odd.select("*", *[F.lit("x").alias(n) for n in names])


@pytest.fixture(scope="session")
def empty(odd):
    return odd.limit(0)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF0001}/documents.parquet").cache()


@pytest.fixture(scope="session")
def labels(spark):
    return spark.read.parquet(f"{SF0001}/labels.parquet").cache()
