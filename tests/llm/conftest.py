from __future__ import annotations

import pytest
from pyspark.sql import types as T

# Nulls in every column, empty and very long texts, ties, repeated rows, extra columns.
LONG = "alpha beta gamma. " * 4000
ROWS = [
    (1, "Plain text, nothing else.", "en", "a", 25, "x", 9),
    (2, "Plain text, nothing else.", "en", "a", 25, "y", 9),
    (2, "Plain text, nothing else.", "en", "a", 25, "y", 9),
    (3, "", "de", "b", 0, None, None),
    (4, None, None, None, None, None, None),
    (None, "no key here +49 30 1234567", "en", "b", 26, "z", 1),
    (6, LONG, "fr", "b", len(LONG), "z", 1),
    (7, "ünï¢öde \U0001F600 漢字\n\nsecond line <|endoftext|> it's", "fr", "c", 40, "z", 1),
    (8, "   \n\t ", "en", "c", 6, "z", 1),
]
SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType()), T.StructField("fp", T.StringType()),
    T.StructField("n_tokens", T.IntegerType())])


@pytest.fixture(scope="session")
def odd(spark):
    """A documents table of edge cases, with extra columns named like ones the operators add."""
    return spark.createDataFrame(ROWS, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)
