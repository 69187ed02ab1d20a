from __future__ import annotations

import pytest


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty and very long texts, repeated rows, a clashing extra column."""
    long = " ".join(f"word{k % 997}x{k}" for k in range(30_000))
    short = "one two three four five six seven eight nine ten " * 8
    rows = [
        (1, None, None, None, None),
        (2, "", "en", "a", 7),
        (None, "null id text with some words in it", "en", "b", 1),
        (3, long, "de", "a", 2),
        (4, short, "en", None, 3),
        (4, short, "en", None, 3),
        (5, short.upper(), None, "b", 4),
        (6, "..", "fr", "", 5),
        (7, "Ünïcode text \u0000 with \u2028 odd 漢字 marks", "fr", "c", 6),
        (8, "\n \t ", "fr", "c", 6),
    ]
    # The extra columns have names that the operators use themselves
    return spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, size long"
    ).selectExpr("*", "1 AS digest", "2 AS row", "doc_id AS node", "text AS row_a")


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.where("false")
