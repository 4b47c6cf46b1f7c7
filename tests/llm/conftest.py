"""Small tables with the awkward rows that every operator must bear."""

from __future__ import annotations

import pytest

from clickweave.llm import common

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(autouse=True)
def importable(spark):
    common.importable(spark)


@pytest.fixture
def documents(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


@pytest.fixture
def awkward(spark):
    """Nulls in any column, empty and very long texts, repeated rows, and columns named like the operators' own."""
    words = " ".join(f"word{i % 977}" for i in range(20_000))
    rows = [
        (None, "some words without an id", "en", "a", 5), (1, None, "en", "a", None), (2, "", "en", "a", 0), (3, "   \n\t ", "en", None, 5),
        (4, words, "en", "b", len(words)), (5, "x" * 50_000, None, "b", 50_000), (6, "the same words again and again here", "en", "c", 1),
        (6, "the same words again and again here", "en", "c", 1), (7, "the same words again and again here", "en", "c", 1),
        (8, "!!! ... 123", "en", "c", 11), (9, "日本語のテキスト 🙂 ß É", "ja", "c", 1), (100, "the same words but in another order", "en", "c", 1),
    ]
    frame = spark.createDataFrame(rows, SCHEMA)
    return frame.selectExpr("*", "1 AS score", "'x' AS held_out", "2 AS component", "3 AS `key`", "4 AS words")


@pytest.fixture
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
