"""Rows that an operator must take without harm."""

import pytest

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, score double, n_tokens string, key string, position int, component_id string, rank int"
LONG = "One line of words, and 3 signs.\n" * 4_000 + "x" * 50_000 + " end"
TEXTS = [None, "", " \t\n ", "a", "...!? 123", "Ünïcödé 日本語 😀 text", "the same text twice " * 20, "the same text twice " * 20, LONG]


@pytest.fixture(scope="session")
def odd_docs(spark):
    rows = [(i, t, None if i % 3 else "en", None if i % 2 else "s", None, None, "x", "k", -1, "c", 0) for i, t in enumerate(TEXTS)]
    rows += [rows[6], rows[0]]  # repeated rows
    rows += [(None, "a row without an id, twice", None, None, None, 1.0, None, None, None, None, None)] * 2
    return spark.createDataFrame(rows, COLUMNS)


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)


@pytest.fixture(scope="session")
def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@pytest.fixture(scope="session")
def labels(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/labels.parquet")
