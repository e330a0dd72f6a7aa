import duckdb
import pytest

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def rows():
    """The rows of a sample table as dictionaries."""

    def read(name):
        found = duckdb.sql(f"SELECT * FROM '{SMALL}/{name}.parquet'")
        return [dict(zip(found.columns, r, strict=True)) for r in found.fetchall()]

    return read


# Texts that operators must live with, as (id, text); ids repeat and miss.
ODD = [
    (1, None), (2, ""), (3, "   \n\t "), (4, "one"), (5, "!!! ... ---"), (6, "é ß Ünï"), (7, "word " * 30_000),
    (8, "same text in two rows"), (8, "same text in two rows"), (9, "same text in two rows"),
    (None, "a row without an id"), (None, None), (10, "0 1 2 3 4 5 6 7 8 9 10 11"), (11, "日本語 の テキスト"), (11, "another text"),
]


@pytest.fixture
def odd(spark):
    """The odd texts as documents, with further columns whose names operators use themselves."""
    data = [(k, t, "en", "s", 7, "x") for k, t in ODD]
    names = "doc_id long, text string, lang string, source string, score int, found string"
    return spark.createDataFrame(data, names)
