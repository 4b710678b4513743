from __future__ import annotations

import duckdb
import pytest

SF = "/root/testdata/sf0.001"

ODD = [
    (None, None, "en"),
    (None, "Of the and to the and.", None),
    (1, None, "en"),
    (2, "", "en"),
    (3, " \n\t \n", "en"),
    (4, "!!! ### ???", "en"),
    (5, "One two three four five six.\nOf the and to the and.", "en"),
    (5, "One two three four five six.\nOf the and to the and.", "en"),
    (5, "Another text of the same id.", "fr"),
    (6, "naïve Ünïcödé \U0001f600 text\r\nwith\x00 odd bytes\x0b.", "de"),
    (7, " ".join(f"word{i % 977}x{i % 13}" for i in range(30_000)), "en"),
    (8, "Der Der Der Der Der Der Der Der " * 40, "de"),
]
SCHEMA = (
    "doc_id bigint, text string, lang string, id int, node int, bucket int, n_words int, "
    "ids int, spans int, score int, key int, removed int, fingerprint int, digest int"
)


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty and long texts, repeated ids and rows, columns that operators use themselves."""
    return spark.createDataFrame([(*row, *[7] * 11) for row in ODD], SCHEMA)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def texts():
    """doc_id -> text of the smallest table."""
    found = duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall()
    return dict(found)
