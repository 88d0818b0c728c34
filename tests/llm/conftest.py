import math
import os

import duckdb
import pytest

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def duck():
    connection = duckdb.connect()
    for file in sorted(os.listdir(SF_DIR)):
        connection.execute(f"CREATE VIEW {file.removesuffix('.parquet')} AS SELECT * FROM '{SF_DIR}/{file}'")
    return connection


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture(scope="session")
def sample(spark):
    """Documents of the test data as (doc_id, text, lang, source)."""
    rows = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text", "lang", "source").collect()
    return [tuple(row) for row in rows]


ODD_TEXTS = [
    None, "", " ", "\n\t \n", "a", "Ä", "one two", "12345", "x" * 70_000, "word " * 9_000, "né à l'été 日本語 😀▁ z",
    "same text here for you and me", "same text here for you and me", "Same TEXT here for you and me", "a\x00b \x1f\x85\xa0c",
]


@pytest.fixture(scope="session")
def odd_documents(spark):
    """Nulls in every column, empty and long texts, repeated rows, and columns whose names clash with results."""
    names = ["score", "kept", "ids", "topic", "weight", "spans", "row", "id", "kind", "n", "component_id", "held_out"]
    rows = [(None if k == 3 else k, text, None if k % 4 == 0 else "en", None if k % 3 == 0 else "s", k, *["clash"] * len(names)) for k, text in enumerate(ODD_TEXTS)]
    rows += [rows[5], rows[5], (None, *rows[3][1:])]
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{n} string" for n in names)
    return spark.createDataFrame(rows, schema).repartition(3)


@pytest.fixture(scope="session")
def no_documents(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")


def close(a: float, b: float) -> bool:
    return math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-9)
