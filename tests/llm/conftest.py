import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long, n_words string, size string, kept string, component_id string"


def rows_of_table(folder, sql):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "labels"):
        con.execute(f"create view {t} as select * from '{folder}/{t}.parquet'")
    return con.execute(sql).fetchall()


@pytest.fixture(scope="session")
def texts(folder):
    return rows_of_table(folder, "select doc_id, text from documents order by doc_id")


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in every column, empty, blank and very long texts, copies, repeated rows, columns that clash with outputs."""
    long = " ".join(f"w{i % 997}x{i // 997}" for i in range(30_000))
    prose = " ".join(f"alpha{i}" for i in range(80))
    rows = [
        (1, prose + "\nsame line here to keep", "en", "a"), (2, prose + "\nsame line here to keep", "en", "a"),
        (2, prose + "\nsame line here to keep", "en", "a"), (3, None, "en", "a"), (4, "", None, None), (5, " \n\t ", "fr", "b"),
        (None, prose, "en", None), (None, None, None, None), (7, long, "en", "b"), (8, "one", "en", "b"), (9, "one", "de", "c"),
        (10, "é ▁ 漢字 😀 password = abcdef0123456789abcdef", "xx", "c"), (11, "\x0b\x0c\rA", "en", "a"), (12, prose + " tail", "en", "a"),
    ]
    return spark.createDataFrame([(i, t, a, s, None, "x", "y", "z", "q") for i, t, a, s in rows], DOCUMENTS)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], DOCUMENTS)
