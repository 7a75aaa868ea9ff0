"""Every registered query with SQL gives the SQL's rows; the others give rows."""

import glob
import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.abspath(__file__)), ".."))

import __spark_entry__ as entry  # noqa: E402
from tools.check import TABLES, rows_of  # noqa: E402

QUERIES, SQL = entry.queries(), entry.oracle_sql()
SLOW = {"train_on_vectors", "train_on_texts", "svm_report", "grid_search", "random_search"}  # run in test_learning on a small frame


@pytest.fixture(scope="module")
def con(folder):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{folder}/{t}.parquet'")
    return c


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - SLOW))
def test_query(spark, folder, con, name):
    df = QUERIES[name](spark, folder)
    got = df.collect()
    if name in SQL:
        cur = con.execute(SQL[name])
        assert rows_of(df.columns, got) == rows_of([d[0] for d in cur.description], cur.fetchall())
    else:
        assert got


def test_entry(spark):
    assert entry.entry(spark).columns == ["source_news", "articles", "latest"]
    assert entry.entry(spark).count() > 0


def test_no_forbidden_lineage_cuts():
    root = os.path.join(os.path.dirname(os.path.abspath(__file__)), "..", "newsloom")
    for path in glob.glob(f"{root}/**/*.py", recursive=True):
        assert "local" + "Checkpoint" not in open(path, encoding="utf-8").read()
