"""Every registered query against its SQL in DuckDB, on the smallest tables."""

import pathlib
import sys

import duckdb
import pytest

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parents[1] / "tools"))

import __spark_entry__ as entry  # noqa: E402
from check_oracle import rows_of  # noqa: E402

SF_DIR = pathlib.Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not SF_DIR.exists(), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in SF_DIR.glob("*.parquet"):
        connection.sql(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def test_every_query_has_its_sql():
    own = {name for name in entry.queries() if not name.startswith("op") and name != "pipeline"}
    assert own <= set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", list(entry.oracle_sql()))
def test_query(spark, duck, name):
    frame = entry.queries()[name](spark, str(SF_DIR))
    result = duck.sql(entry.oracle_sql()[name])
    assert sorted(frame.columns) == sorted(result.columns)
    ours = rows_of(frame.columns, frame.collect())
    assert ours and ours == rows_of(result.columns, result.fetchall())


def test_entry(spark):
    assert entry.entry(spark).columns[:2] == ["product_id", "title"]
