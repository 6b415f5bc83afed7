"""Every registered query against its SQL on the smallest data set."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_points
from check import rows_of

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="test tables not present")


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for file in Path(SF_DIR).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


@pytest.mark.parametrize("name", sorted(entry_points.oracle_sql()))
def test_query_equals_sql(spark, db, name):
    result = entry_points.queries()[name](spark, SF_DIR)
    answer = db.execute(entry_points.oracle_sql()[name])
    columns = [column[0] for column in answer.description]
    assert sorted(columns) == sorted(result.columns)
    assert rows_of(result.columns, result.collect()) == rows_of(columns, answer.fetchall())


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0


def test_bernoulli_sample(spark):
    taken = entry_points.queries()["bernoulli_sample"](spark, SF_DIR)
    assert 0 < taken.count() < 200
