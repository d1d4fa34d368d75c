"""Every registered core query against its SQL on the smallest tables."""

import glob
from pathlib import Path

import duckdb
import pytest

from lexloom.plans import oracles, registry

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(DATA).is_dir(), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for f in glob.glob(f"{DATA}/*.parquet"):
        connection.execute(f"CREATE VIEW {Path(f).stem} AS SELECT * FROM '{f}'")
    return connection


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query(spark, duck, name):
    df = registry.queries()[name](spark, DATA)
    columns = sorted(df.columns)
    rows = sorted((tuple(r[c] for c in columns) for r in df.collect()), key=str)
    if name not in oracles.oracle_sql():
        assert rows
        return
    result = duck.execute(oracles.oracle_sql()[name])
    place = {d[0]: i for i, d in enumerate(result.description)}
    assert sorted(place) == columns
    expected = sorted((tuple(r[place[c]] for c in columns) for r in result.fetchall()), key=str)
    assert rows == expected


def test_contract(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
