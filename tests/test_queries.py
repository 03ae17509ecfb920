"""Every registered query against its SQL on the smallest tables."""

import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as driver  # noqa: E402
from siltbed.plans.queries import ORACLES, QUERIES  # noqa: E402

SF = "/root/testdata/sf0.001"
TABLES = [p.stem for p in Path(SF).glob("*.parquet")]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return con


def _plain(value):
    value = value.item() if hasattr(value, "item") else value
    return None if value != value else value


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, duck, name):
    got = driver.queries()[name](spark, SF)
    want = duck.execute(driver.oracle_sql()[name])
    columns = [c[0] for c in want.description]
    assert sorted(got.columns) == sorted(columns)
    have = sorted((tuple(map(_plain, r)) for r in got.select(*columns).collect()), key=repr)
    assert have == sorted((tuple(map(_plain, r)) for r in want.fetchall()), key=repr)


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLES.keys()


def test_entry(spark):
    assert driver.entry(spark).count() == 1000
