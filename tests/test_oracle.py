"""Every registered query against its SQL on the smallest data."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import __spark_entry__ as entry
from tools.compare import compare, database

from splitweave.checks.registered import ORACLES, QUERIES  # noqa: E402  after the entry, which registers them


@pytest.fixture(scope="module")
def con(sf):
    return database(sf)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, sf, name):
    assert compare(spark, con, sf, name, QUERIES[name], ORACLES.get(name)).startswith("ok")


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


def test_entry(spark):
    rows = entry.entry(spark)
    assert rows.count() == 3 and "pk_dupes" in rows.columns
