"""Every named query of the store against its SQL twin on the smallest table set."""

import sys
from pathlib import Path

import pytest

import __spark_entry__ as entry
from mercato.catalog.all import ORACLES, QUERIES

sys.path.insert(0, str(Path(__file__).resolve().parents[1] / "tools"))

NAMES = sorted(QUERIES)
ROWS_ONLY = {"scan_bytes"}


@pytest.fixture(scope="module")
def duck(sf_dir_module):
    check_sql = pytest.importorskip("check_sql")
    return check_sql.duck(sf_dir_module)


@pytest.fixture(scope="module")
def sf_dir_module():
    import os

    from store_rows import SMALL

    if not os.path.isdir(SMALL):
        pytest.skip("benchmark tables not present")
    return SMALL


def test_names():
    assert set(ORACLES) == set(NAMES) - ROWS_ONLY
    assert QUERIES.items() <= entry.queries().items() and ORACLES.items() <= entry.oracle_sql().items()
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark, sf_dir):
    assert "total_revenue" in entry.entry(spark).columns


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_sql(spark, duck, sf_dir_module, name):
    import check_sql

    note, _, ok = check_sql.compare(spark, duck, sf_dir_module, name)
    assert ok, note
