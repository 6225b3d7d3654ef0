"""Every registered query against its SQL, on the smallest tables."""

from __future__ import annotations

from functools import cache

import duckdb
import pytest

import __spark_entry__ as entry
from sentrel.plans import catalog, ingest_catalog
from sentrel.plans.registry import QUERIES
from tests.compare import duck_rows, register, spark_rows

SF_DIR = "/root/testdata/sf0.001"
SQL = {name: sql for name, sql in entry.oracle_sql().items() if name in QUERIES}


@pytest.fixture(scope="module")
def tables():
    con = duckdb.connect()
    register(con, SF_DIR)
    return con


@pytest.fixture(scope="module", autouse=True)
def stages_once():
    """The queries share their first stages here; outside the tests each builds its own."""
    patch = pytest.MonkeyPatch()
    for module, names in ((catalog, ("_events", "_state")), (ingest_catalog, ("_uploads", "_sources"))):
        for name in names:
            patch.setattr(module, name, cache(getattr(module, name)))
    patch.setattr(catalog.inv, "detect", cache(catalog.inv.detect))
    patch.setattr(catalog.inv, "correlate_alerts", cache(catalog.inv.correlate_alerts))
    yield
    patch.undo()


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, tables, name):
    assert spark_rows(QUERIES[name](spark, SF_DIR)) == duck_rows(tables, SQL[name])


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0
