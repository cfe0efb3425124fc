"""Every registered query against its SQL on the smallest tables."""

import re
from pathlib import Path

import pytest

import __spark_entry__ as entry
from forumlens.workload.registry import ENTRIES
from tools.compare import compare, connect

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def db():
    return connect(SF)


@pytest.mark.parametrize("name", list(ENTRIES))
def test_query(spark, db, name):
    assert compare(spark, db, SF, name).startswith(("ok", "rows"))


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0


def test_every_query_has_sql():
    assert set(ENTRIES) <= set(entry.oracle_sql())


def test_no_query_limits_its_rows():
    for name, sql in ((n, e.sql) for n, e in ENTRIES.items()):
        if name != "batch_ledger":
            assert not re.search(r"\bLIMIT\b", sql), name
