"""Every registered query gives what its SQL gives in DuckDB."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as entry_module
from oracle_check import connect, differences
from rivermark.registry import ORACLES, QUERIES

FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("key", sorted(entry_module.oracle_sql()))
def test_query_equals_sql(spark, con, key):
    sql = entry_module.oracle_sql()[key]
    assert differences(spark, con, entry_module.queries()[key], sql, FOLDER) is None


def test_every_report_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())


def test_entry_gives_windows(spark):
    rows = entry_module.entry(spark)
    assert rows.count() > 0
    assert rows.columns[:2] == ["janela_inicio", "janela_fim"]
