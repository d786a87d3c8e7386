"""Every registered query against its SQL, on the smallest given tables."""

from __future__ import annotations

import os
import re
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import compare
from __spark_entry__ import entry, oracle_sql, queries
from quaylake.registry.base import REGISTERED

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return compare.database(FOLDER)


@pytest.mark.parametrize("name", list(queries()))
def test_query_agrees_with_its_sql(spark, con, name):
    assert compare.difference(spark, con, FOLDER, name) is None


def test_entry(spark):
    assert entry(spark).columns == ["status", "total", "media"]


def test_a_difference_is_noticed(spark, con, monkeypatch):
    wrong = {**oracle_sql(), "console_total": "SELECT count(*) + 1 AS total FROM orders"}
    monkeypatch.setattr(compare, "oracle_sql", lambda: wrong)
    assert "first difference" in compare.difference(spark, con, FOLDER, "console_total")


def test_every_operator_is_shown():
    groups = {"A": 12, "B": 9, "C": 13, "D": 8, "E": 16, "F": 20, "G": 9, "H": 1, "L": 2, "M": 16}
    shown = {c for q in REGISTERED.values() for c in q.covers.split()}
    missing = {f"{g}{i}" for g, n in groups.items() for i in range(1, n + 1)} - shown
    assert missing == {"A5"}  # a database table: none is started, see test_jdbc_options
    assert all(re.fullmatch(r"[A-M]\d+", c) for c in shown)
