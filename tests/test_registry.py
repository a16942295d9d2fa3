"""Registered queries against their SQL.

By default the composite queries; ``ORACLE_FULL=1`` runs every entry. The same
comparison for any scale is ``python tests/oracle.py <sf>``.
"""

import os
import re

import pytest

from commentlens import registry
from tests.oracle import ROOT, connect, difference

FOLDER = f"{ROOT}/sf0.001"
SQL = registry.oracle_sql()
FULL = os.environ.get("ORACLE_FULL") == "1"
NAMES = sorted(n for n in SQL if FULL or re.match(r"q\d\d_", n))


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


def test_names_agree():
    assert set(SQL) <= set(registry.queries())


@pytest.mark.parametrize("name", NAMES)
def test_equals_sql(spark, con, name):
    rows, problem = difference(spark, con, FOLDER, registry.queries()[name], SQL[name])
    assert not problem
    assert rows >= 0


def test_entry(spark):
    from __spark_entry__ import entry

    assert entry(spark).count() > 0
