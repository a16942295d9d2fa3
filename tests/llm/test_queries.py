"""Registered corpus queries against their SQL on the small tables."""

from __future__ import annotations

import pytest

from commentlens.llm.queries import ENTRIES
from tests.oracle import ROOT, connect, difference

FOLDER = f"{ROOT}/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


def test_one_query_an_operator():
    assert sorted(int(name[2:].split("_")[0]) for name in ENTRIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(n for n, (_, sql) in ENTRIES.items() if sql))
def test_equals_sql(spark, con, name):
    run, sql = ENTRIES[name]
    rows, problem = difference(spark, con, FOLDER, run, sql)
    assert not problem and rows > 0
