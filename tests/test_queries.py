"""Registered queries against their SQL."""

import pytest

import __spark_entry__ as entry
from grantflow.plans import QUERIES

from .conftest import SMALL
from .oracle import compare, connect

def names():
    """All queries but those of the optional subpackage, which has tests of its own."""
    return list(QUERIES)


@pytest.fixture(scope="module")
def con():
    return connect(SMALL)


@pytest.mark.parametrize("name", names())
def test_query(spark, con, name):
    assert compare(spark, con, name, entry.queries()[name], entry.oracle_sql().get(name), SMALL) == ""


def test_entry_gives_rows(spark):
    assert entry.entry(spark).count() == 2990


def test_every_operator_is_registered():
    wanted = [f"{k}{i:02d}" for k, n in dict(s=17, p=12, g=22, w=11, c=15, k=7, m=17, t=19).items() for i in range(1, n + 1)]
    assert not [w for w in wanted if not any(q.startswith(w + "_") for q in entry.queries())]
