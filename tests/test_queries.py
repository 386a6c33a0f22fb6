"""Every inventory row has a query, and the queries agree with their check SQL."""

import re

import pytest

import __spark_entry__ as entry
from checks.compare import compare, connect

SMALL = "/root/testdata/sf0.001"
SIZES = {
    "src": 5, "snk": 5, "cat": 1, "ing": 2, "pipe": 1, "prj": 15, "flt": 8, "cln": 10, "dim": 7,
    "fct": 7, "gld": 17, "jn": 11, "agg": 24, "win": 1, "srt": 4, "lim": 1, "set": 2, "scl": 20,
    "fea": 10, "feb": 7, "fep": 4, "fec": 3, "fei": 6, "fek": 3, "fem": 1, "eda": 14, "ml": 4,
    "udf": 1,
}


def test_every_inventory_row_has_a_query():
    # The pipeline and the corpus operators are no inventory rows.
    have = {m.group() for name in entry.queries() if (m := re.match(r"[a-z]+\d+", name))}
    want = {f"{family}{i}" for family, n in SIZES.items() for i in range(1, n + 1)}
    assert want - have == set()
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.fixture(scope="module")
def engine():
    return connect(SMALL)


@pytest.mark.parametrize("name", list(entry.oracle_sql()))
def test_against_check_sql(spark, engine, name):
    assert compare(entry.queries()[name](spark, SMALL), engine, entry.oracle_sql()[name]) == []


def test_entry(spark):
    assert entry.entry(spark).count() > 0
