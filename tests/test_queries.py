"""Every registered query against its oracle on the smallest data set."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from compare import compare

SF = "/root/testdata/sf0.001"
QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, name):
    assert compare(spark, SF, name, QUERIES[name], ORACLES.get(name)) is None


def test_every_oracle_belongs_to_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
