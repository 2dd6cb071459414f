"""Every registered query against its SQL twin on the smallest tables."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tools.compare import compare

SF = "/root/testdata/sf0.001"
NAMES = list(queries())


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, name):
    verdict, _, _ = compare(spark, name, queries()[name], oracle_sql().get(name), SF)
    assert verdict.startswith(("ok", "rows-only")), verdict


def test_entry(spark):
    assert set(entry(spark).columns) == {"lang", "source", "documents", "mean_length"}


def test_twins_have_queries():
    assert set(oracle_sql()) <= set(NAMES)
