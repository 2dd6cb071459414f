"""Queries of tests must show both verdicts, or a test that keeps everything would pass as well."""

import pytest

from __spark_entry__ import queries
from sluice.plans.queries.filters import CODE_TESTS, FILTERS

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", FILTERS)
def test_filter_keeps_some(spark, name):
    kept = queries()[f"filter_{name}"](spark, SF).count()
    assert 0 < kept < spark.read.parquet(f"{SF}/documents.parquet").count()


@pytest.mark.parametrize("name", CODE_TESTS)
def test_code_label_has_both_values(spark, name):
    labels = queries()[f"code_{name}"](spark, SF).select(f"{name}_label").distinct().collect()
    assert {r[0] for r in labels} == {0, 1}
