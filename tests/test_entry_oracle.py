"""Every registered query against its DuckDB oracle (the driver's check,
run here on sf0.001), plus the entry contract."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))),
                                "tools"))

import __spark_entry__ as E  # noqa: E402
from skyfold.plans.registry import QUERIES  # noqa: E402
from compare import compare  # noqa: E402

from conftest import SF_SMALL  # noqa: E402


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["city_key", "weather_date", "avg_LowestTemp", "avg_HighestTemp",
                          "flag_HighestTemp"]
    assert df.count() > 0


def test_oracle_keys_are_queries():
    assert set(E.oracle_sql()) <= set(E.queries())
    assert set(QUERIES) <= set(E.oracle_sql())


@pytest.fixture(scope="module")
def report(spark):
    return compare(spark, SF_SMALL, sorted(QUERIES), verbose=False)


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query_matches_oracle(report, key):
    assert report[key].startswith("OK") or report[key].startswith("rows-only"), report[key]
