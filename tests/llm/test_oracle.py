"""The queries that SQL can express against their DuckDB statements, on whole tables."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(__file__), "..", "..", "tools"))

from compare import compare  # noqa: E402

from conftest import SF_SMALL  # noqa: E402
from skyfold.llm.queries import ORACLE, QUERIES  # noqa: E402


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_query_matches_oracle(spark, key):
    assert key in QUERIES
    report = compare(spark, SF_SMALL, [key], verbose=False)
    assert report[key].startswith("OK"), report[key]
