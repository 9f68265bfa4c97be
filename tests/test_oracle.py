"""Every registered query against DuckDB on the smallest tables."""

from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1] / "tools"))

import __spark_entry__ as entry  # noqa: E402
import compare  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="test tables are absent")


@pytest.fixture(scope="module")
def base():
    return compare.tables(SF_DIR)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_same_as_sql(spark, base, name):
    assert compare.difference(entry.queries()[name](spark, SF_DIR), base, entry.oracle_sql()[name]) is None


def test_entry(spark):
    rows = {r.rule_name: r.rows_passed for r in entry.entry(spark).collect()}
    # Rows that pass each check on the smallest tables.
    assert rows == {
        "completeness_customer_id": 5762, "completeness_order_amount": 5756,
        "validity_quantity_positive": 5837, "validity_order_date": 5813,
        "uniqueness_order_id": 4599, "integrity_product_id": 5825,
        "integrity_customer_id": 5641, "accuracy_amount_matches": 5591,
    }
