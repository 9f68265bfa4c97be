"""Each check on its own defect, and the edge cases of the contract."""

from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F
from rows import customers, default_checks, orders, products

from siltgate.operators import checks as c
from siltgate.operators import gate


def failures(spark, *changes, limits=None):
    """order_id -> (failed, warned) lists, in row order per id."""
    rules = default_checks(spark)
    args = (limits,) if limits else ()
    found = {}
    for row in gate.judge(orders(spark, *changes), rules, *args).collect():
        found.setdefault(row.order_id, []).append((row[gate.FAILED], row[gate.WARNED]))
    return found


def test_clean_row(spark):
    assert failures(spark, {}) == {"O1": [([], [])]}


@pytest.mark.parametrize(
    ("change", "rule"),
    [
        ({"customer_id": ""}, "completeness_customer_id"),
        ({"customer_id": "   "}, "completeness_customer_id"),
        ({"customer_id": None}, "completeness_customer_id"),
        ({"order_amount": ""}, "completeness_order_amount"),
        ({"order_amount": None}, "completeness_order_amount"),
        ({"quantity": "-2"}, "validity_quantity_positive"),
        ({"quantity": "0"}, "validity_quantity_positive"),
        ({"quantity": "abc"}, "validity_quantity_positive"),
        ({"order_date": "2025-13-40"}, "validity_order_date"),
        ({"order_date": None}, "validity_order_date"),
        ({"product_id": "P999"}, "integrity_product_id"),
        ({"product_id": None}, "integrity_product_id"),
        ({"customer_id": "C99999"}, "integrity_customer_id"),
    ],
)
@pytest.mark.parametrize("scale", ["small", "large"])
def test_each_defect(spark, large, change, rule, scale):
    found = failures(spark, change, limits=large if scale == "large" else None)
    assert rule in found["O1"][0][0]


def test_blank_customer_fails_completeness_and_integrity(spark):
    assert failures(spark, {"customer_id": None})["O1"][0][0] == [
        "completeness_customer_id", "integrity_customer_id",
    ]


def test_soft_check_warns_only(spark):
    assert failures(spark, {"order_amount": "9.99"}) == {"O1": [([], ["accuracy_amount_matches"])]}


def test_null_result_of_a_soft_check_warns(spark):
    assert failures(spark, {"unit_price": "x"})["O1"] == [([], ["accuracy_amount_matches"])]


def test_nan_amount_is_complete_but_not_accurate(spark):
    assert failures(spark, {"order_amount": "NaN"})["O1"] == [([], ["accuracy_amount_matches"])]


def test_one_cent_off_fails_in_doubles(spark):
    assert failures(spark, {"order_amount": "2.41"})["O1"][0][1] == ["accuracy_amount_matches"]


def test_second_copy_is_a_repeat(spark):
    found = failures(spark, {}, {})["O1"]
    assert sorted(f for f, _ in found) == [[], ["uniqueness_order_id"]]


def test_bad_first_copy_still_comes_first(spark):
    later = {"_ingested_at": datetime(2025, 1, 2)}
    found = failures(spark, {"quantity": "-1"}, later)["O1"]
    assert sorted(f for f, _ in found) == [["uniqueness_order_id"], ["validity_quantity_positive"]]


def test_null_order_ids_are_one_group(spark):
    found = failures(spark, {"order_id": None}, {"order_id": None}, {"order_id": None})[None]
    assert sorted(f for f, _ in found) == [[], ["uniqueness_order_id"], ["uniqueness_order_id"]]


def test_duplicate_reference_keys_do_not_multiply_rows(spark, large):
    rules = c.order_checks(products(spark, "P001", "P001"), customers(spark))
    for limits in (c.DEFAULT_LIMITS, large):
        assert gate.judge(orders(spark, {}), rules, limits).count() == 1


def test_sql_text_and_function_conditions_agree(spark):
    typed = c.Typed("quantity_int", "quantity", "int")
    rules = [
        c.satisfies("text", "quantity_int > 1", needs=[typed]),
        c.satisfies("function", lambda: F.col("quantity_int") > 1, needs=[typed]),
    ]
    rows = gate.judge(orders(spark, {}, {"quantity": "1"}, {"quantity": "x"}), rules).select(
        f"{gate.VERDICTS}.*"
    )
    assert sorted(map(tuple, rows.collect())) == [(False, False), (False, False), (True, True)]


def test_odd_check_names_are_kept(spark):
    name = "it's `odd`. name; really"
    rules = [c.satisfies(name, "order_id = 'O2'"), c.satisfies("plain", "order_id = 'O1'")]
    judged = gate.judge(orders(spark, {}), rules)
    assert judged.first()[gate.FAILED] == [name]
    measured = gate.metrics(judged, rules, "r", "orders").select("rule_name", "rows_passed")
    assert sorted(map(tuple, measured.collect())) == [(name, 0), ("plain", 1)]


def test_repeated_check_names_are_refused(spark):
    rule = c.not_blank("same", "order_id")
    with pytest.raises(ValueError, match="unique"):
        gate.judge(orders(spark, {}), [rule, rule])


def test_unknown_severity_is_refused():
    with pytest.raises(ValueError, match="severity"):
        c.not_blank("x", "y", severity="fatal")


def test_orphans(spark, large):
    df = orders(spark, {}, {"order_id": "O2", "product_id": "P9"}, {"order_id": "O3", "product_id": None})
    for limits in (c.DEFAULT_LIMITS, large):
        lost = c.orphans(df, ["product_id"], products(spark), limits)
        assert sorted(r.order_id for r in lost.collect()) == ["O2", "O3"]
        assert lost.columns.count("product_id") == 1
