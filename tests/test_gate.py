"""Splitting, metrics, the SLA stop and the audit."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from rows import LOADED, default_checks, orders

from siltgate.operators import audit, gate, kpi
from siltgate.operators.checks import HARD


def judged(spark, *changes):
    rules = default_checks(spark)
    return gate.judge(orders(spark, *changes), rules), rules


def test_split_routes_and_explains(spark):
    evaluated, _ = judged(spark, {}, {"order_id": "O10", "customer_id": ""})
    clean, rejected = gate.split(evaluated)
    assert [r.order_id for r in clean.collect()] == ["O1"]
    row = rejected.first()
    assert row.order_id == "O10"
    assert row.dq_reason == "completeness_customer_id; integrity_customer_id"


def test_quarantine_keeps_raw_text(spark):
    evaluated, _ = judged(spark, {"quantity": "abc", "order_amount": "x"})
    row = gate.quarantine(gate.split(evaluated)[1], "r1").first()
    assert (row.quantity, row.order_amount, row.run_id) == ("abc", "x", "r1")
    assert row.failed_rules == ["completeness_order_amount", "validity_quantity_positive"]
    assert row._source_file == "t.csv"


def test_silver_columns_and_types(spark):
    evaluated, _ = judged(spark, {"order_amount": "9.99"})
    silver = gate.publishable(gate.split(evaluated)[0])
    assert silver.dtypes == [
        ("order_id", "string"), ("customer_id", "string"), ("product_id", "string"),
        ("quantity", "int"), ("unit_price", "double"), ("order_amount", "double"),
        ("order_date", "date"), ("dq_warnings", "array<string>"),
    ]
    assert silver.first().dq_warnings == ["accuracy_amount_matches"]


def test_strip_removes_only_what_the_gate_added(spark):
    rules = default_checks(spark)
    prepared = gate.prepare(orders(spark, {}), rules)
    assert gate.strip(gate.evaluate(prepared, rules)).columns == prepared.columns


def test_metrics_of_one_clean_row(spark):
    evaluated, rules = judged(spark, {})
    rows = gate.metrics(evaluated, rules, "r1", "orders", LOADED).collect()
    assert [r.rule_name for r in rows] == [r.name for r in rules]
    assert {r.pass_rate for r in rows} == {1.0}
    assert {(r.run_id, r.dataset, r.measured_at) for r in rows} == {("r1", "orders", LOADED)}


def test_metrics_agree_with_the_failed_names(spark):
    evaluated, rules = judged(
        spark, {}, {"order_id": "O2", "quantity": "-1"}, {"order_id": "O2"}, {"order_id": "O3", "product_id": "x"},
    )
    failed = {
        r.rule: r.rows
        for r in evaluated.select(F.explode(F.concat(gate.FAILED, gate.WARNED)).alias("rule"))
        .groupBy("rule").agg(F.count("*").alias("rows")).collect()
    }
    for row in gate.metrics(evaluated, rules, "r", "orders").collect():
        assert row.rows_failed == failed.get(row.rule_name, 0)
        assert row.rows_passed + row.rows_failed == row.rows_evaluated == 4


def test_empty_input_passes_with_zero_counts(spark):
    rules = default_checks(spark)
    empty = gate.judge(orders(spark, {}).where("false"), rules)
    rows = gate.metrics(empty, rules, "r", "orders").collect()
    assert len(rows) == 8
    assert {(r.rows_evaluated, r.rows_passed, r.rows_failed, r.pass_rate) for r in rows} == {(0, 0, 0, 1.0)}


def test_no_checks_pass_everything(spark):
    evaluated = gate.judge(orders(spark, {}), [])
    assert evaluated.first()[gate.PASSED] is True
    assert gate.metrics(evaluated, [], "r", "orders").count() == 0


def test_only_soft_checks(spark):
    rules = [r for r in default_checks(spark) if not r.hard]
    row = gate.judge(orders(spark, {"order_amount": "1"}), rules).first()
    assert row[gate.PASSED] and row[gate.FAILED] == [] and len(row[gate.WARNED]) == 1


def test_sla_stop(spark):
    evaluated, rules = judged(spark, {}, {"order_id": "O2", "quantity": "-1"})
    rows = gate.metrics(evaluated, rules, "r1", "orders", LOADED)
    gate.enforce_sla(rows, "r1", 0.5)
    gate.enforce_sla(rows, "other", 0.8)
    with pytest.raises(gate.SlaBreach, match="validity_quantity_positive=0.500"):
        gate.enforce_sla(rows, "r1", 0.8)


def test_soft_checks_never_breach(spark):
    evaluated, rules = judged(spark, {"order_amount": "9.99"})
    rows = gate.metrics(evaluated, rules, "r1", "orders", LOADED)
    gate.enforce_sla(rows, "r1")
    assert kpi.sla_breaches(rows).count() == 0
    assert rows.where(F.col("severity") != HARD).first().pass_rate == 0.0


def test_audit_bounds(spark):
    evaluated, _ = judged(spark, {}, {"order_id": "O2", "quantity": "-1"}, {"order_id": "O3"})
    good = audit.report(evaluated, "order_id", audit.Bounds(min_clean_rows=2))
    audit.enforce(good)
    assert {r.audit_check: r.observed for r in good.collect()} == {
        "clean_rows": 2.0, "clean_fraction": 2 / 3, "duplicate_keys": 0.0,
    }
    with pytest.raises(audit.AuditFailed, match="clean_rows"):
        audit.enforce(audit.report(evaluated, "order_id"))


def test_audit_of_nothing(spark):
    rules = default_checks(spark)
    empty = gate.judge(orders(spark, {}).where("false"), rules)
    assert audit.clean_fraction(empty).first().clean_fraction == 0.0
    seen = {r.audit_check: (r.observed, r.holds) for r in audit.report(empty, "order_id").collect()}
    assert seen["clean_fraction"] == (0.0, False) and seen["duplicate_keys"] == (0.0, True)


def test_duplicate_audit_counts_null_as_a_key(spark):
    df = orders(spark, {"order_id": None}, {"order_id": None}, {"order_id": "O1"})
    assert tuple(audit.duplicates(df, "order_id").first()) == (3, 2, 1)
