"""KPIs, star schema, history, injection and expressions on hand-made rows."""

from __future__ import annotations

import random
from collections import defaultdict
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F
from rows import GOOD, customers, default_checks, orders

from siltgate.functions.expressions import exact_sum, standardise
from siltgate.operators import conform, gate, history, inject, kpi, star
from siltgate.operators.checks import satisfies
from siltgate.operators.reprocess import affected_days, reprocess

METRICS = (
    "run_id string, dataset string, rule_name string, dimension string, severity string,"
    " rows_evaluated bigint, rows_passed bigint, rows_failed bigint, pass_rate double,"
    " measured_at timestamp"
)


def metric_rows(spark, *rows):
    """(run, rule, severity, failed of 100, day)"""
    return spark.createDataFrame(
        [
            (run, "orders", rule, "validity", severity, 100, 100 - failed, failed,
             (100 - failed) / 100, datetime(2025, 1, day))
            for run, rule, severity, failed, day in rows
        ],
        METRICS,
    )


@pytest.fixture
def four_runs(spark):
    return metric_rows(
        spark,
        *[(f"r{d}", "hard", "error", f, d) for d, f in ((1, 50), (2, 10), (3, 30), (4, 15))],
        *[(f"r{d}", "soft", "warn", f, d) for d, f in ((1, 10), (2, 10), (3, 10), (4, 40))],
    )


def test_latest_run_and_ties(spark, four_runs):
    assert kpi.latest_run(four_runs).first().run_id == "r4"
    tied = metric_rows(spark, ("a", "x", "error", 1, 1), ("b", "x", "error", 2, 1))
    assert [r.rows_failed for r in kpi.kpi_table(tied).collect()] == [2]
    assert kpi.metrics_latest_run(four_runs.where("false")).count() == 0


def test_trend_flags_low_hard_checks(four_runs):
    rows = [(r.rule_name, r.run_id, r.is_low) for r in kpi.pass_rate_trend(four_runs).collect()]
    assert rows == [
        ("hard", "r4", False), ("hard", "r3", True), ("hard", "r2", False),
        ("soft", "r4", False), ("soft", "r3", False), ("soft", "r2", False),
    ]


def test_top_failing_and_worst(four_runs):
    assert [r.rule_name for r in kpi.top_failing(four_runs, 1).collect()] == ["soft"]
    worst = [r.worst_hard_rule_pass_rate for r in kpi.worst_hard_rate_trend(four_runs).collect()]
    assert worst == [0.5, 0.9, 0.7, 0.85]


def test_alerts_use_the_newest_rate(four_runs):
    assert kpi.sla_breaches(four_runs).count() == 0
    found = kpi.sla_breaches(four_runs.where("run_id <> 'r4'")).collect()
    assert [r.message for r in found] == ["hard (validity) holds for 0.700 of the rows, agreed are 0.8"]


def test_soft_spikes(four_runs):
    assert [r.run_id for r in kpi.soft_rule_spikes(four_runs).collect()] == ["r4"]


def test_quarantine_reports(spark):
    rules = default_checks(spark)
    judged = gate.judge(
        orders(spark, {}, {"order_id": "O2", "customer_id": ""}, {"order_id": "O3", "customer_id": "C9"}), rules
    )
    rows = gate.quarantine(gate.split(judged)[1], "r1")
    assert [tuple(r) for r in kpi.quarantine_by_rule(rows).collect()] == [
        ("integrity_customer_id", 2), ("completeness_customer_id", 1),
    ]
    assert kpi.reasons_for_run(rows, "r1").count() == 2
    assert kpi.reasons_for_run(rows, "r2").count() == 0
    assert {r.layer: r.rows for r in kpi.layer_counts(judged).collect()} == {
        "clean": 1, "quarantine": 2,
    }
    assert {r.layer: r.rows for r in kpi.table_counts(a=rows, b=judged).collect()} == {"a": 2, "b": 3}


def test_version_diff_is_a_null_safe_set(spark):
    bad = spark.createDataFrame([(1, None), (1, None), (2, "x"), (3, "y"), (3, "y")], "id int, v string")
    good = spark.createDataFrame([(1, None), (2, "z")], "id int, v string")
    assert sorted(map(tuple, kpi.version_diff(bad, good).collect())) == [(2, "x"), (3, "y")]


def test_period_compare_and_volume(spark):
    rows = spark.createDataFrame(
        [("a", datetime(2025, m, 1 + d), 1.0) for m, n in ((1, 2), (2, 5)) for d in range(n)]
        + [("b", datetime(2025, 1, 1), 1.0)],
        "seg string, ts timestamp, v double",
    )
    found = kpi.period_compare(rows, F.trunc("ts", "month"), "seg", exact_sum("v")).collect()
    assert {(r.seg, r.period): (r.previous, r.change) for r in found} == {
        ("a", date(2025, 1, 1)): (None, None),
        ("a", date(2025, 2, 1)): (2.0, 3.0),
        ("b", date(2025, 1, 1)): (None, None),
    }
    daily = spark.createDataFrame(
        [("s", datetime(2025, 1, d, 0, 0, i)) for d, n in ((1, 10), (2, 10), (3, 2)) for i in range(n)],
        "source string, ts timestamp",
    )
    status = {r.day.day: r.status for r in kpi.volume_anomaly(daily, "source", "ts").collect()}
    assert status == {1: "ok", 2: "ok", 3: "low"}
    gap = spark.createDataFrame([("s", datetime(2025, 1, d)) for d in (1, 2, 6)] + [("t", datetime(2025, 1, 4))], "source string, ts timestamp")
    found = {(r.source, r.day.day): (r.rows, r.status) for r in kpi.volume_anomaly(gap, "source", "ts").collect()}
    assert found[("s", 3)] == (0, "low") and found[("s", 6)][0] == 1 and found[("t", 6)] == (0, "low") and len(found) == 9
    late = {r.source: r.is_late for r in kpi.lateness(gap, "source", "ts", F.lit(datetime(2025, 1, 7)), "2 days").collect()}
    assert late == {"s": False, "t": True}
    months = spark.createDataFrame([("a", datetime(2025, m, 1), float(m)) for m in (1, 3, 4)], "seg string, ts timestamp, v double")
    jumps = {r.period.month: r.previous for r in kpi.period_compare(months, F.trunc("ts", "month"), "seg", exact_sum("v")).collect()}
    assert jumps == {1: None, 3: None, 4: 3.0}
    assert kpi.freshness(daily, "source", "ts").first().last_arrival == datetime(2025, 1, 3, 0, 0, 1)
    assert tuple(kpi.volume(daily, "source").first()) == ("s", 22)


@pytest.mark.parametrize(
    ("raw", "code"),
    [("Poland", "PL"), ("pl", "PL"), ("NL", "NL"), ("Germany", "DE"), (" POL ", "PL"), (" fr ", " FR "), (None, None)],
)
def test_conform_country(spark, raw, code):
    df = conform.conform_customers(customers(spark, ("C1", "A", "X", raw)))
    assert df.first().country == code


def test_standardise_without_spellings(spark):
    assert customers(spark).select(standardise("country", {}).alias("c")).first().c == "PL"


def test_exact_sum(spark):
    def total(*values):
        return spark.createDataFrame([(v,) for v in values], "v double").agg(exact_sum("v").alias("s")).first().s

    assert total(0.1, 0.2, None) == 0.3
    assert total(*[0.01] * 1000) == 10.0
    assert total(1e15, 1.0) == 1e15 + 1
    assert total(1.0, float("nan")) != total(1.0, float("nan"))
    mixed = total(4e-7, 1e15, float("nan"))
    assert mixed != mixed and total(1.0, float("inf")) == float("inf")
    assert total(*[4e-7] * 20_000) == 0.01 and total(*[4e-7] * 12_500, 1e15) == 1e15
    assert total(1e30, 1.0, -1e30) == 1.0 and total(-0.004, -0.001) == -0.01 and total(-1.0, 0.005) == -1.0
    with pytest.raises(Exception, match="does not fit"):
        total(1e300)
    assert total(None) is None


def test_star(spark):
    rules = default_checks(spark)
    judged = gate.judge(orders(spark, {}, {"order_id": "O2", "order_date": "2024-12-31"}), rules)
    silver = gate.publishable(gate.split(judged)[0])
    keys = sorted(tuple(r) for r in star.date_dim(silver).collect())
    assert keys == [(20241231, date(2024, 12, 31), 2024, 12, 31), (20250115, date(2025, 1, 15), 2025, 1, 15)]
    assert star.fact_sales(silver).columns == [
        "order_id", "customer_id", "product_id", "date_key", "quantity", "unit_price", "order_amount",
    ]
    dims = customers(spark, ("C1", "old", "X", "PL"), ("C1", "new", "X", "PL"))
    assert [r.name for r in star.dim_customer(dims, [F.col("name")]).collect()] == ["new"]
    assert star.dim_customer(dims).count() == 2


def test_injection(spark):
    typed = spark.range(100).selectExpr(
        "id AS bucket", "CAST(id AS STRING) AS order_id", "'C1' AS customer_id", "'P1' AS product_id",
        "2 AS quantity", "1.5D AS unit_price", "3.0D AS order_amount", "DATE'2025-01-15' AS order_date",
    )
    rows = {r.bucket: r for r in inject.defects(typed, F.col("bucket")).collect()}
    broken = {
        "customer_id": {b for b, r in rows.items() if r.customer_id == ""},
        "unknown customer": {b for b, r in rows.items() if r.customer_id == "-1"},
        "order_amount": {b for b, r in rows.items() if r.order_amount == ""},
        "quantity": {b for b, r in rows.items() if r.quantity == "-2"},
        "order_date": {b for b, r in rows.items() if r.order_date == "2025-13-40"},
        "product": {b for b, r in rows.items() if r.product_id == "-1"},
        "accuracy": {b for b, r in rows.items() if r.order_amount == "4.5"},
    }
    assert broken == {
        "customer_id": set(range(4)), "order_amount": set(range(4, 8)), "quantity": set(range(8, 11)),
        "order_date": set(range(11, 14)), "product": set(range(14, 17)),
        "unknown customer": {17, 18}, "accuracy": set(range(19, 22)),
    }
    assert {r.order_amount for b, r in rows.items() if 8 <= b <= 10} == {"-3.0"}
    twice = inject.defects(typed, F.col("bucket"), repeat=F.col("bucket") == 50)
    assert twice.count() == 101 and twice.columns == typed.columns


def test_profile(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (3, "a")], "n int, s string")
    found = {r.column_name: r for r in history.profile(df, ["n", "s"]).collect()}
    assert (found["n"].min_value, found["n"].max_value, found["n"].suggested) == (1.0, 3.0, "not_null,positive")
    assert (found["s"].nulls, found["s"].null_rate, found["s"].approx_distinct) == (1, 0.333333, 1)
    assert found["s"].suggested == ""


def test_guard(spark):
    rule = satisfies("positive", "n > 0")
    df = spark.range(-1, 3).selectExpr("id AS n")
    assert sorted(r.n for r in history.guard(df.where("n > 0"), [rule]).collect()) == [1, 2]
    with pytest.raises(Exception, match="broken: positive"):
        history.guard(df, [rule]).collect()


@pytest.mark.parametrize("slice_", ["month", "year"])
def test_scd2(spark, slice_):
    draw = random.Random(3)
    start = datetime(2024, 1, 1)
    rows = [
        (draw.choice("abc"), start + timedelta(days=draw.randrange(500)), n, draw.choice(["x", "y", None]))
        for n in range(400)
    ]
    df = spark.createDataFrame(rows, "key string, at timestamp, n int, v string")
    found = history.scd2(df, "key", ["at", "n"], ["v"], F.trunc("at", slice_)).collect()
    expected = []
    groups = defaultdict(list)
    for key, at, n, v in rows:
        groups[key].append((at, n, v))
    for key, states in groups.items():
        states.sort(key=lambda s: s[:2])
        changes = [s for i, s in enumerate(states) if i == 0 or s[2] != states[i - 1][2]]
        for i, (at, _, v) in enumerate(changes):
            until = changes[i + 1][0] if i + 1 < len(changes) else None
            expected.append((key, v, at, until, until is None))
    assert sorted(map(repr, map(tuple, found))) == sorted(map(repr, expected))


def test_reprocess(spark):
    rules = default_checks(spark)
    judged = gate.judge(
        orders(spark, {}, {}, {"order_id": "O2", "quantity": "-2", "order_amount": "-2.4"}), rules
    )
    clean, rejected = gate.split(judged)

    def fix(rows):
        raw = rows.select(*GOOD)
        return raw.withColumns({c: F.regexp_replace(c, "^-", "") for c in ("quantity", "order_amount")})

    again = reprocess(rejected, fix, clean, ["order_id"], rules)
    recovered = gate.split(again)[0]
    # The surplus copy of O1 stays out: its key is already published.
    assert [r.order_id for r in recovered.collect()] == ["O2"]
    assert [r.date_key for r in affected_days(recovered).collect()] == [20250115]
