"""Invariants over random rows."""

from __future__ import annotations

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from rows import default_checks, orders

from siltgate.operators import gate

text = st.sampled_from(["", " ", "abc", None])
row = st.fixed_dictionaries(
    {
        "order_id": st.sampled_from(["O1", "O2", "O3", None]),
        "customer_id": st.one_of(text, st.just("C00001")),
        "product_id": st.one_of(text, st.just("P001")),
        "quantity": st.one_of(text, st.integers(-3, 3).map(str)),
        "unit_price": st.one_of(text, st.just("1.2")),
        "order_amount": st.one_of(text, st.sampled_from(["2.4", "1.2", "NaN"])),
        "order_date": st.one_of(text, st.sampled_from(["2025-01-15", "2025-13-40", "2024-02-30"])),
    }
)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows=st.lists(row, min_size=1, max_size=25))
def test_gate_invariants(spark, large, rows):
    rules = default_checks(spark)
    for limits in (None, large):
        judged = gate.judge(orders(spark, *rows), rules, *([limits] if limits else []))
        verdicts = [r.asDict(recursive=True) for r in judged.collect()]
        assert len(verdicts) == len(rows)
        hard = [r.name for r in rules if r.hard]
        for v in verdicts:
            failed = [name for name in hard if not v[gate.VERDICTS][name]]
            assert v[gate.FAILED] == failed
            assert v[gate.PASSED] == (not failed)
        ids = [r["order_id"] for r in rows]
        firsts = sum(v[gate.VERDICTS]["uniqueness_order_id"] for v in verdicts)
        assert firsts == len(set(ids))
        silver = [v for v in verdicts if v[gate.PASSED]]
        assert len({v["order_id"] for v in silver}) == len(silver)
        exploded = judged.select(F.explode(F.concat(gate.FAILED, gate.WARNED))).count()
        measured = gate.metrics(judged, rules, "r", "orders").agg(F.sum("rows_failed")).first()[0]
        assert measured == exploded
