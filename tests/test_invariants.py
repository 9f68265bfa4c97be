"""Invariants of the gate, each over 200 generated tables, by the plain plans and those for large inputs."""

from __future__ import annotations

from collections import Counter, defaultdict

import generated as g
import pytest
from pyspark.sql import functions as F

from siltgate.operators import gate
from siltgate.operators.repeats import newest_per_key, rank_copies
from siltgate.plans.lookup import lookup
from siltgate.plans.sizing import DEFAULT_LIMITS, Limits
from siltgate.sources.raw import unseen

LARGE = Limits(broadcast_bytes=-1, small_bytes=-1, hot_rows=3, sample=1.0)


@pytest.fixture(params=[DEFAULT_LIMITS, LARGE], ids=["plain", "large"])
def limits(request):
    return request.param


def per_case(rows):
    found = defaultdict(list)
    for row in rows:
        found[row["case_id"]].append(row)
    return found


def differing(cases, left, right):
    """Places of the cases whose bags differ."""
    return {i for i in range(len(cases)) if Counter(left.get(i, ())) != Counter(right.get(i, ()))}


def shown(row):
    return tuple(row[name] for name in g.COLUMNS)


def judged_by(spark, limits):
    def run(cases):
        rows, reference = g.frame(spark, cases)
        checks = g.rules(reference)
        return gate.judge(rows, checks, limits), checks

    return run


def judged_rows(spark, limits, cases):
    judged, _ = judged_by(spark, limits)(cases)
    return per_case(r.asDict(recursive=True) for r in judged.collect())


def test_every_verdict_is_the_oracles(spark, limits):
    def broken(cases):
        found = judged_rows(spark, limits, cases)
        left = {i: [(shown(r), *r[gate.VERDICTS].values()) for r in rows] for i, rows in found.items()}
        right = {i: [(row, *v.values()) for row, v in g.verdicts(one)] for i, one in enumerate(cases)}
        return differing(cases, left, right)

    g.holds(broken)


def test_no_row_is_lost_or_made(spark, limits):
    def broken(cases):
        left = {i: [shown(r) for r in rows] for i, rows in judged_rows(spark, limits, cases).items()}
        return differing(cases, left, {i: one.rows for i, one in enumerate(cases)})

    g.holds(broken, seed=1)


def test_failures_are_the_names_of_false_verdicts_in_order(spark, limits):
    def broken(cases):
        bad = set()
        for i, rows in judged_rows(spark, limits, cases).items():
            for row in rows:
                held = row[gate.VERDICTS]
                hard, soft = ([n for n in names if not held[n]] for names in (g.HARD, g.SOFT))
                if (row[gate.FAILED], row[gate.WARNED], row[gate.PASSED]) != (hard, soft, not hard):
                    bad.add(i)
        return bad

    g.holds(broken, seed=2)


def test_clean_and_rejected_part_the_rows(spark, limits):
    def broken(cases):
        clean, rejected = gate.split(judged_by(spark, limits)(cases)[0])
        parts = [per_case(r.asDict() for r in part.select("case_id", *g.COLUMNS).collect()) for part in (clean, rejected)]
        both = {i: [shown(r) for part in parts for r in part.get(i, ())] for i in range(len(cases))}
        kept = {i: [shown(r) for r in parts[0].get(i, ())] for i in range(len(cases))}
        right = {i: [row for row, v in g.verdicts(one) if all(v[n] for n in g.HARD)] for i, one in enumerate(cases)}
        return differing(cases, both, {i: one.rows for i, one in enumerate(cases)}) | differing(cases, kept, right)

    g.holds(broken, seed=3)


def test_every_key_has_one_first_row(spark, limits):
    def broken(cases):
        bad = set()
        for i, rows in judged_rows(spark, limits, cases).items():
            firsts = Counter(r["key"] for r in rows if r[gate.VERDICTS]["first"])
            if firsts != Counter({r["key"] for r in rows}):
                bad.add(i)
        return bad

    g.holds(broken, seed=4)


def test_judging_clean_rows_again_rejects_none(spark, limits):
    def broken(cases):
        rows, reference = g.frame(spark, cases)
        checks = g.rules(reference)
        clean = gate.split(gate.judge(rows, checks, limits))[0].select("case_id", *g.COLUMNS)
        return {r.case_id for r in gate.split(gate.judge(clean, checks, limits))[1].select("case_id").collect()}

    g.holds(broken, seed=5)


def test_metrics_add_up(spark, limits):
    def broken(cases):
        judged, checks = judged_by(spark, limits)(cases)
        rates = gate.metrics(judged, checks, F.col("case_id").cast("string"), "t", F.lit("now"), by=["case_id"])
        found = {(int(r.run_id), r.rule_name): (r.rows_evaluated, r.rows_passed, r.rows_failed, r.pass_rate) for r in rates.collect()}
        bad = set()
        for i, one in enumerate(cases):
            rows = g.verdicts(one)
            for name in (*g.HARD, *g.SOFT) if rows else ():
                passed = sum(v[name] for _, v in rows)
                expected = (len(rows), passed, len(rows) - passed)
                if found[i, name][:3] != expected or abs(found[i, name][3] - passed / len(rows)) > 1e-6:
                    bad.add(i)
        return bad

    g.holds(broken, seed=6)


def test_arrival_in_other_partitions_changes_nothing(spark, limits):
    def broken(cases):
        rows, reference = g.frame(spark, cases)
        found = []
        for dealt in (rows.coalesce(1), rows.repartition(5, "at", "price")):
            judged = gate.judge(dealt, g.rules(reference), limits)
            held = per_case(r.asDict(recursive=True) for r in judged.collect())
            found.append({i: [(shown(r), *r[gate.VERDICTS].values()) for r in held[i]] for i in held})
        return differing(cases, *found)

    g.holds(broken, seed=7)


def test_soft_checks_reject_nothing(spark, limits):
    def broken(cases):
        rows, reference = g.frame(spark, cases)
        checks = g.rules(reference)
        found = []
        for some in (checks, [k for k in checks if k.hard]):
            kept = gate.split(gate.judge(rows, some, limits))[0].select("case_id", *g.COLUMNS)
            held = per_case(r.asDict() for r in kept.collect())
            found.append({i: [shown(r) for r in held[i]] for i in held})
        return differing(cases, *found)

    g.holds(broken, seed=8)


def test_ranks_count_the_rows_of_a_key(spark, limits):
    def broken(cases):
        rows, _ = g.frame(spark, cases)
        ranked = rank_copies(rows, ["case_id", "key"], ["at"], "n", limits)
        bad = set()
        for i, held in per_case(r.asDict() for r in ranked.collect()).items():
            by_key = defaultdict(list)
            for r in held:
                by_key[r["key"]].append((r["n"], r["at"]))
            for places in by_key.values():
                places.sort()
                times = [at for _, at in places]
                if [n for n, _ in places] != list(range(1, len(places) + 1)) or times != sorted(times):
                    bad.add(i)
        return bad

    g.holds(broken, seed=9)


def test_lookups_keep_every_row_once(spark, limits):
    def broken(cases):
        rows, reference = g.frame(spark, cases)
        side = reference.distinct().withColumn("label", F.concat(F.lit("is "), "ref"))
        found = lookup(rows.select("case_id", "ref", "at"), side, ["case_id", "ref"], "left", limits)
        left = {i: [(r["ref"], r["at"], r["label"]) for r in held] for i, held in per_case(r.asDict() for r in found.collect()).items()}
        right = {
            i: [(row[1], row[7], f"is {row[1]}" if row[1] is not None and row[1] in one.reference else None) for row in one.rows]
            for i, one in enumerate(cases)
        }
        return differing(cases, left, right)

    g.holds(broken, seed=10)


def test_a_load_appended_twice_adds_nothing(spark, limits):
    def broken(cases):
        rows, reference = g.frame(spark, cases)
        arriving = rows.select("case_id", "ref", "at")
        new = unseen(arriving, reference, ["case_id", "ref"], limits)
        held = per_case(r.asDict() for r in new.collect())
        left = {i: [(r["ref"], r["at"]) for r in held[i]] for i in held}
        right = {i: [(row[1], row[7]) for row in one.rows if row[1] not in one.reference] for i, one in enumerate(cases)}
        again = unseen(arriving, reference.union(new.select("case_id", "ref")), ["case_id", "ref"], limits)
        return differing(cases, left, right) | {r.case_id for r in again.select("case_id").collect()}

    g.holds(broken, seed=11)


def test_newest_is_the_least_of_its_key(spark):
    def broken(cases):
        rows, _ = g.frame(spark, cases)
        found = newest_per_key(rows.select("case_id", *g.COLUMNS), ["case_id", "key"], list(g.COLUMNS[::-1]))
        left = {i: [shown(r) for r in held] for i, held in per_case(r.asDict() for r in found.collect()).items()}
        right = {i: [row for row, v in g.verdicts(one) if v["first"]] for i, one in enumerate(cases)}
        return differing(cases, left, right)

    g.holds(broken, seed=12)


def test_what_fails_is_shrunk():
    """A property broken by one kind of cell shrinks to that cell, without Spark."""

    def broken(cases):
        return {i for i, one in enumerate(cases) if any(row[3] == "NaN" for row in one.rows)}

    with pytest.raises(AssertionError, match="cases, one shrinks to") as found:
        g.holds(broken)
    least = g.Case((tuple("NaN" if name == "quantity" else plain for name, plain in zip(g.COLUMNS, g.PLAIN, strict=True)),), ())
    assert str(least) in str(found.value)


def test_the_generator_reaches_the_edges():
    cases = [g.case(i) for i in range(200)]
    rows = [row for one in cases for row in one.rows]
    assert any(not one.rows for one in cases) and any(not one.reference for one in cases)
    assert any(len(set(one.rows)) < len(one.rows) for one in cases)
    assert any(Counter(r[0] for r in one.rows).most_common(1)[0][1] > 6 for one in cases if one.rows)
    assert all(any(row[at] is None for row in rows) for at in range(len(g.COLUMNS) - 1))
    assert any(one.extra for one in cases) and g.case(7) == g.case(7)
