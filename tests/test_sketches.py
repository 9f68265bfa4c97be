"""Sketches of loads, united, and the rules they suggest."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from siltgate.operators import gate, sketches


@pytest.fixture
def rows(spark):
    return spark.range(6000).select(
        "id", (F.col("id") % 7).alias("kind"), F.when(F.col("id") % 10 > 0, F.col("id") * 2.5 - 100).alias("amount"),
        F.concat(F.lit("c"), F.col("id") % 4000).alias("code"), F.lit(None).cast("string").alias("nothing"),
    )


COLUMNS = ["id", "kind", "amount", "code", "nothing"]


def test_united_sketches_are_those_of_all_rows(spark, rows):
    loads = [sketches.sketch(rows.where(F.col("id") % 4 == i), COLUMNS) for i in range(4)]
    all_loads = loads[0].union(loads[1]).union(loads[2]).union(loads[3]).union(sketches.sketch(rows.limit(0), COLUMNS))
    many = {r["column_name"]: r for r in sketches.summary(sketches.unite(all_loads)).collect()}
    once = {r["column_name"]: r for r in sketches.summary(sketches.sketch(rows, COLUMNS)).collect()}
    exact = {"id": 6000, "kind": 7, "amount": 5400, "code": 4000, "nothing": 0}
    for name in COLUMNS:
        assert [many[name][c] for c in ("rows", "nulls", "low", "high")] == [once[name][c] for c in ("rows", "nulls", "low", "high")]
        for told in (many, once):
            assert abs(told[name]["distinct"] - exact[name]) <= sketches.SLACK * exact[name]
    assert many["amount"]["nulls"] == 600 and abs(many["id"]["q0.5"] - 3000) < 150 and many["code"]["q0.5"] is None


def test_suggestions_hold_and_become_checks(spark, rows):
    codes = spark.range(4000).select(F.concat(F.lit("c"), "id").alias("key"))
    fewer = codes.where("key != 'c17'")
    references = {
        "codes": sketches.Reference(codes, "key", sketches.sketch(codes, ["key"])),
        "fewer": sketches.Reference(fewer, "key", sketches.sketch(fewer, ["key"])),
    }
    united = sketches.sketch(rows, COLUMNS)
    # The sketches cannot tell the two tables apart; reading the column can.
    assert ("code", "fewer") in sketches.inclusions(united, references)
    made = sketches.suggest(rows, united, references)
    assert {tuple(r) for r in made.collect()} == {
        ("id", "not_null", None), ("id", "not_negative", None), ("id", "key", None), ("kind", "not_null", None), ("kind", "not_negative", None),
        ("kind", "one_of", "0|1|2|3|4|5|6"), ("code", "not_null", None), ("code", "references", "codes"),
    }
    rules = sketches.checks_of(made, references)
    assert gate.judge(rows, rules).where(f"NOT {gate.PASSED}").count() == 0
    bad = spark.createDataFrame([(1, 9, None, "c1", None), (1, 3, None, "zz", None), (None, 3, None, "c1", None)], "id long, kind long, amount double, code string, nothing string")
    failed = {name for r in gate.judge(bad, rules).collect() for name in r[gate.FAILED]}
    assert failed == {"one_of_kind", "key_id", "references_code_codes", "not_null_id", "not_negative_id"}


def test_nothing_is_suggested_for_nothing(spark, rows):
    none = rows.limit(0)
    assert sketches.suggest(none, sketches.unite(sketches.sketch(none, COLUMNS))).count() == 0
