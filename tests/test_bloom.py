"""The Bloom filter that keeps rows out of a shuffle, and counts taken while writing."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from rows import default_checks, orders

from siltgate.operators import checks, gate
from siltgate.plans import bloom


@pytest.mark.parametrize("words", [1024, 1])
def test_no_key_is_lost_and_few_others_pass(spark, words):
    rows = spark.range(20_000).select(F.when(F.col("id") > 0, F.col("id")).alias("k"), F.col("id").cast("string").alias("t"))
    known = rows.where("k IS NULL OR k % 20 = 0")
    flagged = bloom.flag(rows, ["k", "t"], bloom.build(known, ["k", "t"], words), words, "possible")
    found = flagged.groupBy(F.expr("k IS NULL OR k % 20 = 0").alias("is_known")).agg(F.count_if("possible").alias("n"), F.count("*").alias("all")).collect()
    by = {r["is_known"]: r for r in found}
    assert by[True]["n"] == by[True]["all"] == 1000
    # A filter of one word is full and lets all pass; a fitting one stops nearly all.
    assert by[False]["n"] < 800 if words > 1 else by[False]["n"] > 10_000
    assert flagged.columns == ["k", "t", "possible"]


def test_words_are_bounded(spark):
    assert bloom.words_for(0) == 1024 and bloom.words_for(1 << 60) == bloom.MOST_WORDS
    with pytest.raises(ValueError):
        bloom.build(spark.range(1), ["id"], 3)


def test_rows_that_cannot_match_are_not_joined(spark, large, monkeypatch):
    joined, real = [], checks.lookup

    def spy(df, *args):
        joined.append(df.count())
        return real(df, *args)

    monkeypatch.setattr(checks, "lookup", spy)
    rows = spark.range(5000).select(F.when(F.col("id") % 7 > 0, F.col("id")).alias("k"), F.col("id").alias("v"))
    reference = spark.range(0, 5000, 10).select(F.col("id").alias("k"))
    made = checks.key_exists(rows, ["k"], reference, "found", large)
    assert made.where("found != (k IS NOT NULL AND v % 10 = 0)").count() == 0 and made.count() == 5000
    assert 428 <= joined[0] < 900


def test_writing_counts_what_metrics_need(spark, tmp_path):
    for rows in (orders(spark, {}, {"order_id": "O2", "quantity": "-1"}, {"order_amount": "9"}), orders(spark, {}).limit(0)):
        rules = default_checks(spark)
        judged = gate.judge(rows, rules)
        observed = gate.observe(judged, rules)
        observed.rows.select("order_id").write.mode("overwrite").parquet(str(tmp_path / "rows"))
        shown = gate.rates(observed.wide(), rules, "r", "orders").drop("measured_at")
        assert sorted(shown.collect()) == sorted(gate.metrics(judged, rules, "r", "orders").drop("measured_at").collect())
        clean, rejected = (x.count() for x in gate.split(judged))
        assert observed.split_counts() == (clean, rejected)

