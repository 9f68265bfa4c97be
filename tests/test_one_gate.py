"""Queries that judge once what they read several times."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F
from rows import LOADED, customers, default_checks, orders, products

from siltgate.operators import gate
from siltgate.operators.reprocess import reprocess
from siltgate.plans import medallion
from siltgate.plans.sizing import Limits
from siltgate.sources import lake as tables
from siltgate.sources.lake import Lake
from siltgate.sources.raw import read_csv_raw, unseen
from siltgate.streaming import gated
from siltgate.workload import files, registry


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    at = tmp_path_factory.mktemp("tables")
    made = {
        "customer": spark.range(5).selectExpr("id AS c_custkey", "concat('c', id) AS c_name", "int(id) AS c_nationkey", "1.0D AS c_acctbal", "'X' AS c_mktsegment"),
        "part": spark.range(9).selectExpr("id AS p_partkey", "'p' AS p_name", "'b' AS p_brand", "'t' AS p_type", "1 AS p_size", "2.0D AS p_retailprice"),
        "orders": spark.range(30).selectExpr("id AS o_orderkey", "id % 5 AS o_custkey", "timestamp_ntz '1998-02-06' AS o_orderdate", "'1' AS o_orderpriority"),
        "lineitem": spark.range(90).selectExpr(
            "id % 30 AS l_orderkey", "id % 9 AS l_partkey", "id % 3 AS l_suppkey", "int(id % 2) AS l_linenumber", "2.0D AS l_quantity", "9.0D AS l_extendedprice",
            "0.1D AS l_discount", "0.1D AS l_tax", "'N' AS l_returnflag", "'O' AS l_linestatus", "timestamp_ntz '1999-01-01' + make_interval(0, 0, 0, int(id)) AS l_shipdate",
        ),
    }
    for name, df in made.items():
        df.write.parquet(f"{at}/{name}.parquet")
    return str(at)


def test_guarded_rows_are_judged_once(spark, sf_dir, monkeypatch):
    judged, judge = [], gate.judge
    monkeypatch.setattr(gate, "judge", lambda *a: judged.append(1) or judge(*a))
    found = {r.guard: r for r in registry.guard_stops_writes(spark, sf_dir).collect()}
    assert len(judged) == 1
    clean = registry.clean(spark, sf_dir).count()
    every = registry.judged(spark, sf_dir).count()
    for row in found.values():
        assert row.stopped == (row.rows_broken > 0) and row.rows_published == (clean if row.stopped else every)


def test_hot_keys_are_looked_for_in_the_stored_fact(spark, sf_dir):
    shown = registry.skewed_revenue_by_country(spark, sf_dir)
    assert "l_orderkey" not in shown._jdf.queryExecution().optimizedPlan().toString()
    plain = registry.revenue_by_country(spark, sf_dir)
    assert sorted(map(tuple, shown.collect())) == sorted(map(tuple, plain.collect()))


def test_candidates_are_joined_with_what_is_published_once(spark):
    rules = default_checks(spark)
    rejected = gate.judge(orders(spark, {"quantity": "-2"}, {"order_id": "O2", "quantity": "-2"}, {"order_id": None, "quantity": "-2"}), rules)
    published = spark.createDataFrame([("O2",), (None,)], "order_id string")
    again = reprocess(rejected, lambda df: df.withColumn("quantity", F.lit("2")), published, ["order_id"], rules)
    assert "LeftAnti" not in again._jdf.queryExecution().optimizedPlan().toString()
    assert [r.order_id for r in again.collect()] == ["O1"]


def test_known_keys_are_shuffled_once(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        keyed = spark.createDataFrame([("a", 1), (None, 1), ("b", None), ("b", 2)], "k string, n int")
        known = spark.createDataFrame([("a", 1), (None, 1), ("b", None), ("a", 1)], "k string, n int")
        new = unseen(keyed, known, ["k", "n"], Limits(small_bytes=1 << 40))
        assert new._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 2
        assert [tuple(r) for r in new.collect()] == [("b", 2)]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_casts_follow_the_shuffle_where_the_raw_text_is_kept(spark):
    rules = default_checks(spark)
    rows = orders(spark, {}, {"quantity": "-2"}, {"order_id": "O2", "order_date": "x"}, {"order_id": None, "order_amount": ""})
    late, early = gate.judge(rows, rules, raw_kept=True), gate.judge(rows, rules)
    below = [j._jdf.queryExecution().optimizedPlan().toString().split("Window [", 1)[1].split("\n", 1)[1] for j in (late, early)]
    assert ["quantity_int" in plan for plan in below] == [False, True]
    assert sorted(map(str, late.select(*early.columns).collect())) == sorted(map(str, early.collect()))


def test_candidate_holds_the_raw_text_alone(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    lake.append(orders(spark, {}, {"order_id": "O2", "quantity": "x"}, {"order_id": "O3", "order_amount": "9.9"}), tables.BRONZE_ORDERS)
    lake.append(customers(spark).withColumn("_ingested_at", F.lit(LOADED)), tables.BRONZE_CUSTOMERS)
    lake.append(products(spark).withColumn("_ingested_at", F.lit(LOADED)), tables.BRONZE_PRODUCTS)
    summary = medallion.build_silver(lake, "r", bounds=None)
    assert (summary.clean, summary.quarantined) == (2, 1)
    assert not {"quantity_int", "unit_price_dbl", gate.VERDICTS} & set(lake.read(tables.ORDERS_CANDIDATE).columns)
    shown = {r.order_id: (r.quantity, r.unit_price, r.order_amount, str(r.order_date), r.dq_warnings) for r in lake.read(tables.SILVER_ORDERS).collect()}
    assert shown == {"O1": (2, 1.2, 2.4, "2025-01-15", []), "O3": (2, 1.2, 9.9, "2025-01-15", ["accuracy_amount_matches"])}


def test_raw_files_are_compressed_and_bounded(spark, monkeypatch):
    monkeypatch.setattr(files, "ROWS_PER_CSV", 10)
    path = files.as_csv(spark.range(95).coalesce(1).selectExpr("id", "concat('a,', id) AS t"), "bounded")
    parts = [n for n in os.listdir(path) if n.endswith(".csv.gz")]
    assert len(parts) == 10
    assert sorted(int(r.id) for r in read_csv_raw(spark, path).where("t = concat('a,', id)").collect()) == list(range(95))


def test_a_batch_is_ranked_once(spark, large, monkeypatch):
    asked, key_exists = [], gated.key_exists
    monkeypatch.setattr(gated, "key_exists", lambda df, *a: asked.append("is_repeat" in df.columns) or key_exists(df, *a))
    batch = orders(spark, {}, {"order_id": "O2"}, {"order_id": None}, {"order_id": "O3"}, {"order_id": "O3", "quantity": "3", "order_amount": "3.6"})
    new = spark.createDataFrame([("O3",), (None,)], "order_id string")
    judged = gated.judge_batch(batch, default_checks(spark), lambda keys: new, large).collect()
    assert asked == [False]
    assert sorted((str(r.order_id), r.quantity) for r in judged if not r.is_repeat) == [("None", "2"), ("O3", "2")]
    assert len(judged) == 5 and not any(name.startswith("_new") for name in judged[0].asDict())
