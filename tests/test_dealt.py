"""Orders dealt into buckets as they are written: the gate and the audit group them without a shuffle."""

from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F
from rows import LOADED, customers, products

from siltgate.operators import audit, gate
from siltgate.operators.checks import order_checks
from siltgate.plans import medallion
from siltgate.plans.sizing import Limits, buckets_for
from siltgate.sources import lake as tables
from siltgate.sources.lake import CatalogLake, Lake, Table

BY = medallion.ORDER_KEY
LARGE = Limits(small_bytes=-1, hot_rows=5, sample=1.0)
BOUNDS = audit.Bounds(min_clean_rows=10, min_clean_fraction=0.1, max_clean_fraction=1.0)
HEADER = "order_id,customer_id,product_id,quantity,unit_price,order_amount,order_date"


def feeds(folder, more=()):
    """60 orders, a copy of every tenth, some broken ones and ``more``, in three files."""
    lines = [f"O{i},C{i % 4 + 1},P{i % 2 + 1},{i % 5 + 1},2.5,{(i % 5 + 1) * 2.5},2025-01-{i % 28 + 1:02d}" for i in range(60)]
    lines += [line.replace(",2.5,", ",3.5,") for line in lines[::10]]
    lines += [",C1,P1,1,2.5,2.5,2025-01-01", ",C1,P1,2,2.5,5.0,2025-01-01", "O90,,P1,1,2.5,2.5,2025-01-01", "O91,C1,P9,1,2.5,,2025-13-40", *more]
    (folder / "orders").mkdir()
    for i in range(3):
        (folder / "orders" / f"{i}.csv").write_text("\n".join([HEADER, *lines[i::3]]) + "\n")
    (folder / "customers.csv").write_text("customer_id,name,company,country\n" + "".join(f"C{i},N,X,PL\n" for i in range(1, 5)))
    (folder / "products.json").write_text(
        "[" + ",".join(f'{{"product_id": "P{n}", "product_name": "n", "category": "Beer", "unit_price": 2.5}}' for n in (1, 2)) + "]"
    )
    return [str(folder / name) for name in ("orders", "customers.csv", "products.json")]


def shown(lake):
    read = (tables.BRONZE_ORDERS, tables.ORDERS_CANDIDATE, tables.SILVER_ORDERS, tables.QUARANTINE_ORDERS, tables.REVENUE_BY_COUNTRY)
    metrics = lake.read(tables.DQ_METRICS).drop("measured_at")
    return [sorted(map(str, df.collect())) for df in (*map(lake.read, read), metrics)]


def shuffles(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning(order_id")


ARRIVAL = ("_ingested_at", "unit_price", "quantity")


@pytest.fixture
def run(spark, tmp_path):
    def made(name, limits, more=()):
        (tmp_path / name).mkdir()
        lake = Lake(spark, str(tmp_path / name / "it's a lake"))
        medallion.run(lake, *feeds(tmp_path / name, more), run_id="r", arrival=ARRIVAL, bounds=BOUNDS, at=LOADED, limits=limits)
        return lake

    return made


def test_a_large_load_is_dealt_and_judged_without_a_shuffle(spark, run):
    small, large = run("small", Limits()), run("large", LARGE)
    assert shown(large) == shown(small)
    assert small.buckets(tables.BRONZE_ORDERS, BY) == small.buckets(tables.ORDERS_CANDIDATE, BY) == 0
    assert large.buckets(tables.BRONZE_ORDERS, BY) == large.buckets(tables.ORDERS_CANDIDATE, BY) == 4
    checks = order_checks(products(spark), customers(spark), ARRIVAL)
    for lake, n in ((large, 0), (small, 1)):
        assert shuffles(gate.judge(lake.read_dealt(tables.BRONZE_ORDERS, BY), checks)) == n
        assert shuffles(audit.report(lake.read_dealt(tables.ORDERS_CANDIDATE, BY), "order_id")) == n
    # No name is left in the user's catalog.
    assert not [t.name for t in spark.catalog.listTables("spark_catalog.default") if t.name.startswith("siltgate_")]


def test_a_hot_key_is_not_left_to_one_bucket(run):
    more = [f"O1,C1,P1,{i},2.5,{i * 2.5},2025-01-01" for i in range(1, 20)]
    small, large = run("small", Limits(), more), run("large", LARGE, more)
    assert large.buckets(tables.BRONZE_ORDERS, BY) == 4 and large.buckets(tables.ORDERS_CANDIDATE, BY) == 0
    assert shown(large) == shown(small)


def test_several_loads_are_judged_together(spark, run, tmp_path):
    small, large = run("small", Limits()), run("large", LARGE)
    for lake, limits in ((small, Limits()), (large, LARGE)):
        folder = tmp_path / f"again{limits.small_bytes}"
        folder.mkdir()
        medallion.run(lake, *feeds(folder, ["O99,C1,P1,1,2.5,2.5,2025-01-01"]), run_id="r2", arrival=ARRIVAL, bounds=BOUNDS, at=datetime(2025, 1, 2), limits=limits)
    assert large.buckets(tables.BRONZE_ORDERS, BY) == 0
    assert large.read_dealt(tables.BRONZE_ORDERS, BY).count() == large.read(tables.BRONZE_ORDERS).count() == 70 + 71
    assert shown(large) == shown(small)


def test_a_version_is_read_as_it_was_dealt(spark, tmp_path):
    lake, table = Lake(spark, str(tmp_path)), Table("silver", "pairs")
    rows = spark.range(100).selectExpr("IF(id % 7 = 0, NULL, id % 10) AS `a key`", "id AS `v,w`", "named_struct('x', id) AS s")
    lake.overwrite(rows, table, deal_by=["a key"], buckets=3)
    dealt = lake.read_dealt(table, ["a key"])
    assert dealt.schema == lake.read(table).schema and sorted(map(str, dealt.collect())) == sorted(map(str, rows.collect()))
    assert lake.buckets(table, ["a key"]) == 3 and lake.buckets(table, ["v,w"]) == 0
    lake.extend(rows.limit(5), table)
    assert lake.buckets(table, ["a key"]) == 0 and lake.read_dealt(table, ["a key"]).count() == 105
    lake.overwrite(rows, table)
    assert lake.buckets(table, ["a key"]) == 0
    lake.restore(table, 1)
    assert lake.read_dealt(table, ["a key"]).count() == 105
    with pytest.raises(ValueError, match="not both"):
        lake.overwrite(rows, table, ["s"], ["a key"], 2)


def test_inputs_of_one_task_are_not_dealt(spark, tmp_path):
    spark.range(1000).withColumn("t", F.lit("x")).write.parquet(f"{tmp_path}/t")
    df = spark.read.parquet(f"{tmp_path}/t")
    assert buckets_for(df) == 0 and buckets_for(df, LARGE) == 4


def test_a_catalog_deals_in_its_own_way(spark):
    lake, table = CatalogLake(spark, schema_prefix="dealt_"), Table("bronze", "orders", tables.LOG)
    lake.ensure()
    try:
        lake.append(spark.range(5), table, deal_by=["id"], buckets=2)
        assert lake.buckets(table, ["id"]) == 0 and lake.read_dealt(table, ["id"]).count() == 5
    finally:
        lake.remove()
