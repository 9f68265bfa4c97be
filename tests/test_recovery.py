"""Recovered rows in silver, fact and revenue."""

from __future__ import annotations

from pathlib import Path

import pytest
from pyspark.sql import functions as F
from rows import customers, orders, products

from siltgate.operators import gate
from siltgate.operators.checks import order_checks
from siltgate.plans import recovery
from siltgate.plans.medallion import build_revenue
from siltgate.sources import lake as tables
from siltgate.sources.lake import CatalogLake, Lake


@pytest.fixture
def lake(spark, tmp_path):
    """Orders of three months; O2 and O4 have a wrong sign, O5 an unknown product, O1 a later copy."""
    lake = Lake(spark, str(tmp_path / "lake"))
    rows = orders(
        spark, {}, {"order_id": "O2", "quantity": "-2", "order_amount": "-2.4", "order_date": "2025-02-10"},
        {"order_id": "O3", "order_date": "2025-03-01"}, {"order_id": "O4", "quantity": "-2", "order_date": "2025-02-11"},
        {"order_id": "O5", "product_id": "P9", "quantity": "-1"}, {"quantity": "-2", "order_date": "2025-03-20"},
        {"order_id": "O6", "order_date": "2025-02-01"},
    )
    judged = gate.judge(rows, order_checks(products(spark), customers(spark)))
    clean, rejected = gate.split(judged)
    lake.overwrite(gate.publishable(clean), tables.SILVER_ORDERS)
    lake.append(gate.quarantine(rejected, "run-1"), tables.QUARANTINE_ORDERS)
    lake.overwrite(products(spark), tables.SILVER_PRODUCTS)
    lake.overwrite(products(spark), tables.DIM_PRODUCT)
    lake.overwrite(customers(spark), tables.SILVER_CUSTOMERS)
    lake.overwrite(customers(spark), tables.DIM_CUSTOMER)
    recovery.publish_fact(lake)
    build_revenue(lake)
    return lake


def unsigned(rows):
    return rows.withColumns({c: F.regexp_replace(c, "^-", "") for c in ("quantity", "order_amount")})


def files(lake, month):
    return {f: f.stat().st_mtime_ns for f in Path(lake.path(tables.FACT_SALES)).rglob(f"month_key={month}/*.parquet")}


def ids(df):
    return sorted(r["order_id"] for r in df.collect())


def test_recovered_rows_reach_every_table(lake):
    before = {m: files(lake, m) for m in (202501, 202502, 202503)}
    recovery.recover(lake, "fix", unsigned)
    assert ids(lake.read(tables.SILVER_ORDERS)) == ids(lake.read(tables.FACT_SALES)) == ["O1", "O2", "O3", "O4", "O6"]
    assert ids(recovery.open_quarantine(lake)) == ["O1", "O5"]
    after = {m: files(lake, m) for m in before}
    assert after[202501] == before[202501] and after[202503] == before[202503] and after[202502] != before[202502]
    assert lake.read(tables.REVENUE_BY_CATEGORY).first()["revenue"] == pytest.approx(5 * 2.4)
    assert lake.read(tables.DIM_DATE).count() == 5


def test_a_repeated_recovery_changes_nothing(lake, monkeypatch):
    """Also one that stopped after silver had its rows and before the fact was rebuilt."""
    stop = RuntimeError("lost")

    def fail(*_):
        raise stop

    with monkeypatch.context() as patched:
        patched.setattr(Lake, "replace_partitions", fail)
        with pytest.raises(RuntimeError):
            recovery.recover(lake, "fix", unsigned)
    assert len(ids(lake.read(tables.SILVER_ORDERS))) == 5 and len(ids(lake.read(tables.FACT_SALES))) == 3
    for _ in range(2):
        recovery.recover(lake, "fix", unsigned)
        assert ids(lake.read(tables.SILVER_ORDERS)) == ids(lake.read(tables.FACT_SALES)) == ["O1", "O2", "O3", "O4", "O6"]
    recovery.recover(lake, "another", lambda rows: rows.withColumn("product_id", F.lit("P001")).withColumn("quantity", F.lit("1")))
    assert ids(lake.read(tables.SILVER_ORDERS)) == ["O1", "O2", "O3", "O4", "O5", "O6"]
    assert ids(recovery.open_quarantine(lake)) == ["O1"]


def test_nothing_to_recover(lake):
    recovery.recover(lake, "none", lambda rows: rows)
    assert ids(lake.read(tables.FACT_SALES)) == ["O1", "O3", "O6"] and len(ids(recovery.open_quarantine(lake))) == 4


def test_partitions_of_catalog_tables(spark):
    lake = CatalogLake(spark)
    lake.ensure()
    spark.sql(f"DROP TABLE IF EXISTS {lake.path(tables.FACT_SALES)}")
    lake.overwrite(spark.createDataFrame([(1, 10), (2, 20)], "v int, k int"), tables.FACT_SALES, ["k"])
    lake.replace_partitions(spark.createDataFrame([(20, 9), (20, 8)], "k int, v int"), tables.FACT_SALES, ["k"])
    assert sorted(map(tuple, lake.read(tables.FACT_SALES).collect())) == [(1, 10), (8, 20), (9, 20)]
    spark.sql(f"DROP TABLE {lake.path(tables.FACT_SALES)}")
