"""Raw readers, lineage, versions and the end-to-end run."""

from __future__ import annotations

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from rows import LOADED

from siltgate.operators import audit, gate
from siltgate.plans import medallion
from siltgate.sources import lake as tables
from siltgate.sources import raw
from siltgate.sources.lake import LOG, CatalogLake, Lake, Table

PRODUCTS = "product_id string, product_name string, category string, unit_price double"


@pytest.fixture
def lake(spark, tmp_path):
    return Lake(spark, str(tmp_path / "lake"))


def frame(spark, *ids):
    return spark.createDataFrame([(i,) for i in ids], "id int")


def ids(df):
    return sorted(r.id for r in df.collect())


def test_csv_is_text_and_keeps_malformed_rows(spark, tmp_path):
    path = tmp_path / "orders.csv"
    path.write_text('order_id,quantity,order_date\nO1,2,2025-13-40\nO2,,""\nO3,x\nO4,1,d,extra\n')
    df = raw.read_csv_raw(spark, str(path))
    assert {kind for _, kind in df.dtypes} == {"string"}
    assert [tuple(r) for r in df.collect()] == [
        ("O1", "2", "2025-13-40"), ("O2", None, None), ("O3", "x", None), ("O4", "1", "d"),
    ]


def test_json_array_is_inferred_or_typed(spark, tmp_path):
    path = tmp_path / "products.json"
    path.write_text(json.dumps([{"product_id": "P1", "unit_price": 1.5}, {"product_id": "P2", "unit_price": 2.0}], indent=2))
    df = raw.read_json_raw(spark, str(path))
    assert df.dtypes == [("product_id", "string"), ("unit_price", "double")]
    assert df.count() == 2
    schema = StructType.fromDDL("product_id string")
    assert raw.read_json_raw(spark, str(path), schema).columns == ["product_id"]


def test_lineage(spark):
    row = raw.with_lineage(frame(spark, 1), "a.csv", LOADED).first()
    assert (row._ingested_at, row._source_file) == (LOADED, "a.csv")
    assert raw.with_lineage(frame(spark, 1), "a.csv").first()._ingested_at is not None


def test_overwrite_versions(spark, lake):
    table = Table("silver", "t")
    assert lake.overwrite(frame(spark, 1), table) == 1
    # A plan may read the table it replaces.
    assert lake.overwrite(lake.read(table).union(frame(spark, 2)), table) == 2
    assert ids(lake.read(table)) == [1, 2]
    assert ids(lake.read(table, version=1)) == [1]
    assert lake.read(table).columns == ["id"]


def test_overwrite_replaces_the_schema(spark, lake):
    table = Table("silver", "t")
    lake.overwrite(frame(spark, 1), table)
    lake.overwrite(frame(spark, 1).withColumn("name", F.lit("a")).drop("id"), table)
    assert lake.read(table).columns == ["name"]


def test_append_merges_schemas_and_reads_as_of(spark, lake):
    table = Table("bronze", "t", LOG)
    lake.append(frame(spark, 1), table)
    lake.append(frame(spark, 2).withColumn("late", F.lit("x")), table)
    assert sorted(map(tuple, lake.read(table).collect())) == [(1, None), (2, "x")]
    assert ids(lake.read(table, version=1)) == [1]


@pytest.mark.parametrize(("kind", "after"), [("snapshot", [9]), (LOG, [1, 9])])
def test_restore_copies_nothing_and_goes_on(spark, lake, kind, after):
    table = Table("ops", "t", kind)
    write = lake.append if kind == LOG else lake.overwrite
    write(frame(spark, 1), table)
    write(frame(spark, 2), table)
    assert lake.restore(table, 1) == 3
    assert ids(lake.read(table)) == [1]
    assert ids(lake.read(table, version=2)) == ([1, 2] if kind == LOG else [2])
    assert write(frame(spark, 9), table) == 4
    assert ids(lake.read(table)) == after
    assert lake.versions(table) == [1, 2, 3, 4]


def test_uncommitted_versions_are_not_read(spark, lake, tmp_path):
    table = Table("silver", "t")
    lake.overwrite(frame(spark, 1), table)
    (tmp_path / "lake" / "silver" / "t" / "version=2").mkdir()
    assert ids(lake.read(table)) == [1]
    assert lake.overwrite(frame(spark, 3), table) == 3
    assert ids(lake.read(table)) == [3]


def test_unknown_tables_and_versions(spark, lake):
    table = Table("silver", "t")
    with pytest.raises(LookupError):
        lake.read(table)
    lake.overwrite(frame(spark, 1), table)
    with pytest.raises(LookupError, match="no version 7"):
        lake.read(table, version=7)
    with pytest.raises(LookupError):
        lake.restore(table, 7)
    with pytest.raises(ValueError, match="layer"):
        Table("copper", "t")


def test_kinds_are_kept_apart(spark, lake):
    with pytest.raises(ValueError):
        lake.append(frame(spark, 1), Table("silver", "t"))
    with pytest.raises(ValueError):
        lake.overwrite(frame(spark, 1), Table("bronze", "t", LOG))


def test_catalog_tables(spark):
    catalog = CatalogLake(spark)
    catalog.ensure()
    assert {"bronze", "silver", "gold", "quarantine", "ops"} <= {
        r.namespace for r in spark.sql("SHOW DATABASES").collect()
    }
    table = Table("silver", "named")
    catalog.overwrite(frame(spark, 1), table)
    catalog.append(frame(spark, 2), table)
    assert ids(catalog.read(table)) == [1, 2]
    catalog.overwrite(frame(spark, 3), table)
    assert ids(catalog.read(table)) == [3]


def test_repeated_load_adds_nothing(spark, lake):
    table = Table("bronze", "t", LOG)
    for _ in range(2):
        medallion.append_new(lake, frame(spark, 1, 2), table, ["id"])
    medallion.append_new(lake, frame(spark, 2, 3), table, ["id"])
    assert ids(lake.read(table)) == [1, 2, 3]


def test_schema_drift(spark):
    contract = StructType.fromDDL("id int, name string, at date")
    df = spark.createDataFrame([(1, "a", 2.0)], "id bigint, name string, extra double")
    assert raw.schema_drift(df, contract) == [
        ("at", "missing"), ("extra", "unexpected"), ("id", "bigint instead of int"),
    ]
    with pytest.raises(raw.SchemaDrift, match="extra: unexpected"):
        raw.hold_to_contract(df, contract)
    assert raw.hold_to_contract(df, df.schema) is df


@pytest.fixture
def feeds(tmp_path):
    orders = ["order_id,customer_id,product_id,quantity,unit_price,order_amount,order_date"]
    for i in range(1, 41):
        orders.append(f"O{i},C{i % 4 + 1},P{i % 2 + 1},{i % 5 + 1},2.5,{(i % 5 + 1) * 2.5},2025-01-{i % 28 + 1:02d}")
    orders.append(orders[1])
    orders.append("O41,,P1,1,2.5,2.5,2025-01-01")
    orders.append("O42,C1,P9,1,2.5,,2025-13-40")
    (tmp_path / "orders.csv").write_text("\n".join(orders) + "\n")
    (tmp_path / "customers.csv").write_text(
        "customer_id,name,company,country\nC1,A,X,Poland\nC2,B,X,pl\nC3,C,Y,fr\nC4,D,Y,\n"
    )
    (tmp_path / "products.json").write_text(
        json.dumps([
            {"product_id": f"P{n}", "product_name": f"n{n}", "category": "Beer", "unit_price": 2.5}
            for n in (1, 2)
        ])
    )
    return [str(tmp_path / name) for name in ("orders.csv", "customers.csv", "products.json")]


BOUNDS = audit.Bounds(min_clean_rows=10, max_clean_fraction=0.99)


def test_end_to_end(spark, lake, feeds):
    summary = medallion.run(lake, *feeds, run_id="r1", bounds=BOUNDS, sla=0.8, at=LOADED)
    assert (summary.clean, summary.quarantined) == (40, 3)
    assert lake.read(tables.BRONZE_ORDERS).count() == 43
    assert lake.read(tables.SILVER_ORDERS).count() == 40
    reasons = {r.order_id: r.failed_rules for r in lake.read(tables.QUARANTINE_ORDERS).collect()}
    assert reasons == {
        "O1": ["uniqueness_order_id"],
        "O41": ["completeness_customer_id", "integrity_customer_id"],
        "O42": ["completeness_order_amount", "validity_order_date", "integrity_product_id"],
    }
    assert lake.read(tables.DQ_METRICS).count() == 8
    countries = {r.customer_id: r.country for r in lake.read(tables.DIM_CUSTOMER).collect()}
    assert countries == {"C1": "PL", "C2": "PL", "C3": "FR", "C4": None}
    revenue = {r.category: (r.revenue, r.units) for r in lake.read(tables.REVENUE_BY_CATEGORY).collect()}
    assert revenue == {"Beer": (300.0, 120)}
    by_country = {r.country: r.orders for r in lake.read(tables.REVENUE_BY_COUNTRY).collect()}
    assert by_country == {"PL": 20, "FR": 10, None: 10}
    assert lake.read(tables.DIM_DATE).count() == 28
    assert lake.read(tables.FACT_SALES).select("date_key").distinct().count() == 28


def test_reingest_makes_the_second_load_repeats_but_keeps_revenue(spark, lake, feeds):
    medallion.run(lake, *feeds, run_id="r1", bounds=BOUNDS, at=LOADED)
    loose = audit.Bounds(min_clean_rows=10, min_clean_fraction=0.1)
    again = medallion.run(lake, *feeds, run_id="r2", bounds=loose, at=datetime(2025, 1, 2))
    assert (again.clean, again.quarantined) == (40, 46)
    assert lake.read(tables.DIM_PRODUCT).count() == 2
    assert lake.read(tables.REVENUE_BY_CATEGORY).first().units == 120
    assert lake.read(tables.DQ_METRICS).select("run_id").distinct().count() == 2
    assert lake.read(tables.QUARANTINE_ORDERS).count() == 3 + 46


def test_a_load_key_makes_reingest_harmless(spark, lake, feeds):
    medallion.run(lake, *feeds, run_id="r1", bounds=BOUNDS, at=LOADED, load_key=["order_id"])
    again = medallion.run(
        lake, *feeds, run_id="r2", bounds=BOUNDS, at=datetime(2025, 1, 2), load_key=["order_id"]
    )
    assert lake.read(tables.BRONZE_ORDERS).count() == 43
    assert (again.clean, again.quarantined) == (40, 3)


def test_end_to_end_by_name(spark, feeds):
    catalog = CatalogLake(spark)
    summary = medallion.run(catalog, *feeds, run_id="r1", bounds=BOUNDS, at=LOADED)
    assert (summary.clean, summary.quarantined) == (40, 3)
    assert spark.table("gold.fact_sales").count() == 40
    assert spark.table("ops.dq_metrics").count() == 8


def test_a_failed_audit_publishes_nothing(spark, lake, feeds):
    medallion.run(lake, *feeds, run_id="r1", bounds=BOUNDS, at=LOADED)
    with pytest.raises(audit.AuditFailed, match="clean_rows"):
        medallion.build_silver(lake, "r2", bounds=audit.Bounds(min_clean_rows=1000))
    assert lake.versions(tables.SILVER_ORDERS) == [1]
    assert lake.versions(tables.DQ_METRICS) == [1, 2]


def test_an_sla_breach_stops_before_silver(spark, lake, feeds):
    with pytest.raises(gate.SlaBreach):
        medallion.run(lake, *feeds, run_id="r1", bounds=None, sla=0.99)
    assert lake.versions(tables.SILVER_ORDERS) == []
    assert lake.read(tables.DQ_METRICS).count() == 8


def test_end_to_end_large(spark, lake, feeds, large):
    summary = medallion.run(lake, *feeds, run_id="r1", bounds=BOUNDS, at=LOADED, limits=large)
    assert (summary.clean, summary.quarantined) == (40, 3)
    assert lake.read(tables.REVENUE_BY_CATEGORY).first().revenue == 300.0
    assert {r.country: r.orders for r in lake.read(tables.REVENUE_BY_COUNTRY).collect()} == {
        "PL": 20, "FR": 10, None: 10,
    }


def test_published_tables_are_audited_as_they_stand(spark, lake, feeds):
    medallion.run(lake, *feeds, run_id="r1", bounds=BOUNDS, at=LOADED)

    def audited(run_id=None):
        made = audit.published(lake.read(tables.SILVER_ORDERS), lake.read(tables.QUARANTINE_ORDERS), "order_id", run_id, BOUNDS)
        return {r.audit_check: (r.observed, r.holds) for r in made.collect()}

    assert audited() == audited("r1") == {"clean_rows": (40.0, True), "clean_fraction": (40 / 43, True), "duplicate_keys": (0.0, True)}
    assert audited("r2")["clean_fraction"] == (1.0, False)
    # A writer past the gate adds a key that an earlier version holds.
    lake.extend(lake.read(tables.SILVER_ORDERS).where("order_id = 'O5'"), tables.SILVER_ORDERS)
    assert audited()["duplicate_keys"] == (1.0, False)
    empty = lake.read(tables.SILVER_ORDERS).limit(0)
    none = audit.published(empty, lake.read(tables.QUARANTINE_ORDERS).limit(0), "order_id", bounds=BOUNDS)
    assert {r.audit_check: r.observed for r in none.collect()} == {"clean_rows": 0.0, "clean_fraction": 0.0, "duplicate_keys": 0.0}
