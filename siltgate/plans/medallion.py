"""Raw files to bronze, through the gate to silver and quarantine, and on to gold.

Rows are judged once: the evaluated rows are written as a candidate, and that write counts
what the metrics need. The audit, silver and quarantine read the candidate, each once. Silver
gets a new version only when the audit holds.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from siltgate.functions.expressions import is_present
from siltgate.operators import audit, gate, star
from siltgate.operators.checks import ARRIVAL, Check, order_checks, satisfies
from siltgate.operators.conform import conform_customers, conform_products
from siltgate.operators.history import write_guarded
from siltgate.operators.repeats import newest_per_key
from siltgate.plans.sizing import DEFAULT_LIMITS, Limits, buckets_for, hot_keys, stored
from siltgate.sources import contract
from siltgate.sources import lake as tables
from siltgate.sources.lake import CatalogLake, Lake, Table
from siltgate.sources.raw import read_csv_raw, read_json_raw, unseen, with_lineage


# What the audit, silver and quarantine read; bronze may hold more. Silver's types are cast from the text again.
CANDIDATE_COLUMNS = (*gate.RAW_ORDER_COLUMNS, "_source_file", "_ingested_at", gate.FAILED, gate.WARNED, gate.PASSED)

# Large loads of orders are dealt by it as they are written, so that no pass through the gate shuffles them.
ORDER_KEY = ("order_id",)


@dataclass(frozen=True)
class Summary:
    run_id: str
    clean: int
    quarantined: int


def new_run_id() -> str:
    return uuid.uuid4().hex[:12]


def ingest(
    lake: Lake | CatalogLake,
    orders_csv: str,
    customers_csv: str,
    products_json: str,
    at: datetime | None = None,
    products_schema: StructType | None = None,
    load_key: Sequence[str] = (),
    limits: Limits = DEFAULT_LIMITS,
    contracts: Mapping[str, StructType] | None = None,
) -> None:
    """Append the three feeds to bronze with their lineage. A schema saves inferring the JSON.

    A feed with a contract (by file name, as "orders.csv") is held to it: bronze gets its columns and
    the rescued ones, and what the contract refuses goes to quarantine with the reason.

    With a ``load_key``, orders whose key bronze already holds are left out, so that a
    repeated load changes nothing; without one, all rows are appended as they come.
    """
    spark, contracts = lake.spark, contracts or {}
    feeds = (
        (orders_csv, "orders.csv", tables.BRONZE_ORDERS),
        (customers_csv, "customers.csv", tables.BRONZE_CUSTOMERS),
        (products_json, "products.json", tables.BRONZE_PRODUCTS),
    )
    for path, source, table in feeds:
        is_json = path is products_json
        if source in contracts:
            admitted = (contract.read_json if is_json else contract.read_csv)(spark, [path], contracts[source])
            df = admitted.accepted
            lake.append(with_lineage(admitted.refused, source, at), tables.REFUSED_FEEDS)
        else:
            df = read_json_raw(spark, path, products_schema) if is_json else read_csv_raw(spark, path)
        rows = with_lineage(df, source, at)
        if table is not tables.BRONZE_ORDERS:
            lake.append(rows, table)
            continue
        buckets = buckets_for(df, limits)
        if load_key:
            append_new(lake, rows, table, load_key, limits, ORDER_KEY, buckets)
        else:
            lake.append(rows, table, deal_by=ORDER_KEY, buckets=buckets)


def append_new(
    lake: Lake | CatalogLake,
    df: DataFrame,
    table: Table,
    load_key: Sequence[str],
    limits: Limits = DEFAULT_LIMITS,
    deal_by: Sequence[str] = (),
    buckets: int = 0,
) -> None:
    """Append only the rows whose load key the table lacks, so a repeated load changes nothing."""
    if lake.exists(table):
        df = unseen(df, lake.read(table), load_key, limits)
    lake.append(df, table, deal_by=deal_by, buckets=buckets)


def append_run(lake: Lake | CatalogLake, df: DataFrame, table: Table, run_id: str) -> None:
    """Append a run's rows unless the table has rows of that run, so a run that is repeated adds nothing."""
    if lake.exists(table) and not lake.read(table).where(F.col("run_id") == run_id).isEmpty():
        return
    lake.append(df, table)


def silver_guards() -> list[Check]:
    """What must hold for every row of silver.orders, whatever the gate did."""
    return [
        satisfies("customer_id_filled", lambda: is_present("customer_id")),
        satisfies("order_amount_filled", "order_amount IS NOT NULL"),
        satisfies("order_date_filled", "order_date IS NOT NULL"),
        satisfies("quantity_positive", "quantity > 0"),
    ]


def build_silver(
    lake: Lake | CatalogLake,
    run_id: str,
    arrival: Sequence[str | Column] = ARRIVAL,
    bounds: audit.Bounds | None = audit.Bounds(),
    sla: float | None = None,
    measured_at: datetime | None = None,
    limits: Limits = DEFAULT_LIMITS,
) -> Summary:
    """Gate bronze orders into silver and quarantine and add this run's metrics.

    ``bounds`` None publishes without an audit; ``sla`` stops the run after the
    metrics are stored when a hard check is below it.
    """
    # The newest load of a key wins; within one load its content decides.
    newest = F.desc("_ingested_at")
    customers = conform_customers(
        newest_per_key(
            lake.read(tables.BRONZE_CUSTOMERS),
            ["customer_id"],
            [newest, "name", "company", "country"],
        )
    )
    products = conform_products(
        newest_per_key(
            lake.read(tables.BRONZE_PRODUCTS),
            ["product_id"],
            [newest, "product_name", "category", "unit_price"],
        )
    )
    # Written once, published only after the audit.
    customers, products = stored(customers, "customers"), stored(products, "products")
    checks = order_checks(products, customers, arrival)
    orders, buckets = lake.read(tables.BRONZE_ORDERS), lake.buckets(tables.BRONZE_ORDERS, ORDER_KEY)
    # A bucket is one task, so a hot key takes the way by slots and shuffles.
    if buckets and hot_keys(orders, ORDER_KEY, limits) is not None:
        buckets = 0
    if buckets:
        orders = lake.read_dealt(tables.BRONZE_ORDERS, ORDER_KEY)
    judged = gate.judge(orders, checks, limits, raw_kept=True)
    # The write counts what metrics and summary need.
    observed = gate.observe(judged.select(*CANDIDATE_COLUMNS, gate.VERDICTS), checks)
    lake.overwrite(observed.rows.drop(gate.VERDICTS), tables.ORDERS_CANDIDATE, deal_by=ORDER_KEY, buckets=buckets)
    candidate = lake.read_dealt(tables.ORDERS_CANDIDATE, ORDER_KEY)

    measured = gate.rates(observed.wide(), checks, run_id, "orders", measured_at)
    append_run(lake, measured, tables.DQ_METRICS, run_id)
    clean, rejected = gate.split(candidate)
    append_run(lake, gate.quarantine(rejected, run_id), tables.QUARANTINE_ORDERS, run_id)
    if bounds is not None:
        audit.enforce(audit.report(candidate, "order_id", bounds))
    if sla is not None:
        gate.enforce_sla(lake.read(tables.DQ_METRICS), run_id, sla)
    lake.overwrite(customers, tables.SILVER_CUSTOMERS)
    lake.overwrite(products, tables.SILVER_PRODUCTS)
    write_guarded(gate.publishable(gate.typed(clean, checks)), silver_guards(), lambda rows: lake.overwrite(rows, tables.SILVER_ORDERS))

    return Summary(run_id, *observed.split_counts())


def build_gold(lake: Lake | CatalogLake, limits: Limits = DEFAULT_LIMITS) -> None:
    """Dimensions, fact and revenue tables."""
    orders = lake.read(tables.SILVER_ORDERS)
    lake.overwrite(star.dim_customer(lake.read(tables.SILVER_CUSTOMERS)), tables.DIM_CUSTOMER)
    lake.overwrite(star.dim_product(lake.read(tables.SILVER_PRODUCTS)), tables.DIM_PRODUCT)
    lake.overwrite(star.date_dim(orders), tables.DIM_DATE)
    lake.overwrite(star.fact_sales(orders), tables.FACT_SALES)
    build_revenue(lake, limits)


def build_revenue(lake: Lake | CatalogLake, limits: Limits = DEFAULT_LIMITS) -> None:
    """The revenue tables, from the stored fact and dimensions."""
    fact = lake.read(tables.FACT_SALES)
    lake.overwrite(
        star.revenue_by_country(fact, lake.read(tables.DIM_CUSTOMER), limits),
        tables.REVENUE_BY_COUNTRY,
    )
    lake.overwrite(
        star.revenue_by_category(fact, lake.read(tables.DIM_PRODUCT), limits),
        tables.REVENUE_BY_CATEGORY,
    )


def run(
    lake: Lake | CatalogLake,
    orders_csv: str,
    customers_csv: str,
    products_json: str,
    run_id: str | None = None,
    arrival: Sequence[str | Column] = ARRIVAL,
    bounds: audit.Bounds | None = audit.Bounds(),
    sla: float | None = None,
    at: datetime | None = None,
    products_schema: StructType | None = None,
    load_key: Sequence[str] = (),
    limits: Limits = DEFAULT_LIMITS,
    contracts: Mapping[str, StructType] | None = None,
) -> Summary:
    """Everything, end to end. Use a fresh root for a fresh start."""
    lake.ensure()
    ingest(lake, orders_csv, customers_csv, products_json, at, products_schema, load_key, limits, contracts)
    summary = build_silver(lake, run_id or new_run_id(), arrival, bounds, sla, at, limits)
    build_gold(lake, limits)
    return summary
