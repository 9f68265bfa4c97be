"""The registered queries: every operator over the whole test tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StringType, StructField, StructType

from siltgate.functions.expressions import exact_sum
from siltgate.operators import audit, checks, conform, gate, history, kpi, repeats, sketches, star
from siltgate.operators.reprocess import reprocess
from siltgate.plans import dimension, medallion, recovery
from siltgate.plans.sizing import Limits, scratch_path, stored
from siltgate.sources import contract, raw
from siltgate.sources import lake as tables
from siltgate.sources.lake import CatalogLake, Lake, Table
from siltgate.streaming import gated
from siltgate.workload import files
from siltgate.workload.oracle import RULE_QUERIES
from siltgate.workload.sales import (
    ARRIVAL,
    RUN,
    raw_customers,
    raw_products,
    raw_sales,
    sales_checks,
    table,
)

Query = Callable[[SparkSession, str], DataFrame]
LOADED_AT = datetime(2025, 1, 1)
SECONDS = "yyyy-MM-dd HH:mm:ss"


def _text(names: str) -> Column:
    return F.concat_ws("; ", names)


def judged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gate.judge(raw_sales(spark, sf_dir), sales_checks(spark, sf_dir))


def clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gate.split(judged(spark, sf_dir))[0]


def rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gate.split(judged(spark, sf_dir))[1]


def silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gate.publishable(clean(spark, sf_dir))


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conform.conform_customers(raw_customers(spark, sf_dir))


def metric_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metrics of every order month, as if each had been one run.

    Stored, as the metrics table is: reports that read it twice do not gate twice.
    """
    rows = gate.metrics(
        judged(spark, sf_dir),
        sales_checks(spark, sf_dir),
        F.col("_batch"),
        "orders",
        F.concat("_batch", F.lit("-01")),
        by=["_batch"],
    )
    return stored(rows, "metrics")


# --- the gate ---------------------------------------------------------------


def gate_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = gate.metrics(
        judged(spark, sf_dir), sales_checks(spark, sf_dir), RUN, "orders", LOADED_AT
    )
    return rows.drop("measured_at")


def unpivot_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = sales_checks(spark, sf_dir)
    return gate.spread(gate.tally(judged(spark, sf_dir), rules), rules)


def gate_evaluate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged(spark, sf_dir).select(
        "order_id",
        "product_id",
        f"{gate.VERDICTS}.*",
        _text(gate.FAILED).alias("failed_rules"),
        _text(gate.WARNED).alias("warnings"),
        F.col(gate.PASSED).alias("passed"),
    )


def failed_rule_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged(spark, sf_dir).select(
        "order_id",
        _text(gate.FAILED).alias("failed_rules"),
        F.size(gate.FAILED).alias("failed"),
        F.size(gate.WARNED).alias("warned"),
    )


def gate_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean(spark, sf_dir).select(
        "order_id", "customer_id", "product_id", "order_date", _text(gate.WARNED).alias("warnings")
    )


def gate_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rejected(spark, sf_dir).select(
        "order_id", "customer_id", "product_id", F.col("dq_reason").alias("reason")
    )


def silver_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver(spark, sf_dir).withColumn("dq_warnings", _text("dq_warnings"))


def write_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history.guard(silver(spark, sf_dir), medallion.silver_guards()).select(
        "order_id", "customer_id", "product_id", "quantity", "order_amount", "order_date"
    )


def guard_stops_writes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean rows are published; then every order, good or bad, is to replace them under one guard at a time.

    One row a guard: the rows that break it, whether its write was stopped, and the rows that the table shows
    afterwards, counted through the guards.
    """
    lake, orders = _lake(spark), tables.SILVER_ORDERS
    rules = medallion.silver_guards()
    # Judged once: the clean rows are a part of every row.
    every_judged = stored(gate.publishable(judged(spark, sf_dir), gate.PASSED), "every-order")
    published, every = every_judged.where(gate.PASSED).drop(gate.PASSED), every_judged.drop(gate.PASSED)
    history.write_guarded(published, rules, lambda rows: lake.overwrite(rows, orders))
    breaking = [F.count_if(~F.coalesce(rule.holds(), F.lit(False))) for rule in rules]
    broken = every.agg(*[n.alias(rule.name) for rule, n in zip(rules, breaking)]).first()
    outcome = []
    for rule in rules:
        try:
            history.write_guarded(every, [rule], lambda rows: lake.overwrite(rows, orders))
            stopped = False
        except history.Broken as reason:
            stopped = reason.checks == [rule.name]
        if not stopped:
            lake.restore(orders, 1)
        shown = history.counted(history.guard(lake.read(orders), rules)).first().rows
        outcome.append((rule.name, broken[rule.name], stopped, shown))
    return spark.createDataFrame(outcome, "guard string, rows_broken bigint, stopped boolean, rows_published bigint")


def quarantine_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = gate.quarantine(rejected(spark, sf_dir), RUN)
    return rows.withColumns(
        {
            "unit_price": F.col("unit_price").try_cast("double"),
            "order_amount": F.col("order_amount").try_cast("double"),
            "_ingested_at": F.date_format("_ingested_at", SECONDS),
            "failed_rules": _text("failed_rules"),
        }
    )


def strip_scratch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gate.strip(judged(spark, sf_dir)).select(
        "order_id", "customer_id", "product_id", "order_date", "quantity_int", "is_repeat"
    )


TYPED = ("order_id", "quantity_int", "unit_price_dbl", "order_amount_dbl", "order_date_parsed")


def typed_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    local = [
        check
        for check in sales_checks(spark, sf_dir)
        if all(isinstance(need, checks.Typed) for need in check.needs)
    ]
    return gate.prepare(raw_sales(spark, sf_dir), local).select(*TYPED)


def prepared_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gate.prepare(raw_sales(spark, sf_dir), sales_checks(spark, sf_dir)).select(
        *TYPED, "is_repeat", "product_exists", "customer_exists"
    )


def dedup_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranked = repeats.rank_copies(raw_sales(spark, sf_dir), ["order_id"], ARRIVAL, "copy_rank")
    return ranked.select(
        "order_id", "product_id", "copy_rank", (F.col("copy_rank") > 1).alias("is_repeat")
    )


def fk_product_exists(spark: SparkSession, sf_dir: str) -> DataFrame:
    sales = raw_sales(spark, sf_dir).select("order_id", "product_id")
    return checks.key_exists(sales, ["product_id"], raw_products(spark, sf_dir), "product_exists")


def fk_customer_exists(spark: SparkSession, sf_dir: str) -> DataFrame:
    sales = raw_sales(spark, sf_dir).select("order_id", "customer_id")
    return checks.key_exists(
        sales, ["customer_id"], raw_customers(spark, sf_dir), "customer_exists"
    )


def orphans_anti_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    sales = raw_sales(spark, sf_dir).select("order_id", "customer_id")
    return checks.orphans(sales, ["customer_id"], raw_customers(spark, sf_dir))


def inject_defects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_sales(spark, sf_dir).select(
        "order_id",
        "customer_id",
        "product_id",
        "quantity",
        F.col("unit_price").try_cast("double").alias("unit_price"),
        F.col("order_amount").try_cast("double").alias("order_amount"),
        "order_date",
    )


def _rule(name: str) -> Query:
    """Rows that fail one check; only what that check needs is computed."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        one = [c for c in sales_checks(spark, sf_dir) if c.name == name]
        rows = gate.judge(raw_sales(spark, sf_dir), one)
        return rows.where(~F.col(gate.VERDICTS)[name]).select(
            "order_id", "customer_id", "product_id", "quantity", "order_date"
        )

    return query


def reprocess_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Negative quantities are a sign error of the source: fix and judge again."""

    def fix(rows: DataFrame) -> DataFrame:
        return rows.withColumns(
            {
                "quantity": F.abs(F.col("quantity_int")).cast("string"),
                "order_amount": F.abs(F.col("order_amount_dbl")).cast("string"),
            }
        ).drop(*[n.column for c in sales_checks(spark, sf_dir) for n in c.needs], "dq_reason")

    # Published and rejected rows are two tables of one run.
    kept = (*gate.RAW_ORDER_COLUMNS, *ARRIVAL, "quantity_int", "order_amount_dbl", gate.FAILED, gate.PASSED)
    published, refused = gate.split(stored(judged(spark, sf_dir).select(*kept), "judged"))
    again = reprocess(refused, fix, published, ["order_id"], sales_checks(spark, sf_dir))
    return again.select(
        "order_id",
        "customer_id",
        "product_id",
        F.col("quantity_int").alias("quantity"),
        F.col("order_amount_dbl").alias("order_amount"),
        F.col("order_date_parsed").alias("order_date"),
        F.col(gate.PASSED).alias("passed"),
        _text(gate.FAILED).alias("reason"),
    )


# --- star schema ------------------------------------------------------------


def dim_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    products = conform.conform_products(raw_products(spark, sf_dir))
    return star.dim_product(products, ["product_name"])


def dim_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.dim_customer(customers(spark, sf_dir), ["name"])


def date_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.date_dim(silver(spark, sf_dir))


def fact_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.fact_sales(silver(spark, sf_dir))


def revenue_by_country(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.revenue_by_country(
        fact_sales(spark, sf_dir), customers(spark, sf_dir), probe=raw_sales(spark, sf_dir)
    )


def revenue_by_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.revenue_by_category(
        fact_sales(spark, sf_dir), raw_products(spark, sf_dir), probe=raw_sales(spark, sf_dir)
    )


# --- reports ----------------------------------------------------------------


def _report(report: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: report(metric_history(spark, sf_dir))


def soft_rule_spikes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kpi.soft_rule_spikes(metric_history(spark, sf_dir), factor=1.1).select(
        "rule_name",
        "run_id",
        "rows_failed",
        "rows_evaluated",
        F.round("failure_rate", 6).alias("failure_rate"),
        F.round("trailing_mean", 6).alias("trailing_mean"),
    )


def sla_breaches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Over the whole load as one run, whose repeated orders breach the SLA."""
    rows = gate.metrics(judged(spark, sf_dir), sales_checks(spark, sf_dir), RUN, "orders", LOADED_AT)
    return kpi.sla_breaches(rows)


def quarantine_by_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kpi.quarantine_by_rule(gate.quarantine(rejected(spark, sf_dir), RUN))


def reasons_for_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reasons of the newest order month, each month standing for a run."""
    newest = table(spark, sf_dir, "orders").agg(
        F.date_format(F.max("o_orderdate"), "yyyy-MM").alias("run_id")
    )
    quarantined = gate.quarantine(rejected(spark, sf_dir), F.col("_batch"))
    return kpi.reasons_for_run(quarantined, newest.first()["run_id"])


def layer_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kpi.layer_counts(judged(spark, sf_dir))


def distinct_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_sales(spark, sf_dir).select("customer_id").distinct()


def audit_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.layer_duplicates(judged(spark, sf_dir), "order_id")


def audit_clean_fraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.clean_fraction(judged(spark, sf_dir))


def audit_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.report(judged(spark, sf_dir), "order_id")


def version_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What an ungated version of silver would hold beyond the gated one."""

    rows = judged(spark, sf_dir)
    versions = (rows, rows.where(F.col(gate.PASSED)))
    suspect, good = (gate.publishable(v) for v in versions)
    return kpi.version_diff(suspect, good).withColumn("dq_warnings", _text("dq_warnings"))


def freshness_by_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = kpi.freshness(table(spark, sf_dir, "events"), "event_type", "ts")
    return rows.withColumn("last_arrival", F.date_format("last_arrival", SECONDS))


def volume_by_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kpi.volume(table(spark, sf_dir, "documents"), "source")


def period_over_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kpi.period_compare(
        table(spark, sf_dir, "orders"),
        F.trunc("o_orderdate", "month"),
        "o_orderpriority",
        exact_sum("o_totalprice"),
    )


def period_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers order in some months only: the month before may have no rows."""
    return kpi.period_compare(
        table(spark, sf_dir, "orders"), F.trunc("o_orderdate", "month"), "o_custkey", exact_sum("o_totalprice")
    )


def volume_anomaly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bounds close enough that the test tables have days on either side of them."""
    return kpi.volume_anomaly(table(spark, sf_dir, "events"), "event_type", "ts", low=0.9, high=1.1)


def volume_outages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders a customer's nation makes a day; small nations have days without any."""
    orders, customer = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    rows = orders.join(customer, orders["o_custkey"] == customer["c_custkey"])
    return kpi.volume_anomaly(rows, "c_nationkey", "o_orderdate")


def late_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers without an order in the 30 days before the newest one of all."""
    orders = table(spark, sf_dir, "orders")
    now = F.lit(orders.agg(F.max("o_orderdate")).first()[0])
    rows = kpi.lateness(orders, "o_custkey", "o_orderdate", now, "30 days")
    return rows.withColumns({c: F.date_format(c, SECONDS) for c in ("last_arrival", "due")})


def idempotent_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders that no stored line refers to: the part of a load that is new."""
    arriving = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    stored = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return raw.unseen(arriving, stored, ["o_orderkey"])


def profile_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    return history.profile(lines, lines.columns, distinct=False)


def profile_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed orders, in which text that does not parse is NULL, with exact distinct counts."""
    return history.profile(typed_orders(spark, sf_dir), TYPED, exact=True)


SKETCHED = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_discount", "l_returnflag", "l_linestatus")
REFERENCES = {"orders": "o_orderkey", "part": "p_partkey", "supplier": "s_suppkey", "customer": "c_custkey"}


def suggested_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules for order lines from the stored sketches of three loads, and for orders from one."""
    lines = table(spark, sf_dir, "lineitem")
    loads = [sketches.sketch(lines.where(F.col("l_linenumber") % 3 == i), SKETCHED) for i in range(3)]
    united = stored(sketches.unite(stored(loads[0].union(loads[1]).union(loads[2]), "sketches")), "united")
    references = {}
    for name, key in REFERENCES.items():
        known = table(spark, sf_dir, name)
        references[name] = sketches.Reference(known, key, stored(sketches.sketch(known, [key]), "sketches"))
    orders = references["orders"]
    of_lines = sketches.suggest(lines, united, references).select(F.lit("lineitem").alias("table_name"), "*")
    return of_lines.union(sketches.suggest(orders.table, orders.united).select(F.lit("orders"), "*"))


def scd2_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periods in which a customer's newest order had one priority."""
    rows = history.scd2(
        table(spark, sf_dir, "orders"),
        "o_custkey",
        ["o_orderdate", "o_orderkey"],
        ["o_orderpriority"],
        F.trunc("o_orderdate", "month"),
    )
    return rows.withColumns(
        {
            "valid_from": F.date_format("valid_from", SECONDS),
            "valid_to": F.date_format("valid_to", SECONDS),
        }
    )


def scd2_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same periods from three batches: orders up to 1998, later ones, and some of all years too late."""
    orders, late = table(spark, sf_dir, "orders"), F.col("o_orderkey") % 25 == 0
    old = F.year("o_orderdate") <= 1998
    batches = [orders.where(~late & old), orders.where(~late & ~old), orders.where(late)]
    lake, kept = _lake(spark), Table("silver", "customer_priority")
    log = batches[0]
    for i, batch in enumerate(batches):
        log = log.union(batch) if i else log
        dimension.merge(
            lake, kept, batch, log, "o_custkey", ["o_orderdate", "o_orderkey"], ["o_orderpriority"], F.trunc("o_orderdate", "year"), 8
        )
    shown = lake.read(kept).select("o_custkey", "o_orderpriority", "valid_from", "valid_to", "is_current")
    return shown.withColumns({c: F.date_format(c, SECONDS) for c in ("valid_from", "valid_to")})


# --- sources, sinks, versions -----------------------------------------------


def src_csv_all_string(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = files.as_csv(raw_sales(spark, sf_dir).select(*gate.RAW_ORDER_COLUMNS), "orders-csv")
    rows = raw.read_csv_raw(spark, path)
    # Text of doubles is written differently by the two engines; its value is not.
    return rows.withColumns({c: F.col(c).try_cast("double") for c in ("unit_price", "order_amount")})


def src_json_multiline(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = files.as_json_arrays(raw_products(spark, sf_dir), "product_id", "products-json")
    return raw.read_json_raw(spark, path).drop("chunk")


PARTY_CONTRACT = StructType(
    [
        StructField("party_id", LongType(), nullable=False),
        StructField("name", StringType()),
        StructField("nation", IntegerType()),
        StructField("balance", DoubleType()),
    ]
)


def contract_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers in three loads: one lacks the balance, one has a segment more, one has retyped nations,
    lines with a column too many and lines without an id. Accepted and refused rows in one list."""
    customer = table(spark, sf_dir, "customer")
    key, load = F.col("c_custkey"), F.col("c_custkey") % 3
    base = [key.alias("party_id"), F.col("c_name").alias("name")]
    narrow = customer.where(load == 0).select(*base, F.col("c_nationkey").alias("nation"))
    wide = customer.where(load == 1).select(
        *base, F.col("c_nationkey").alias("nation"), F.col("c_mktsegment").alias("segment"), F.col("c_acctbal").alias("balance")
    )
    # Written without quotes, so that a comma in a name is a column too many.
    broken = customer.where(load == 2).select(
        F.when(key % 11 == 0, F.lit("")).otherwise(key.cast("string")).alias("party_id"),
        F.when(key % 5 == 0, F.concat("c_name", F.lit(",x"))).otherwise(F.col("c_name")).alias("name"),
        F.when(key % 7 == 0, F.concat(F.lit("n/a "), F.col("c_nationkey").cast("string"))).otherwise(F.col("c_nationkey").cast("string")).alias("nation"),
    )
    loads = [files.as_csv(narrow, "narrow"), files.as_csv(wide, "wide"), scratch_path(spark, "broken")]
    broken.write.option("header", True).option("quote", "\u0000").option("emptyValue", "").csv(loads[2])
    read = contract.read_csv(spark, loads, PARTY_CONTRACT)
    accepted = read.accepted.select(
        F.lit("accepted").alias("part"), "party_id", "name", "nation", "balance", F.element_at(contract.RESCUED, "segment").alias("segment"), F.lit(None).cast("string").alias("reason")
    )
    nothing = [F.lit(None).cast(t) for t in ("bigint", "string", "int", "double", "string")]
    return accepted.union(read.refused.select(F.lit("refused"), *nothing, contract.REASON))


def lineage_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "customer").select(
        "c_custkey", "c_name", F.col("_metadata.file_name").alias("_file")
    )
    return raw.with_lineage(rows, F.col("_file"), LOADED_AT).select(
        "c_custkey",
        "c_name",
        F.date_format("_ingested_at", SECONDS).alias("_ingested_at"),
        "_source_file",
    )


def _parties(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Two loads of different width."""
    narrow = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("party_id"),
        F.col("c_name").alias("name"),
        F.col("c_nationkey").alias("nation"),
    )
    wide = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("party_id"),
        F.col("s_name").alias("name"),
        F.col("s_nationkey").alias("nation"),
        F.col("s_acctbal").alias("balance"),
    )
    return narrow, wide


def _lake(spark: SparkSession) -> Lake:
    return Lake(spark, scratch_path(spark, "lake"))


def sink_append_merge_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake, parties = _lake(spark), Table("bronze", "parties", tables.LOG)
    for load in _parties(spark, sf_dir):
        lake.append(load, parties)
    return lake.read(parties)


def sink_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two loads of different width appended to a table of the catalog and read by its name."""
    # Schemas of its own, gone afterwards: the user's catalog stays as it was.
    lake = CatalogLake(spark, schema_prefix=f"scratch_{uuid.uuid4().hex}_")
    parties = Table("bronze", "registered_parties", tables.LOG)
    lake.ensure()
    try:
        for load in _parties(spark, sf_dir):
            lake.append(load, parties)
        return stored(lake.read(parties), "parties")
    finally:
        lake.remove()


def _overwritten(spark: SparkSession, sf_dir: str) -> tuple[Lake, Table]:
    lake, parties = _lake(spark), Table("silver", "parties")
    for load in _parties(spark, sf_dir):
        lake.overwrite(load, parties)
    return lake, parties


def sink_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake, parties = _overwritten(spark, sf_dir)
    return lake.read(parties)


def table_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake, parties = _overwritten(spark, sf_dir)
    return lake.read(parties, version=1)


def table_restore(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake, parties = _overwritten(spark, sf_dir)
    lake.restore(parties, 1)
    return lake.read(parties)


def _line_arrival() -> tuple[Column, ...]:
    """Which copy of an order line is first, in columns that a CSV file carries as text."""
    numbers = {"l_partkey": "bigint", "l_suppkey": "bigint"} | dict.fromkeys(
        ("l_quantity", "l_extendedprice", "l_discount", "l_tax"), "double"
    )
    return (
        F.col("arrived"),
        *[F.col(name).try_cast(type_) for name, type_ in numbers.items()],
        F.col("l_returnflag"),
        F.col("l_linestatus"),
    )


def _medallion(spark: SparkSession, sf_dir: str) -> Lake:
    """Raw files to gold; the run is then repeated from silver on, which must change nothing."""
    lines = raw_sales(spark, sf_dir).select(
        *gate.RAW_ORDER_COLUMNS,
        F.date_format("_ingested_at", SECONDS).alias("arrived"),
        "_line.*",
    )
    arrival = _line_arrival()
    lake = _lake(spark)
    medallion.run(
        lake,
        files.as_csv(lines, "orders-csv"),
        files.as_csv(raw_customers(spark, sf_dir), "customers-csv"),
        files.as_json_arrays(raw_products(spark, sf_dir), "product_id", "products-json"),
        RUN,
        arrival,
        at=LOADED_AT,
        products_schema=raw_products(spark, sf_dir).schema,
    )
    medallion.build_silver(lake, RUN, arrival, measured_at=LOADED_AT)
    return lake


def medallion_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The metrics that the run stored."""
    return _medallion(spark, sf_dir).read(tables.DQ_METRICS).drop("measured_at")


def medallion_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored quarantine reasons, revenue and dimension values in one list."""
    lake = _medallion(spark, sf_dir)
    reasons = lake.read(tables.QUARANTINE_ORDERS).groupBy("reason").agg(F.count(F.lit(1)).alias("n"))
    parts = [
        reasons.select(F.lit("quarantine").alias("part"), F.col("reason").alias("name"), F.col("n").cast("double").alias("value")),
        lake.read(tables.REVENUE_BY_COUNTRY).select(F.lit("country"), "country", "revenue"),
        lake.read(tables.REVENUE_BY_CATEGORY).select(F.lit("category"), "category", "revenue"),
        lake.read(tables.DIM_CUSTOMER).select(F.lit("customer"), F.concat_ws("|", "customer_id", "name", "company", "country"), F.lit(1.0)),
        lake.read(tables.DIM_PRODUCT).select(F.lit("product"), F.concat_ws("|", "product_id", "product_name", "category"), "unit_price"),
        lake.read(tables.DIM_DATE).select(F.lit("date"), F.date_format("date", "yyyy-MM-dd"), F.col("date_key").cast("double")),
    ]
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.union(part)
    return rows


def _sign_error(rows: DataFrame) -> DataFrame:
    """Negative quantities are a sign error of the source."""
    return rows.withColumns(
        {
            "quantity": F.abs(F.col("quantity").try_cast("int")).cast("string"),
            "order_amount": F.abs(F.col("order_amount").try_cast("double")).cast("string"),
        }
    )


# Which copy of a quarantined order is first: everything that quarantine holds of it is text.
RECOVERY_ARRIVAL = ("order_date", "customer_id", "product_id", "quantity", "unit_price", "order_amount")


def recovered_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver, fact, dates, revenue and what is left in quarantine after a recovery that was run twice."""
    lake = _medallion(spark, sf_dir)
    recovery.publish_fact(lake)
    for _ in range(2):
        recovery.recover(lake, "fix-signs", _sign_error, RECOVERY_ARRIVAL)
    fact, left = lake.read(tables.FACT_SALES), recovery.open_quarantine(lake)
    one = F.count(F.lit(1)).cast("double")
    parts = [
        lake.read(tables.SILVER_ORDERS).select(F.lit("silver").alias("part"), F.concat_ws("|", "order_id", "customer_id", "product_id", "quantity").alias("name"), F.col("order_amount").alias("value")),
        fact.groupBy("date_key").agg(one.alias("n")).select(F.lit("fact"), F.col("date_key").cast("string"), "n"),
        lake.read(tables.DIM_DATE).select(F.lit("date"), F.date_format("date", "yyyy-MM-dd"), F.lit(1.0)),
        lake.read(tables.REVENUE_BY_COUNTRY).select(F.lit("country"), "country", "revenue"),
        lake.read(tables.REVENUE_BY_CATEGORY).select(F.lit("category"), "category", "revenue"),
        left.groupBy("reason").agg(one.alias("n")).select(F.lit("quarantine"), "reason", "n"),
    ]
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.union(part)
    return rows


def medallion_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The row count of every table after raw files went to gold."""
    lake = _medallion(spark, sf_dir)
    shown = {
        "bronze_orders": tables.BRONZE_ORDERS,
        "silver_orders": tables.SILVER_ORDERS,
        "quarantine_orders": tables.QUARANTINE_ORDERS,
        "dq_metrics": tables.DQ_METRICS,
        "dim_customer": tables.DIM_CUSTOMER,
        "dim_product": tables.DIM_PRODUCT,
        "dim_date": tables.DIM_DATE,
        "fact_sales": tables.FACT_SALES,
        "revenue_by_country": tables.REVENUE_BY_COUNTRY,
        "revenue_by_category": tables.REVENUE_BY_CATEGORY,
    }
    return kpi.table_counts(**{name: lake.read(at) for name, at in shown.items()})


def stopped_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second run that asks for every row to pass is stopped: which checks stopped it, and what the tables hold.

    Its metrics and quarantine are kept, silver stays the first run's.
    """
    lake = _medallion(spark, sf_dir)
    before = lake.versions(tables.SILVER_ORDERS)
    breached: dict[str, float] = {}
    try:
        medallion.build_silver(lake, "run-2", _line_arrival(), sla=1.0, measured_at=LOADED_AT)
    except gate.SlaBreach as stop:
        breached = stop.rates
    published = len(lake.versions(tables.SILVER_ORDERS)) - len(before)
    found = [("breach", name, rate) for name, rate in breached.items()]
    rows = spark.createDataFrame([*found, ("published", "silver_orders", float(published))], "part string, name string, value double")
    runs = {"dq_metrics": tables.DQ_METRICS, "quarantine_orders": tables.QUARANTINE_ORDERS}
    for name, at in runs.items():
        held = lake.read(at).groupBy("run_id").agg(F.count(F.lit(1)).cast("double").alias("n"))
        rows = rows.union(held.select(F.lit(name), "run_id", "n"))
    return rows.union(lake.read(tables.SILVER_ORDERS).agg(F.count(F.lit(1)).cast("double").alias("n")).select(F.lit("silver_orders"), F.lit(RUN), "n"))


def audit_published(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The audit of what a run has published, from the stored tables alone."""
    lake = _medallion(spark, sf_dir)
    return audit.published(lake.read(tables.SILVER_ORDERS), lake.read(tables.QUARANTINE_ORDERS), "order_id")


# How far the stream's watermark trails its newest line.
STREAM_DELAY = "90 days"


def streaming_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines arrive as a stream of files, those of two years a micro-batch, some a batch too late.

    An order's lines repeat across batches, so keys of earlier batches decide in later ones. Lines behind
    the watermark are not judged.
    """
    lines = table(spark, sf_dir, "lineitem")
    landing, output = scratch_path(spark, "landing"), scratch_path(spark, "stream")
    year = F.year("l_shipdate")
    first, last = lines.agg(F.min(year), F.max(year)).first()
    batch = F.floor((year - first) / 2) + F.when(F.col("l_partkey") % 20 == 0, 1).otherwise(0)
    files_each = 4
    for i in range((last - first) // 2 + 2):
        lines.where(batch == i).repartition(files_each).write.mode("append").parquet(landing)
    arriving = spark.readStream.schema(lines.schema).option("maxFilesPerTrigger", files_each).parquet(landing)
    gated.start(
        arriving,
        # Watermarks need instants; the session's zone is UTC.
        lambda rows: raw_sales(spark, sf_dir, rows).withColumn("_ingested_at", F.col("_ingested_at").cast("timestamp")),
        sales_checks(spark, sf_dir),
        output,
        scratch_path(spark, "stream-checkpoint"),
        event_time="_ingested_at",
        delay=STREAM_DELAY,
    ).awaitTermination()
    shown = ["order_id", "customer_id", "product_id"]
    judged_rows = gated.read(spark, output).select(*shown, _text(gate.FAILED).alias("failed_rules"), F.col(gate.PASSED).alias("passed"))
    late = gated.read_late(spark, output).select(*shown, F.lit("late"), F.lit(False))
    return judged_rows.union(late)


# Under these limits nothing is broadcast by size and keys of 20 rows are hot: the plans for large,
# skewed inputs, run on the same tables.
SKEWED = Limits(broadcast_bytes=-1, small_bytes=-1, hot_rows=20, sample=1.0)


def skewed_prepared_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Stored: the gate looks for hot and missing keys in all rows, and lines and orders need not be joined for that again.
    read = ("order_id", "customer_id", "product_id", "quantity", "unit_price", "order_amount", "order_date", *ARRIVAL)
    sales = stored(raw_sales(spark, sf_dir).select(*read), "sales")
    rows = gate.prepare(sales, sales_checks(spark, sf_dir), SKEWED)
    return rows.select(*TYPED, "is_repeat", "product_exists", "customer_exists")


def skewed_dedup_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ranks within a customer, whose NULL-like key "-1" is hot."""
    # Stored: hot keys are looked for in all rows, and hot and cold ones are read apart.
    rows = stored(raw_sales(spark, sf_dir).select("customer_id", "order_id", "product_id", *ARRIVAL), "sales")
    order = ["_ingested_at", "order_id", "_line"]
    ranked = repeats.rank_copies(rows, ["customer_id"], order, "copy_rank", SKEWED)
    return ranked.select("customer_id", "order_id", "product_id", "copy_rank")


def skewed_fk_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    sales = raw_sales(spark, sf_dir).select("order_id", "customer_id")
    return checks.key_exists(sales, ["customer_id"], raw_customers(spark, sf_dir), "customer_exists", SKEWED)


def skewed_fk_sparse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines against the tenth of the parts that are smallest: neither these nor the missing keys are broadcast."""
    sales = raw_sales(spark, sf_dir).select("order_id", "product_id")
    small = table(spark, sf_dir, "part").where("p_size <= 5").selectExpr("CAST(p_partkey AS STRING) AS product_id")
    return checks.key_exists(sales, ["product_id"], small, "is_small", SKEWED)


def skewed_revenue_by_country(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Stored: hot keys are looked for in the fact, and the gate need not run for that as well.
    fact = stored(fact_sales(spark, sf_dir).select("order_id", "customer_id", "order_amount"), "fact")
    return star.revenue_by_country(fact, customers(spark, sf_dir), SKEWED)


def skewed_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    arriving = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    known = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return raw.unseen(arriving, known, ["o_orderkey"], SKEWED)


def queries() -> dict[str, Query]:
    named = [
        gate_metrics, unpivot_metrics, gate_evaluate, failed_rule_array, gate_clean,
        gate_quarantine, silver_orders, write_guard, guard_stops_writes, quarantine_rows, strip_scratch, typed_orders,
        prepared_orders, dedup_rank, fk_product_exists, fk_customer_exists, orphans_anti_join,
        inject_defects, reprocess_quarantine, dim_product, dim_customer, date_dim, fact_sales,
        revenue_by_country, revenue_by_category, soft_rule_spikes, quarantine_by_rule,
        reasons_for_run, layer_counts, distinct_keys, audit_duplicates, audit_clean_fraction,
        audit_report, version_diff, freshness_by_source, volume_by_source, period_over_period,
        volume_anomaly, period_gaps, volume_outages, late_sources, sla_breaches, idempotent_append,
        profile_columns, profile_values, suggested_rules, scd2_customer, scd2_incremental, src_csv_all_string,
        src_json_multiline, contract_feed, lineage_columns, sink_append_merge_schema, sink_by_name, sink_overwrite, table_as_of,
        table_restore, medallion_run, medallion_metrics, medallion_values, recovered_tables, stopped_run, audit_published, streaming_gate,
        skewed_prepared_orders, skewed_dedup_rank, skewed_fk_customer, skewed_fk_sparse, skewed_revenue_by_country, skewed_append,
    ]
    return (
        {query.__name__: query for query in named}
        | {name: _rule(check) for name, check in RULE_QUERIES.items()}
        | {
            "conform_country": customers,
            "metrics_latest_run": _report(kpi.metrics_latest_run),
            "kpi_table": _report(kpi.kpi_table),
            "top_failing_rules": _report(kpi.top_failing),
            "pass_rate_trend": _report(kpi.pass_rate_trend),
            "latest_per_rule": _report(kpi.latest_per_rule),
            "worst_hard_rate_trend": _report(kpi.worst_hard_rate_trend),
        }
    )
