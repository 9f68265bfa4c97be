"""Star schema and revenue tables, built from clean rows only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltgate.functions.expressions import day_key, exact_sum
from siltgate.operators.repeats import newest_per_key
from siltgate.plans.lookup import lookup
from siltgate.plans.sizing import DEFAULT_LIMITS, Limits


def dimension(
    rows: DataFrame, key: str, columns: Sequence[str], newest: Sequence[str | Column] = ()
) -> DataFrame:
    """The named columns, one row per key: the newest when an order is given."""
    if newest:
        rows = newest_per_key(rows, [key], newest)
    return rows.select(*columns)


def dim_customer(customers: DataFrame, newest: Sequence[str | Column] = ()) -> DataFrame:
    return dimension(customers, "customer_id", ["customer_id", "name", "company", "country"], newest)


def dim_product(products: DataFrame, newest: Sequence[str | Column] = ()) -> DataFrame:
    return dimension(
        products, "product_id", ["product_id", "product_name", "category", "unit_price"], newest
    )


def date_dim(orders: DataFrame) -> DataFrame:
    """One row per day that has an order."""
    return (
        orders.where(F.col("order_date").isNotNull())
        .select("order_date")
        .distinct()
        .select(
            day_key("order_date").alias("date_key"),
            F.col("order_date").alias("date"),
            F.year("order_date").alias("year"),
            F.month("order_date").alias("month"),
            F.dayofmonth("order_date").alias("day"),
        )
    )


def fact_sales(orders: DataFrame) -> DataFrame:
    return orders.select(
        "order_id",
        "customer_id",
        "product_id",
        day_key("order_date").alias("date_key"),
        "quantity",
        "unit_price",
        "order_amount",
    )


def by_month(fact: DataFrame) -> DataFrame:
    """The fact with the month its rows are partitioned by, each month's rows together and large months split."""
    return fact.withColumn("month_key", F.floor(F.col("date_key") / 100).cast("int")).hint("rebalance", "month_key")


def revenue_by_country(
    fact: DataFrame,
    customers: DataFrame,
    limits: Limits = DEFAULT_LIMITS,
    probe: DataFrame | None = None,
) -> DataFrame:
    """Revenue and distinct orders per country, highest first."""
    sold = fact.select("order_id", "customer_id", "order_amount")
    homes = customers.select("customer_id", "country")
    return (
        lookup(sold, homes, ["customer_id"], "inner", limits, probe)
        .groupBy("country")
        .agg(exact_sum("order_amount").alias("revenue"), F.count_distinct("order_id").alias("orders"))
        .orderBy(F.desc("revenue"), "country")
    )


def revenue_by_category(
    fact: DataFrame,
    products: DataFrame,
    limits: Limits = DEFAULT_LIMITS,
    probe: DataFrame | None = None,
) -> DataFrame:
    """Revenue and units per category, highest first."""
    sold = fact.select("product_id", "order_amount", "quantity")
    kinds = products.select("product_id", "category")
    return (
        lookup(sold, kinds, ["product_id"], "inner", limits, probe)
        .groupBy("category")
        .agg(exact_sum("order_amount").alias("revenue"), F.sum("quantity").alias("units"))
        .orderBy(F.desc("revenue"), "category")
    )
