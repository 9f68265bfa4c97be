"""Small frames with explicit schemas."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from siltgate.operators.checks import order_checks

LOADED = datetime(2025, 1, 1)
ORDER_SCHEMA = (
    "order_id string, customer_id string, product_id string, quantity string, unit_price string,"
    " order_amount string, order_date string, _ingested_at timestamp, _source_file string"
)
GOOD = {
    "order_id": "O1", "customer_id": "C00001", "product_id": "P001", "quantity": "2",
    "unit_price": "1.2", "order_amount": "2.4", "order_date": "2025-01-15",
    "_ingested_at": LOADED, "_source_file": "t.csv",
}


def orders(spark: SparkSession, *changes: dict) -> DataFrame:
    return spark.createDataFrame([tuple((GOOD | c).values()) for c in changes], ORDER_SCHEMA)


def products(spark: SparkSession, *ids: str) -> DataFrame:
    return spark.createDataFrame(
        [(i, "Lager", "Beer", 1.2) for i in ids or ("P001",)],
        "product_id string, product_name string, category string, unit_price double",
    )


def customers(spark: SparkSession, *rows: tuple) -> DataFrame:
    return spark.createDataFrame(
        rows or [("C00001", "A", "X", "PL")],
        "customer_id string, name string, company string, country string",
    )


def default_checks(spark: SparkSession, **arrival):
    return order_checks(products(spark), customers(spark), **arrival)
