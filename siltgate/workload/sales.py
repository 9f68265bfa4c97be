"""Bronze-shaped sales, customers and products derived from the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltgate.operators import inject
from siltgate.operators.checks import Check, order_checks

# The country codes customers are spread over.
COUNTRIES = ["PL", "NL", "DE", "GB", "FR", "ES", "IT"]
RUN = "run-1"
# Whole cents below the price of one piece; floor is the same in every engine.
UNIT_PRICE = "(floor(l_extendedprice * 100 / l_quantity) / 100)"
# Which copy of an order is first: arrival, then every other column of the line.
ARRIVAL = ("_ingested_at", "_line")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def typed_sales(spark: SparkSession, sf_dir: str, lines: DataFrame | None = None) -> DataFrame:
    """Order lines before any defect; ``lines`` may be a batch of lineitem."""
    if lines is None:
        lines = table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return lines.join(orders, lines["l_orderkey"] == orders["o_orderkey"]).selectExpr(
        "concat_ws('-', l_orderkey, l_linenumber) AS order_id",
        "CAST(o_custkey AS STRING) AS customer_id",
        "CAST(l_partkey AS STRING) AS product_id",
        "CAST(l_quantity AS INT) AS quantity",
        f"{UNIT_PRICE} AS unit_price",
        f"l_quantity * {UNIT_PRICE} AS order_amount",
        "CAST(l_shipdate AS DATE) AS order_date",
        "l_shipdate AS _ingested_at",
        "'lineitem' AS _source_file",
        """struct(l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax,
                  l_returnflag, l_linestatus) AS _line""",
        "date_format(o_orderdate, 'yyyy-MM') AS _batch",
        "pmod(l_orderkey * 7 + l_linenumber * 13 + l_partkey, 100) AS _at",
    )


def raw_sales(spark: SparkSession, sf_dir: str, lines: DataFrame | None = None) -> DataFrame:
    """Order lines as text with defects in known bands."""
    return inject.defects(typed_sales(spark, sf_dir, lines), F.col("_at")).drop("_at")


def raw_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "customer").selectExpr(
        "CAST(c_custkey AS STRING) AS customer_id",
        "c_name AS name",
        "c_mktsegment AS company",
        f"element_at(array{tuple(COUNTRIES)}, c_nationkey % {len(COUNTRIES)} + 1) AS country",
        "c_custkey AS _key",
    )
    return inject.country_noise(rows, F.expr("_key % 12 = 0"), F.expr("_key DIV 12")).drop("_key")


def raw_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").selectExpr(
        "CAST(p_partkey AS STRING) AS product_id",
        "p_name AS product_name",
        "p_type AS category",
        "p_retailprice AS unit_price",
    )


def sales_checks(spark: SparkSession, sf_dir: str) -> list[Check]:
    products = table(spark, sf_dir, "part").selectExpr("CAST(p_partkey AS STRING) AS product_id")
    customers = table(spark, sf_dir, "customer").selectExpr(
        "CAST(c_custkey AS STRING) AS customer_id"
    )
    return order_checks(products, customers, ARRIVAL)
