"""Controlled defects for test data, as a distributed transform."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The unparseable date, and the spellings that conformed data must recover from.
BAD_DATE = "2025-13-40"
SPELLING_NOISE = {
    "PL": ["Poland", "pl", "POL"],
    "NL": ["Netherlands", "nl"],
    "DE": ["Germany", "de"],
}


def defects(
    sales: DataFrame, bucket: Column, unknown: str = "-1", repeat: Column | None = None
) -> DataFrame:
    """Typed sales become raw text, about a fifth of them broken.

    ``bucket`` is 0-99 per row. Bands: 0-3 no customer, 4-7 no amount, 8-10 negated
    quantity, 11-13 impossible date, 14-16 unknown product, 17-18 unknown customer,
    19-21 amount times 1.5. Rows where ``repeat`` is true are emitted twice.
    """
    missing = unknown.replace("'", "\\'")
    columns = {
        "customer_id": f"""CASE WHEN _bucket BETWEEN 0 AND 3 THEN ''
            WHEN _bucket BETWEEN 17 AND 18 THEN '{missing}' ELSE customer_id END""",
        "product_id": f"""CASE WHEN _bucket BETWEEN 14 AND 16 THEN '{missing}'
            ELSE product_id END""",
        "quantity": """CAST(CASE WHEN _bucket BETWEEN 8 AND 10 THEN -quantity
            ELSE quantity END AS STRING)""",
        "unit_price": "CAST(unit_price AS STRING)",
        "order_amount": """CASE WHEN _bucket BETWEEN 4 AND 7 THEN '' ELSE CAST(
            CASE WHEN _bucket BETWEEN 8 AND 10 THEN -order_amount
                 WHEN _bucket BETWEEN 19 AND 21 THEN order_amount * 1.5D
                 ELSE order_amount END AS STRING) END""",
        "order_date": f"""CASE WHEN _bucket BETWEEN 11 AND 13 THEN '{BAD_DATE}'
            ELSE CAST(order_date AS STRING) END""",
    }
    dirty = sales.withColumn("_bucket", bucket).withColumns(
        {name: F.expr(text) for name, text in columns.items()}
    )
    if repeat is not None:
        copies = F.when(repeat, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
        dirty = dirty.withColumn("_copy", F.explode(copies)).drop("_copy")
    return dirty.drop("_bucket")


def country_noise(customers: DataFrame, noisy: Column, pick: Column) -> DataFrame:
    """Replace the country code of ``noisy`` rows by one of its spellings, chosen by ``pick``."""
    cases = " ".join(
        f"WHEN country = '{code}' THEN element_at(array{tuple(spellings)}, "
        f"CAST(pmod(_pick, {len(spellings)}) AS INT) + 1)"
        for code, spellings in SPELLING_NOISE.items()
    )
    spelled = F.expr(f"CASE WHEN NOT _noisy THEN country {cases} ELSE country END")
    return (
        customers.withColumns({"_noisy": noisy, "_pick": pick})
        .withColumn("country", spelled)
        .drop("_noisy", "_pick")
    )
