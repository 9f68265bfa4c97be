"""A stored dimension of validity periods that batches of states are merged into."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltgate.operators.history import merge_periods, periods
from siltgate.plans.sizing import DEFAULT_LIMITS, Limits, stored
from siltgate.sources.lake import CatalogLake, Lake, Table

# Partitions that keys are spread over; a batch rewrites those it has keys of.
BUCKETS = 64


def _bucket(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def merge(
    lake: Lake | CatalogLake,
    table: Table,
    states: DataFrame,
    log: DataFrame,
    key: str,
    order: Sequence[str],
    tracked: Sequence[str],
    slice_: Column,
    buckets: int = BUCKETS,
    limits: Limits = DEFAULT_LIMITS,
) -> None:
    """Merge a batch into the stored periods, or begin them. A batch that is merged twice changes nothing.

    ``log`` holds all states, the batch among them; only keys whose late states fall into a period are
    read from it. Buckets without a key of the batch keep their files.
    """
    if not lake.exists(table):
        made = periods(states, key, order, tracked, slice_, limits).withColumn("bucket", _bucket(key, buckets))
        lake.overwrite(made, table, ["bucket"])
        return
    # At most ``buckets`` numbers.
    touched = [r.bucket for r in states.select(_bucket(key, buckets).alias("bucket")).distinct().collect()]
    current = lake.read(table).where(F.col("bucket").isin(touched)).drop("bucket")
    merged = merge_periods(current, states, log, key, order, tracked, slice_, limits)
    # Stored first: the partitions it was made from are about to be replaced.
    lake.replace_partitions(stored(merged.withColumn("bucket", _bucket(key, buckets)), "scd2-merged"), table, ["bucket"])
