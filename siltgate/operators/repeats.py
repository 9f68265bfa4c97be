"""Repeated keys: which copy is first, and the exact rank of every copy."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from siltgate.functions.expressions import quoted
from siltgate.plans.sizing import DEFAULT_LIMITS, Limits, bounded, hot_keys, same_key, spread_slot, stored

# Slots per map partition in which rows of a hot key are ranked first.
SLOTS = 8
# Winners of a key that meet in one place in a round.
FAN_IN = 1024


def _position(by: Sequence[str], order: Sequence[str | Column]) -> Column:
    return F.row_number().over(Window.partitionBy(*by).orderBy(*order)).cast("bigint")


def flag_repeats(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str | Column],
    flag: str,
    limits: Limits = DEFAULT_LIMITS,
    probe: DataFrame | None = None,
) -> DataFrame:
    """Add ``flag``: false for the first row of each key, true for every later one.

    ``order`` should be total up to rows that are equal in every respect. NULL keys
    form one group. One shuffle on the key; a hot key is first ranked within slots
    of each map partition, and the winners of the slots meet in rounds (``settle``).
    """
    keys = list(keys)
    hot = hot_keys(df if probe is None else probe, keys, limits)
    if hot is None:
        return df.withColumn(flag, _position(keys, order) > 1)
    match = same_key(df, hot, keys)
    cold = df.join(bounded(hot), match, "left_anti").withColumn(flag, _position(keys, order) > 1)
    # Stored with their slots: a slot's winner is settled, and only winners are read again.
    slots = stored(
        df.join(bounded(hot), match, "left_semi")
        .withColumn("_slot", spread_slot(df, SLOTS))
        .withColumn("_local", _position([*keys, "_slot"], order)),
        "slots",
    )
    losers = slots.where(F.col("_local") > 1).withColumn(flag, F.lit(True))
    last = slots.agg(F.max("_slot")).first()[0]
    winners = settle(slots.where(F.col("_local") == 1), keys, order, flag, last or 0)
    return cold.unionByName(losers.unionByName(winners).select(*quoted(df.columns), flag))


def rounds(last: int, fan_in: int = FAN_IN) -> list[int]:
    """How many slots share a seat in each round, until slots 0 to ``last`` share one."""
    wide = [fan_in]
    while wide[-1] <= last:
        wide.append(wide[-1] * fan_in)
    return wide


def settle(
    winners: DataFrame, keys: Sequence[str], order: Sequence[str | Column], flag: str, last: int, fan_in: int = FAN_IN
) -> DataFrame:
    """``flag`` for one row per key and ``_slot`` (0 to ``last``): false for the key's first row alone.

    A tree of rounds: in each, the rows still in the running meet at most ``fan_in`` to a
    seat and all but the first drop out, so no task ranks more than ``fan_in`` rows of a
    key at once. Rows that dropped out keep a seat each, below zero.
    """
    rows = winners.withColumn(flag, F.lit(False))
    for wide in rounds(last, fan_in):
        seat = F.when(F.col(flag), -1 - F.col("_slot")).otherwise(F.floor(F.col("_slot") / wide))
        rows = rows.withColumn("_seat", seat.cast("bigint")).withColumn(
            flag, F.col(flag) | (_position([*keys, "_seat"], order) > 1)
        )
    return rows.drop("_seat")


def rank_copies(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str | Column],
    rank: str,
    limits: Limits = DEFAULT_LIMITS,
    probe: DataFrame | None = None,
) -> DataFrame:
    """Add ``rank``: 1, 2, 3 … within each key, in ``order``.

    Rows of hot keys that are equal in every column are counted first, then range-partitioned
    by key and order and stored, so that the partition of a row is settled; they are ranked inside
    each partition, shifted by the rows of the same key in earlier partitions, and written out as
    often as they were counted. Rows must be of types that can be grouped.
    """
    keys = list(keys)
    hot = hot_keys(df if probe is None else probe, keys, limits)
    if hot is None:
        return df.withColumn(rank, _position(keys, order))
    match = same_key(df, hot, keys)
    cold = df.join(bounded(hot), match, "left_anti").withColumn(rank, _position(keys, order))
    rows = df.join(bounded(hot), match, "left_semi")
    sorting = [F.col(c) if isinstance(c, str) else c for c in order]
    # Which partition a row goes to depends on its values alone, so a task that runs again sends it there again.
    ranged = stored(
        rows.groupBy(*quoted(df.columns))
        .agg(F.count(F.lit(1)).alias("_copies"))
        .repartitionByRange(*keys, *sorting)
        .withColumn("_part", F.spark_partition_id()),
        "ranged",
    )
    earlier = Window.partitionBy(*keys).orderBy("_part").rowsBetween(
        Window.unboundedPreceding, -1
    )
    # One row per key and partition it reaches.
    shifts = (
        ranged.groupBy(*keys, "_part")
        .agg(F.sum("_copies").alias("_rows"))
        .withColumn("_shift", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)))
        .select(*[F.col(k).alias(f"_of_{k}") for k in keys], F.col("_part").alias("_of_part"), "_shift")
    )
    # Ties of the order are settled by the other columns.
    inside = Window.partitionBy(*keys, "_part").orderBy(*sorting, *quoted(df.columns)).rowsBetween(
        Window.unboundedPreceding, -1
    )
    local = ranged.withColumn("_before", F.coalesce(F.sum("_copies").over(inside), F.lit(0)))
    condition = local["_part"] == shifts["_of_part"]
    condition = condition & same_key(local, shifts, keys, "_of_")
    at = F.col("_before") + F.col("_shift")
    hot_ranked = local.join(shifts, condition, "left").select(
        *quoted(df.columns), F.explode(F.sequence(at + 1, at + F.col("_copies"))).alias(rank)
    )
    return cold.unionByName(hot_ranked)


def newest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """One row per key, the first in ``order``. Catalyst limits each group before the shuffle."""
    return (
        df.withColumn("_at", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
        .where(F.col("_at") == 1)
        .drop("_at")
    )
