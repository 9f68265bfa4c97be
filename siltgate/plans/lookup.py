"""Joining a large table to a one-row-per-key table, whatever the key distribution."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltgate.functions.expressions import quoted
from siltgate.plans.sizing import DEFAULT_LIMITS, Limits, bounded, broadcasts, hot_keys, spread_slot, stored

# Shuffle slots per map partition for the rows of hot keys.
SLOTS = 16


def lookup(
    df: DataFrame,
    side: DataFrame,
    on: Sequence[str],
    how: str = "left",
    limits: Limits = DEFAULT_LIMITS,
    probe: DataFrame | None = None,
) -> DataFrame:
    """Join ``df`` to ``side`` (unique on ``on``), "left" or "inner".

    A side within the broadcast limit is broadcast: no shuffle of ``df``.
    Beyond it the join shuffles on the key, and keys that hold too many rows of
    ``df`` take another way: their few matches are broadcast, and their rows are
    spread over the shuffle by map partition and content instead of by key.

    ``probe`` is a cheaper frame with the same key columns to look for hot keys in.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"unsupported join: {how}")
    on = list(on)
    values = [c for c in side.columns if c not in on]
    columns = [*df.columns, *values]
    if broadcasts(side, limits):
        # Its size has just been checked; the hint holds if the limit differs from the session's.
        return df.join(F.broadcast(side), on, how).select(*quoted(columns))
    hot = hot_keys(df if probe is None else probe, on, limits)
    if hot is None:
        return df.join(side, on, how).select(*quoted(columns))

    # At most one row per hot key; stored, so that its size is known before it may be broadcast.
    matches = side.join(bounded(hot), on, "left_semi").withColumn("_hot_found", F.lit(True))
    hot_side = stored(
        hot.join(matches, on, "left")
        .select(
            *[F.col(c).alias(f"_hot_{c}") for c in on],
            *[F.col(q).alias(f"_hot_{c}") for c, q in zip(values, quoted(values), strict=True)],
            F.coalesce("_hot_found", F.lit(False)).alias("_hot_found"),
            F.lit(True).alias("_is_hot"),
        ),
        "hot-side",
    )
    condition = F.lit(True)
    for c in on:
        condition = condition & df[c].eqNullSafe(F.col(f"_hot_{c}"))
    marked = df.join(bounded(hot_side), condition, "left").withColumn(
        "_slot",
        F.when(F.col("_is_hot"), F.xxhash64(spread_slot(df, SLOTS))).otherwise(F.xxhash64(*on)),
    )
    cold_side = side.select(
        *on,
        F.xxhash64(*on).alias("_slot"),
        *[F.col(q).alias(f"_cold_{c}") for c, q in zip(values, quoted(values), strict=True)],
        F.lit(True).alias("_cold_found"),
    )
    joined = marked.join(cold_side, [*on, "_slot"], "left")
    found = F.when(F.col("_is_hot"), F.col("_hot_found")).otherwise(F.col("_cold_found"))
    if how == "inner":
        joined = joined.where(found)
    return joined.select(
        *quoted(df.columns),
        *[
            F.when(F.col("_is_hot"), F.col(hot_value)).otherwise(F.col(cold_value)).alias(c)
            for c, hot_value, cold_value in zip(
                values, quoted(f"_hot_{c}" for c in values), quoted(f"_cold_{c}" for c in values), strict=True
            )
        ],
    )
