"""Change history, profiles and write-time guards."""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, NumericType, StructField, TimestampNTZType, TimestampType
from pyspark.sql.window import Window

from siltgate.functions.expressions import quoted
from siltgate.operators.checks import Check
from siltgate.plans.sizing import DEFAULT_LIMITS, Limits, bounded, hot_keys, same_key, stored


def profile(
    df: DataFrame, columns: Sequence[str], distinct: bool = True, exact: bool = False
) -> DataFrame:
    """One row per column: rows, nulls, null rate, range, how many distinct values, and the checks
    these numbers suggest. The range of a date or time is in seconds since 1970. One pass; distinct
    counts are sketches unless ``exact``, which shuffles every column's values.
    """
    numeric = {f.name for f in df.schema if isinstance(f.dataType, NumericType)}
    times = {f.name for f in df.schema if isinstance(f.dataType, DateType | TimestampType | TimestampNTZType)}
    count = F.count_distinct if exact else F.approx_count_distinct
    counted = "distinct_values" if exact else "approx_distinct"
    sums: list[Column] = [F.count(F.lit(1)).alias("rows")]
    for i, name in enumerate(columns):
        sums.append(F.count(F.col(name)).alias(f"_filled_{i}"))
        if name in numeric:
            sums.append(F.min(name).cast("double").alias(f"_min_{i}"))
            sums.append(F.max(name).cast("double").alias(f"_max_{i}"))
        if name in times:
            sums.append(F.min(name).cast("timestamp").cast("double").alias(f"_min_{i}"))
            sums.append(F.max(name).cast("timestamp").cast("double").alias(f"_max_{i}"))
        if distinct:
            sums.append(count(F.col(name)).alias(f"_distinct_{i}"))
    nothing = F.lit(None).cast("double")
    rows = F.array(
        *[
            F.struct(
                F.lit(name).alias("column_name"),
                F.col(f"_filled_{i}").alias("_filled"),
                (F.col(f"_min_{i}") if name in numeric | times else nothing).alias("min_value"),
                (F.col(f"_max_{i}") if name in numeric | times else nothing).alias("max_value"),
                F.lit(name in times).alias("_is_time"),
                *([F.col(f"_distinct_{i}").alias(counted)] if distinct else []),
            )
            for i, name in enumerate(columns)
        ]
    )
    nulls = F.col("rows") - F.col("_filled")
    suggested = F.concat_ws(
        ",",
        F.when((F.col("rows") > 0) & (nulls == 0), "not_null"),
        F.when(F.col("_is_time"), None)
        .when(F.col("min_value") > 0, "positive")
        .when(F.col("min_value") == 0, "not_negative"),
    )
    return (
        df.agg(*sums)
        .select("rows", F.inline(rows))
        .withColumn("nulls", nulls)
        .withColumn(
            "null_rate", F.when(F.col("rows") > 0, F.round(F.col("nulls") / F.col("rows"), 6))
        )
        .withColumn("suggested", suggested)
        .drop("_filled", "_is_time")
    )


def guard(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """The same rows, but a job that meets a row breaking a hard check fails and names the check.

    Built into every column, so that reading any of them meets the check, and not into a
    filter: Catalyst may move a filter below the gate, where rows that the gate removes
    would trip it. A reader that needs no column at all, as a bare count, is not checked;
    ``counted`` is the count that is.
    """
    hard = [(c.name, F.coalesce(c.holds(), F.lit(False))) for c in checks if c.hard]
    if not hard:
        return df
    broken = F.concat_ws("; ", *[F.when(~holds, F.lit(name)) for name, holds in hard])

    def carried(field: StructField) -> Column:
        stop = F.raise_error(F.concat(F.lit("broken: "), broken)).cast(field.dataType)
        return F.when(broken == "", F.col(*quoted([field.name]))).otherwise(stop).alias(field.name)

    return df.select(*[carried(field) for field in df.schema])


class Broken(Exception):
    """A write was stopped by its guard; ``checks`` names what the first such row broke."""

    def __init__(self, checks: list[str]) -> None:
        super().__init__("; ".join(checks))
        self.checks = checks


def write_guarded(df: DataFrame, checks: Sequence[Check], write: Callable[[DataFrame], None]) -> None:
    """Have ``write`` write the guarded rows; raise Broken if a row broke a check.

    What a table shows after that is up to its writer: a lake's version does not count.
    """
    try:
        write(guard(df, checks))
    except PySparkException as failure:
        found = re.search(r"\[USER_RAISED_EXCEPTION\] broken: (.*?)(?: SQLSTATE|$)", str(failure), re.MULTILINE)
        if found is None:
            raise
        raise Broken(found.group(1).split("; ")) from failure


def counted(guarded: DataFrame) -> DataFrame:
    """One row: how many rows there are, of which every one has met its guard."""
    # The rows' number is given only beside a value read from a guarded column, so the column stays in the plan.
    read = F.max(F.col(*quoted(guarded.columns[:1])).isNull().cast("int"))
    both = guarded.agg(F.count(F.lit(1)).alias("rows"), read.alias("_read"))
    return both.select(F.when((F.col("rows") == 0) | F.col("_read").isNotNull(), F.col("rows")).alias("rows"))


def _beside(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    slice_: str,
    values: Sequence[str],
    forward: bool,
    whole: bool = False,
) -> DataFrame:
    """Add ``_near_<value>``: the value of the next row (or the one before) of the same key.

    The window runs within key and time slice, so a hot key is spread over its
    slices; the row at the edge of a slice takes its value from the nearest
    non-empty slice, found on one summary row per key and slice. With ``whole`` the window runs
    within the key, so several of these in a row take one shuffle together.
    """
    if forward:
        sort, pick, step = order, F.min_by, F.lead
    else:
        sort, pick, step = order, F.max_by, F.lag
    packed = F.struct(*[F.col(v) for v in values])
    shown = [*df.columns, *[F.col("_near")[v].alias(f"_near_{v}") for v in values]]
    if whole:
        beside = step(packed).over(Window.partitionBy(*keys).orderBy(slice_, *sort))
        return df.withColumn("_near", beside).select(*shown)
    within = Window.partitionBy(*keys, slice_).orderBy(*sort)
    across = Window.partitionBy(*keys).orderBy(slice_)
    edge = (
        df.groupBy(*keys, slice_)
        .agg(pick(packed, F.struct(*order)).alias("_edge"))
        .withColumn("_over", step("_edge").over(across))
        .select(*[F.col(c).alias(f"_edge_{c}") for c in (*keys, slice_)], "_over")
    )
    near = df.withColumn("_near", step(packed).over(within))
    return (
        near.join(edge, same_key(near, edge, [*keys, slice_], "_edge_"), "left")
        .withColumn("_near", F.coalesce("_near", "_over"))
        .select(*shown)
    )


def _by_heat(
    rows: DataFrame, key: str, made: Callable[[DataFrame, bool], DataFrame], limits: Limits, probe: DataFrame | None = None
) -> DataFrame:
    """``made`` of the rows, key by key whole; only rows of hot keys are told to go by slices.

    ``probe`` must hold every row that a key has here and is cheaper to read twice.
    """
    hot = hot_keys(rows if probe is None else probe, [key], limits)
    if hot is None:
        return made(rows, True)
    match = same_key(rows, hot, [key])
    cold = made(rows.join(bounded(hot), match, "left_anti"), True)
    return cold.unionByName(made(rows.join(bounded(hot), match, "left_semi"), False))


def scd2(
    states: DataFrame, key: str, order: Sequence[str], tracked: Sequence[str], slice_: Column, limits: Limits = DEFAULT_LIMITS
) -> DataFrame:
    """Validity periods of a slowly changing dimension from a log of states.

    A row opens a period when a tracked value differs from the key's previous row
    (NULLs equal). ``order`` must be total within a key and starts with the time;
    ``slice_`` cuts that time into pieces small enough for one task, for keys that do not fit one.
    """
    seen = states.select(key, *order, *tracked).withColumn("_slice", slice_)
    return _by_heat(seen, key, lambda rows, whole: _scd2(rows, key, order, tracked, whole), limits)


def _scd2(seen: DataFrame, key: str, order: Sequence[str], tracked: Sequence[str], whole: bool) -> DataFrame:
    # The flag tells a first row apart from a previous row full of NULLs.
    before = _beside(
        seen.withColumn("_exists", F.lit(True)), [key], order, "_slice", ["_exists", *tracked], False, whole
    )
    changed = F.col("_near__exists").isNull()
    for name in tracked:
        changed = changed | ~F.col(name).eqNullSafe(F.col(f"_near_{name}"))
    changes = before.where(changed).select(key, *order, *tracked, "_slice")
    if not whole:
        # Read twice below; stored so that the first comparison runs once.
        changes = stored(changes, "changes")
    start = order[0]
    return _beside(changes, [key], order, "_slice", [start], True, whole).select(
        key,
        *tracked,
        F.col(start).alias("valid_from"),
        F.col(f"_near_{start}").alias("valid_to"),
        F.col(f"_near_{start}").isNull().alias("is_current"),
    )


def _seen_states(states: DataFrame, key: str, order: Sequence[str], tracked: Sequence[str], slice_: Column) -> DataFrame:
    return states.select(key, *order, *tracked).withColumn("_slice", slice_)


def _differs(tracked: Sequence[str], other: str) -> Column:
    differs = F.lit(False)
    for name in tracked:
        differs = differs | ~F.col(name).eqNullSafe(F.col(f"{other}{name}"))
    return differs


def periods(
    states: DataFrame,
    key: str,
    order: Sequence[str],
    tracked: Sequence[str],
    slice_: Column,
    limits: Limits = DEFAULT_LIMITS,
    probe: DataFrame | None = None,
) -> DataFrame:
    """The periods of ``scd2`` with what a later merge needs: ``opened`` and ``seen``, the places in
    ``order`` of a period's first and last state. States at one place must agree; repeats are one."""
    rows = _seen_states(states, key, order, tracked, slice_)
    return _by_heat(rows, key, lambda some, whole: _periods(some, key, order, tracked, whole), limits, probe)


def _periods(rows: DataFrame, key: str, order: Sequence[str], tracked: Sequence[str], whole: bool) -> DataFrame:
    # Whole keys are shuffled once, here; what goes by slices is stored before it is read twice.
    kept = (lambda df, _: df) if whole else stored
    rows = (rows.repartition(F.col(key)) if whole else rows).distinct().withColumn("_here", F.lit(True))
    beside = ["_here", *tracked]
    opens = F.col("_near__here").isNull() | _differs(tracked, "_near_")
    first = _beside(rows, [key], order, "_slice", beside, False, whole).withColumn("_opens", opens).select(*rows.columns, "_opens")
    ends = _beside(kept(first, "opens"), [key], order, "_slice", beside, True, whole).withColumn("_ends", opens)
    place = F.struct(*order)
    marks = ends.where("_opens OR _ends").select(*rows.columns, "_opens", "_ends", place.alias("_place"))
    marks = kept(marks, "period-marks")
    # The next mark of a row that opens a period and does not end it is the row that ends it.
    paired = _beside(marks, [key], order, "_slice", ["_place"], True, whole).where("_opens")
    paired = paired.withColumn("_seen", F.when(F.col("_ends"), F.col("_place")).otherwise(F.col("_near__place")))
    paired = kept(paired.select(*rows.columns, "_place", "_seen"), "period-starts")
    start = order[0]
    return _beside(paired, [key], order, "_slice", [start], True, whole).select(
        key, *tracked, F.col(start).alias("valid_from"), F.col(f"_near_{start}").alias("valid_to"),
        F.col(f"_near_{start}").isNull().alias("is_current"), F.col("_place").alias("opened"), F.col("_seen").alias("seen"),
    )


def _split_spans(
    ends: DataFrame, states: DataFrame, key: str, order: Sequence[str], tracked: Sequence[str], slice_: Column, limits: Limits, probe: DataFrame
) -> DataFrame:
    """Keys with a state strictly inside the span of a period of other values.

    Spans do not overlap, so a state is inside one if the next end of a span is a closing one. The next
    end of a hot key comes from the state's own slice or, by one row a slice, from a later one.
    """
    nothing = F.lit(None).cast(ends.schema["closes"].dataType)
    both = ends.unionByName(states.select(key, *order, *tracked, nothing.alias("closes"))).withColumn("_slice", slice_)
    return _by_heat(both, key, lambda some, whole: _inside(some, key, order, tracked, whole), limits, probe).distinct()


def _inside(both: DataFrame, key: str, order: Sequence[str], tracked: Sequence[str], whole: bool) -> DataFrame:
    end = F.when(F.col("closes").isNotNull(), F.struct("closes", *tracked))
    if whole:
        # Backwards, as a running value: frames that reach forward to the end are read anew for every row.
        back = Window.partitionBy(key).orderBy(*[F.desc(c) for c in ("_slice", *order)], F.col("closes").isNotNull().desc())
        after = F.last(end, ignorenulls=True).over(back.rowsBetween(Window.unboundedPreceding, -1))
        return _torn(both.withColumn("_next", after).where(F.col("closes").isNull()), key, tracked)
    ahead = Window.partitionBy(key, "_slice").orderBy(*order, F.col("closes").isNotNull()).rowsBetween(1, Window.unboundedFollowing)
    later = Window.partitionBy(key).orderBy("_slice").rowsBetween(1, Window.unboundedFollowing)
    edges = (
        both.groupBy(key, "_slice")
        .agg(F.min_by(end, F.when(F.col("closes").isNotNull(), F.struct(*order))).alias("_first"))
        .withColumn("_later", F.first("_first", ignorenulls=True).over(later))
        .select(F.col(key).alias(f"_edge_{key}"), F.col("_slice").alias("_edge__slice"), "_later")
    )
    near = both.withColumn("_next", F.first(end, ignorenulls=True).over(ahead)).where(F.col("closes").isNull())
    found = near.join(edges, same_key(near, edges, [key, "_slice"], "_edge_"), "left").withColumn("_next", F.coalesce("_next", "_later"))
    return _torn(found, key, tracked)


def _torn(found: DataFrame, key: str, tracked: Sequence[str]) -> DataFrame:
    inside = found.where(F.col("_next.closes")).select(key, *tracked, *[F.col("_next")[t].alias(f"_of_{t}") for t in tracked])
    return inside.where(_differs(tracked, "_of_")).select(key)


def merge_periods(
    current: DataFrame,
    states: DataFrame,
    log: DataFrame,
    key: str,
    order: Sequence[str],
    tracked: Sequence[str],
    slice_: Column,
    limits: Limits = DEFAULT_LIMITS,
) -> DataFrame:
    """``current`` periods (of ``periods``) with a batch of ``states`` merged in, late ones included.

    A period stands for all its states by its first and last one, so only those and the batch are
    compared; open periods are closed, new ones inserted, late states put between two periods. Where a
    late state falls inside a period of other values, what that period was made of matters, and only the
    keys concerned are read from ``log`` (all states, the batch among them) again. Keys must not be NULL.
    """
    states = stored(states.select(key, *order, *tracked), "scd2-batch")
    asked = states.select(key).distinct()
    mine = stored(current.join(asked, key, "left_semi"), "scd2-affected")
    first = F.struct(F.col("opened").alias("at"), F.lit(False).alias("closes"))
    last = F.struct(F.col("seen").alias("at"), F.lit(True).alias("closes"))
    # A period of a single state has one end.
    both = F.when(F.col("opened") == F.col("seen"), F.array(first)).otherwise(F.array(first, last))
    ends = mine.select(key, *tracked, F.inline(both)).select(key, *[F.col("at")[o].alias(o) for o in order], *tracked, "closes")
    # No key has many more ends and states than the log has rows of it.
    torn = stored(_split_spans(ends, states, key, order, tracked, slice_, limits, log), "scd2-torn")
    plain = ends.drop("closes").unionByName(states).join(torn, key, "left_anti")
    again = log.select(key, *order, *tracked).join(torn, key, "left_semi")
    made = periods(plain.unionByName(again), key, order, tracked, slice_, limits, log)
    return current.join(asked, key, "left_anti").unionByName(made)
