"""The gate: prepare what the checks need, judge every row, split, and measure."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from siltgate.operators.checks import HARD, Check, Exists, Repeated, Typed, key_exists
from siltgate.operators.repeats import flag_repeats
from siltgate.plans.sizing import DEFAULT_LIMITS, Limits, broadcasts

VERDICTS = "dq_verdicts"
FAILED = "dq_failed"
WARNED = "dq_warned"
PASSED = "dq_passed"


class SlaBreach(Exception):
    """Hard checks fell below their agreed pass rate; ``rates`` has them by name."""

    def __init__(self, rates: dict[str, float]) -> None:
        super().__init__(", ".join(f"{name}={rate:.3f}" for name, rate in rates.items()))
        self.rates = rates


def typed(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """Add the safe casts that the checks declare."""
    casts = {n.column: F.col(n.source).try_cast(n.type) for c in checks for n in c.needs if isinstance(n, Typed)}
    return df.withColumns(casts) if casts else df


def prepare(
    df: DataFrame,
    checks: Sequence[Check],
    limits: Limits = DEFAULT_LIMITS,
    probe: DataFrame | None = None,
    raw_kept: bool = False,
) -> DataFrame:
    """Add the columns the checks declare: safe casts, key-exists flags, repeat flags.

    A column two checks share is computed once. What needs no shuffle comes first, so
    that the shuffle for repeats carries results and not raw text that nothing else
    reads. Joins to references too large to broadcast leave nearly all rows where they are
    and read them twice, so they come before that shuffle as well. Hot keys are looked
    for in ``df`` itself, before any join or window, or in ``probe`` where ``df`` has joins already.
    With ``raw_kept`` the raw text is read afterwards as well, so the casts follow the shuffle
    and only the text travels.
    """
    raw = df if probe is None else probe
    needs = {need.column: need for check in checks for need in check.needs}.values()
    if not raw_kept:
        df = typed(df, checks)
    exists = [n for n in needs if isinstance(n, Exists)]
    small = [n for n in exists if broadcasts(n.reference.select(*n.keys), limits)]
    large = [n for n in exists if n not in small]
    repeated = [n for n in needs if isinstance(n, Repeated)]
    for need in (*small, *large, *repeated):
        if isinstance(need, Repeated):
            df = flag_repeats(df, need.keys, need.order, need.column, limits, probe=raw)
        else:
            df = key_exists(df, need.keys, need.reference, need.column, limits, probe=raw)
    return typed(df, checks) if raw_kept else df


def _verdict(check: Check) -> str:
    """The path of a check's verdict, quoted."""
    return f"{VERDICTS}.`{check.name.replace('`', '``')}`"


def _all_hold(checks: Sequence[Check]) -> Column:
    # Verdicts are never NULL, so the least of them is their conjunction.
    names = [_verdict(c) for c in checks]
    return F.least(*names, F.lit(True)) if names else F.lit(True)


def _names_of_failures(checks: Sequence[Check]) -> Column:
    """Names of failed checks, in check order; the array work is skipped for good rows."""
    none = F.array().cast("array<string>")
    if not checks:
        return none
    names = F.lit([c.name for c in checks])
    held = F.array(*[_verdict(c) for c in checks])
    failed = F.array_compact(F.zip_with(names, held, lambda name, ok: F.when(~ok, name)))
    return F.when(_all_hold(checks), none).otherwise(failed)


def evaluate(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """Judge prepared rows: one boolean per check, failed and warned names, and the verdict."""
    names = [c.name for c in checks]
    if len(set(names)) != len(names):
        raise ValueError("check names must be unique")
    hard = [c for c in checks if c.hard]
    soft = [c for c in checks if not c.hard]
    if checks:
        df = df.withColumn(
            VERDICTS, F.struct(*[F.coalesce(c.holds(), F.lit(False)).alias(c.name) for c in checks])
        )
    return df.withColumns(
        {
            FAILED: _names_of_failures(hard),
            WARNED: _names_of_failures(soft),
            PASSED: _all_hold(hard),
        }
    )


def judge(
    df: DataFrame, checks: Sequence[Check], limits: Limits = DEFAULT_LIMITS, raw_kept: bool = False
) -> DataFrame:
    return evaluate(prepare(df, checks, limits, raw_kept=raw_kept), checks)


def split(evaluated: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Clean rows, and rejected rows with their reasons as one text."""
    clean = evaluated.where(F.col(PASSED))
    rejected = evaluated.where(~F.col(PASSED)).withColumn("dq_reason", F.concat_ws("; ", FAILED))
    return clean, rejected


def strip(df: DataFrame) -> DataFrame:
    """Drop everything ``evaluate`` added."""
    return df.drop(VERDICTS, FAILED, WARNED, PASSED)


def publishable(clean: DataFrame, *more: str) -> DataFrame:
    """The typed orders table, and ``more`` columns before it; soft warnings ride along."""
    return clean.select(
        *more,
        "order_id",
        "customer_id",
        "product_id",
        F.col("quantity_int").alias("quantity"),
        F.col("unit_price_dbl").alias("unit_price"),
        F.col("order_amount_dbl").alias("order_amount"),
        F.col("order_date_parsed").alias("order_date"),
        F.col(WARNED).alias("dq_warnings"),
    )


RAW_ORDER_COLUMNS = (
    "order_id", "customer_id", "product_id", "quantity", "unit_price", "order_amount", "order_date",
)


def quarantine(rejected: DataFrame, run_id: str | Column) -> DataFrame:
    """Rejected orders exactly as they arrived, with reasons and the run that rejected them."""
    return rejected.select(
        *RAW_ORDER_COLUMNS,
        "_source_file",
        "_ingested_at",
        F.col(FAILED).alias("failed_rules"),
        F.col("dq_reason").alias("reason"),
        (F.lit(run_id) if isinstance(run_id, str) else run_id).alias("run_id"),
    )


def _tallies(checks: Sequence[Check]) -> list[Column]:
    return [
        F.count(F.lit(1)).alias("rows_evaluated"),
        *[F.count_if(_verdict(c)).alias(f"_held_{i}") for i, c in enumerate(checks)],
    ]


def tally(evaluated: DataFrame, checks: Sequence[Check], by: Sequence[str | Column] = ()) -> DataFrame:
    """One wide row (per group): rows seen and rows that hold each check. One pass over the data."""
    return evaluated.groupBy(*by).agg(*_tallies(checks))


@dataclass
class Observed:
    """The tallies of evaluated rows, filled in by the job that writes ``rows``; no scan of their own."""

    rows: DataFrame
    seen: Observation

    def wide(self) -> DataFrame:
        """The row of ``tally``. Waits for the job."""
        counts = self.seen.get
        names = [name for name in counts if name != "_clean"]
        schema = ", ".join(f"{name} bigint" for name in names)
        return self.rows.sparkSession.createDataFrame([tuple(counts[n] for n in names)], schema)

    def split_counts(self) -> tuple[int, int]:
        """Clean and rejected rows."""
        counts = self.seen.get
        return counts["_clean"], counts["rows_evaluated"] - counts["_clean"]


def observe(evaluated: DataFrame, checks: Sequence[Check]) -> Observed:
    """Evaluated rows whose next action also counts them and every check. The first action decides."""
    seen = Observation()
    return Observed(evaluated.observe(seen, *_tallies(checks), F.count_if(F.col(PASSED)).alias("_clean")), seen)


def spread(wide: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """Turn wide tallies into one row per check, each check's attributes travelling with it."""
    kept = [c for c in wide.columns if not c.startswith("_held_")]
    held = [f"_held_{i}" for i in range(len(checks))]
    columns = {
        "rule_name": [c.name for c in checks],
        "dimension": [c.dimension for c in checks],
        "severity": [c.severity for c in checks],
    }
    lists = [F.lit(v).cast("array<string>").alias(k) for k, v in columns.items()]
    passed = F.array(*held).cast("array<bigint>").alias("rows_passed")
    return wide.select(*kept, *lists, passed).select(
        *kept, F.inline(F.arrays_zip(*columns, "rows_passed"))
    )


def metrics(
    evaluated: DataFrame,
    checks: Sequence[Check],
    run_id: str | Column,
    dataset: str,
    measured_at: datetime | Column | None = None,
    by: Sequence[str] = (),
) -> DataFrame:
    """One row per check (and group) with counts and pass rate; an empty input passes at 1.0.

    With ``by``, ``run_id`` and ``measured_at`` may be columns of the group.
    """
    return rates(tally(evaluated, checks, by), checks, run_id, dataset, measured_at)


def rates(
    wide: DataFrame, checks: Sequence[Check], run_id: str | Column, dataset: str, measured_at: datetime | Column | None = None
) -> DataFrame:
    """The metric rows of wide tallies, counted by ``tally`` or observed while the rows were written."""
    if measured_at is None:
        measured_at = F.current_timestamp()
    elif isinstance(measured_at, datetime):
        measured_at = F.lit(measured_at)
    total, held = F.col("rows_evaluated"), F.col("rows_passed")
    return spread(wide, checks).select(
        (F.lit(run_id) if isinstance(run_id, str) else run_id).alias("run_id"),
        F.lit(dataset).alias("dataset"),
        "rule_name",
        "dimension",
        "severity",
        "rows_evaluated",
        "rows_passed",
        (total - held).alias("rows_failed"),
        F.when(total > 0, F.round(held / total, 6)).otherwise(F.lit(1.0)).alias("pass_rate"),
        measured_at.alias("measured_at"),
    )


def enforce_sla(metric_rows: DataFrame, run_id: str, sla: float = 0.80) -> None:
    """Raise when a hard check of this run is below ``sla``. At most one row per check is fetched."""
    low = (
        metric_rows.where(
            (F.col("run_id") == run_id) & (F.col("severity") == HARD) & (F.col("pass_rate") < sla)
        )
        .select("rule_name", "pass_rate")
        .orderBy("rule_name")
        .collect()
    )
    if low:
        raise SlaBreach({r.rule_name: r.pass_rate for r in low})
