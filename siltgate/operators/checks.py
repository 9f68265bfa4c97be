"""Declarative checks: what must hold, how serious it is, and what it needs computed first."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltgate.functions.expressions import is_present, quoted, within
from siltgate.plans import bloom
from siltgate.plans.lookup import lookup
from siltgate.plans.sizing import DEFAULT_LIMITS, Limits, broadcasts, stored

# The six dimensions and the two severities.
COMPLETENESS = "completeness"
VALIDITY = "validity"
UNIQUENESS = "uniqueness"
CONSISTENCY = "consistency"
INTEGRITY = "integrity"
ACCURACY = "accuracy"
DIMENSIONS = (COMPLETENESS, VALIDITY, UNIQUENESS, CONSISTENCY, INTEGRITY, ACCURACY)
HARD = "error"
SOFT = "warn"

# Arrival first; rows of one load tie on it, so their content decides.
ARRIVAL = (
    "_ingested_at", "_source_file", "order_date", "customer_id", "product_id", "quantity",
    "unit_price", "order_amount",
)


@dataclass(frozen=True)
class Typed:
    """A safely cast copy of a raw column; text that does not parse becomes NULL."""

    column: str
    source: str
    type: str


@dataclass(frozen=True, eq=False)
class Repeated:
    """A flag that is true for every row of a key but the first."""

    column: str
    keys: tuple[str, ...]
    order: tuple[str | Column, ...]


@dataclass(frozen=True, eq=False)
class Exists:
    """A flag that is true when the key is present in another table."""

    column: str
    keys: tuple[str, ...]
    reference: DataFrame


Need = Typed | Repeated | Exists


@dataclass(frozen=True, eq=False)
class Check:
    """``holds`` builds the column that is true for a good row; NULL counts as a failure."""

    name: str
    dimension: str
    severity: str
    description: str
    holds: Callable[[], Column]
    needs: tuple[Need, ...] = ()

    def __post_init__(self) -> None:
        if self.dimension not in DIMENSIONS:
            raise ValueError(f"unknown dimension: {self.dimension}")
        if self.severity not in (HARD, SOFT):
            raise ValueError(f"unknown severity: {self.severity}")

    @property
    def hard(self) -> bool:
        return self.severity == HARD


def not_blank(name: str, column: str, severity: str = HARD) -> Check:
    return Check(
        name, COMPLETENESS, severity, f"{column} is filled in", lambda: is_present(column)
    )


def parses(
    name: str, column: str, type_: str, into: str, dimension: str = VALIDITY, severity: str = HARD
) -> Check:
    return Check(
        name, dimension, severity, f"{column} reads as {type_}",
        lambda: F.col(into).isNotNull(), (Typed(into, column, type_),),
    )


def satisfies(
    name: str,
    condition: str | Callable[[], Column],
    dimension: str = VALIDITY,
    severity: str = HARD,
    needs: Sequence[Need] = (),
    description: str | None = None,
) -> Check:
    """Any row-local condition, as SQL text or as a function that builds a column."""
    holds = condition if callable(condition) else lambda: F.expr(condition)
    text = description or (condition if isinstance(condition, str) else name)
    return Check(name, dimension, severity, text, holds, tuple(needs))


def unique(
    name: str,
    keys: Sequence[str],
    order: Sequence[str | Column],
    into: str = "is_repeat",
    severity: str = HARD,
) -> Check:
    return Check(
        name, UNIQUENESS, severity, f"first row of its {', '.join(keys)}",
        lambda: ~F.col(into), (Repeated(into, tuple(keys), tuple(order)),),
    )


def foreign_key(
    name: str, keys: Sequence[str], reference: DataFrame, into: str, severity: str = HARD
) -> Check:
    return Check(
        name, INTEGRITY, severity, f"{', '.join(keys)} exists in its reference table",
        lambda: F.col(into), (Exists(into, tuple(keys), reference),),
    )


def close_to(
    name: str,
    actual: Callable[[], Column],
    expected: Callable[[], Column],
    tolerance: float,
    severity: str = SOFT,
    needs: Sequence[Need] = (),
) -> Check:
    return Check(
        name, ACCURACY, severity, f"within {tolerance} of the expected value",
        lambda: within(actual(), expected(), tolerance), tuple(needs),
    )


def key_exists(
    df: DataFrame,
    keys: Sequence[str],
    reference: DataFrame,
    into: str,
    limits: Limits = DEFAULT_LIMITS,
    probe: DataFrame | None = None,
    rare: str = "missing",
) -> DataFrame:
    """Add a true/false flag; distinct reference keys mean that rows never multiply.

    A reference within the broadcast limit is broadcast. Beyond it only distinct keys
    are shuffled first: the keys that are "missing" (or "present", whichever ``rare``
    says is the exception) are stored, and if those can be broadcast, the rows of
    ``df`` are never shuffled at all. Otherwise a Bloom filter of bounded size, of the exceptions
    or of the reference keys, whichever are fewer, decides the rows that cannot match where they
    stand, and only the rest is joined by ``lookup``.

    ``probe`` must hold every key of ``df`` and is cheaper to read twice.
    """
    keys = list(keys)
    known = reference.select(*keys).distinct()
    shown = [*quoted(c for c in df.columns if c != into), into]
    given = F.lit(True)
    for key in keys:
        given = given & F.col(key).isNotNull()
    if not broadcasts(known, limits):
        source = df if probe is None else probe
        asked = source.select(*keys).dropna().distinct()
        how = {"missing": "left_anti", "present": "left_semi"}[rare]
        exceptions = stored(asked.join(known, keys, how), "rare-keys")
        if broadcasts(exceptions, limits):
            marked = exceptions.withColumn("_rare", F.lit(True))
            found = F.coalesce("_rare", F.lit(False))
            if rare == "missing":
                found = given & ~found
            joined = df.join(F.broadcast(marked), keys, "left").withColumn(into, found)
            return joined.select(*shown)
    listed = F.coalesce("_listed", F.lit(False))
    if broadcasts(known, limits):
        # The hint follows the check above: with one more column, the estimate may be just over the limit.
        marked = known.withColumn("_listed", F.lit(True))
        return df.join(F.broadcast(marked), keys, "left").withColumn(into, listed).select(*shown)
    # Present keys are among the known ones, so they are never more.
    known = stored(known, "reference-keys")
    n_known, n_exceptions = known.count(), exceptions.count()
    by_exceptions = rare == "present" or n_exceptions < n_known
    some, n = (exceptions, n_exceptions) if by_exceptions else (known, n_known)
    found, otherwise = (given & ~listed, given) if by_exceptions and rare == "missing" else (listed, F.lit(False))
    words = bloom.words_for(n)
    sifted = bloom.flag(df, keys, bloom.build(some, keys, words), words, "_possible")
    possible = sifted.where("_possible").drop("_possible")
    flagged = lookup(possible, some.withColumn("_listed", F.lit(True)), keys, "left", limits, probe)
    flagged = flagged.withColumn(into, found).select(*shown)
    return flagged.union(sifted.where("NOT _possible").withColumn(into, otherwise).select(*shown))


def orphans(
    df: DataFrame, keys: Sequence[str], reference: DataFrame, limits: Limits = DEFAULT_LIMITS
) -> DataFrame:
    """Rows whose key is missing from the reference table, NULL keys included."""
    return key_exists(df, keys, reference, "_exists", limits).where(~F.col("_exists")).drop("_exists")


def order_checks(
    products: DataFrame, customers: DataFrame, arrival: Sequence[str | Column] = ARRIVAL
) -> list[Check]:
    """The eight checks of the orders table. ``arrival`` decides which copy of an order is first."""
    quantity = Typed("quantity_int", "quantity", "int")
    price = Typed("unit_price_dbl", "unit_price", "double")
    amount = Typed("order_amount_dbl", "order_amount", "double")
    # The check names, which reports and stored metrics are keyed by.
    return [
        not_blank("completeness_customer_id", "customer_id"),
        parses(
            "completeness_order_amount", "order_amount", "double", "order_amount_dbl", COMPLETENESS
        ),
        satisfies("validity_quantity_positive", "quantity_int > 0", needs=[quantity]),
        parses("validity_order_date", "order_date", "date", "order_date_parsed"),
        unique("uniqueness_order_id", ["order_id"], arrival),
        foreign_key("integrity_product_id", ["product_id"], products, "product_exists"),
        foreign_key("integrity_customer_id", ["customer_id"], customers, "customer_exists"),
        close_to(
            "accuracy_amount_matches",
            lambda: F.col("order_amount_dbl"),
            lambda: F.col("quantity_int") * F.col("unit_price_dbl"),
            0.01,
            needs=[quantity, price, amount],
        ),
    ]
