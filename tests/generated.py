"""Seeded tables that try the gate's edges, an oracle in plain Python, and a shrinker for what fails.

Many small tables ("cases") travel in one frame under a case number that is part of every key, so a
property over hundreds of tables is one Spark job, and so is one step of shrinking.
"""

from __future__ import annotations

import math
import random
from collections.abc import Callable, Iterable
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltgate.operators import checks as c

# What a text reads as: (text, int, double). NULL reads as NULL everywhere.
NUMBERS = [
    ("3", 3, 3.0), (" 3 ", 3, 3.0), ("0", 0, 0.0), ("-2", -2, -2.0), ("+4", 4, 4.0), ("1.5", None, 1.5),
    ("99999999999", None, 99999999999.0), ("NaN", None, math.nan), ("x", None, None), ("", None, None), (None, None, None),
]
AS_INT = {text: number for text, number, _ in NUMBERS}
AS_DOUBLE = {text: number for text, _, number in NUMBERS}
# Texts that read as a date, and some that do not.
DATES = ["2024-02-29", "2025-01-15", "2025-02-29", "2025-13-01", "yesterday", "", None]
VALID_DATES = {"2024-02-29", "2025-01-15"}
KEYS = ["a", "b", "c", "", " ", None]
COLUMNS = ("key", "ref", "owner", "quantity", "price", "amount", "day", "at")
SCHEMA = "case_id int, key string, ref string, owner string, quantity string, price string, amount string, day string, at int"
PLAIN = ("a", "a", "own", "3", "0", "0", "2025-01-15", 1)


@dataclass(frozen=True)
class Case:
    """Rows of COLUMNS, the keys of the reference table, and columns that no check knows."""

    rows: tuple[tuple, ...]
    reference: tuple[str | None, ...]
    extra: tuple[str, ...] = ()


def case(seed: int) -> Case:
    """Empty tables, one hot key, ties in arrival, repeated rows and columns full of NULL all occur."""
    draw = random.Random(seed)
    many = draw.choice([0, 1, 2, 5, 12])
    hot = draw.choice(KEYS) if draw.random() < 0.4 else "-"
    empty = draw.choice(COLUMNS[:-1]) if draw.random() < 0.2 else "-"
    wide = draw.choice([1, 3, 50])
    rows: list[tuple] = []
    for _ in range(many):
        if rows and draw.random() < 0.2:
            rows.append(draw.choice(rows))
            continue
        made = {
            "key": hot if hot != "-" and draw.random() < 0.7 else draw.choice(KEYS),
            "ref": draw.choice(KEYS),
            "owner": draw.choice(["own", " ", "", None, "own", "own"]),
            "quantity": draw.choice(NUMBERS)[0] if draw.random() < 0.5 else "3",
            "price": draw.choice(NUMBERS)[0],
            "amount": draw.choice(NUMBERS)[0],
            "day": draw.choice(DATES) if draw.random() < 0.5 else DATES[0],
            "at": draw.randrange(wide),
        }
        if empty != "-":
            made[empty] = None
        rows.append(tuple(made[name] for name in COLUMNS))
    reference = tuple(k for k in KEYS if draw.random() < 0.6 for _ in range(draw.choice([1, 2])))
    extra = tuple(draw.sample(["dq", "a.b", "n` n", "Größe"], draw.randrange(3)))
    return Case(tuple(rows), reference, extra)


def frame(spark: SparkSession, cases: Iterable[Case]) -> tuple[DataFrame, DataFrame]:
    """(rows, reference keys) of all cases, each under its place in the list."""
    cases = list(cases)
    extra = sorted({name for one in cases for name in one.extra})
    schema = SCHEMA + "".join(f", `{name.replace('`', '``')}` string" for name in extra)
    rows = [(i, *row, *extra) for i, one in enumerate(cases) for row in one.rows]
    keys = [(i, key) for i, one in enumerate(cases) for key in one.reference]
    return spark.createDataFrame(rows, schema), spark.createDataFrame(keys, "case_id int, ref string")


def rules(reference: DataFrame) -> list[c.Check]:
    quantity = c.Typed("quantity_int", "quantity", "int")
    numbers = [quantity, c.Typed("price_dbl", "price", "double"), c.Typed("amount_dbl", "amount", "double")]
    return [
        c.not_blank("owner_given", "owner"),
        c.satisfies("positive", "quantity_int > 0", needs=[quantity]),
        c.parses("dated", "day", "date", "day_date"),
        c.unique("first", ["case_id", "key"], list(COLUMNS[::-1])),
        c.foreign_key("known", ["case_id", "ref"], reference, "ref_known"),
        c.close_to("amount_fits", lambda: F.col("amount_dbl"), lambda: F.col("quantity_int") * F.col("price_dbl"), 0.01, needs=numbers),
    ]


HARD = ("owner_given", "positive", "dated", "first", "known")
SOFT = ("amount_fits",)


def _least_first(row: tuple) -> tuple:
    """Sort key of ``COLUMNS[::-1]`` with NULL before every value."""
    return tuple((value is not None, value if value is not None else 0) for value in row[::-1])


def verdicts(one: Case) -> list[tuple[tuple, dict[str, bool]]]:
    """(row, verdict of every check), by plain loops."""
    by_key: dict = {}
    for i, row in enumerate(one.rows):
        by_key.setdefault(row[0], []).append(i)
    firsts = {min(places, key=lambda i: (_least_first(one.rows[i]), i)) for places in by_key.values()}
    judged = []
    for i, row in enumerate(one.rows):
        _, ref, owner, quantity, price, amount, day, _ = row
        n, p, a = AS_INT[quantity], AS_DOUBLE[price], AS_DOUBLE[amount]
        fits = None not in (n, p, a) and not math.isnan(a) and not math.isnan(p) and abs(a - n * p) <= 0.01
        judged.append(
            (
                row,
                {
                    "owner_given": owner is not None and owner.strip(" ") != "",
                    "positive": n is not None and n > 0,
                    "dated": day in VALID_DATES,
                    "first": i in firsts,
                    "known": ref is not None and ref in one.reference,
                    "amount_fits": fits,
                },
            )
        )
    return judged


def smaller(one: Case) -> list[Case]:
    """Cases a step simpler: halves, a row less, an extra column less, a cell made plain."""
    rows, half = one.rows, len(one.rows) // 2
    made = [replace(one, rows=rows[:half]), replace(one, rows=rows[half:])] if half else []
    made += [replace(one, rows=rows[:i] + rows[i + 1 :]) for i in range(len(rows))]
    made += [replace(one, extra=()) for _ in one.extra[:1]]
    for i, row in enumerate(rows):
        for at, plain in enumerate(PLAIN):
            if row[at] != plain:
                made.append(replace(one, rows=(*rows[:i], (*row[:at], plain, *row[at + 1 :]), *rows[i + 1 :])))
    made += [replace(one, reference=one.reference[:i] + one.reference[i + 1 :]) for i in range(len(one.reference))]
    return made


def _weight(one: Case) -> tuple:
    cells = sum(value != plain for row in one.rows for value, plain in zip(row, PLAIN, strict=True))
    return len(one.rows), cells, len(one.extra), len(one.reference)


def shrink(one: Case, broken: Callable[[list[Case]], set[int]]) -> Case:
    """The simplest case reached from ``one`` by steps that still fail; one call of ``broken`` a step."""
    while True:
        steps = smaller(one)
        failing = [steps[i] for i in broken(steps)] if steps else []
        best = min(failing, key=_weight, default=one)
        if _weight(best) >= _weight(one):
            return one
        one = best


def holds(broken: Callable[[list[Case]], set[int]], count: int = 200, seed: int = 0) -> None:
    """Fail with the shrunken form of a case that breaks the property."""
    cases = [case(seed * 100_003 + i) for i in range(count)]
    failing = sorted(broken(cases))
    if failing:
        raise AssertionError(f"{len(failing)} of {count} cases, one shrinks to {shrink(cases[failing[0]], broken)}")
