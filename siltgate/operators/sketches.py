"""Profiles that add up: sketches kept for each load, united for the table, and the checks they suggest.

A load is sketched once: counts, range, a distinct-count sketch and a quantile sketch per column. United
sketches of all loads stand for the table without reading it. They name candidates; what is suggested in
the end was confirmed on the columns concerned, and on no others.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType, NumericType, StringType

from siltgate.operators.checks import VALIDITY, Check, foreign_key, satisfies, unique

# 2**14 registers: distinct counts within about one percent.
REGISTERS = 14
# How far a sketch may be off before a true candidate would be missed: five times its error.
SLACK = 0.05
# Columns with more distinct values have no list of allowed ones.
MOST_VALUES = 20


def _hashable(df: DataFrame, name: str) -> Column:
    """Integers of any width are equal across tables; everything else is compared as text."""
    return F.col(name).cast("bigint" if isinstance(df.schema[name].dataType, IntegralType) else "string")


def sketch(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column_name, rows, filled, low, high, distinct, quantiles): one row a column from one pass.

    ``low`` and ``high`` are the exact range of numbers, NULL for other types, as are the quantiles.
    """
    sums = [F.count(F.lit(1)).alias("rows")]
    for i, name in enumerate(columns):
        number = F.col(name).cast("double") if isinstance(df.schema[name].dataType, NumericType) else F.lit(None).cast("double")
        sums += [
            F.count(name).alias(f"filled_{i}"), F.min(number).alias(f"low_{i}"), F.max(number).alias(f"high_{i}"),
            F.hll_sketch_agg(_hashable(df, name), REGISTERS).alias(f"distinct_{i}"), F.kll_sketch_agg_double(number).alias(f"quantiles_{i}"),
        ]
    fields = ("filled", "low", "high", "distinct", "quantiles")
    rows = [F.struct(F.lit(name).alias("column_name"), "rows", *[F.col(f"{f}_{i}").alias(f) for f in fields]) for i, name in enumerate(columns)]
    return df.agg(*sums).select(F.inline(F.array(*rows)))


def unite(sketches: DataFrame) -> DataFrame:
    """The sketches of several loads as those of all their rows."""
    return sketches.groupBy("column_name").agg(
        F.sum("rows").alias("rows"),
        F.sum("filled").alias("filled"),
        F.min("low").alias("low"),
        F.max("high").alias("high"),
        F.hll_union_agg("distinct").alias("distinct"),
        F.kll_merge_agg_double("quantiles").alias("quantiles"),
    )


def summary(united: DataFrame, at: Sequence[float] = (0.01, 0.5, 0.99)) -> DataFrame:
    """What the sketches say: rows, nulls, range, about how many distinct values, and quantiles of numbers."""
    quantiles = [F.kll_sketch_get_quantile_double("quantiles", F.lit(q)).alias(f"q{q:g}") for q in at]
    numbers = united.where("low IS NOT NULL").select("column_name", *quantiles)
    nulls = (F.col("rows") - F.col("filled")).alias("nulls")
    told = united.select("column_name", "rows", nulls, "low", "high", F.hll_sketch_estimate("distinct").alias("distinct"))
    return told.join(numbers, "column_name", "left")


@dataclass(frozen=True)
class Reference:
    """A key column of another table and its united sketch."""

    table: DataFrame
    column: str
    united: DataFrame


def inclusions(united: DataFrame, references: Mapping[str, Reference]) -> list[tuple[str, str]]:
    """(column, reference) where adding the column's values to the reference's adds about none. Reads sketches only."""
    found = []
    for name, reference in references.items():
        row = reference.united.where(F.col("column_name") == reference.column).select("distinct").first()
        if row is None:
            continue
        # One sketch, of 2**REGISTERS bytes at most.
        theirs = F.lit(row["distinct"])
        most = F.hll_sketch_estimate(theirs) * (1 + SLACK) + 1
        inside = F.hll_sketch_estimate(F.hll_union("distinct", theirs)) <= most
        ours = united.where(F.col("filled") > 0)
        found += [(r["column_name"], name) for r in ours.where(inside).select("column_name").collect()]
    return sorted(found)


def suggest(df: DataFrame, united: DataFrame, references: Mapping[str, Reference] | None = None) -> DataFrame:
    """(column_name, rule, detail): not_null, not_negative or positive, one_of, key, references.

    Counts and ranges are exact as they are. Lists of values, keys and references are proposed by the
    sketches and confirmed by reading the one column; at most a row a column reaches the driver.
    """
    told, references = summary(united, ()).collect(), references or {}
    integral = {f.name for f in df.schema if isinstance(f.dataType, IntegralType)}
    textual = {f.name for f in df.schema if isinstance(f.dataType, StringType)}
    out: list[tuple[str, str, str | None]] = []
    for r in told:
        name, filled = r["column_name"], r["rows"] - r["nulls"]
        if not filled:
            continue
        if not r["nulls"]:
            out.append((name, "not_null", None))
        if r["low"] is not None and r["low"] >= 0:
            out.append((name, "positive" if r["low"] > 0 else "not_negative", None))
        if name in integral | textual and r["distinct"] <= MOST_VALUES * (1 + SLACK):
            values = df.where(F.col(name).isNotNull()).select(F.col(name).cast("string")).distinct().limit(MOST_VALUES + 1).collect()
            if len(values) <= MOST_VALUES:
                out.append((name, "one_of", "|".join(sorted(v[0] for v in values))))
        if not r["nulls"] and r["distinct"] >= filled * (1 - SLACK):
            if df.groupBy(name).agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty():
                out.append((name, "key", None))
    for name, reference in inclusions(united.where(F.col("column_name").isin(sorted(integral | textual))), references):
        other = references[reference]
        known = other.table.select(F.col(other.column).alias("_known")).distinct()
        same_kind = df.schema[name].dataType.typeName() == "string"
        if same_kind == (other.table.schema[other.column].dataType.typeName() == "string"):
            asked = df.where(F.col(name).isNotNull()).select(name).distinct()
            if asked.join(known, F.col(name) == F.col("_known"), "left_anti").isEmpty():
                out.append((name, "references", reference))
    return df.sparkSession.createDataFrame(out, "column_name string, rule string, detail string")


def checks_of(suggestions: DataFrame, references: Mapping[str, Reference] | None = None, order: Sequence[str] = ()) -> list[Check]:
    """Suggestions as checks of the gate; one row a suggestion is fetched. ``order`` says which copy of a key is first."""
    made = []
    for name, rule, detail in sorted((tuple(r) for r in suggestions.collect()), key=str):
        column, label = f"`{name}`", f"{rule}_{name}"
        if rule == "one_of":
            allowed = detail.split("|")
            made.append(satisfies(label, lambda n=name, a=allowed: F.col(n).cast("string").isin(a), VALIDITY))
        elif rule == "key":
            made.append(unique(label, [name], list(order) or [name], f"is_repeat_{name}"))
        elif rule == "references":
            known = references[detail].table.select(F.col(references[detail].column).alias(name))
            made.append(foreign_key(f"{label}_{detail}", [name], known, f"{name}_in_{detail}"))
        else:
            conditions = {"not_null": f"{column} IS NOT NULL", "positive": f"{column} > 0", "not_negative": f"{column} >= 0"}
            made.append(satisfies(label, conditions[rule], VALIDITY))
    return made

