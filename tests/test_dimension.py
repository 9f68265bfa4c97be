"""Batches of states merged into stored periods."""

from __future__ import annotations

import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from siltgate.operators.history import periods
from siltgate.plans import dimension
from siltgate.plans.sizing import Limits
from siltgate.sources.lake import Lake, Table

SCHEMA, DIM = "k string, at long, n long, v string, w int", Table("silver", "states")


def how():
    return "k", ["at", "n"], ["v", "w"], F.floor(F.col("at") / 10)


def shown(df):
    return sorted((tuple(r) for r in df.drop("bucket").collect()), key=repr)


def expected(states):
    """One pass in plain Python."""
    out = []
    for key in {s[0] for s in states}:
        rows = sorted({s for s in states if s[0] == key}, key=lambda s: s[1:3])
        opened = [s for i, s in enumerate(rows) if not i or rows[i - 1][3:] != s[3:]]
        for s, after in zip(opened, [*opened[1:], None], strict=True):
            until = after[1:3] if after else (10**9, 0)
            seen = max(r[1:3] for r in rows if s[1:3] <= r[1:3] < until)
            out.append((key, *s[3:], s[1], after[1] if after else None, after is None, s[1:3], seen))
    return sorted(out, key=repr)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_batches_in_any_order_equal_one_pass(spark, tmp_path, seed):
    rng = random.Random(seed)
    states = [(rng.choice("aaaabc"), rng.randrange(60), n, rng.choice(["x", "y", None]), rng.choice([1, None])) for n in range(90)]
    rng.shuffle(states)
    lake, log = Lake(spark, str(tmp_path)), []
    for i in range(0, 90, 30):
        log += states[i : i + 30]
        dimension.merge(lake, DIM, spark.createDataFrame(states[i : i + 30], SCHEMA), spark.createDataFrame(log, SCHEMA), *how(), 4)
        made = [(*r[:6], tuple(r[6]), tuple(r[7])) for r in shown(lake.read(DIM))]
        assert sorted(made, key=repr) == expected(log)


def test_a_batch_reads_the_log_only_for_torn_periods(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    first = [("a", 1, 0, "x", 1), ("a", 5, 0, "x", 1), ("a", 9, 0, "y", 1), ("b", 1, 0, "x", 1), ("c", 3, 0, "x", 1)]
    dimension.merge(lake, DIM, spark.createDataFrame(first, SCHEMA), spark.createDataFrame(first, SCHEMA), *how(), 64)
    before = {f: f.stat().st_mtime_ns for f in Path(lake.path(DIM)).rglob("*.parquet")}
    # Between two periods, behind the last, and the same value inside a period: the log is not needed, so an empty one does.
    batch = [("a", 7, 0, "z", 1), ("a", 3, 0, "x", 1), ("b", 9, 0, "y", 1)]
    nothing = spark.createDataFrame([], SCHEMA)
    for _ in range(2):
        dimension.merge(lake, DIM, spark.createDataFrame(batch, SCHEMA), nothing, *how(), 64)
        made = [(*r[:6], tuple(r[6]), tuple(r[7])) for r in shown(lake.read(DIM))]
        assert sorted(made, key=repr) == expected(first + batch)
    # The bucket of a key that no batch named keeps its file.
    kept = [f for f in Path(lake.path(DIM)).rglob("*.parquet") if before.get(f) == f.stat().st_mtime_ns]
    assert [r["k"] for f in kept for r in spark.read.parquet(str(f)).collect()] == ["c"]


@pytest.mark.parametrize("hot_rows", [3, 25, 10**9])
def test_hot_keys_go_by_slices_and_the_rest_whole(spark, tmp_path, hot_rows):
    rng, limits = random.Random(7), Limits(small_bytes=-1, hot_rows=hot_rows, sample=1.0)
    states = [(rng.choice("aaaabc"), rng.randrange(60), n, rng.choice(["x", "y", None]), rng.choice([1, None])) for n in range(80)]
    rng.shuffle(states)
    lake = Lake(spark, str(tmp_path))
    for i in (0, 40):
        log = spark.createDataFrame(states[: i + 40], SCHEMA)
        dimension.merge(lake, DIM, spark.createDataFrame(states[i : i + 40], SCHEMA), log, *how(), 4, limits)
        made = [(*r[:6], tuple(r[6]), tuple(r[7])) for r in shown(lake.read(DIM))]
        assert sorted(made, key=repr) == expected(states[: i + 40])


def test_periods_of_whole_keys_take_one_shuffle(spark):
    made = periods(spark.range(1000).selectExpr("string(id % 9) AS k", "id AS at", "id AS n", "string(id % 2) AS v", "1 AS w"), *how())
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan


def test_periods_of_nothing(spark):
    assert periods(spark.createDataFrame([], SCHEMA), *how()).count() == 0
