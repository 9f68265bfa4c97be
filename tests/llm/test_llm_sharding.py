from __future__ import annotations

from collections import Counter

import cases
import numpy as np
import pytest
from pyspark.sql import functions as F

from siltgate.llm import sharding


def drawn(spark, total, good, n, draws):
    df = spark.range(draws).select(F.lit(total).cast("long").alias("t"), F.lit(good).cast("long").alias("g"), F.lit(n).cast("long").alias("n"), sharding._uniform(F.lit(3), F.col("id")).alias("u"))
    made = df.select(sharding.hypergeometric(F.col("t"), F.col("g"), F.col("n"), F.col("u")).alias("k"))
    return np.array([r["k"] for r in made.collect()])


@pytest.mark.parametrize(("total", "good", "n"), [(50, 20, 10), (1000, 25, 400), (12, 12, 5), (12, 0, 5), (7, 3, 7), (1, 1, 0), (10**9, 10**7, 10**6)])
def test_draws_follow_the_hypergeometric_law(spark, total, good, n):
    k = drawn(spark, total, good, n, 2000)
    assert (k >= max(0, n + good - total)).all() and (k <= min(good, n)).all()
    mean = n * good / total
    spread = np.sqrt(mean * (1 - good / total) * (total - n) / max(total - 1, 1))
    assert abs(k.mean() - mean) <= 5 * spread / np.sqrt(len(k)) + 1e-9
    if spread:
        assert 0.85 < k.std() / spread < 1.15


def test_a_small_law_in_full(spark):
    from math import comb

    k = Counter(drawn(spark, 10, 4, 3, 6000).tolist())
    for value in range(4):
        p = comb(4, value) * comb(6, 3 - value) / comb(10, 3)
        assert abs(k[value] / 6000 - p) < 5 * (p * (1 - p) / 6000) ** 0.5


@pytest.mark.parametrize(("blocks", "shards"), [(1, 7), (5, 3), (40, 4), (1100, 2)])
def test_the_matrix_has_exact_sums(spark, blocks, shards):
    sizes = [(i, (i * 37) % 50) for i in range(blocks)]
    total = sum(n for _, n in sizes)
    made = {r["block"]: r["row"] for r in sharding.matrix(spark.createDataFrame(sizes, "block long, n long"), shards, total, 1).collect()}
    assert {b: sum(row) for b, row in made.items()} == dict(sizes)
    columns = [sum(row[j] for row in made.values()) for j in range(shards)]
    assert max(columns) - min(columns) <= 1 and min(min(row) for row in made.values()) >= 0


@pytest.mark.parametrize("bucket_rows", [1 << 20, 40])
def test_exact_shards_and_gapless_slots(spark, bucket_rows):
    docs = spark.range(0, 1003, 1, 6).select((F.col("id") % 900).alias("doc_id"), F.lit("x").alias("shard"), F.when(F.col("id") % 3 > 0, F.lit("hot")).alias("text"))
    made = sharding.shuffle_into(docs, 7, bucket_rows=bucket_rows)
    rows = made.collect()
    assert Counter((r["doc_id"], r["text"]) for r in rows) == Counter((r["doc_id"], r["text"]) for r in docs.collect())
    slots = {}
    for r in rows:
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert sorted(slots) == list(range(7)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    assert as_rows(made) == as_rows(sharding.shuffle_into(docs, 7, bucket_rows=bucket_rows))


def as_rows(df):
    return cases.as_set(df, "doc_id", "text", "shard", "slot")


def test_every_row_goes_anywhere_and_order_is_mixed(spark):
    docs = spark.range(0, 4000, 1, 8)
    rows = sharding.shuffle_into(docs, 4, seed=9).collect()
    table = np.zeros((8, 4))
    for r in rows:
        table[r["id"] // 500, r["shard"]] += 1
    assert abs(table - 125).max() < 6 * 125**0.5
    shard = sorted((r["slot"], r["id"]) for r in rows if r["shard"] == 0)
    assert abs(np.corrcoef([s for s, _ in shard], [i for _, i in shard])[0, 1]) < 0.15


def test_odd_rows_more_shards_than_rows_and_an_empty_table(spark):
    docs = cases.clashing(cases.frame(spark), "slot", "row", "left", "_row2")
    made = sharding.shuffle_into(docs, 100)
    assert made.count() == docs.count() and made.select("shard").distinct().count() == docs.count()
    assert sharding.shuffle_into(docs.limit(0), 5).count() == 0


def test_no_python_on_the_main_path(spark):
    plan = sharding.shuffle_into(spark.range(100), 3)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
