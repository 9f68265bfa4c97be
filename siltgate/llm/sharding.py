"""Uniform shuffle into shards of exact sizes, by a hypergeometric communication matrix.

A uniform random permutation cut into shards sends from each block of rows a multivariate
hypergeometric number of rows to each shard. Those numbers are drawn first, exactly and for
all blocks together; then each block orders its own rows at random and cuts them by its
numbers, the rows are exchanged, and each shard orders what it got at random. Rows move once,
and no shard size depends on luck.
"""

from __future__ import annotations

from collections.abc import Callable
from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from siltgate.plans.sizing import stored

# Children of a node of the tree over which the matrix is drawn.
FAN = 32
# Rows that one task orders when a shard is permuted; larger shards are cut by ranges of the random key.
BUCKET_ROWS = 1 << 20
# Support of a draw on both sides of its mean, in standard deviations: beyond lies less than 1e-30.
DEVIATIONS = 12


def _uniform(*parts: Column) -> Column:
    """A number in [0, 1) that depends on the parts alone."""
    return F.shiftrightunsigned(F.xxhash64(*parts), 11).cast("double") / F.lit(float(1 << 53))


def hypergeometric(total: Column, good: Column, drawn: Column, u: Column) -> Column:
    """Exact inverse-CDF draw: how many of ``drawn`` items taken from ``total`` are among the ``good`` ones.

    The probabilities are walked by their ratios over the support, once for their sum and once
    up to u of it, so memory is constant. Columns must be names or literals, not expressions.
    """
    mean = drawn.cast("double") * good / F.greatest(total, F.lit(1))
    spread = F.sqrt(
        F.greatest(mean * (1 - good.cast("double") / F.greatest(total, F.lit(1))) * (total - drawn) / F.greatest(total - 1, F.lit(1)), F.lit(0.0))
    )
    reach = F.ceil(spread * DEVIATIONS) + DEVIATIONS
    low = F.greatest(F.lit(0).cast("long"), drawn + good - total, F.floor(mean).cast("long") - reach.cast("long"))
    high = F.least(good, drawn, F.floor(mean).cast("long") + reach.cast("long"))

    def step(k: Column) -> Column:
        """log P(k) - log P(k - 1)"""
        return F.log((good - k + 1).cast("double")) + F.log((drawn - k + 1).cast("double")) - F.log(k.cast("double")) - F.log((total - good - drawn + k).cast("double"))

    def grow(state: Column, k: Column) -> Column:
        log = state["log"] + F.when(k > low, step(k)).otherwise(0.0)
        top = F.greatest(state["top"], log)
        return F.struct(
            log.alias("log"), top.alias("top"), (state["sum"] * F.exp(state["top"] - top) + F.exp(log - top)).alias("sum")
        )

    zero = F.struct(F.lit(0.0).alias("log"), F.lit(-1e300).alias("top"), F.lit(0.0).alias("sum"))
    summed = F.aggregate(F.sequence(low, high), zero, grow)

    def seek(sums: Column) -> Column:
        def walk(state: Column, k: Column) -> Column:
            log = state["log"] + F.when(k > low, step(k)).otherwise(0.0)
            below = state["below"] + F.exp(log - sums["top"])
            return F.struct(
                log.alias("log"),
                below.alias("below"),
                F.when(state["k"].isNull() & (below > u * sums["sum"]), k).otherwise(state["k"]).alias("k"),
            )

        start = F.struct(F.lit(0.0).alias("log"), F.lit(0.0).alias("below"), F.lit(None).cast("long").alias("k"))
        return F.coalesce(F.aggregate(F.sequence(low, high), start, walk)["k"], high)

    # transform over one element binds the sums to a name, so they are computed once.
    return F.element_at(F.transform(F.array(summed), seek), 1)


def _row_of_matrix(left: Column, size: Column, seed: Column) -> Column:
    """How many of ``size`` rows each shard gets, when shard j still has ``left[j]`` free places."""

    def one(state: Column, item: Column) -> Column:
        good = item["free"]
        bound = F.array(F.struct(state["total"].alias("total"), state["drawn"].alias("drawn"), good.alias("good"), _uniform(seed, item["j"]).alias("u")))
        got = F.element_at(F.transform(bound, lambda b: hypergeometric(b["total"], b["good"], b["drawn"], b["u"])), 1)
        return F.element_at(
            F.transform(
                F.array(got),
                lambda g: F.struct(
                    (state["total"] - good).alias("total"), (state["drawn"] - g).alias("drawn"), F.concat(state["row"], F.array(g)).alias("row")
                ),
            ),
            1,
        )

    places = F.transform(left, lambda x, j: F.struct(x.alias("free"), j.alias("j")))
    start = F.struct(
        F.aggregate(left, F.lit(0).cast("long"), lambda a, b: a + b).alias("total"), size.alias("drawn"), F.array().cast("array<long>").alias("row")
    )
    return F.aggregate(places, start, one)["row"]


def _share_out(seed: int, level: int) -> Callable[[Column, Column], Column]:
    """A fold step: the next child gets its row, which leaves the others fewer places."""

    def give(state: Column, child: Column) -> Column:
        row = _row_of_matrix(state["left"], child["n"], F.struct(F.lit(seed), F.lit(level), child["node"]))
        return F.element_at(
            F.transform(
                F.array(row),
                lambda r: F.struct(
                    F.zip_with(state["left"], r, lambda a, b: a - b).alias("left"),
                    F.concat(state["out"], F.array(F.struct(child["node"].alias("node"), r.alias("row")))).alias("out"),
                ),
            ),
            1,
        )

    return give


def matrix(blocks: DataFrame, shards: int, rows: int, seed: int) -> DataFrame:
    """(block, row): exact draws for all blocks, ``blocks`` being (block long from 0, n long).

    Drawn down a tree with FAN children a node: a node shares its places among its children one
    after the other, so each task draws FAN rows at most and a level is one job step.
    """
    n_blocks = (blocks.agg(F.max("block")).first()[0] or 0) + 1
    depth = 1
    while FAN**depth < n_blocks:
        depth += 1
    sizes = [blocks.select(F.col("block").alias("node"), F.col("n"))]
    for _ in range(depth):
        above = sizes[-1].groupBy(F.floor(F.col("node") / FAN).cast("long").alias("node")).agg(F.sum("n").alias("n"))
        sizes.append(above)
    # Shard sizes differ by one at most; which shards get one more is drawn too.
    base, extra = divmod(rows, shards)
    spark = blocks.sparkSession
    lucky = F.sort_array(F.transform(F.sequence(F.lit(0), F.lit(shards - 1)), lambda j: F.struct(F.xxhash64(F.lit(seed), j).alias("h"), j.alias("j"))))
    first = F.transform(F.slice(lucky, 1, extra), lambda x: x["j"]) if extra else F.array().cast("array<int>")
    places = F.transform(
        F.sequence(F.lit(0), F.lit(shards - 1)), lambda j: F.lit(base).cast("long") + F.array_contains(first, j).cast("long")
    )
    nodes = spark.range(1).select(F.col("id").alias("node"), places.alias("left"))
    for level in range(depth - 1, -1, -1):
        children = sizes[level].groupBy(F.floor(F.col("node") / FAN).cast("long").alias("parent")).agg(
            F.sort_array(F.collect_list(F.struct("node", "n"))).alias("children")
        )

        start = F.struct(F.col("left"), F.array().cast("array<struct<node:bigint,row:array<bigint>>>").alias("out"))
        drawn = children.join(nodes, children["parent"] == nodes["node"]).select(F.explode(F.aggregate("children", start, _share_out(seed, level))["out"]).alias("c"))
        nodes = drawn.select(F.col("c.node").alias("node"), F.col("c.row").alias("left"))
    return nodes.select(F.col("node").alias("block"), F.col("left").alias("row"))


def shuffle_into(rows: DataFrame, shards: int, seed: int = 5, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """``rows`` plus ``shard`` (0 to shards - 1) and ``slot`` (0, 1, ... in each shard), uniformly at random.

    Shard sizes differ by one at most (law ``rows``). Each input partition is a block; blocks and the
    slim ``rows`` are stored once, so retried tasks see the same rows in the same blocks. Equal rows,
    NULLs and rows of one key need no care: a row's place depends on its rank in its block alone, so no
    key is hot. No rows give no rows. Columns named like the results are replaced.
    """
    rows = rows.drop("shard", "slot")
    names = rows.columns
    # Local permutation: each block is sorted by a random key where it stands, and numbered in that order.
    mixed = rows.select(F.monotonically_increasing_id().alias("_id"), F.struct(*names).alias("_row"))
    mixed = mixed.sortWithinPartitions(F.xxhash64(F.lit(seed), F.lit("cut"), "_id"), "_id")
    rank = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) + 1
    kept = stored(mixed.select(F.spark_partition_id().cast("long").alias("_part"), "_id", rank.alias("_rank"), "_row"), "blocks")
    counts = kept.groupBy("_part").agg(F.count(F.lit(1)).alias("n"))
    counts = stored(counts, "block-sizes")
    total = counts.agg(F.sum("n")).first()[0] or 0
    sized = counts.select(F.col("_part").alias("block"), "n")
    drawn = matrix(sized, shards, total, seed) if total else sized.select("block", F.array().cast("array<long>").alias("row"))
    # The cut: a block's first row[0] rows go to shard 0, the next row[1] to shard 1, ...
    drawn = drawn.select(
        F.col("block").alias("_part"),
        F.aggregate(
            "row", F.array().cast("array<long>"), lambda a, x: F.concat(a, F.array(x + F.coalesce(F.try_element_at(a, F.lit(-1)), F.lit(0))))
        ).alias("_upto"),
    )
    placed = kept.join(drawn, "_part").select(
        "_id", "_row", F.size(F.filter("_upto", lambda x: x < F.col("_rank"))).alias("shard"), F.xxhash64(F.lit(seed), F.lit("slot"), "_id").alias("_key")
    )
    # Second permutation: the order of the random key; ranges of it are ranked apart and shifted by the rows before them.
    buckets = max(1, ceil(total / shards / bucket_rows))
    placed = placed.withColumn("_bucket", F.floor((F.shiftrightunsigned("_key", 11).cast("double") / float(1 << 53)) * buckets).cast("int"))
    within = Window.partitionBy("shard", "_bucket").orderBy(F.shiftrightunsigned("_key", 11), "_id")
    placed = placed.withColumn("_at", F.row_number().over(within).cast("long") - 1)
    if buckets > 1:
        before = Window.partitionBy("shard").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
        shift = placed.groupBy("shard", "_bucket").agg(F.count(F.lit(1)).alias("_n")).withColumn("_shift", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
        placed = placed.join(shift, ["shard", "_bucket"]).withColumn("_at", F.col("_at") + F.col("_shift"))
    return placed.select("_row.*", "shard", F.col("_at").alias("slot"))
