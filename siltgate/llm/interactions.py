"""How filters interact: what every order of them removes, what is redundant, and what it costs.

A document fails a set of filters, its mask; all that matters of a document is its part, its mask and
its labels. Documents are counted into those cells first. Each cell then folds across the array of all
orders (``aggregate`` along an order, ``transform`` over the orders), which gives one struct per order
and step, weighted by the cell's documents; the structs of a part are summed element by element.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")
DUPLICATE = "E"


def failures(text: str = "text") -> dict[str, Column]:
    """The failure conditions that a text decides alone; ``_words`` holds its words."""
    words, body = F.col("_words"), F.col(text)
    return {
        "A": F.size(words) < 100,
        "B": F.size(F.array_distinct(words)) * 100 < F.size(words) * 80,
        "C": F.regexp_count(body, F.lit("[A-Z]")).cast("long") * 100 > F.length(body).cast("long") * 10,
        "D": body.rlike("[#$%&*|]"),
    }


def masks(docs: DataFrame, key: str = "doc_id", text: str = "text", part: str = "lang") -> DataFrame:
    """(_key, _part, _digest, _mask) of every row: one bit for each failed condition of its own text.

    NULL texts are empty and NULL parts the empty string.
    """
    slim = docs.select(F.col(key).alias("_key"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("_part"), F.coalesce(text, F.lit("")).alias("_text"))
    split = slim.withColumn("_words", F.array_remove(F.split("_text", "[\\x20\\x09-\\x0D]+"), ""))
    bits = [F.when(failed, F.lit(1 << i)).otherwise(F.lit(0)) for i, failed in enumerate(failures("_text").values())]
    mask = bits[0]
    for bit in bits[1:]:
        mask = mask.bitwiseOR(bit)
    # Texts are equal where their SHA-256 is: 32 bytes are shuffled instead of a text.
    return split.select("_key", "_part", F.unhex(F.sha2("_text", 256)).alias("_digest"), mask.alias("_mask"))


def cells(judged: DataFrame, labels: DataFrame, key: str = "doc_id") -> DataFrame:
    """(_part, _mask, _good, _toxic, _n): documents of each kind, the duplicate filter's bit included.

    A row fails it if a smaller key has the same text anywhere in the table; rows without a key never
    do, and rows that repeat the smallest key do not. Several label rows of a key count as one.
    """
    bit = len(failures())
    known = (
        labels.where(F.col(key).isNotNull())
        .groupBy(F.col(key).alias("_key"))
        .agg(F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("_good"), F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("_toxic"))
    )
    # Equal rows are counted before they meet the labels, so a key of very many rows is spread by text.
    rows = judged.groupBy("_key", "_part", "_digest", "_mask").agg(F.count(F.lit(1)).alias("_n"))
    rows = rows.join(known, "_key", "left").withColumns({c: F.coalesce(c, F.lit(False)) for c in ("_good", "_toxic")})
    cell = ["_part", "_mask", "_good", "_toxic"]
    no_key = F.col("_key").isNull()
    # Copies of a text collapse into their cells, then the few cells of a text compare their smallest keys.
    texts = rows.groupBy("_digest", *cell).agg(
        F.sum("_n").alias("_all"),
        F.sum(F.when(no_key, F.col("_n")).otherwise(0)).alias("_without"),
        F.min(F.when(~no_key, F.struct("_key", "_n"))).alias("_least"),
    )
    first = F.min("_least._key").over(Window.partitionBy("_digest"))
    at_first = F.when(F.col("_least._key") == F.col("_first"), F.col("_least._n")).otherwise(0)
    failing = (F.col("_all") - F.col("_without") - at_first).alias("_failing")
    counted = texts.withColumn("_first", first).select(*cell, "_all", failing)
    both = F.array(
        F.struct((F.col("_mask") + F.lit(1 << bit)).alias("_mask"), F.col("_failing").alias("_n")),
        F.struct(F.col("_mask"), (F.col("_all") - F.col("_failing")).alias("_n")),
    )
    shared = [c for c in cell if c != "_mask"]
    return counted.select(*shared, F.inline(both)).where("_n > 0").groupBy(*cell).agg(F.sum("_n").alias("_n"))


def orders(letters: str) -> list[str]:
    return ["".join(p) for p in permutations(letters)]


def fold(counted: DataFrame, letters: str) -> DataFrame:
    """(_part, _steps): of each cell, one struct of weighted counts per order and step, all orders in a row."""
    every = F.array(*[F.array(*[F.lit(letters.index(c)) for c in order]) for order in orders(letters)])
    nothing = F.struct(*[F.lit(0).cast("bigint").alias(c) for c in COUNTS])
    start = F.struct(F.array_repeat(nothing, 0).alias("steps"), F.lit(True).alias("alive"))

    def counts(holds: Column) -> Column:
        return F.when(holds, F.col("_n")).otherwise(F.lit(0).cast("bigint"))

    def step(done: Column, bit: Column) -> Column:
        fails, alive = F.getbit("_mask", bit) == 1, done["alive"]
        removed = alive & fails
        values = (
            alive & ~fails, removed, ~alive & fails, fails & (F.bit_count("_mask") == 1), removed & F.col("_good"), removed & F.col("_toxic"),
        )
        made = F.struct(*[counts(v).alias(c) for c, v in zip(COUNTS, values, strict=True)])
        return F.struct(F.array_append(done["steps"], made).alias("steps"), (alive & ~fails).alias("alive"))

    along = F.transform(every, lambda order: F.aggregate(order, start, step, lambda done: done["steps"]))
    return counted.select("_part", F.flatten(along).alias("_steps"))


def audit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", part: str = "lang") -> DataFrame:
    """part, filter_order, step and the counts, a row for every part, order and step.

    ``labels`` has (key, quality, toxic); NULLs there label nothing. Extra columns of ``docs`` do not
    matter, no rows give no rows. shapley is what the step's filter removes, summed over all orders.
    """
    letters = "".join(failures()) + DUPLICATE
    folded = fold(cells(masks(docs, key, text, part), labels, key), letters)
    summed = (
        folded.select("_part", F.posexplode("_steps").alias("_at", "_step"))
        .groupBy("_part", "_at")
        .agg(*[F.sum(f"_step.{c}").alias(c) for c in COUNTS])
    )
    width = len(letters)
    named = summed.select(
        F.col("_part").alias("part"),
        F.element_at(F.lit(orders(letters)), F.floor(F.col("_at") / width).cast("int") + 1).alias("filter_order"),
        (F.col("_at") % width + 1).cast("int").alias("step"),
        *COUNTS,
    )
    of_filter = Window.partitionBy("part", F.expr("substring(filter_order, step, 1)"))
    return named.withColumn("shapley", F.sum("removed").over(of_filter))
