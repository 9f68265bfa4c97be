"""Importance resampling towards a target corpus.

Features are runs of one to three words, hashed into a fixed array of buckets. The array of log
ratios between target and raw corpus scores every document, Gumbel noise drawn from its key makes the
highest scores a sample without replacement, and the cutoff of the sample is found by bracketing: a
quantile sketch proposes a bracket, exact counts outside it validate or widen it, and only what lies
inside is sorted.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructType
from pyspark.sql.window import Window

from siltgate.llm.base import annotate, slices
from siltgate.plans.sizing import stored

BUCKETS = 10_000
SEED = 42
# Sketches name quantiles to within a ten-thousandth of the rows.
ACCURACY = 10_000
# A bracket of more rows is bracketed again before it is sorted.
SORTED_ROWS = 100_000
# Letters in lower case and digits stay, as does everything outside ASCII; the rest separates words.
_WORDS = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))
FIELDS = StructType().add("n_words", LongType()).add("n_features", LongType()).add("weight", LongType())


def _buckets(text: bytes, buckets: int) -> tuple[int, np.ndarray]:
    """How many words a text has, and the bucket of every run of one to three of them.

    A CRC goes on where another ended, so longer runs start from the shorter ones' values.
    """
    words = text.translate(_WORDS).split()
    one = list(map(crc32, words))
    later = [b" " + w for w in words[1:]]
    two = list(map(crc32, later, one))
    three = list(map(crc32, later[1:], two))
    return len(words), np.array([*one, *two, *three], np.uint32) % np.uint32(buckets)


def feature_counts(df: DataFrame, text: str = "text", buckets: int = BUCKETS) -> np.ndarray:
    """Features of all texts per bucket. A task sends at most one row a bucket, whatever it reads."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for first, last, data, offsets in slices(batch.column(0)):
                raw = data.tobytes()
                for i in range(last - first):
                    total += np.bincount(_buckets(raw[offsets[i] : offsets[i + 1]], buckets)[1], minlength=buckets)
        full = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(full), pa.array(total[full])], ["bucket", "n"])

    found = df.select(F.col(text)).mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(buckets, np.int64)
    out[found["bucket"].to_numpy()] = found["n"].to_numpy()
    return out


def gains(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """What one feature of each bucket adds to a weight: floored thousandths of the smoothed log ratio."""
    all_raw, all_target, buckets = int(raw.sum()), int(target.sum()), len(raw)
    made = [
        math.floor(1000 * math.log((float(t + 1) * float(all_raw + buckets)) / (float(s + 1) * float(all_target + buckets))))
        for s, t in zip(raw.tolist(), target.tolist(), strict=True)
    ]
    return np.array(made, np.int64)


def weigh(docs: DataFrame, gain: np.ndarray, text: str = "text", into: str = "_weight") -> DataFrame:
    """``docs`` plus a struct ``into`` with n_words, n_features and weight; NULL and empty texts have none of them.

    No shuffle; rows, repeats and other columns stay as they are. ``gain`` is one number a bucket.
    """

    def start():
        def work(texts: pa.Array) -> list[pa.Array]:
            words, features, weight = [], [], []
            for first, last, data, offsets in slices(texts):
                raw = data.tobytes()
                for i in range(last - first):
                    n, found = _buckets(raw[offsets[i] : offsets[i + 1]], len(gain))
                    words.append(n)
                    features.append(len(found))
                    weight.append(int(gain[found].sum()))
            return [pa.array(x, pa.int64()) for x in (words, features, weight)]

        return work

    return annotate(docs, text, into, FIELDS, start)


def noise(key: str, seed: int = SEED) -> Column:
    """Gumbel noise in thousandths, from a hash of the key: the same whenever and wherever a row is read."""
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit("")))
    hashed = F.conv(F.substring(F.sha2(named, 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((hashed + 0.5) / F.lit(4294967296.0)))).cast("long")


def _bracket(rows: DataFrame, column: str, share: float, margin: float, accuracy: int) -> tuple[int, int]:
    """Two values that the sketch puts ``margin`` to either side of a quantile."""
    at = [min(1.0, max(0.0, share + side * margin)) for side in (-1, 1)]
    low, high = rows.agg(F.percentile_approx(column, F.lit(at), F.lit(accuracy)).alias("q")).first()["q"]
    return low, high


def locate(rows: DataFrame, columns: list[str], rank: int, n: int, accuracy: int = ACCURACY, sorted_rows: int = SORTED_ROWS) -> tuple[int, ...]:
    """The values of the row at ``rank`` (from 1, of n) in ascending order of integer ``columns``.

    ``rows`` is read a few times and should be stored. Each round counts exactly how many rows lie below
    and inside the sketch's bracket. If the rank is inside, only the bracket is searched on, otherwise
    the side that holds it; each round leaves rows out, and what is sorted has a bound, except that
    rows equal in all columns need no sorting.
    """
    for column in columns:
        margin = 2 / accuracy
        while True:
            low, high = _bracket(rows, column, rank / n, margin, accuracy)
            value = F.col(column)
            seen = rows.agg(F.count_if(value < low).alias("below"), F.count_if(value <= high).alias("upto")).first()
            below, inside = seen["below"], seen["upto"] - seen["below"]
            if below < rank <= below + inside:
                if inside == n and low < high:
                    # The bracket holds everything: look at a single value instead.
                    margin = 0.0
                    continue
                rows, rank, n = rows.where((value >= low) & (value <= high)), rank - below, inside
                if low == high:
                    break
                if n <= sorted_rows:
                    found = rows.select(*columns).orderBy(*columns).offset(rank - 1).limit(1).first()
                    return tuple(found)
            elif rank <= below:
                rows, n = rows.where(value < low), below
            else:
                rows, rank, n = rows.where(value > high), rank - below - inside, n - below - inside
    # Whatever is left is equal in every column.
    return tuple(rows.select(*columns).first())


def ranked(rows: DataFrame, order: list[Column]) -> DataFrame:
    """``rows`` plus ``rank``, 1, 2, 3 … in an order that is total up to equal rows.

    Equal rows are counted first. The rest is range-partitioned and stored, numbered inside each
    partition, and shifted by the rows of the partitions before; the driver sees one number a partition.
    """
    columns = rows.columns
    ranged = stored(
        rows.groupBy(*columns).agg(F.count(F.lit(1)).alias("_copies")).repartitionByRange(*order).withColumn("_part", F.spark_partition_id()),
        "ranged",
    )
    before, shifts = 0, []
    for part, n in sorted(tuple(r) for r in ranged.groupBy("_part").agg(F.sum("_copies")).collect()):
        shifts.append((part, before))
        before += n
    shift = rows.sparkSession.createDataFrame(shifts, "_part int, _shift long")
    inside = Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    last = ranged.withColumn("_before", F.coalesce(F.sum("_copies").over(inside), F.lit(0))).join(F.broadcast(shift), "_part")
    at = F.col("_before") + F.col("_shift")
    return last.select(*columns, F.explode(F.sequence(at + 1, at + F.col("_copies"))).alias("rank"))


def resample(
    docs: DataFrame, target: DataFrame, key: str = "doc_id", text: str = "text", target_text: str = "text", percent: int = 5, min_words: int = 20,
    seed: int = SEED, buckets: int = BUCKETS, accuracy: int = ACCURACY, sorted_rows: int = SORTED_ROWS,
) -> DataFrame:
    """(key, n_features, weight, score, rank) of every row of ``docs``; rank is NULL where a row is not drawn.

    Of the rows with ``min_words`` words or more, ``percent`` in a hundred (rounded down) are drawn, the
    highest scores first and ties to the smaller key, rows without a key last. Repeated rows are rows of
    their own. NULL texts are empty. Keys are integers. Other columns do not matter.
    """
    slim = docs.select(F.col(key).cast("long").alias("_key"), F.col(text).alias("_text"))
    gain = gains(feature_counts(slim, "_text", buckets), feature_counts(target, target_text, buckets))
    weighed = weigh(slim, gain, "_text").select("_key", "_weight.*")
    # Ascending in all three columns is the order of the draw.
    scored = stored(
        weighed.withColumn("score", F.col("weight") + noise("_key", seed)).withColumns(
            {"_down": -F.col("score"), "_no_key": F.col("_key").isNull().cast("int"), "_at": F.coalesce("_key", F.lit(0))}
        ),
        "scored",
    )
    shown = [F.col("_key").cast(docs.schema[key].dataType).alias(key), "n_features", "weight", "score"]
    able = F.col("n_words") >= min_words
    rows = scored.where(able)
    n = rows.count()
    drawn = n * percent // 100
    if not drawn:
        return scored.select(*shown, F.lit(None).cast("long").alias("rank"))
    order = ["_down", "_no_key", "_at"]
    cut = locate(rows, order, drawn, n, accuracy, sorted_rows)
    down, no_key, at = (F.col(c) for c in order)
    upto = (down < cut[0]) | ((down == cut[0]) & ((no_key < cut[1]) | ((no_key == cut[1]) & (at <= cut[2]))))
    chosen = ranked(rows.where(upto), [F.col(c) for c in (*order, "n_features", "weight")])
    # Rows equal to the last one drawn may reach beyond the draw.
    chosen = chosen.withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")))
    rest = scored.where(~(able & upto)).withColumn("rank", F.lit(None).cast("long"))
    return chosen.unionByName(rest).select(*shown, "rank")
