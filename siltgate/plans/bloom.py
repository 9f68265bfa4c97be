"""A Bloom filter as a small table: rows that cannot match are dropped before they are shuffled.

A key sets three bits of one 64-bit word; the words are OR-ed together by an aggregation and
broadcast. The number of words is fixed by the caller's bound, never by the data: with more keys
than it was made for the filter lets more rows pass, and the exact join that follows is what decides.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltgate.functions.expressions import quoted

# Words of 64 bits at most: 2**20 rows of 16 bytes, 16 MB, whatever the number of keys.
MOST_WORDS = 1 << 20
# Keys that share a word when the filter is as large as it should be.
KEYS_PER_WORD = 6


def _hash(keys: Sequence[str | Column]) -> Column:
    return F.xxhash64(*[F.col(k) if isinstance(k, str) else k for k in keys])


def _word(hashed: Column, words: int) -> Column:
    return hashed.bitwiseAND(F.lit(words - 1).cast("bigint"))


def _mask(hashed: Column) -> Column:
    mask = F.lit(0).cast("bigint")
    for shift in (40, 46, 52):
        at = F.shiftrightunsigned(hashed, shift).bitwiseAND(F.lit(63).cast("bigint")).cast("int")
        mask = mask.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("bigint"), at))
    return mask


def words_for(keys: int, most: int = MOST_WORDS) -> int:
    """A power of two with room for ``keys`` keys, up to ``most``."""
    return min(most, 1 << max(10, (max(keys, 1) // KEYS_PER_WORD).bit_length()))


def build(df: DataFrame, keys: Sequence[str | Column], words: int) -> DataFrame:
    """(_bloom_word, _bloom_bits): at most ``words`` rows, OR-ed map-side first. NULL is a value like others."""
    if words & (words - 1):
        raise ValueError("words must be a power of two")
    hashed = df.select(_hash(keys).alias("_h"))
    return (
        hashed.select(_word(F.col("_h"), words).alias("_bloom_word"), _mask(F.col("_h")).alias("_bloom_bits"))
        .groupBy("_bloom_word")
        .agg(F.bit_or("_bloom_bits").alias("_bloom_bits"))
    )


def flag(df: DataFrame, keys: Sequence[str | Column], made: DataFrame, words: int, into: str) -> DataFrame:
    """``df`` plus a boolean: false only for rows whose key is certainly not in the filter. No shuffle.

    ``made`` must come from ``build`` with the same ``words``, which is what bounds the broadcast.
    """
    hashed = df.withColumn("_bloom_hash", _hash(keys)).withColumn("_bloom_word", _word(F.col("_bloom_hash"), words))
    joined = hashed.join(F.broadcast(made), "_bloom_word", "left")
    mask = _mask(F.col("_bloom_hash"))
    found = F.coalesce(F.col("_bloom_bits").bitwiseAND(mask) == mask, F.lit(False))
    return joined.select(*quoted(df.columns), found.alias(into))


def only_possible(df: DataFrame, keys: Sequence[str], wanted: DataFrame, most: int = MOST_WORDS) -> DataFrame:
    """Rows of ``df`` whose key may be in ``wanted`` (same column names): all that are, and a few others.

    ``wanted`` is counted and read again, so it should be a stored table.
    """
    words = words_for(wanted.count(), most)
    made = build(wanted, keys, words)
    kept = flag(df, keys, made, words, "_possible")
    return kept.where("_possible").drop("_possible")
