"""SimHash fingerprints and groups of near duplicates.

Candidates come from an inverted index over byte positions: fingerprints at most two bits
apart agree in at least six of their eight bytes, so they share the bytes at four positions
of some of six fixed sets. Pairs that share an entry have their equal positional bytes tallied,
pairs with the guaranteed six stay, and the bit distance decides.
"""

from __future__ import annotations

from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructType

from siltgate.llm.base import annotate, slices, with_row_ids
from siltgate.llm.components import components
from siltgate.plans.sizing import stored

SEED = 42
MAX_BITS = 2
# Entries of the index with more fingerprints are linked through shared neighbours instead of pairs.
LONG_ENTRY = 64


def _fingerprints(texts: pa.Array, width: int) -> np.ndarray:
    out = np.zeros(len(texts), np.uint64)
    for first, last, data, offsets in slices(texts):
        raw = data.tobytes().lower()
        hashes, sizes = [], []
        for i in range(last - first):
            words = raw[offsets[i] : offsets[i + 1]].split()
            if len(words) > width:
                shingles = map(b" ".join, zip(*(words[j:] for j in range(width)), strict=False))
                n = len(words) - width + 1
            else:
                shingles, n = ([b" ".join(words)], 1) if words else ([], 0)
            hashes.append(np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(SEED)), np.uint64, n))
            sizes.append(n)
        sizes = np.array(sizes, np.int64)
        full = np.flatnonzero(sizes)
        if not len(full):
            continue
        starts = np.concatenate([[0], np.cumsum(sizes[full])[:-1]])
        bits = np.unpackbits(np.concatenate(hashes).astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        set_bits = np.add.reduceat(bits, starts, axis=0, dtype=np.int32)
        on = set_bits * 2 > sizes[full, None]
        out[first + full] = np.packbits(on, axis=1).view(">u8").ravel()
    return out.view(np.int64)


def fingerprint(docs: DataFrame, text: str = "text", width: int = 3, into: str = "_simhash") -> DataFrame:
    """``docs`` plus a struct column ``into`` with ``fp``, the 64 bits as a signed long.

    Texts without words, NULL included, have fingerprint zero; fewer words than ``width`` are one
    shingle. Every row and column is kept.
    """

    def start():
        return lambda texts: [pa.array(_fingerprints(texts, width), pa.int64())]

    return annotate(docs, text, into, StructType().add("fp", LongType()), start)


def _tally(difference: Column) -> Column:
    """In how many byte positions two fingerprints agree, given their XOR."""
    return sum(((F.shiftrightunsigned(difference, 8 * i).bitwiseAND(F.lit(255))) == 0).cast("int") for i in range(8))


def links(prints: DataFrame, long_entry: int = LONG_ENTRY) -> DataFrame:
    """Links (a, b) over distinct fingerprints ``fp``; their closure is that of all pairs within two bits.

    Entries of at most ``long_entry`` fingerprints give their pairs. In longer entries pairs would grow
    with the square: there, two fingerprints are within two bits exactly if they share a value at most
    one bit from both, so each of the entry's fingerprints names its 65 such values, and the smallest
    fingerprint at a value links with the others. Nothing is cut off.
    """
    halves = [F.shiftrightunsigned("fp", 16 * i).bitwiseAND(F.lit(0xFFFF)) for i in range(4)]
    keys = [
        (F.lit(n << 32) + halves[i] * 65536 + halves[j]).alias("key") for n, (i, j) in enumerate(combinations(range(4), 2))
    ]
    entries = prints.select("fp", F.explode(F.array(*keys)).alias("key"))
    sizes = entries.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    index = stored(entries.join(sizes, "key"), "simhash-index")
    short = index.where(F.col("n") <= long_entry)
    a, b = short.select("key", F.col("fp").alias("a")), short.select("key", F.col("fp").alias("b"))
    difference = F.col("a").bitwiseXOR(F.col("b"))
    near = (
        a.join(b, "key")
        .where(F.col("a") < F.col("b"))
        .where(_tally(difference) >= 8 - MAX_BITS)
        .where(F.bit_count(difference) <= MAX_BITS)
        .select("a", "b")
    )
    crowded = index.where(F.col("n") > long_entry).select("fp").distinct()
    flips = F.array(F.lit(0).cast("long"), *(F.lit(1 << i if i < 63 else -(1 << 63)).cast("long") for i in range(64)))
    at = crowded.select("fp", F.explode(flips).alias("flip")).select("fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("value"))
    centres = at.groupBy("value").agg(F.min("fp").alias("b"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    stars = at.join(centres, "value").where(F.col("fp") != F.col("b")).select(F.col("fp").alias("a"), "b")
    return near.union(stars).distinct()


def groups(prints: DataFrame, long_entry: int = LONG_ENTRY) -> DataFrame:
    """(fp, label) for every distinct fingerprint: equal labels exactly for connected fingerprints."""
    distinct = stored(prints.select("fp").distinct(), "simhash-distinct")
    found = components(links(distinct, long_entry))
    joined = distinct.join(found, distinct["fp"] == found["node"], "left")
    return joined.select("fp", F.coalesce("label", "fp").alias("label"))


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = 3) -> DataFrame:
    """(key, fingerprint, component_id) for each row of ``docs``.

    component_id is the smallest key in the row's component, NULL keys ignored; it is NULL where a
    component has only NULL keys. Repeated rows stay repeated. Other columns do not matter.
    """
    slim = docs.select(F.col(key).alias("_k"), F.col(text).alias("_t"))
    prints = stored(fingerprint(slim, "_t", width, "_s").select("_k", F.col("_s.fp").alias("fp")), "simhash")
    label = groups(prints)
    owner = prints.groupBy("fp").agg(F.min("_k").alias("_least"))
    least = label.join(owner, "fp")
    smallest = least.groupBy("label").agg(F.min("_least").alias("component_id"))
    known = stored(least.join(smallest, "label").select("fp", "component_id"), "simhash-components")
    return prints.join(known, "fp").select(
        F.col("_k").alias(key), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = 3) -> DataFrame:
    """Of each group of near duplicates the row with the smallest key; NULL keys come last, ties go by place.

    Rows and columns are otherwise as they were. Only row names move through the grouping; texts are
    shuffled once, at the end.
    """
    docs, ids = with_row_ids(docs)
    slim = docs.select(*ids, F.col(key).alias("_k"), F.col(text).alias("_t"))
    prints = stored(fingerprint(slim, "_t", width, "_s").select("f", "r", "_k", F.col("_s.fp").alias("fp")), "simhash")
    named = prints.join(groups(prints), "fp")
    first = named.groupBy("label").agg(F.min(F.struct(F.col("_k").isNull().alias("no_key"), "_k", "f", "r")).alias("one"))
    chosen = stored(first.select("one.f", "one.r"), "simhash-kept")
    return docs.select(F.struct(*docs.columns).alias("_row"), *ids).join(chosen, ["f", "r"], "left_semi").select("_row.*")
