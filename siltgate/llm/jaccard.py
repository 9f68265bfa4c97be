"""Documents whose sets of word shingles overlap, found exactly.

The tiles of the join are a band of set sizes and one of the shingles that a set must share: two sets
that are similar enough share one of the few that come first in a common order, rare ones first, and
lie in one band or in two that touch. Within a tile a pair is judged by the sets' hashed bitmaps: bits
that only one of the two has bound the overlap from above. What passes is intersected exactly.

Where a shared shingle stands in the order of either set bounds the overlap too, so most sets that
share one by chance are told apart by numbers before any bitmap moves. A tile of very many sets never
gives all its pairs: its sets are compared with two of them and within small random parts of the tile,
and what is joined by then needs no further comparison. Only sets that are still in different
components meet each other, and only pairs that their bitmaps leave possible come out of that join.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructType

from siltgate.llm.base import GRAM, LOWER, ODD, SPACE, Words, annotate, grams, mix, slices, whole
from siltgate.llm.components import components
from siltgate.plans.bloom import only_possible
from siltgate.plans.sizing import stored

WIDTH = 4
PERCENT = 85
# Buckets in which shingles are counted to tell frequent ones from rare ones, and how many travel in a row.
COUNT_BITS = 22
COUNT_BLOCK = 1 << 14
# Each size band reaches this much further than the one before; similar sets are never two bands apart.
BAND = 1.7
# Bits of a bitmap for each shingle of the set, rounded up to a power of two of 64-bit words.
BITS_PER_SHINGLE = 2
# Tiles of more sets than this are compared in part first.
DENSE = 16
LIST = ArrayType(LongType())
FIELDS = StructType().add("n", LongType()).add("node", LongType()).add("keys", LIST).add("bits", LIST)


def _band_starts(band: float = BAND, most: int = 1 << 40) -> np.ndarray:
    starts = [1]
    while starts[-1] < most:
        starts.append(max(starts[-1] + 1, int(np.ceil(starts[-1] * band))))
    return np.array(starts, np.int64)


def _shingles(data: np.ndarray, offsets: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every shingle of a slice, repeats included, and the text it belongs to."""
    words = Words(LOWER[data], offsets, ~SPACE)
    hashes, bounds = words.hashes(), words.bounds
    at = np.flatnonzero(whole(bounds, width))
    owner = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    found, owners = [grams(hashes, width)[at]], [owner[at]]
    for n in range(1, width):
        # All words of a text with fewer.
        short = np.flatnonzero(np.diff(bounds) == n)
        folded = hashes[bounds[short]].copy()
        for j in range(1, n):
            folded = folded * np.uint64(GRAM) + hashes[bounds[short] + j]
        found.append(mix(folded + ODD * np.array([n], np.uint64)))
        owners.append(short)
    return np.concatenate(found), np.concatenate(owners)


def _distinct(hashes: np.ndarray, first: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes of each owner, in order of ``first`` (a small number) and then of the hash."""
    group = owner << 8 | first
    order = np.lexsort((hashes, group))
    hashes, group = hashes[order], group[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (group[1:] != group[:-1])
    return hashes[new], group[new] >> 8


def _names(hashes: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """A name for each set, whatever the order of its hashes."""
    return mix(np.add.reduceat(mix(hashes ^ np.uint64(0x3C6EF372FE94F82B)), starts) + sizes.astype(np.uint64) * ODD)


def frequencies(docs: DataFrame, text: str, width: int = WIDTH, bits: int = COUNT_BITS) -> np.ndarray:
    """For each of 2**bits buckets of hashes how often its shingles occur, on a scale of 0 to 255.

    The scale only orders shingles, so any numbers give the same links; better ones give smaller tiles.
    A task sends its counts as compressed blocks, whose number is fixed.
    """
    block = min(COUNT_BLOCK, 1 << bits)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << bits, np.uint32)
        for batch in batches:
            for _, _, data, offsets in slices(batch.column(0)):
                hashes, _ = _shingles(data, offsets, width)
                bucket, n = np.unique(hashes >> np.uint64(64 - bits), return_counts=True)
                total[bucket.astype(np.int64)] += n.astype(np.uint32)
        yield from packed(total)

    def packed(total: np.ndarray) -> Iterator[pa.RecordBatch]:
        for i, part in enumerate(total.reshape(-1, block)):
            if part.any():
                yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([zlib.compress(part.tobytes(), 1)])], ["block", "counts"])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << bits, np.uint32)
        for batch in batches:
            for i, counts in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                into = total[i * block : (i + 1) * block]
                into += np.minimum(np.frombuffer(zlib.decompress(counts), np.uint32), ~into)
        yield from packed(total)

    kind = "block int, counts binary"
    counted = docs.select(F.col(text)).mapInArrow(count, kind).repartition("block").mapInArrow(merge, kind).toArrow()
    out = np.zeros(1 << bits, np.uint32)
    for i, counts in zip(*(column.to_pylist() for column in counted.columns), strict=True):
        out[i * block : (i + 1) * block] = np.frombuffer(zlib.decompress(counts), np.uint32)
    return np.minimum(255, 6 * np.log2(out + 1.0)).astype(np.uint8)


def _lists(values: np.ndarray, sizes: np.ndarray) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.view(np.int64)))


def _summaries(texts: pa.Array, frequent: np.ndarray, width: int, percent: int, bands: np.ndarray) -> list[pa.Array]:
    """n, node, keys and bits of each text; a text without words has n 0, no name and empty lists."""
    made: list[list[pa.Array]] = [[], [], [], []]
    shift = np.uint64(64 - (len(frequent).bit_length() - 1))
    for first, last, data, offsets in slices(texts):
        rows = last - first
        hashes, owner = _shingles(data, offsets, width)
        hashes, owner = _distinct(hashes, frequent[(hashes >> shift).astype(np.int64)].astype(np.int64), owner)
        sizes = np.bincount(owner, minlength=rows)
        full = np.flatnonzero(sizes)
        begin = np.concatenate([[0], np.cumsum(sizes)])[:-1]
        node = np.zeros(rows, np.uint64)
        if len(full):
            node[full] = _names(hashes, begin[full], sizes[full])
        # An overlap of ``least`` leaves room for size - least shingles that the other set lacks.
        least = -(-percent * sizes // 100)
        early = np.arange(len(hashes)) - begin[owner] < (sizes - least + 1)[owner]
        lead, lead_owner = hashes[early], owner[early]
        band = np.searchsorted(bands, np.maximum(sizes, 1), "right") - 1
        low = least < bands[band]
        # A set whose partners may be smaller than its band is in the band below as well.
        both = np.concatenate([lead, lead[low[lead_owner]]])
        both_owner = np.concatenate([lead_owner, lead_owner[low[lead_owner]]])
        tile = np.concatenate([band[lead_owner], band[lead_owner[low[lead_owner]]] - 1])
        order = np.argsort(both_owner, kind="stable")
        keys = mix(both + (tile + 1).astype(np.uint64) * np.uint64(GRAM))[order]
        # A flag for each bit of all bitmaps in a row.
        count = np.where(sizes > 0, 1 << np.ceil(np.log2(np.maximum(1, sizes * BITS_PER_SHINGLE / 64))).astype(np.int64), 0)
        base = np.concatenate([[0], np.cumsum(count)]) * 64
        flags = np.zeros(base[-1], bool)
        flags[base[owner] + (hashes & (count[owner] * 64 - 1).astype(np.uint64)).astype(np.int64)] = True
        bits = np.packbits(flags, bitorder="little").view("<u8")
        made[0].append(pa.array(sizes, pa.int64()))
        made[1].append(pa.array(node.view(np.int64), mask=sizes == 0))
        made[2].append(_lists(keys, np.bincount(both_owner, minlength=rows)))
        made[3].append(_lists(bits, count))
    kinds = [pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64())]
    return [pa.chunked_array(x, kind).combine_chunks() if x else pa.array([], kind) for x, kind in zip(made, kinds, strict=True)]


def summaries(docs: DataFrame, text: str = "text", width: int = WIDTH, percent: int = PERCENT, into: str = "_set") -> DataFrame:
    """``docs`` plus a struct: size of the shingle set, its 64-bit name, its tiles and its bitmap. No shuffle."""
    frequent, bands = frequencies(docs, text, width), _band_starts()
    return annotate(docs, text, into, FIELDS, lambda: lambda texts: _summaries(texts, frequent, width, percent, bands))


def _sets(docs: DataFrame, text: str, width: int) -> DataFrame:
    """(node, shingles): every text's shingles as a sorted array. Texts without words are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, data, offsets in slices(batch.column(0)):
                hashes, owner = _shingles(data, offsets, width)
                hashes, owner = _distinct(hashes, np.zeros(len(hashes), np.int64), owner)
                sizes = np.bincount(owner, minlength=last - first)
                full = np.flatnonzero(sizes)
                if len(full):
                    begin = (np.cumsum(sizes) - sizes)[full]
                    names = _names(hashes, begin, sizes[full])
                    yield pa.RecordBatch.from_arrays([pa.array(names.view(np.int64)), _lists(hashes, sizes[full])], ["node", "shingles"])

    return docs.select(F.col(text)).mapInArrow(run, "node long, shingles array<long>")


def _enough(overlap: Column, sizes: Column, percent: int) -> Column:
    """Whether 100 overlaps reach ``percent`` unions."""
    return overlap * (100 + percent) >= sizes * percent


def _bound(a: str, b: str) -> Column:
    """At most so many shingles are in both sets: each bit that one bitmap alone has is a shingle of that set alone."""
    least = F.least(F.size(f"{a}.bits"), F.size(f"{b}.bits"))

    def fitted(side: str) -> Column:
        # A bitmap of twice the length folds by OR-ing its halves.
        bits = F.col(f"{side}.bits")
        folded = F.zip_with(F.slice(bits, F.lit(1), least), F.slice(bits, least + 1, least), lambda p, q: p.bitwiseOR(q))
        return F.when(F.size(bits) > least, folded).otherwise(bits)

    def alone(one: Column, other: Column) -> Column:
        counts = F.zip_with(one, other, lambda p, q: F.bit_count(p.bitwiseAND(F.bitwise_not(q))))
        return F.aggregate(counts, F.lit(0).cast("long"), lambda total, n: total + n)

    x, y = fitted(a), fitted(b)
    return F.least(F.col(f"{a}.n") - alone(x, y), F.col(f"{b}.n") - alone(y, x))


def _beside(tiles: DataFrame, pivot: str, percent: int) -> DataFrame:
    """(a, b) of the rows of each tile and its row ``pivot``, where sizes and places allow a link."""
    pairs = tiles.where(F.col("node") != F.col(f"{pivot}.node")).where(_in_reach("", f"{pivot}.", percent))
    return pairs.select(F.least("node", f"{pivot}.node").alias("a"), F.greatest("node", f"{pivot}.node").alias("b"))


def _within(tiles: DataFrame, by: list[str], percent: int, further: Column | None = None) -> DataFrame:
    """Pairs (x, y) of rows that agree in ``by`` and are in different components, where a link is possible."""
    x, y = (tiles.select(*by, F.struct(*[c for c in tiles.columns if c not in by]).alias(s)) for s in "xy")
    apart = (F.col("x.node") < F.col("y.node")) & (F.col("x.c") != F.col("y.c")) & _in_reach("x.", "y.", percent)
    return x.join(y, by).where(apart if further is None else apart & further)


def _in_parts(tiles: DataFrame, salts: range, percent: int) -> DataFrame:
    """(a, b) of rows that fall into one of a tile's random parts, of about four rows each, for each of ``salts``."""
    salted = tiles.select("key", "node", "n", "place", "c", "m", F.explode(F.lit(list(salts))).alias("salt"))
    part = F.pmod(F.xxhash64("salt", "key", "node"), F.ceil(F.col("m") / 4)).alias("part")
    by = ["key", "salt", "part"]
    return _names_of(_within(salted.select("key", "salt", part, "node", "n", "place", "c"), by, percent))


def _names_of(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("x.node").alias("a"), F.col("y.node").alias("b"))


def _in_reach(x: str, y: str, percent: int) -> Column:
    """Whether two sets may be linked whose first common shingle stands at these places: what follows it is all they share."""
    left = F.least(F.col(f"{x}n") - F.col(f"{x}place"), F.col(f"{y}n") - F.col(f"{y}place"))
    return _enough(left, F.col(f"{x}n") + F.col(f"{y}n"), percent)


def _bounded(pairs: DataFrame, maps: DataFrame, percent: int) -> DataFrame:
    """(a, b, sizes) of the distinct pairs that the bitmaps leave possible, stored."""
    sides = [maps.select(F.col("node").alias(name), F.struct("n", "bits").alias(f"_{name}")) for name in "ab"]
    sizes = F.col("_a.n") + F.col("_b.n")
    joined = pairs.distinct().join(sides[1], "b").join(sides[0], "a").where(_enough(_bound("_a", "_b"), sizes, percent))
    return stored(joined.select("a", "b", sizes.alias("sizes")), "jaccard-possible")


class _Sets:
    """Shingle arrays of the sets that were needed so far, read out of the texts when they are."""

    def __init__(self, docs: DataFrame, text: str, width: int):
        self.every, self.known = _sets(docs, text, width), None

    def of(self, possible: DataFrame) -> DataFrame:
        wanted = possible.select(F.explode(F.array("a", "b")).alias("node")).distinct()
        if self.known is not None:
            wanted = wanted.join(self.known, "node", "left_anti")
        wanted = stored(wanted, "jaccard-wanted")
        if self.known is None or not wanted.isEmpty():
            arrays = only_possible(self.every, ["node"], wanted).join(wanted, "node", "left_semi")
            arrays = stored(arrays.dropDuplicates(["node"]), "jaccard-sets")
            self.known = arrays if self.known is None else self.known.union(arrays)
        return self.known


def _exact(possible: DataFrame, sets: _Sets, percent: int) -> DataFrame:
    """(a, b) of the pairs that are links, stored."""
    arrays = sets.of(possible)
    a, b = (arrays.select(F.col("node").alias(x), F.col("shingles").alias(f"_{x}")) for x in "ab")
    overlap = F.size(F.array_intersect("_a", "_b")).cast("long")
    joined = possible.join(b, "b").join(a, "a").where(_enough(overlap, F.col("sizes"), percent))
    return stored(joined.select("a", "b"), "jaccard-links")


def _still_open(tiles: DataFrame, links: DataFrame) -> DataFrame:
    """Rows of tiles whose sets lie in several components, ``c`` being each set's component now."""
    found = components(links)
    named = tiles.join(found, "node", "left").withColumn("c", F.coalesce("label", "node")).select(*tiles.columns)
    named = stored(named, "jaccard-named")
    several = named.groupBy("key").agg(F.min("c").alias("low"), F.max("c").alias("high")).where("low != high").select("key")
    return stored(named.join(several, "key", "left_semi"), "jaccard-open")


def links(sets: DataFrame, docs: DataFrame, text: str = "text", width: int = WIDTH, percent: int = PERCENT, dense: int = DENSE) -> DataFrame:
    """Links (a, b) between names of sets whose closure is that of all links between different sets.

    ``sets`` are stored ``summaries`` of ``docs``.
    """
    full = sets.where("n > 0")
    # Tiles of the set's own band come first, then, in the same order, those of the band below.
    leading = F.col("n") - F.ceil(F.col("n") * percent / 100) + 1
    place = F.pmod(F.col("pos").cast("long"), leading).alias("place")
    postings = full.select("node", "n", F.posexplode("keys").alias("pos", "key")).select("key", "node", "n", place)
    shared = postings.groupBy("key").agg(F.min("node").alias("low"), F.max("node").alias("high")).where("low != high").select("key")
    shared = stored(shared, "jaccard-shared")
    # Most postings are nobody else's; the filter keeps them out of the shuffle.
    meeting = only_possible(postings, ["key"], shared).distinct()
    tiles = stored(meeting.join(shared, "key", "left_semi").withColumn("c", F.col("node")), "jaccard-tiles")
    members = stored(tiles.select("node").distinct(), "jaccard-members")
    maps = only_possible(full.select("node", "n", "bits"), ["node"], members)
    maps = stored(maps.join(members, "node", "left_semi").dropDuplicates(["node"]), "jaccard-maps")
    arrays = _Sets(docs, text, width)

    row = F.struct("node", "n", "place")
    about = tiles.groupBy("key").agg(F.count(F.lit(1)).alias("m"), F.min(row).alias("low"), F.max(row).alias("high"))
    sized = tiles.join(about, "key")
    crowded = stored(sized.where(F.col("m") > dense), "jaccard-crowded")
    # A small tile gives a bounded number of pairs a row.
    pairs = _names_of(_within(sized.where(F.col("m") <= dense).select(*tiles.columns), ["key"], percent))
    pairs = pairs.union(_beside(crowded, "low", percent)).union(_beside(crowded, "high", percent)).union(_in_parts(crowded, range(1), percent))
    found = _exact(_bounded(pairs, maps, percent), arrays, percent)
    if crowded.isEmpty():
        return found
    rest = _still_open(crowded.drop("low", "high"), found)
    found = found.union(_exact(_bounded(_in_parts(rest, range(1, 9), percent), maps, percent), arrays, percent))
    rest = _still_open(rest, found).join(maps.select("node", "bits"), "node")
    sizes = F.col("x.n") + F.col("y.n")
    apart = _within(rest, ["key"], percent, _enough(_bound("x", "y"), sizes, percent))
    pairs = apart.select(F.col("x.node").alias("a"), F.col("y.node").alias("b"), sizes.alias("sizes"))
    possible = stored(pairs.distinct(), "jaccard-possible")
    return found if possible.isEmpty() else found.union(_exact(possible, arrays, percent))


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """(key, n_shingles, component_id) for each row of ``docs``.

    component_id is the smallest key that links reach, NULL keys ignored; it is NULL where a component
    has only NULL keys. Texts without words, NULL included, are linked with nothing. Repeated rows stay
    repeated, and other columns do not matter. Sets are known by 64-bit hashes of shingles and names.
    """
    slim = docs.select(F.col(key).alias("_k"), F.col(text).alias("_t"))
    sets = stored(summaries(slim, "_t", width, percent).select("_k", "_set.*"), "jaccard-summaries")
    label = components(links(sets, slim, "_t", width, percent)).select("node", "label")
    owner = sets.where("n > 0").groupBy("node").agg(F.min("_k").alias("_least"))
    labelled = owner.join(label, "node", "left").withColumn("label", F.coalesce("label", "node"))
    smallest = labelled.groupBy("label").agg(F.min("_least").alias("_id"))
    known = stored(labelled.join(smallest, "label").select("node", "_id"), "jaccard-components")
    return sets.join(known, "node", "left").select(
        F.col("_k").alias(key), F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("_id")).otherwise(F.col("_k")).alias("component_id")
    )
