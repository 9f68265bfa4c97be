"""Removal of byte strings that occur more than once, from suffix intervals merged over shards.

Merging the shards' transforms one symbol a round would pass over all bytes once for each of the
400 bytes that a match must have; see the README for figures. Here an interval of the merged order,
the suffixes that agree to some depth, is refined in few rounds of larger depth. Suffixes are sampled
where the text itself says so (the least hash of the next bytes nearby), so equal passages are sampled
alike wherever they stand. Each shard counts its own suffixes by interval, the shards' sizes are added, intervals of
one suffix are closed and the others refined: first by the bytes to the right of the sample, then by
those to its left and to full depth, last window by window where a match ends inside. The order
between intervals is never needed, so a hash names each instead of its rank.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, LongType, StringType, StructType

from siltgate.llm.base import BASE, BASE_INVERSE, ODD, mix, powers, slices, with_row_ids
from siltgate.plans.sizing import bounded, stored

LENGTH = 400
ANCHOR_BYTES = 16
# Bytes to the right of a sampled suffix in which every match of a window agrees: the first depth.
RIGHT = 64
# Suffixes of an interval that one task refines; larger intervals are refined by counts over all tasks.
TASK_SUFFIXES = 4096
# Bytes of windows that a task refines, about.
TASK_BYTES = 2 << 20
ROW = "f long, r long, first int, last int, interval long, whole long"


class Prefixes:
    """Hashes of any byte strings of a slice; equal strings have equal hashes in every slice."""

    def __init__(self, data: np.ndarray):
        n = len(data)
        self.total = np.zeros(n + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(BASE, n), out=self.total[1:])
        self.inverse = powers(BASE_INVERSE, n + 1)

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.total[end] - self.total[start]) * self.inverse[start] + (end - start).astype(np.uint64) * ODD)


def _ranges(first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index, value) of every number from first[i] to last[i]."""
    count = np.maximum(last - first + 1, 0)
    index = np.repeat(np.arange(len(first)), count)
    return index, first[index] + np.arange(len(index)) - np.repeat(np.cumsum(count) - count, count)


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each run of ``width`` values, from minima within blocks of that width."""
    n = len(values)
    padded = np.full(-(-n // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = values
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[: n - width + 1], ahead[width - 1 : n])


def sampled(data: np.ndarray, offsets: np.ndarray, length: int = LENGTH) -> dict[str, np.ndarray]:
    """Sampled suffixes of a slice and the windows that each stands for.

    A window of ``length`` bytes belongs to the position whose next bytes hash least (the first such)
    among those that leave RIGHT bytes of the window to their right; so equal windows have their sample
    at the same place. Rows: doc, first and last (window starts, all of them in the doc), interval (hash
    of RIGHT bytes at the sample) and whole (hash of all bytes of the row's windows).
    """
    n, reach = len(data), length - RIGHT
    inside = np.zeros(n + 1, np.int64)
    np.add.at(inside, offsets[:-1], 1)
    np.add.at(inside, np.maximum(offsets[:-1], offsets[1:] - length + 1), -1)
    starts = np.flatnonzero(np.cumsum(inside)[:n] > 0)
    hashes = Prefixes(data)
    if not len(starts):
        nothing = np.zeros(0, np.int64)
        return {"doc": nothing, "first": nothing, "last": nothing, "interval": nothing.view(np.uint64), "whole": nothing.view(np.uint64)}
    spots = np.arange(n - ANCHOR_BYTES + 1)
    keys = (hashes.of(spots, spots + ANCHOR_BYTES) & np.uint64(0xFFFFFFFF00000000)) | spots.astype(np.uint64)
    at = (_least(keys, reach + 1)[starts] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    new = np.ones(len(starts), bool)
    new[1:] = (at[1:] != at[:-1]) | (starts[1:] != starts[:-1] + 1)
    head = np.flatnonzero(new)
    first, last, at = starts[head], starts[np.concatenate([head[1:] - 1, [len(starts) - 1]])], at[head]
    return {
        "doc": np.searchsorted(offsets, first, "right") - 1,
        "first": first,
        "last": last,
        "interval": hashes.of(at, at + RIGHT),
        "whole": hashes.of(first, last + length),
    }


def _suffix_rows(length: int):
    names = [x.split()[0] for x in ROW.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            f, r = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for start, _, data, offsets in slices(batch.column(2)):
                s = sampled(data, offsets, length)
                doc, base = s["doc"], offsets[s["doc"]]
                columns = [f[start + doc], r[start + doc], (s["first"] - base).astype(np.int32), (s["last"] - base).astype(np.int32),
                           s["interval"].view(np.int64), s["whole"].view(np.int64)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names)

    return run


def _shard_intervals(length: int):
    """A shard's intervals of the first depth with their sizes, from its own order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [sampled(data, offsets, length)["interval"] for _, _, data, offsets in slices(batch.column(0))]
            interval, size = np.unique(np.concatenate(parts) if parts else np.zeros(0, np.uint64), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(interval.view(np.int64)), pa.array(size)], ["interval", "size"])

    return run


def _window_rows(length: int):
    names = ["f", "r", "at", "window", "open"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            f, r = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            asked = batch.column(3)
            upto = np.array(asked.offsets)
            lists = asked.values
            first, last = (np.array(lists.field(i)).astype(np.int64) for i in (0, 1))
            is_open = np.array(lists.field(2))
            for start, end, data, offsets in slices(batch.column(2)):
                hashes = Prefixes(data)
                low, high = upto[start], upto[end]
                doc = np.repeat(np.arange(end - start), np.diff(upto[start : end + 1]))
                index, position = _ranges(first[low:high], last[low:high])
                owner = doc[index]
                where = position + offsets[owner]
                window = hashes.of(where, where + length).view(np.int64)
                columns = [f[start + owner], r[start + owner], position.astype(np.int32), window, is_open[low:high][index]]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names)

    return run


REGION = "interval long, f long, r long, first int, last int, open boolean, bytes binary"


def _regions(length: int):
    """The bytes of the asked windows of each row."""
    names = [x.split()[0] for x in REGION.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[list] = [[] for _ in names]
            f, r = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for i, (text, asked) in enumerate(zip(batch.column(2), batch.column(3), strict=True)):
                raw = text.as_py().encode()
                for one in asked.as_py():
                    made = (one["interval"], f[i], r[i], one["first"], one["last"], one["open"], raw[one["first"] : one["last"] + length])
                    for column, value in zip(rows, made, strict=True):
                        column.append(value)
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.bool_(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(rows, kinds, strict=True)], names)

    return run


def _repeated_here(length: int):
    """Which windows of open regions occur twice or more among all regions of a task.

    Equal windows have equal intervals, and all regions of an interval are in one task.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        table = pa.Table.from_batches(held)
        f, r, first, last, is_open = (table.column(i).to_numpy() for i in range(1, 6))
        raw = table.column(6).cast(pa.large_binary()).combine_chunks()
        begins = np.frombuffer(raw.buffers()[1], np.int64)[raw.offset : raw.offset + len(raw)]
        data = np.frombuffer(raw.buffers()[2], np.uint8)
        owner, position = _ranges(first.astype(np.int64), last.astype(np.int64))
        where = begins[owner] + position - first[owner]
        window = Prefixes(data).of(where, where + length)
        order = np.argsort(window, kind="stable")
        again = window[order][1:] == window[order][:-1]
        twice = np.zeros(len(window), bool)
        twice[order[1:][again]] = twice[order[:-1][again]] = True
        found = np.flatnonzero(twice & is_open[owner])
        # Neighbouring windows of a region become one range.
        head = np.ones(len(found), bool)
        head[1:] = (found[1:] != found[:-1] + 1) | (owner[found[1:]] != owner[found[:-1]])
        start = np.flatnonzero(head)
        end = np.concatenate([start[1:] - 1, [len(found) - 1]]) if len(found) else start
        mine = owner[found[start]]
        columns = [f[mine], r[mine], position[found[start]].astype(np.int32), position[found[end]].astype(np.int32)]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["f", "r", "first", "last"])

    return run


def repeated_windows(docs: DataFrame, text: str, length: int = LENGTH, task_suffixes: int = TASK_SUFFIXES) -> tuple[DataFrame, DataFrame]:
    """(file-backed docs, (f, r, starts)): per row the ranges (first, last) of window starts whose bytes occur elsewhere too."""
    docs, ids = with_row_ids(docs)
    source = docs.select(*ids, F.col(text).alias("t"))
    # First depth: RIGHT bytes after a sample. Shards' interval sizes are added; intervals of one suffix are closed.
    shards = docs.select(F.col(text).alias("t")).mapInArrow(_shard_intervals(length), "interval long, size long")
    open_1 = stored(shards.groupBy("interval").agg(F.sum("size").alias("size")).where("size > 1"), "open-intervals")
    # At most one in task_suffixes of all suffixes is such an interval. Its suffixes are open without a
    # look at the sizes, so they go anywhere; the others meet their interval's size.
    large = stored(open_1.where(F.col("size") > task_suffixes).select("interval", F.lit(True).alias("large")), "large-intervals")
    rows = source.mapInArrow(_suffix_rows(length), ROW).join(bounded(large), "interval", "left")
    rows = rows.withColumn("_dealt", F.when(F.col("large"), F.xxhash64("f", "r", "first")).otherwise(F.col("interval")))
    known = open_1.select(F.col("interval").alias("_dealt"), F.lit(True).alias("_open"))
    suffixes = stored(rows.join(known, "_dealt", "left").where("large OR _open").drop("large", "_dealt", "_open"), "suffixes")
    # Full depth, to both sides: all windows of the suffix at once.
    # Strings that repeat are stored apart from the join: a very frequent one can then be split over tasks.
    full = suffixes.groupBy("whole").agg(F.count(F.lit(1)).alias("size"), F.min(F.struct("f", "r", "first")).alias("one"))
    repeating = stored(full.where("size > 1").drop("size"), "repeating-strings")
    is_one = F.coalesce(F.col("one") == F.struct("f", "r", "first"), F.lit(False))
    judged = suffixes.join(repeating, "whole", "left").select("f", "r", "first", "last", "interval", F.col("one").isNotNull().alias("closed"), is_one.alias("is_one"))
    judged = stored(judged, "judged-suffixes")
    covered = judged.where("closed").select("f", "r", "first", "last")
    # Suffixes that part from their interval on the way: each of their windows by itself, against those of the
    # same interval and one of each string that is known to repeat.
    parted = judged.where("NOT closed")
    classes = parted.groupBy("interval").agg(F.count(F.lit(1)).alias("parted"))
    one_each = judged.where("is_one").join(classes, "interval", "left_semi")
    asked = parted.select("interval", "f", "r", "first", "last", F.lit(True).alias("open")).unionByName(
        one_each.select("interval", "f", "r", "first", "last", F.lit(False).alias("open"))
    )
    sizes = asked.groupBy("interval").agg(F.count(F.lit(1)).alias("members"))
    # An interval that kept one suffix has nothing to compare it with.
    asked = stored(asked.join(sizes.where("members > 1"), "interval"), "parted-suffixes")

    def with_text(some: DataFrame) -> DataFrame:
        per_row = some.groupBy("f", "r").agg(F.collect_list(F.struct("first", "last", "open", "interval")).alias("asked"))
        return source.join(per_row, ["f", "r"]).select("f", "r", "t", "asked")

    few, many = asked.where(F.col("members") <= task_suffixes), asked.where(F.col("members") > task_suffixes)
    found = covered
    size = few.agg(F.sum(F.col("last") - F.col("first") + length)).first()[0]
    if size:
        tasks = max(1, ceil(size / TASK_BYTES))
        regions = with_text(few).mapInArrow(_regions(length), REGION).repartition(tasks, "interval")
        found = found.unionByName(regions.mapInArrow(_repeated_here(length), "f long, r long, first int, last int"))
    if not many.isEmpty():
        # Counted over all tasks, so no interval is gathered anywhere.
        windows = stored(with_text(many).mapInArrow(_window_rows(length), "f long, r long, at int, window long, open boolean"), "windows")
        twice = windows.groupBy("window").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("window")
        single = windows.where("open").join(twice, "window", "left_semi")
        found = found.unionByName(single.select("f", "r", F.col("at").alias("first"), F.col("at").alias("last")))
    starts = found.groupBy("f", "r").agg(F.array_sort(F.collect_list(F.struct("first", "last"))).alias("starts"))
    return docs, starts


FIELDS = (
    StructType()
    .add("kept", BinaryType())
    .add("text", StringType())
    .add("n_bytes", LongType())
    .add("n_removed", LongType())
    .add("n_spans", LongType())
    .add("spans", ArrayType(StructType().add("first", IntegerType()).add("after", IntegerType())))
)


def _without(raw: bytes, spans: list[list[int]]) -> bytes:
    kept, at = [], 0
    for a, b in spans:
        kept.append(raw[at:a])
        at = max(at, b)
    kept.append(raw[at:])
    return b"".join(kept)


def _whole_characters(raw: bytes, spans: list[list[int]]) -> list[list[int]]:
    """The spans, widened to the bounds of the characters that they cut in two."""
    wide = []
    for a, b in spans:
        while a and raw[a] & 0xC0 == 0x80:
            a -= 1
        while b < len(raw) and raw[b] & 0xC0 == 0x80:
            b += 1
        wide.append([a, b])
    return wide


def _cutter(length: int, text_at: int, starts_at: int, schema: StructType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made: list[list] = [[] for _ in FIELDS.fields]
            texts, lists = batch.column(text_at), batch.column(starts_at)
            for value, starts in zip(texts, lists, strict=True):
                raw = (value.as_py() or "").encode()
                spans: list[list[int]] = []
                if starts.is_valid:
                    first = np.array(starts.values.field(0)).astype(np.int64)
                    after = np.array(starts.values.field(1)).astype(np.int64) + length
                    upto = np.maximum.accumulate(after) if len(after) else after
                    heads = np.flatnonzero(np.concatenate([[True], first[1:] > upto[:-1]])) if len(first) else []
                    tails = np.concatenate([heads[1:] - 1, [len(first) - 1]]) if len(first) else []
                    spans = [[int(first[h]), int(upto[t])] for h, t in zip(heads, tails, strict=True)]
                text = _without(raw, _whole_characters(raw, spans)).decode()
                row = (_without(raw, spans), text, len(raw), sum(b - a for a, b in spans), len(spans), [{"first": a, "after": b} for a, b in spans])
                for column, v in zip(made, row, strict=True):
                    column.append(v)
            kinds = [pa.binary(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.struct([("first", pa.int32()), ("after", pa.int32())]))]
            result = pa.StructArray.from_arrays([pa.array(c, k) for c, k in zip(made, kinds, strict=True)], FIELDS.names)
            keep = [c for i, c in enumerate(batch.columns) if i != starts_at]
            yield pa.RecordBatch.from_arrays([*keep, result], schema.names)

    return run


def remove_repeats(
    docs: DataFrame, text: str = "text", into: str = "_cut", length: int = LENGTH, task_suffixes: int = TASK_SUFFIXES
) -> DataFrame:
    """``docs`` plus a struct ``into``: kept bytes, the text of the characters kept whole, n_bytes, n_removed, n_spans and the removed byte spans.

    Removed is every byte covered by a string of ``length`` bytes that also starts anywhere else, in the
    same or another document; strings are judged on the input and never cross documents. NULL is empty;
    texts shorter than ``length`` keep all. Strings are told apart by 64-bit hashes with their lengths.
    Rows are named by file and place, so repeated rows and clashing columns do not matter; a frame that
    is no plain file scan is written first.
    """
    names = docs.columns
    docs, starts = repeated_windows(docs, text, length, task_suffixes)
    ids = with_row_ids(docs)[1]
    row = docs.select(*ids, F.struct(*names).alias("_row")).join(starts, ["f", "r"], "left")
    flat = row.select("_row.*", F.col("starts").alias("_starts_"))
    schema = StructType([*docs.select(*names).schema.fields]).add(into, FIELDS)
    return flat.mapInArrow(_cutter(length, names.index(text), len(names), schema), schema)

