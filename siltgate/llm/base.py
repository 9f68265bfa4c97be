"""Helpers the text operators share: whole texts as numpy arrays, one result column per row."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from siltgate.plans.sizing import stored

# Texts are worked on in slices of about this many bytes; a longer text is a slice of its own.
SLICE_BYTES = 512 << 10
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
ODD = np.uint64(0x9E3779B97F4A7C15)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free_name(df: DataFrame, name: str) -> str:
    """``name``, or the first variant of it that no column has (case ignored)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, bytes, offsets) of consecutive whole texts; NULL is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.fill_null("").cast(pa.large_string())
    n = len(texts)
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + n + 1] if n else np.zeros(1, np.int64)
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
    start = 0
    while start < n:
        end = max(start + 1, int(np.searchsorted(offsets, offsets[start] + limit, "right")) - 1)
        end = min(end, n)
        yield start, end, data[offsets[start] : offsets[end]], offsets[start : end + 1] - offsets[start]
        start = end


def _plain_scan(df: DataFrame) -> bool:
    """Whether ``df`` reads files and at most narrows them, so that file and place name a row."""
    plan = df._jdf.queryExecution().analyzed()
    while plan.getClass().getSimpleName() in ("Project", "Filter", "SubqueryAlias"):
        plan = plan.children().apply(0)
    return plan.getClass().getSimpleName() == "LogicalRelation" and bool(df.inputFiles())


def with_row_ids(docs: DataFrame) -> tuple[DataFrame, list[Column]]:
    """``docs`` as a plain file scan, and columns (f, r) that name a row: its file and its place there.

    A scan that runs again finds the same ids, however it is split. Other frames are written first.
    """
    if not _plain_scan(docs):
        docs = stored(docs, "rows")
    return docs, [F.xxhash64("_metadata.file_path").alias("f"), F.col("_metadata.row_index").alias("r")]


def parts(batch: pa.RecordBatch, at: int, limit: int) -> Iterator[pa.RecordBatch]:
    """The rows of a batch in order, in parts of about ``limit`` bytes of column ``at``; a longer row is a part of its own."""
    column = batch.column(at)
    if pa.types.is_list(column.type):
        sizes, width = pc.list_value_length(column), column.type.value_type.bit_width // 8
    else:
        sizes, width = pc.binary_length(column), 1
    upto = np.cumsum(sizes.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)) * width
    start, done = 0, 0
    while start < batch.num_rows:
        end = max(start + 1, int(np.searchsorted(upto, done + limit, "right")))
        yield batch.slice(start, end - start)
        start, done = end, int(upto[end - 1])


def give_back() -> None:
    """Returns a task's freed memory to the system, since Spark's Python workers live on and the next stage's come beside them."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def annotate(
    df: DataFrame, text: str, name: str, fields: StructType, start: Callable[[], Callable[[pa.Array], list[pa.Array]]], limit: int | None = None
) -> DataFrame:
    """Every row and column of ``df`` plus a struct column computed from the whole text, without a shuffle.

    ``start`` runs once per task and returns what maps a batch of texts to the struct's arrays. With a
    ``limit``, a batch is worked on and sent on in parts of about so many bytes of text.
    """
    at = df.columns.index(text)
    schema = StructType([*df.schema.fields, StructField(name, fields)])
    names = [f.name for f in schema.fields]
    inner = fields.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = start()
        for part in batches if limit is None else (p for batch in batches for p in parts(batch, at, limit)):
            made = pa.StructArray.from_arrays(work(part.column(at)), inner)
            yield pa.RecordBatch.from_arrays([*part.columns, made], names)
        del work
        give_back()

    return df.mapInArrow(run, schema)


def one_thread() -> None:
    """Keeps numpy's matrix products on the task's own thread: Spark runs a task on each core, more threads spin in vain."""
    for path in Path(np.__file__).parent.with_name("numpy.libs").glob("*openblas*"):
        library = ctypes.CDLL(str(path))
        for name in ("scipy_openblas_set_num_threads64_", "scipy_openblas_set_num_threads", "openblas_set_num_threads64_", "openblas_set_num_threads"):
            if hasattr(library, name):
                getattr(library, name)(1)
                break


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    out = np.ones(n, np.uint64)
    if n > 1:
        out[1:] = np.uint64(base)
        np.multiply.accumulate(out, out=out)
    return out


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit numbers, one to one."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


BASE = 0x5851F42D4C957F2D
BASE_INVERSE = pow(BASE, -1, 1 << 64)


class Words:
    """The words of a slice of texts: bounds in bytes, text of each, and a 64-bit hash of each."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray):
        """``is_word``: for each byte value, whether it belongs to words. No word crosses texts."""
        inside = is_word[data]
        edge = np.empty(len(data) + 1, bool)
        edge[0] = edge[-1] = True
        np.not_equal(inside[1:], inside[:-1], out=edge[1:-1])
        edge[offsets] = True
        cuts = np.flatnonzero(edge)
        first = cuts[:-1][inside[cuts[:-1]]] if len(data) else cuts[:0]
        keep = inside[cuts[:-1]] if len(data) else np.zeros(0, bool)
        self.start, self.end = first, cuts[1:][keep] if len(data) else first
        # How many words end before each text begins.
        self.bounds = np.searchsorted(self.start, offsets, "left")
        self.data = data
        self._sums: tuple[np.ndarray, np.ndarray] | None = None
        self._letters: tuple[np.ndarray, np.ndarray, np.ndarray] | None = None

    def hashes(self) -> np.ndarray:
        return self.spans(self.start, self.end)

    def spans(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """A hash of the bytes from each ``start`` to its ``end``, the same wherever they stand."""
        n = len(self.data)
        if not n:
            return np.zeros(0, np.uint64)
        if self._sums is None:
            total = np.zeros(n + 1, np.uint64)
            np.cumsum((self.data.astype(np.uint64) + np.uint64(1)) * powers(BASE, n), out=total[1:])
            self._sums = total, powers(BASE_INVERSE, n)
        total, inverse = self._sums
        # Dividing by the power at the start makes the hash the same anywhere.
        return mix((total[end] - total[start]) * inverse[start] + (end - start).astype(np.uint64) * ODD)

    def beginnings(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Which words have ``n`` characters or more, and a hash of the first ``n`` of each."""
        if self._letters is None:
            letters = np.append(np.flatnonzero((self.data & 0xC0) != 0x80), len(self.data))
            first = np.searchsorted(letters, self.start)
            self._letters = letters, first, np.searchsorted(letters, self.end) - first
        letters, first, size = self._letters
        at = np.flatnonzero(size >= n)
        return at, self.spans(self.start[at], letters[first[at] + n])


GRAM = 0xD6E8FEB86659FD93


def grams(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of n neighbouring hashes; run i begins at i. Runs may cross texts: see ``whole``."""
    if len(hashes) < n:
        return np.zeros(0, np.uint64)
    out = hashes[: len(hashes) - n + 1].copy()
    for j in range(1, n):
        out *= np.uint64(GRAM)
        out += hashes[j : len(hashes) - n + 1 + j]
    return mix(out)


def whole(bounds: np.ndarray, n: int) -> np.ndarray:
    """For each run of n words whether it lies in one text."""
    total = int(bounds[-1])
    if total < n:
        return np.zeros(0, bool)
    ok = np.ones(total - n + 1, bool)
    for j in range(1, n):
        late = bounds[1:-1] - j
        late = late[(late >= 0) & (late < len(ok))]
        ok[late] = False
    return ok
