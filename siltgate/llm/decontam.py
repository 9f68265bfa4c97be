"""Benchmark passages inside documents, found by winnowing.

Hashes of k neighbouring words are winnowed: of each run of w such hashes only the smallest
stay. A shared span of at least k + w - 1 words holds a whole run, so both sides keep the same
hash inside it and no such span is missed. Documents' fingerprints are joined with those of the
benchmark, and each meeting is extended in both directions to the longest equal run of words.
"""

from __future__ import annotations

from collections.abc import Callable
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructType

from siltgate.llm.base import LOWER, Words, annotate, free_name, grams, slices, whole

WINDOW = 13
K = 8
# Benchmark text that one pass over the documents holds in each task; a larger benchmark takes more passes.
BLOCK_BYTES = 16 << 20
IS_WORD = np.ones(256, bool)
IS_WORD[:0x80] = False
IS_WORD[ord("0") : ord("9") + 1] = True
IS_WORD[ord("a") : ord("z") + 1] = True
SPAN = StructType().add("first", IntegerType()).add("after", IntegerType())
FIELDS = (
    StructType()
    .add("n_words", LongType())
    .add("n_hit", LongType())
    .add("items", ArrayType(StringType()))
    .add("spans", ArrayType(SPAN))
)
NONE = np.uint64(0xFFFFFFFFFFFFFFFF)


def _winnowed(hashes: np.ndarray, bounds: np.ndarray, window: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions and hashes of the k-grams that are smallest in some window of words; ties all stay."""
    full = whole(bounds, window)
    if not full.any():
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    g = grams(hashes, k)
    w = window - k + 1
    least = g[: len(full)].copy()
    for j in range(1, w):
        np.minimum(least, g[j : len(full) + j], out=least)
    keep = np.zeros(len(g), bool)
    for j in range(w):
        keep[j : len(full) + j] |= full & (g[j : len(full) + j] == least)
    at = np.flatnonzero(keep)
    return at, g[at]


class Items:
    """Fingerprints of some benchmark items, ready to be looked up."""

    def __init__(self, ids: list[str], texts: list[str | None], window: int = WINDOW, k: int = K):
        self.ids, self.window, self.k = np.array(ids, object), window, min(k, window)
        hashes, sizes = [np.zeros(0, np.uint64)], []
        for _, _, data, offsets in slices(pa.array(texts, pa.string())):
            words = Words(LOWER[data], offsets, IS_WORD)
            hashes.append(words.hashes())
            sizes.append(np.diff(words.bounds))
        self.hashes = np.concatenate(hashes)
        self.bounds = np.concatenate([[0], np.cumsum(np.concatenate(sizes))]) if sizes else np.zeros(1, np.int64)
        at, prints = _winnowed(self.hashes, self.bounds, window, self.k)
        order = np.argsort(prints, kind="stable")
        self.long = (prints[order], at[order])
        size = np.diff(self.bounds)
        self.short = {}
        for n in np.unique(size[(size > 0) & (size < window)]):
            which = np.flatnonzero(size == n)
            prints = grams(self.hashes, int(n))[self.bounds[which]]
            order = np.argsort(prints, kind="stable")
            self.short[int(n)] = (prints[order], which[order])

    @staticmethod
    def _meet(found: np.ndarray, table: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """All (index into found, value of the table) with equal hashes."""
        low = np.searchsorted(table[0], found, "left")
        count = np.searchsorted(table[0], found, "right") - low
        index = np.repeat(np.arange(len(found)), count)
        step = np.arange(len(index)) - np.repeat(np.cumsum(count) - count, count)
        return index, table[1][low[index] + step]

    def _runs(self, doc: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(first word, word after, item) of each longest run of equal words that is long enough."""
        at, prints = _winnowed(doc, bounds, self.window, self.k)
        index, q = self._meet(prints, self.long)
        p = at[index]
        doc_of = np.searchsorted(bounds, p, "right") - 1
        item = np.searchsorted(self.bounds, q, "right") - 1
        left, right = np.zeros(len(p), np.int64), np.full(len(p), self.k)
        room_left = np.minimum(p - bounds[doc_of], q - self.bounds[item])
        room_right = np.minimum(bounds[doc_of + 1] - p, self.bounds[item + 1] - q)
        live = np.flatnonzero(room_left > 0)
        while len(live):
            live = live[doc[p[live] - left[live] - 1] == self.hashes[q[live] - left[live] - 1]]
            left[live] += 1
            live = live[left[live] < room_left[live]]
        live = np.flatnonzero(room_right > right)
        while len(live):
            live = live[doc[p[live] + right[live]] == self.hashes[q[live] + right[live]]]
            right[live] += 1
            live = live[right[live] < room_right[live]]
        # The k words of a meeting are compared word by word too: equal hashes are not proof.
        same = left + right >= self.window
        for j in range(self.k):
            same &= doc[p + j] == self.hashes[q + j] if len(p) else True
        return (p - left)[same], (p + right)[same], item[same]

    def find(self, texts: pa.Array) -> list[pa.Array]:
        n_words, n_hit, item_lists, span_lists = [], [], [], []
        for first, last, data, offsets in slices(texts):
            words = Words(LOWER[data], offsets, IS_WORD)
            doc, bounds = words.hashes(), words.bounds
            starts, ends, items = self._runs(doc, bounds)
            for n, known in self.short.items():
                at = np.flatnonzero(whole(bounds, n))
                index, item = self._meet(grams(doc, n)[at] if len(at) else np.zeros(0, np.uint64), known)
                starts, ends = np.concatenate([starts, at[index]]), np.concatenate([ends, at[index] + n])
                items = np.concatenate([items, item])
            cover = np.zeros(len(doc) + 1, np.int64)
            np.add.at(cover, starts, 1)
            np.add.at(cover, ends, -1)
            hit = np.concatenate([[0], np.cumsum(np.cumsum(cover)[:-1] > 0)])
            n_words.append(np.diff(bounds))
            n_hit.append(hit[bounds[1:]] - hit[bounds[:-1]])
            doc_of = np.searchsorted(bounds, starts, "right") - 1
            by_doc: dict[int, set] = {}
            for d, s, e, i in zip(doc_of.tolist(), starts.tolist(), ends.tolist(), items.tolist(), strict=True):
                by_doc.setdefault(d, set()).add((s, e, i))
            for d in range(last - first):
                found = by_doc.get(d, ())
                item_lists.append(sorted({self.ids[i] for _, _, i in found}))
                spans: list[list[int]] = []
                for s, e, _ in sorted(found):
                    if spans and s <= spans[-1][1]:
                        spans[-1][1] = max(spans[-1][1], e)
                    else:
                        spans.append([s, e])
                base = int(bounds[d])
                span_lists.append([{"first": s - base, "after": e - base} for s, e in spans])
        flat = lambda parts: np.concatenate(parts) if parts else np.zeros(0, np.int64)
        kind = pa.list_(pa.struct([("first", pa.int32()), ("after", pa.int32())]))
        return [
            pa.array(flat(n_words), pa.int64()),
            pa.array(flat(n_hit), pa.int64()),
            pa.array(item_lists, pa.list_(pa.string())),
            pa.array(span_lists, kind),
        ]


def _start(ids: list[str], texts: list[str | None], window: int, k: int) -> Callable[[], Callable]:
    return lambda: Items(ids, texts, window, k).find


def _merged(parts: list[str]) -> Column:
    """One struct from those of several passes: spans united, items together."""
    spans = F.array_sort(F.flatten(F.array(*(F.col(f"{p}.spans") for p in parts))))

    def join(done: Column, span: Column) -> Column:
        last = F.try_element_at(done, F.lit(-1))
        longer = F.struct(last["first"].alias("first"), F.greatest(last["after"], span["after"]).alias("after"))
        return F.when(
            (F.size(done) > 0) & (span["first"] <= last["after"]),
            F.concat(F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))), F.array(longer)),
        ).otherwise(F.concat(done, F.array(span)))

    union = F.aggregate(spans, F.array().cast(ArrayType(SPAN)), join)
    items = F.array_sort(F.array_distinct(F.flatten(F.array(*(F.col(f"{p}.items") for p in parts)))))
    n_hit = F.aggregate(union, F.lit(0).cast("long"), lambda n, s: n + s["after"] - s["first"])
    return F.struct(F.col(f"{parts[0]}.n_words").alias("n_words"), n_hit.alias("n_hit"), items.alias("items"), union.alias("spans"))


def find_items(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    into: str = "_found",
    window: int = WINDOW,
    k: int = K,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``docs`` plus a struct ``into``: n_words, n_hit, items (ids as strings) and spans of hit words.

    A benchmark window is ``window`` neighbouring words of an item, or the whole of a shorter one; a
    document word inside an occurrence of a window is hit. Words compare by 64-bit hashes, never by
    one hash for many words. NULL and empty texts have no words, items without words no window, NULL
    ids the empty string; items that repeat an id count once. The benchmark is cut into blocks of
    ``block_bytes``; each is a pass that carries its block to the tasks, so the size of what travels is
    bounded whatever the benchmark's. Documents are never shuffled.
    """
    rows = benchmark.select(F.coalesce(F.col(item).cast("string"), F.lit("")).alias("id"), F.col(item_text).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, ceil(size / block_bytes))
    parts = []
    out = docs
    for n in range(blocks):
        mine = rows if blocks == 1 else rows.where(F.pmod(F.xxhash64("id", "text"), F.lit(blocks)) == n)
        held = mine.toArrow()
        parts.append(free_name(out, f"{into}{n}"))
        ids, texts = held.column("id").to_pylist(), held.column("text").to_pylist()
        out = annotate(out, text, parts[-1], FIELDS, _start(ids, texts, window, k))
    whole_result = F.col(parts[0]) if blocks == 1 else _merged(parts)
    return out.select(*docs.columns, whole_result.alias(into))


def is_contaminated(found: Column) -> Column:
    """At least one word in twenty is hit, and at least one."""
    return (found["n_hit"] > 0) & (20 * found["n_hit"] >= found["n_words"])
