"""Language identification by prediction by partial matching.

For each language a tree of byte contexts up to ORDER bytes long is counted. A byte is coded from
the longest context that has seen it; each shorter step costs an escape, whose probability is the
share of distinct followers among all (method C). After training the counts are frozen, so the
exact code length of a text is a sum over its byte grams; the language with the shortest code wins.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructType
from pyspark.sql.window import Window

from siltgate.llm.base import LOWER, annotate, slices

ORDER = 3
# Training text of a language, in bytes of whole documents: those with the smallest key hashes.
TRAINED_BYTES = 3 << 20
UNKNOWN = "und"
FIELDS = StructType().add("lang_pred", StringType()).add("score", DoubleType())
_HASH_BITS = 20


def _codes(data: np.ndarray, offsets: np.ndarray, order: int) -> np.ndarray:
    """The gram of order + 1 bytes that ends at each byte, as a number; before a text lie zero bytes."""
    low = LOWER[data].astype(np.uint32)
    at = np.arange(len(data)) - np.repeat(offsets[:-1], np.diff(offsets))
    out = low.copy()
    for j in range(1, order + 1):
        out[j:] |= np.where(at[j:] >= j, low[:-j], np.uint32(0)) << np.uint32(8 * j)
    return out


class Trees:
    """Frozen context trees of all languages, as costs in bits."""

    def __init__(self, grams: np.ndarray, counts: np.ndarray, langs: list[str], order: int = ORDER):
        """``grams``: distinct grams of order + 1 bytes, ascending; ``counts[g, l]``: how often language l has them."""
        self.langs, self.order = langs, order
        n_langs = len(langs)
        # levels[k]: the (k + 1)-byte grams, last byte lowest, with their costs; contexts[k]: the k-byte contexts.
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []
        self.contexts: list[tuple[np.ndarray, np.ndarray]] = []
        lower_cost = np.full((1, n_langs), 8.0)
        for k in range(order + 1):
            mask = np.uint64((1 << (8 * (k + 1))) - 1)
            keys, inverse = np.unique(grams.astype(np.uint64) & mask, return_inverse=True)
            seen = np.zeros((len(keys), n_langs))
            np.add.at(seen, inverse, counts)
            context, member = np.unique(keys >> np.uint64(8), return_inverse=True)
            total, distinct = np.zeros((len(context), n_langs)), np.zeros((len(context), n_langs))
            np.add.at(total, member, seen)
            np.add.at(distinct, member, seen > 0)
            with np.errstate(divide="ignore", invalid="ignore"):
                escape = np.where(total > 0, -np.log2(distinct / (total + distinct)), 0.0)
                direct = -np.log2(seen / (total + distinct)[member])
            if k:
                shorter = lower_cost[np.searchsorted(self.levels[-1][0], keys & np.uint64((1 << (8 * k)) - 1))]
            else:
                shorter = np.full((len(keys), n_langs), 8.0)
            cost = np.where(seen > 0, direct, escape[member] + shorter)
            self.levels.append((keys, cost))
            self.contexts.append((context, escape))
            lower_cost = cost
        keys, cost = self.levels[-1]
        self.keys, self.cost = keys.astype(np.uint32), cost.astype(np.float32)
        self.slot = np.full(1 << _HASH_BITS, -1, np.int32)
        self.slot[self._hash(self.keys)] = np.arange(len(self.keys))

    @staticmethod
    def _hash(codes: np.ndarray) -> np.ndarray:
        return (codes * np.uint32(0x9E3779B1)) >> np.uint32(32 - _HASH_BITS)

    def _unseen(self, codes: np.ndarray) -> np.ndarray:
        """Costs of grams that no language has whole: escapes down to a context that knows the byte."""
        out = np.zeros((len(codes), len(self.langs)))
        left = np.ones(len(codes), bool)
        for k in range(self.order, -1, -1):
            part = codes.astype(np.uint64) & np.uint64((1 << (8 * (k + 1))) - 1)
            keys, cost = self.levels[k]
            at = np.minimum(np.searchsorted(keys, part), max(len(keys) - 1, 0))
            known = left & (keys[at] == part if len(keys) else False)
            out[known] += cost[at[known]]
            left &= ~known
            context, escape = self.contexts[k]
            at = np.minimum(np.searchsorted(context, part >> np.uint64(8)), max(len(context) - 1, 0))
            escaped = left & (context[at] == part >> np.uint64(8) if len(context) else False)
            out[escaped] += escape[at[escaped]]
        out[left] += 8.0
        return out

    def bits(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Exact code length of each text under each language."""
        codes = _codes(data, offsets, self.order)
        at = self.slot[self._hash(codes)]
        missed = np.flatnonzero((at < 0) | (self.keys[at] != codes))
        # A slot holds one gram; the others of the slot are found by search.
        found = np.minimum(np.searchsorted(self.keys, codes[missed]), len(self.keys) - 1)
        there = self.keys[found] == codes[missed]
        at[missed[there]] = found[there]
        missed = missed[~there]
        rare, where = np.unique(codes[missed], return_inverse=True)
        costs = self._unseen(rare)
        out = np.zeros((len(offsets) - 1, len(self.langs)))
        at[missed] = 0
        for lang in range(len(self.langs)):
            each = self.cost[:, lang][at].astype(np.float64)
            each[missed] = costs[where, lang]
            total = np.concatenate([[0.0], np.cumsum(each)])
            out[:, lang] = total[offsets[1:]] - total[offsets[:-1]]
        return out


def gram_counts(sample: pa.Table, order: int) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """Distinct grams of a sample (text, lang) and how often each language has them."""
    langs = sorted(set(sample["lang"].to_pylist()))
    number = {lang: i for i, lang in enumerate(langs)}
    owner = np.array([number[x] for x in sample["lang"].to_pylist()], np.int64)
    keys, weights = [], []
    for first, last, data, offsets in slices(sample["text"].combine_chunks()):
        lang = np.repeat(owner[first:last], np.diff(offsets)).astype(np.uint64)
        found, count = np.unique(_codes(data, offsets, order).astype(np.uint64) | lang << np.uint64(32), return_counts=True)
        keys.append(found)
        weights.append(count)
    both, inverse = np.unique(np.concatenate(keys), return_inverse=True)
    total = np.bincount(inverse, np.concatenate(weights))
    grams, at = np.unique(both & np.uint64(0xFFFFFFFF), return_inverse=True)
    counts = np.zeros((len(grams), len(langs)))
    counts[at, (both >> np.uint64(32)).astype(np.int64)] = total
    return grams, counts, langs


def fit(labelled: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", trained_bytes: int = TRAINED_BYTES) -> Trees | None:
    """Trees from whole labelled texts, per language those with the smallest key hashes up to ``trained_bytes`` in all.

    The sample is bounded for each language; NULL texts and languages do not count. None if nothing is
    left. The number of languages is taken to be small (it is that of the label's values).
    """
    rows = labelled.where(F.col(text).isNotNull() & F.col(lang).isNotNull()).select(
        F.col(key).cast("string").alias("k"), F.col(lang).cast("string").alias("lang"), F.octet_length(text).cast("long").alias("n"), F.col(text).alias("text")
    ).where("n > 0")
    # Per language one number: which share of its rows, by hash, holds the wanted bytes with some to spare.
    sizes = rows.groupBy("lang").agg(F.sum("n").alias("bytes")).collect()
    if not sizes:
        return None
    total = F.try_element_at(F.create_map(*(F.lit(x) for row in sizes for x in (row["lang"], row["bytes"]))), F.col("lang"))
    drawn = F.shiftrightunsigned(F.xxhash64(F.lit(9), "k", "n"), 11).cast("double") / float(1 << 53)
    drawn_rows = rows.withColumn("h", drawn).where(F.col("h") * total < 1.5 * trained_bytes + (1 << 20))
    order = ["h", "k", "n"]
    ranked = drawn_rows.withColumn("r", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
    so_far = Window.partitionBy("lang").orderBy("r").rowsBetween(Window.unboundedPreceding, -1)
    sample = ranked.withColumn("before", F.coalesce(F.sum("n").over(so_far), F.lit(0))).where(F.col("before") < trained_bytes)
    held = sample.select("lang", "text").toArrow()
    return Trees(*gram_counts(held, ORDER)) if held.num_rows else None


def _no_letter(text: str) -> bool:
    return not any(c.isalpha() for c in text)


def _predictor(trees: Trees | None) -> Callable[[], Callable[[pa.Array], list[pa.Array]]]:
    def work(texts: pa.Array) -> list[pa.Array]:
        langs, scores = [], []
        for first, last, data, offsets in slices(texts):
            best, score = np.zeros(last - first, np.int64), np.zeros(last - first)
            if trees:
                bits = trees.bits(data, offsets)
                best = bits.argmin(axis=1)
                score = 1 / np.exp2(np.maximum(bits.min(axis=1)[:, None] - bits, -1000)).sum(axis=1)
            ascii_letter = (LOWER[data] >= 97) & (LOWER[data] <= 122)
            letters = np.concatenate([[0], np.cumsum(ascii_letter)])
            for i in range(last - first):
                plain = letters[offsets[i + 1]] > letters[offsets[i]]
                if not trees or not plain and _no_letter(data[offsets[i] : offsets[i + 1]].tobytes().decode("utf-8", "replace")):
                    langs.append(UNKNOWN)
                    score[i] = 0.0
                else:
                    langs.append(trees.langs[best[i]])
            scores.append(score)
        return [pa.array(langs, pa.string()), pa.array(np.concatenate(scores) if scores else [], pa.float64())]

    return lambda: work


def predict(docs: DataFrame, trees: Trees | None, text: str = "text", into: str = "_language") -> DataFrame:
    """``docs`` plus a struct ``into``: lang_pred and score, the language's share among all, given the code lengths.

    A NULL text, one without a letter, and any text if nothing was learned, is ``und`` with score 0.
    Equal code lengths go to the first language in alphabetical order. No shuffle; whole texts.
    """
    return annotate(docs, text, into, FIELDS, _predictor(trees))


def held_out(key: Column, parts: int, rest: int) -> Column:
    """Whether crc32 of the key as text, modulo ``parts``, is ``rest``; a NULL key is never held out."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % parts == rest, F.lit(False))
