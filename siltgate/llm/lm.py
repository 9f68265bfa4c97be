"""Log-probability of whole documents under a gated recurrent language model.

The model reads words; the most frequent ones and the end have outputs of their own, all other
words share one output and split its probability by their counts. Outputs are factored into
classes. Weights are learned in numpy by truncated backpropagation, in groups of documents side by
side whose weights are then averaged. A document is scored window by window, its state carried on.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from math import ceil, log10

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StringType, StructType

from siltgate.llm.base import LOWER, SPACE, annotate, one_thread, slices, with_row_ids
from siltgate.plans.sizing import stored

END = "\n"  # no word holds white space
CLASSES, SYMBOLS, HIDDEN = 72, 1 << 14, 16  # the last symbol stands for all words without an output
WINDOW = 32
# Words whose counts travel with the jobs; the counts of rarer words are joined.
FREQUENT = 1 << 16
# The weights are learned on all training documents, in ROUNDS parts.
TRAINED_SHARE, ROUNDS = 1.0, 2
GROUP_BYTES = 8 << 20
# Learned weights that travel as one row.
SENT = 512
# A group has at most LANES lanes, and fewer where it would otherwise take less than STEPS steps.
LANES, STEPS, RATE = 256, 16, 0.01
# Bytes of text whose words are counted at once.
COUNTED_BYTES = 16 << 20
# Bytes of text whose documents are scored side by side.
SIDE_BY_SIDE = 8 << 20
# Tokens whose class outputs are worked on at once, so that they stay in a core's cache.
AT_ONCE = 1024
# Weights that Adam works on at once, for the same reason.
PART = 1 << 13
# Documents that are scored in one step, for the same reason.
ABREAST = 512
# Outputs within this of 0 can be raised in single precision as they are.
SAFE = 60.0
PSEUDO = 0.1
RARE = StructType().add("word", StringType()).add("n", LongType())
FIELDS = (
    StructType()
    .add("n_tokens", LongType())
    .add("n_known", LongType())
    .add("log_count", DoubleType())
    .add("log_rest", DoubleType())
    .add("n_rest", LongType())
    .add("log_model", DoubleType())
    .add("rare", ArrayType(RARE))
)


def word_counts(docs: DataFrame, text: str) -> DataFrame:
    """(word, c) over whole texts without case in A-Z, the end of each included. Tasks add up first, so no word is hot."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ends, size, seen = 0, 0, []

        def out() -> pa.RecordBatch:
            each = pa.chunked_array(seen, pa.large_binary()).value_counts()
            seen.clear()
            return pa.RecordBatch.from_arrays([each.field(0).cast(pa.binary()).cast(pa.string()), each.field(1)], ["word", "c"])

        for batch in batches:
            for _, _, data, offsets in slices(batch.column(0), COUNTED_BYTES):
                seen.append(_words(data, offsets)[0])
                size += len(data)
                if size >= COUNTED_BYTES:
                    yield out()
                    size = 0
            ends += batch.num_rows
        yield out()
        yield pa.RecordBatch.from_arrays([pa.array([END]), pa.array([ends], pa.int64())], ["word", "c"])

    return docs.select(text).mapInArrow(count, "word string, c long").where("c > 0").groupBy("word").agg(F.sum("c").alias("c"))


def _words(data: np.ndarray, offsets: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """All words of a slice in order, lower-cased, and how many there are up to the end of each text.

    Texts meet without a space between, so a word also ends where its text does.
    """
    inside = ~SPACE[data]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    meet = offsets[1:-1]
    meet = meet[(meet > 0) & (meet < len(data))]
    first[meet], last[meet - 1] = inside[meet], inside[meet - 1]
    at = np.flatnonzero(first)
    upto = np.concatenate([[0], np.cumsum(np.flatnonzero(last) - at + 1)]).astype(np.int64)
    words = pa.Array.from_buffers(pa.large_binary(), len(at), [None, pa.py_buffer(upto), pa.py_buffer(LOWER[data[inside]])])
    return words, np.searchsorted(at, offsets[1:])


def _places(words: pa.Array, known: pa.Array) -> np.ndarray:
    """The place of each word in ``known``, -1 where it is not there."""
    return pc.index_in(words, value_set=known).fill_null(-1).to_numpy()


@dataclass
class Vocabulary:
    """Counts of the frequent words, the most frequent first, and the totals of all."""

    frequent: dict[bytes, int]
    counts: np.ndarray
    total: int
    distinct: int

    def __post_init__(self):
        own = [w for w in self.frequent if w != END.encode()][: SYMBOLS - 2]
        self.symbol = {w: i + 1 for i, w in enumerate(own)} | {END.encode(): 0}
        self.rest_total = self.total - sum(int(self.counts[self.frequent[w]]) for w in self.symbol if w in self.frequent)
        self.rest_distinct = self.distinct - sum(w in self.frequent for w in self.symbol)
        self.own_counts = np.ones(SYMBOLS)
        for w, i in self.symbol.items():
            if w in self.frequent:
                self.own_counts[i] += self.counts[self.frequent[w]]
        self.own_counts[-1] += max(self.rest_total, 0)


def vocabulary(counted: DataFrame, frequent: int = FREQUENT) -> Vocabulary:
    """From (word, c): the ``frequent`` largest counts, which is the bound of what is collected, the end's and the totals."""
    total, distinct, ends = counted.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1)), F.sum(F.when(F.col("word") == END, F.col("c")))).first()
    top = counted.orderBy(F.desc("c"), "word").limit(frequent).toArrow()
    words, counts = [w.encode() for w in top["word"].to_pylist()], top["c"].to_numpy()
    if ends and END.encode() not in words:
        # The end never enters the join of rare words, so its count is here whatever its rank.
        words, counts = [*words, END.encode()], np.append(counts, ends)
    return Vocabulary({w: i for i, w in enumerate(words)}, counts, int(total), int(distinct))


def _class_starts() -> np.ndarray:
    """First symbol of each class. The end and the shared output are classes of their own, tokens there need no second softmax.

    The classes between grow with the root of the rank: where a word's frequency falls with its rank,
    that makes the mean size of a token's class the least.
    """
    n = CLASSES - 2
    grown = ((SYMBOLS - 2) * (np.arange(n + 1) / n) ** 2).astype(np.int64)
    return np.concatenate([[0], 1 + np.maximum(grown, np.arange(n + 1)), [SYMBOLS]])


START = _class_starts()
KIND = np.repeat(np.arange(CLASSES), np.diff(START))
# Symbols of a class of several.
SEVERAL = np.diff(START)[KIND] > 1
SHAPES = {
    "embed": (SYMBOLS, HIDDEN), "read": (HIDDEN, 3 * HIDDEN), "bias": (3 * HIDDEN,), "recur": (HIDDEN, 3 * HIDDEN),
    "classes": (HIDDEN, CLASSES), "class_bias": (CLASSES,), "words": (SYMBOLS, HIDDEN), "word_bias": (SYMBOLS,),
}


def initial(own_counts: np.ndarray) -> dict[str, np.ndarray]:
    """Small random weights from a fixed seed; the output biases are the log frequencies."""
    rng = np.random.default_rng(10)
    out = {k: (rng.standard_normal(s) * 0.1).astype(np.float32) for k, s in SHAPES.items()}
    by_class = np.add.reduceat(own_counts, START[:-1])
    out["bias"][:] = 0
    out["class_bias"] = np.log(by_class / by_class.sum()).astype(np.float32)
    out["word_bias"] = np.log(own_counts / by_class[KIND]).astype(np.float32)
    return out


def _step(table: np.ndarray, recur: np.ndarray, h: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, ...]:
    """The next state after reading ``ids``, and what backpropagation needs. ``table``: embed @ read + bias.

    Gates and states are kept features first, so that each gate lies in one piece; the next state is a
    view of that, and so should ``h`` be. What backpropagation needs stays features first.
    """
    a, u = np.ascontiguousarray(table.take(ids, axis=0).T), recur.T @ h.T
    gates = a[: 2 * HIDDEN]
    gates += u[: 2 * HIDDEN]
    np.negative(gates, out=gates)
    np.exp(gates, out=gates)
    gates += 1
    np.reciprocal(gates, out=gates)
    z, r, u = gates[:HIDDEN], gates[HIDDEN:], u[2 * HIDDEN :]
    n = r * u
    n += a[2 * HIDDEN :]
    np.tanh(n, out=n)
    after = h.T - n
    after *= z
    after += n
    return after.T, z, r, n, u


def _by_symbol(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order that brings equal symbols, and so the symbols of a class, together, and the symbols in it."""
    order = np.argsort(ids.astype(np.uint16), kind="stable")
    return order, ids[order]


def _reach(weights: np.ndarray, bias: np.ndarray | float = 0.0, state: float = 1.0) -> float:
    """No output is further from 0 than this where no part of the state is further than ``state``."""
    return float((state * (np.abs(weights) @ np.ones(weights.shape[1], weights.dtype)) + np.abs(bias)).max())


def _log_softmax(x: np.ndarray, target: np.ndarray, reach: float) -> tuple[np.ndarray, np.ndarray]:
    """Log probability of each row's target, and each row's total; ``x`` is used up and becomes the unnormalised probabilities.

    ``reach`` is that of the outputs; small ones need not be shifted before they are raised.
    """
    if not reach < SAFE:
        x -= x.max(axis=1, keepdims=True)
    hit = x[np.arange(len(x)), target]
    np.exp(x, out=x)
    total = x @ np.ones(x.shape[1], x.dtype)
    return hit - np.log(total), total


def _by_class(ordered: np.ndarray) -> Iterator[tuple[int, int, slice]]:
    """(first symbol, symbol after the last, where) of each class of several symbols that the sorted symbols meet."""
    cuts = np.searchsorted(ordered, START)
    for c in range(CLASSES):
        if cuts[c + 1] > cuts[c] and START[c + 1] - START[c] > 1:
            yield START[c], START[c + 1], slice(cuts[c], cuts[c + 1])


def log_probability(w: dict[str, np.ndarray], states: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Natural log probability of each symbol, given the state before it."""
    order, ordered = _by_symbol(ids)
    kind, rows, found = KIND[ordered], states.take(order, axis=0), np.zeros(len(ids), w["classes"].dtype)
    size = float(np.abs(states).max(initial=0))
    reach = _reach(w["classes"].T, w["class_bias"], size)
    for i in range(0, len(ids), AT_ONCE):
        part = slice(i, i + AT_ONCE)
        found[part] = _log_softmax(rows[part] @ w["classes"] + w["class_bias"], kind[part], reach)[0]
    reach = _reach(w["words"], w["word_bias"], size)
    for a, b, at in _by_class(ordered):
        off = rows[at] @ w["words"][a:b].T
        off += w["word_bias"][a:b]
        found[at] += _log_softmax(off, ordered[at] - a, reach)[0]
    out = np.empty_like(found)
    out[order] = found
    return out


def _adam(x: np.ndarray, g: np.ndarray, m: np.ndarray, v: np.ndarray, lanes: int, step: int, rate: float) -> None:
    """One step of Adam on ``x``, ``m`` and ``v`` in place; ``g`` is used up. In parts that stay in a core's cache."""
    small = (1 - 0.999**step) ** 0.5
    scale, least = rate * small / (1 - 0.9**step), 1e-8 * small
    x, g, m, v = (one.reshape(-1) for one in (x, g, m, v))
    for i in range(0, len(x), PART):
        xs, gs, ms, vs = (one[i : i + PART] for one in (x, g, m, v))
        gs *= 1 / lanes
        np.clip(gs, -1, 1, out=gs)
        t = gs - ms
        t *= 0.1
        ms += t
        gs *= gs
        gs -= vs
        gs *= 0.001
        vs += gs
        np.sqrt(vs, out=t)
        t += least
        np.divide(ms, t, out=t)
        t *= scale
        xs -= t


def train(w: dict[str, np.ndarray], ids: np.ndarray, rate: float = RATE) -> tuple[dict[str, np.ndarray], float]:
    """One pass of truncated backpropagation over a stream of symbols that 0 ends documents in; (weights, mean loss).

    The stream is cut into lanes that run side by side in windows; states pass from window to window
    and start anew after an end, gradients stop at the window. Adam takes the steps. Outputs are worked
    on in the order of the symbols, so those of a class lie together; an output's bias is one more
    column of its weights and meets a one beside the state.
    """
    w = {k: v.copy() for k, v in w.items()}
    lanes = max(1, min(LANES, len(ids) // (STEPS * WINDOW)))
    length = len(ids) // lanes
    if not length:
        return w, 0.0
    stream = ids[: lanes * length].reshape(lanes, length).T
    float_ = w["embed"].dtype
    w["classes"] = np.ascontiguousarray(np.column_stack([w["classes"].T, w.pop("class_bias")]))
    w["words"] = np.column_stack([w["words"], w.pop("word_bias")])
    first, second = ({k: np.zeros_like(v) for k, v in w.items()} for _ in range(2))
    h, loss, step = np.zeros((HIDDEN, lanes), float_).T, 0.0, 0

    for at in range(0, length, WINDOW):
        step += 1
        window = np.ascontiguousarray(stream[at : at + WINDOW])
        # Only the symbols that the window reads are looked up, and only their rows change.
        flat = window.ravel()
        order, ordered = _by_symbol(flat)
        heads = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1]))
        own, spot = ordered[heads], np.empty(len(flat), np.intp)
        rank = np.repeat(np.arange(len(own)), np.diff(np.append(heads, len(flat))))
        spot[order] = rank
        embedded, spot = w["embed"][own], spot.reshape(window.shape)
        table = embedded @ w["read"] + w["bias"]
        states, kept = [], []
        before = np.ones((*window.shape, HIDDEN + 1), float_)
        for t, read in enumerate(window):
            states.append(h.T)
            before[t, :, :HIDDEN] = h
            after, *needed = _step(table, w["recur"], h, spot[t])
            kept.append(needed)
            h = (after.T * (read != 0)).T
        rows, kind = before.reshape(-1, HIDDEN + 1).take(order, axis=0), KIND[ordered]
        pulled = np.empty((len(flat), HIDDEN), float_)
        grad = {k: np.zeros_like(w[k]) for k in ("classes", "words")}
        # First the gradients by what is predicted, then those by what was met.
        reach = _reach(w["classes"])
        for i in range(0, len(flat), AT_ONCE):
            part = slice(i, i + AT_ONCE)
            off = rows[part] @ w["classes"].T
            found, total = _log_softmax(off, kind[part], reach)
            loss -= float(found.sum())
            share = (1 / total)[:, None]
            pulled[part] = off @ w["classes"][:, :HIDDEN]
            pulled[part] *= share
            grad["classes"] += off.T @ (rows[part] * share)
        reach = _reach(w["words"])
        for a, b, where in _by_class(ordered):
            off = rows[where] @ w["words"][a:b].T
            found, total = _log_softmax(off, ordered[where] - a, reach)
            loss -= float(found.sum())
            share = (1 / total)[:, None]
            grad["words"][a:b] = off.T @ (rows[where] * share)
            off = off @ w["words"][a:b, :HIDDEN]
            off *= share
            pulled[where] += off
        met, several, of = np.add.reduceat(rows, heads, axis=0), SEVERAL[own], KIND[own]
        grad["words"][own[several]] -= met[several]
        firsts = np.flatnonzero(np.append(True, of[1:] != of[:-1]))
        grad["classes"][of[firsts]] -= np.add.reduceat(met, firsts, axis=0)
        wanted = w["classes"][of, :HIDDEN] + w["words"][own, :HIDDEN] * several[:, None]
        pulled -= wanted.take(rank, axis=0)
        down = np.empty_like(pulled)
        down[order] = pulled
        down = down.reshape(*window.shape, HIDDEN)
        # Of each place, the gradients by n's input, those of z and r, and n's by the state before it:
        # the first three are those by what was read, the last three those by the state.
        pull, back = np.empty((4 * HIDDEN, *window.shape), float_), np.zeros((HIDDEN, lanes), float_)
        for t in range(len(window) - 1, -1, -1):
            z, r, n, u = kept[t]
            n_in, z_in, r_in, by_state = pull[:, t].reshape(4, HIDDEN, lanes)
            back *= window[t] != 0
            left = 1 - z
            left *= back
            np.subtract(states[t], n, out=z_in)
            z_in *= z
            z_in *= left
            n *= n
            np.subtract(1, n, out=n)
            np.multiply(left, n, out=n_in)
            np.multiply(n_in, r, out=by_state)
            np.subtract(1, r, out=left)
            left *= u
            np.multiply(left, by_state, out=r_in)
            back *= z
            back += w["recur"] @ pull[HIDDEN:, t]
            back += down[t].T
        pull = pull.reshape(4 * HIDDEN, -1)
        by_read = pull[: 3 * HIDDEN]
        grad["recur"] = np.ascontiguousarray((pull[HIDDEN:] @ before.reshape(-1, HIDDEN + 1)[:, :HIDDEN]).T)
        grad["read"] = np.roll((by_read @ embedded.take(spot.ravel(), axis=0)).T, -HIDDEN, axis=1)
        grad["bias"] = np.roll(by_read.sum(axis=1), -HIDDEN)
        by_place = by_read.T @ np.roll(w["read"], HIDDEN, axis=1).T
        by_symbol = np.add.reduceat(by_place.take(order, axis=0), heads, axis=0)
        m, v = first["embed"][own], second["embed"][own]
        _adam(embedded, by_symbol, m, v, lanes, step, rate)
        w["embed"][own], first["embed"][own], second["embed"][own] = embedded, m, v
        for k, g in grad.items():
            _adam(w[k], g, first[k], second[k], lanes, step, rate)
    for k, bias in (("classes", "class_bias"), ("words", "word_bias")):
        w[k], w[bias] = w[k][:, :HIDDEN].copy(), w[k][:, HIDDEN].copy()
    w["classes"] = np.ascontiguousarray(w["classes"].T)
    return w, loss / (lanes * length)


def _flat(w: dict[str, np.ndarray]) -> np.ndarray:
    return np.concatenate([w[k].ravel() for k in SHAPES])


def _shaped(flat: np.ndarray) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for k, shape in SHAPES.items():
        n = int(np.prod(shape))
        out[k] = flat[at : at + n].reshape(shape).astype(np.float32)
        at += n
    return out


def _learner(weights: dict[str, np.ndarray], symbol: dict[bytes, int]) -> Callable[[pd.DataFrame], pd.DataFrame]:
    known, numbers = pa.array(list(symbol), pa.large_binary()), np.array([*symbol.values(), SYMBOLS - 1], np.int32)

    def learn(rows: pd.DataFrame) -> pd.DataFrame:
        one_thread()
        parts: list[np.ndarray] = []
        for _, _, data, offsets in slices(pa.array(rows["text"].sort_values(), pa.large_string()), GROUP_BYTES):
            words, upto = _words(data, offsets)
            parts.append(np.insert(numbers[_places(words, known)], upto, 0))
        ids = np.concatenate(parts)
        learned, _ = train(weights, ids)
        flat = _flat(learned)
        starts = range(0, len(flat), SENT)
        return pd.DataFrame({"block": range(len(starts)), "w": [flat[i : i + SENT] for i in starts], "n": float(len(ids))})

    return learn


def _mean(rows: pd.DataFrame) -> pd.DataFrame:
    """A block of weights, averaged over the groups by their number of words."""
    n = rows["n"].to_numpy()
    mean = n @ np.stack(rows["w"].to_list()).astype(np.float64) / n.sum()
    return pd.DataFrame({"block": rows["block"].iloc[:1].to_numpy(), "w": [mean]})


def fit(docs: DataFrame, vocab: Vocabulary, key: str, text: str, share: float = TRAINED_SHARE, rounds: int = ROUNDS) -> dict[str, np.ndarray] | None:
    """Weights from all of ``docs``, or a ``share`` of them drawn by hash; None if there is no word to learn.

    Each round takes its part of the share, cuts it into groups of about GROUP_BYTES, learns in each
    group from the same weights and averages the results by the number of words. A group is a task;
    the driver only ever holds one set of weights.
    """
    if not vocab.total:
        return None
    # The place in the file is hashed too, so that repeated rows and rows without a key spread over the groups.
    docs, (_, place) = with_row_ids(docs)
    drawn = F.shiftrightunsigned(F.xxhash64(F.lit(10), F.col(key).cast("string"), F.octet_length(text), place), 11).cast("double") / float(1 << 53)
    picked = docs.where(F.col(text).isNotNull()).select(F.col(text).alias("text"), (drawn / share).alias("h")).where("h < 1")
    weights = initial(vocab.own_counts)
    for turn in range(rounds):
        part = picked.where(F.floor(F.col("h") * rounds) == turn)
        size = part.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        groups = max(1, ceil(size / GROUP_BYTES))
        grouped = part.withColumn("g", F.pmod(F.xxhash64("h"), F.lit(groups))).groupBy("g").applyInPandas(_learner(weights, vocab.symbol), "block int, w array<float>, n double")
        moved = grouped.groupBy("block").applyInPandas(_mean, "block int, w array<double>").toArrow().sort_by("block")
        if moved.num_rows:
            weights = _shaped(pc.list_flatten(moved["w"]).to_numpy())
    return weights


def _score_slice(w: dict[str, np.ndarray], table: np.ndarray, docs: list[np.ndarray]) -> np.ndarray:
    """Natural log probability of each document's symbols; documents run side by side, longest first."""
    sizes = np.array([len(d) for d in docs], np.int64)
    order = np.argsort(-sizes, kind="stable")
    sizes = sizes[order]
    out = np.zeros(len(docs))
    if not sizes.sum():
        return out
    flat = np.concatenate([docs[i] for i in order])
    starts = np.cumsum(sizes) - sizes
    held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    n_held = 0

    def flush() -> None:
        nonlocal n_held
        if held:
            states, ids, owner = (np.concatenate(x) for x in zip(*held, strict=True))
            out[:] += np.bincount(owner, log_probability(w, states, ids), minlength=len(docs))
            held.clear()
            n_held = 0

    for first in range(0, len(docs), ABREAST):
        lanes = slice(first, first + ABREAST)
        h = np.zeros((HIDDEN, len(sizes[lanes])), table.dtype).T
        for at in range(0, int(sizes[first]), WINDOW):
            live = int(np.searchsorted(-sizes[lanes], -at, "left"))
            width = min(WINDOW, int(sizes[first]) - at)
            places = np.arange(at, at + width)[:, None]
            # Past a document's end any symbol is read, and what comes of it is dropped.
            ids = flat[np.minimum(starts[lanes][:live] + places, len(flat) - 1)]
            h, states = np.ascontiguousarray(h.T[:, :live]).T, np.empty((width, live, HIDDEN), table.dtype)
            for t in range(width):
                states[t] = h
                h = _step(table, w["recur"], h, ids[t])[0]
            valid = places < sizes[lanes][:live]
            held.append((states[valid], ids[valid], np.broadcast_to(order[lanes][:live], valid.shape)[valid]))
            n_held += len(held[-1][1])
            if n_held > 1 << 15:
                flush()
    flush()
    return out


def _scorer(vocab: Vocabulary, w: dict[str, np.ndarray] | None) -> Callable[[], Callable[[pa.Array], list[pa.Array]]]:
    def start():
        one_thread()
        table = w["embed"] @ w["read"] + w["bias"] if w else None
        # Frequent words and the end, each with its log count and its symbol; -1 is any other word.
        known = pa.array(list(vocab.frequent), pa.large_binary())
        logs = np.log10(np.append(vocab.counts, 0) + PSEUDO)
        symbols = np.array([*(vocab.symbol.get(word, SYMBOLS - 1) for word in vocab.frequent), SYMBOLS - 1], np.int32)
        end = vocab.frequent.get(END.encode(), -1)

        def work(texts: pa.Array) -> list[pa.Array]:
            out: list[list] = [[] for _ in range(6)]
            rare_words, rare_counts, rare_upto = [pa.array([], pa.large_binary())], [np.zeros(0, np.int64)], [np.zeros(1, np.int64)]
            for first, last, data, offsets in slices(texts, SIDE_BY_SIDE):
                words, upto = _words(data, offsets)
                at = _places(words, known)
                # Of each document, its rare words and how often they are there.
                rare = np.flatnonzero(at < 0)
                coded = words.take(pa.array(rare)).dictionary_encode()
                owner = np.searchsorted(upto, rare, "right")
                pair, n = np.unique(owner * max(1, len(coded.dictionary)) + coded.indices.to_numpy(), return_counts=True)
                owner, word = np.divmod(pair, max(1, len(coded.dictionary)))
                rare_words.append(coded.dictionary.take(pa.array(word)))
                rare_counts.append(n)
                rare_upto.append(rare_upto[-1][-1] + np.searchsorted(owner, np.arange(last - first), "right"))
                # The end is one more token of each document, so none is without tokens.
                at = np.insert(at, upto, end)
                ends = upto + np.arange(len(upto))
                starts = np.append(0, ends[:-1] + 1)
                symbol = symbols[at]
                symbol[ends] = 0
                frequent, rest = at >= 0, symbol == SYMBOLS - 1
                log = np.where(frequent, logs[at], 0.0)
                counted = np.add.reduceat(log, starts) + (0.0 if end >= 0 else log10(PSEUDO))
                model = _score_slice(w, table, np.split(symbol, starts[1:])) / np.log(10) if w else np.zeros(last - first)
                made = [ends - starts + 1, np.add.reduceat(frequent, starts, dtype=np.int64), counted, np.add.reduceat(log * rest, starts), np.add.reduceat(rest, starts, dtype=np.int64), model]
                for column, values in zip(out, made, strict=True):
                    column.append(values)
            kinds = [pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.int64(), pa.float64()]
            rare_pairs = pa.StructArray.from_arrays([pa.concat_arrays(rare_words).cast(pa.binary()).cast(pa.string()), pa.array(np.concatenate(rare_counts))], ["word", "n"])
            rare = pa.ListArray.from_arrays(pa.array(np.concatenate(rare_upto).astype(np.int32)), rare_pairs)
            return [*(pa.array(np.concatenate(x) if x else [], k) for x, k in zip(out, kinds, strict=True)), rare]

        return work

    return start


def score(docs: DataFrame, training: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without ``text`` plus n_tokens, n_known, train_tokens, base_score and score, learning from ``training``.

    base_score is the log10 probability under smoothed counts of all training words; score that of the
    recurrent model, in which a word without an output of its own has the shared output's probability
    times its smoothed share of the words behind it. NULL and empty texts have the end alone. Without
    training documents every token has probability one. Words that are not frequent get their counts by
    a join; frequent ones, and so all hot ones, never enter it. Rows repeat as they do in ``docs``.
    """
    counted = stored(word_counts(training, text), "word-counts")
    vocab = vocabulary(counted)
    weights = fit(training, vocab, key, text)
    rest = [c for c in docs.columns if c != text]
    slim = docs.select(F.struct(*rest).alias("_row"), F.col(text).alias("_text"))
    scored = annotate(slim, "_text", "_s", FIELDS, _scorer(vocab, weights)).select(F.monotonically_increasing_id().alias("_id"), "_row", "_s")
    kept = stored(scored, "lm-scores")
    rare = kept.select("_id", F.explode("_s.rare").alias("r")).select("_id", "r.word", "r.n")
    known = rare.join(counted, "word", "left")
    added = known.groupBy("_id").agg(
        F.sum(F.when(F.col("c") > 0, F.col("n")).otherwise(0)).alias("_known"),
        F.sum(F.col("n") * F.log10(F.coalesce("c", F.lit(0)) + PSEUDO)).alias("_log"),
    )
    all_words = log10(vocab.total + PSEUDO * (vocab.distinct + 1))
    others = log10(max(vocab.rest_total, 0) + PSEUDO * (max(vocab.rest_distinct, 0) + 1))
    log, base = F.coalesce("_log", F.lit(0.0)), F.col("_s.log_count") + F.coalesce("_log", F.lit(0.0)) - F.col("_s.n_tokens") * all_words
    model = F.col("_s.log_model") + F.col("_s.log_rest") + log - F.col("_s.n_rest") * others
    return kept.join(added, "_id", "left").select(
        "_row.*",
        "_s.n_tokens",
        (F.col("_s.n_known") + F.coalesce("_known", F.lit(0))).alias("n_known"),
        F.lit(vocab.total).cast("long").alias("train_tokens"),
        base.alias("base_score"),
        (model if weights else base).alias("score"),
    )
