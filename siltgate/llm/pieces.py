"""SentencePiece encoding and decoding over a relational lattice.

Text is cut wherever no piece of the vocabulary spans the two neighbouring characters; no
segmentation can cross such a cut. The distinct units between cuts are encoded once: their
substrings of bounded length are exploded and joined with the piece table, the edges that meet are
grouped by unit, and a fold over the lattice picks the pieces. For unigram models the fold is
Viterbi's; for BPE models, whose encoder does not maximise a sum of scores, it takes the merge with
the best score until none is left. Documents then look their units up.
"""

from __future__ import annotations

import heapq
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from itertools import repeat
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructType

from siltgate.llm.base import annotate, give_back, parts, slices
from siltgate.plans.sizing import stored

SPACE = "▁"
MODEL_PATH = "/opt/tokenizers/piece_bpe_32k.model"
# Units whose encodings travel with the jobs: the most frequent ones, this many at most.
DICTIONARY = 1 << 18
# Characters of the longest unit that is encoded by joins; a fold keeps its boundaries in one long.
UNIT_CHARS = 48
# Encodings of rarer units that a task keeps.
CACHED_UNITS = 1 << 16
# Bytes of text, or about as many of ids, whose rows go back to Spark at once.
PART_BYTES = 1 << 20
# Units that one task makes edges for.
TASK_UNITS = 8192
_MAP_BITS = 22
FIELDS = StructType().add("ids", ArrayType(IntegerType()))


@dataclass
class Pieces:
    """A piece table: what each id spells, its score, and which ids stand for single bytes."""

    spelled: list[str]
    scores: np.ndarray
    normal: np.ndarray  # ids that may be matched in text
    byte_ids: np.ndarray | None  # id of each byte value; None: unknown characters become unknown_id
    unknown_id: int = 0
    kind: str = "bpe"
    ids: dict[str, int] = field(init=False)
    costs: dict[str, float] = field(init=False)
    longest: int = field(init=False)
    joined: np.ndarray = field(init=False)

    def __post_init__(self):
        self.ids = {self.spelled[i]: int(i) for i in self.normal}
        self.costs = {p: -float(self.scores[i]) for p, i in self.ids.items()}
        self.longest = max(map(len, self.ids), default=1)
        pairs = {(ord(a), ord(b)) for p in self.ids for a, b in zip(p, p[1:], strict=False)}
        self.joined = np.zeros(1 << _MAP_BITS, bool)
        if pairs:
            both = np.array(sorted(pairs), np.uint32)
            self.joined[_pair_slot(both[:, 0], both[:, 1])] = True


def _pair_slot(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Slot of a pair of 32-bit characters. Pairs that share a slot only make a cut less."""
    out = a * np.uint32(0x9E3779B1)
    out += b * np.uint32(0x85EBCA77)
    out >>= np.uint32(32 - _MAP_BITS)
    return out


def load(path: str = MODEL_PATH, kind: str = "bpe") -> Pieces:
    """The piece table of a model file; ``kind`` is the model's type, bpe or unigram."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    n = model.get_piece_size()
    spelled = [model.id_to_piece(i) for i in range(n)]
    plain = [i for i in range(n) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
    bytes_ = {int(spelled[i][3:5], 16): i for i in range(n) if model.is_byte(i)}
    byte_ids = np.array([bytes_[b] for b in range(256)]) if len(bytes_) == 256 else None
    return Pieces(spelled, np.array([model.get_score(i) for i in range(n)]), np.array(plain), byte_ids, model.unk_id(), kind)


def normalised(text: str) -> str:
    """Spaces become marks and one mark leads; an empty text stays empty."""
    return SPACE + text.replace(" ", SPACE) if text else ""


def units(texts: list[str], pieces: Pieces) -> tuple[list[str], np.ndarray]:
    """All units of some normalised texts in order, and how many lie before each text begins."""
    joined = "".join(texts)
    if not joined:
        return [], np.zeros(len(texts) + 1, np.int64)
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    cut = np.ones(len(points) + 1, bool)
    cut[1:-1] = ~pieces.joined[_pair_slot(points[:-1], points[1:])]
    starts = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    cut[starts] = True
    at = np.flatnonzero(cut)
    bounds = at.tolist()
    return [joined[a:b] for a, b in zip(bounds, bounds[1:], strict=False)], np.searchsorted(at, starts)


def _texts(data: np.ndarray, offsets: np.ndarray) -> list[str]:
    raw = data.tobytes()
    return [normalised(raw[a:b].decode("utf-8", "replace")) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]


def unit_counts(docs: DataFrame, text: str, pieces: Pieces) -> DataFrame:
    """(unit, n) over whole texts; tasks add up first."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for batch in batches:
            for _, _, data, offsets in slices(batch.column(0)):
                seen.update(units(_texts(data, offsets), pieces)[0])
                if len(seen) > 300_000:
                    yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], ["unit", "n"])
                    seen.clear()
        if seen:
            yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], ["unit", "n"])
        del seen
        give_back()

    return docs.select(text).mapInArrow(count, "unit string, n long").groupBy("unit").agg(F.sum("n").alias("n"))


def frequent(counted: DataFrame, most: int = DICTIONARY, chars: int = UNIT_CHARS) -> DataFrame:
    """Units of at most ``chars`` characters with the largest counts, all of a count or none, ``most`` at most."""
    fitting = counted.where(F.length("unit") <= chars)
    total, least = 0, None
    # The number of different counts grows with the root of the corpus at most.
    for row in fitting.groupBy("n").agg(F.count(F.lit(1)).alias("k")).orderBy(F.desc("n")).toLocalIterator():
        if total + row["k"] > most:
            break
        total, least = total + row["k"], row["n"]
    return fitting.where(F.col("n") >= least) if least is not None else fitting.where("false")


def lattice(distinct: DataFrame, pieces: Pieces) -> DataFrame:
    """(unit, edges): per unit the pieces among its substrings, as (cost, start, after, id), best first.

    Substrings are as long as the longest piece at most, and the piece table is the broadcast side: its
    size is the vocabulary's, whatever the corpus.
    """
    spark = distinct.sparkSession
    table = pa.table(
        {
            "piece": [pieces.spelled[i] for i in pieces.normal],
            "id": pa.array(pieces.normal, pa.int32()),
            "cost": pa.array(-pieces.scores[pieces.normal], pa.float64()),
        }
    )
    known = F.broadcast(spark.createDataFrame(table))
    # Few bytes, much work: spread by unit, which also keeps the edges of a unit where they are made.
    distinct = distinct.repartition(max(1, ceil(distinct.count() / TASK_UNITS)), "unit")
    n = F.length("unit")
    spans = distinct.select("unit", n.alias("size"), F.explode(F.sequence(F.lit(0), n - 1)).alias("start")).select(
        "unit", "start", F.explode(F.sequence(F.lit(1), F.least(F.lit(pieces.longest), F.col("size") - F.col("start")))).alias("long")
    )
    substrings = spans.select("unit", "start", (F.col("start") + F.col("long")).alias("after"), F.substring("unit", F.col("start") + 1, F.col("long")).alias("piece"))
    edges = substrings.join(known, "piece")
    met = edges.groupBy("unit").agg(F.sort_array(F.collect_list(F.struct("cost", "start", "after", "id"))).alias("edges"))
    # Units without any piece have no edges, only fallback.
    return distinct.join(met, "unit", "left").select("unit", F.coalesce("edges", F.array().cast("array<struct<cost:double,start:int,after:int,id:int>>")).alias("edges"))


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is worked out once; the optimizer would copy it to every place, into loops too."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _bit(at: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), at)


def fold_merges(edges: Column, size: Column) -> Column:
    """Boundaries, as bits, after merging neighbours while a piece spells two of them, best score and leftmost first."""
    masks = F.transform(
        edges, lambda e: F.struct((_bit(e["start"]).bitwiseOR(_bit(e["after"]))).alias("ends"), (_bit(e["after"]) - _bit(e["start"] + 1)).alias("inner"))
    )
    long_edges = F.filter(masks, lambda m: m["inner"] != 0)

    def step(state: Column, _: Column) -> Column:
        mask = state["mask"]

        def fits(m: Column) -> Column:
            return (mask.bitwiseAND(m["ends"]) == m["ends"]) & (F.bit_count(mask.bitwiseAND(m["inner"])) == 1)

        nothing = F.array().cast("array<struct<ends:bigint,inner:bigint>>")
        return _let(
            F.try_element_at(F.filter(state["edges"], fits), F.lit(1)),
            lambda first: F.struct(
                F.coalesce(mask.bitwiseAND(F.bitwise_not(first["inner"])), mask).alias("mask"),
                F.when(first.isNotNull(), state["edges"]).otherwise(nothing).alias("edges"),
            ),
        )

    start = F.struct((_bit(size + 1) - 1).alias("mask"), long_edges.alias("edges"))
    return F.aggregate(F.sequence(F.lit(1), F.greatest(size - 1, F.lit(1))), start, step)["mask"]


def fold_viterbi(edges: Column, size: Column, unknown_cost: float) -> Column:
    """Boundaries, as bits, of the path of least cost; a character without a piece costs ``unknown_cost``.

    Of paths of equal cost the one whose last piece begins first wins, at each position.
    """

    def step(best: Column, after: Column) -> Column:
        ending = F.filter(edges, lambda e: e["after"] == after)
        fallback = F.filter(
            F.array(F.struct(F.lit(unknown_cost).alias("cost"), (after - 1).alias("start"))), lambda _: ~F.exists(ending, lambda e: e["start"] == after - 1)
        )
        options = F.concat(F.transform(ending, lambda e: F.struct(e["cost"].alias("cost"), e["start"].alias("start"))), fallback)
        arrived = F.transform(
            options,
            lambda o: F.struct(
                (F.element_at(best, o["start"] + 1)["cost"] + o["cost"]).alias("cost"),
                o["start"].alias("start"),
                F.element_at(best, o["start"] + 1)["mask"].bitwiseOR(_bit(after)).alias("mask"),
            ),
        )
        return F.concat(best, F.array(F.array_min(arrived)))

    begin = F.array(F.struct(F.lit(0.0).alias("cost"), F.lit(0).alias("start"), F.lit(1).cast("long").alias("mask")))
    return F.element_at(F.aggregate(F.sequence(F.lit(1), size), begin, step), -1)["mask"]


def encode_units(distinct: DataFrame, pieces: Pieces) -> DataFrame:
    """(unit, spans): spans are (start, after, id) in order, id NULL where no piece spells the character."""
    size = F.length("unit")
    fold = fold_merges(F.col("edges"), size) if pieces.kind == "bpe" else fold_viterbi(F.col("edges"), size, unknown_cost(pieces))
    cuts = _let(fold, lambda mask: F.filter(F.sequence(F.lit(0), size), lambda i: mask.bitwiseAND(_bit(i)) != 0))
    return lattice(distinct, pieces).select("unit", "edges", cuts.alias("cuts")).select(
        "unit",
        F.transform(
            F.slice("cuts", 1, F.size("cuts") - 1),
            lambda start, i: _let(
                F.element_at("cuts", i + 2),
                lambda after: F.struct(
                    start.alias("start"),
                    after.alias("after"),
                    F.try_element_at(F.filter("edges", lambda e: (e["start"] == start) & (e["after"] == after)), F.lit(1))["id"].alias("id"),
                ),
            ),
        ).alias("spans"),
    )


def unknown_cost(pieces: Pieces) -> float:
    """Ten more than the worst piece."""
    return float(10 - pieces.scores[pieces.normal].min())


def _merged(unit: str, costs: dict[str, float]) -> list[str]:
    """Symbols of a short unit after all merges, best score and leftmost first; each merge looks at all pairs."""
    none = float("inf")
    symbols = list(unit)
    pairs = [costs.get(a + b, none) for a, b in zip(symbols, symbols[1:], strict=False)]
    while pairs and (best := min(pairs)) < none:
        i = pairs.index(best)
        symbols[i] += symbols.pop(i + 1)
        del pairs[i]
        if i < len(pairs):
            pairs[i] = costs.get(symbols[i] + symbols[i + 1], none)
        if i:
            pairs[i - 1] = costs.get(symbols[i - 1] + symbols[i], none)
    return symbols


def fold_unit(unit: str, pieces: Pieces) -> list[int]:
    """Ids of one unit of any length: the same lattice and fold, for units that are rare or long."""
    if pieces.kind == "bpe" and len(unit) <= UNIT_CHARS:
        out = []
        for symbol in _merged(unit, pieces.costs):
            found = pieces.ids.get(symbol)
            if found is None:
                out += _ids_of(symbol, pieces)
            else:
                out.append(found)
        return out
    n, ids = len(unit), pieces.ids
    after = list(range(1, n + 1))  # where the symbol that starts here ends; 0 once it is merged away
    if pieces.kind == "bpe":
        before = list(range(-1, n))
        heap = []

        def offer(left: int) -> None:
            middle = after[left]
            if middle < n and (found := ids.get(unit[left : after[middle]])) is not None:
                heapq.heappush(heap, (pieces.costs[unit[left : after[middle]]], left, middle, after[middle]))

        for i in range(n - 1):
            offer(i)
        while heap:
            _, left, middle, right = heapq.heappop(heap)
            if after[left] != middle or after[middle] != right:
                continue
            after[left], after[middle] = right, 0
            if right < n:
                before[right] = left
                offer(left)
            if before[left] >= 0:
                offer(before[left])
    else:
        best = [(0.0, 0)] + [(float("inf"), 0)] * n
        for end in range(1, n + 1):
            for start in range(max(0, end - pieces.longest), end):
                found = ids.get(unit[start:end])
                cost = -pieces.scores[found] if found is not None else unknown_cost(pieces) if start == end - 1 else None
                if cost is not None:
                    best[end] = min(best[end], (best[start][0] + cost, start))
        at = n
        after = [0] * n
        while at:
            after[best[at][1]] = at
            at = best[at][1]
    out, at = [], 0
    while at < n:
        out += _ids_of(unit[at : after[at]], pieces)
        at = after[at]
    return out


def _ids_of(symbol: str, pieces: Pieces) -> list[int]:
    found = pieces.ids.get(symbol)
    if found is not None:
        return [found]
    if pieces.byte_ids is None:
        return [pieces.unknown_id]
    return [int(pieces.byte_ids[b]) for b in symbol.encode()]


@dataclass
class Dictionary:
    """Encodings of the frequent units, end to end."""

    number: dict[str, int]
    offsets: np.ndarray
    ids: np.ndarray


def dictionary(encoded: DataFrame, pieces: Pieces) -> Dictionary:
    """Collected encodings of the frequent units, whose number is bounded."""
    number: dict[str, int] = {}
    sizes, ids = [0], []
    held = encoded.select("unit", F.col("spans.start").alias("start"), F.col("spans.after").alias("after"), F.col("spans.id").alias("id")).toArrow()
    for batch in held.to_batches():
        for unit, starts, ends, found in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
            number[unit] = len(number)
            one = []
            for s, e, i in zip(starts, ends, found, strict=True):
                one += [i] if i is not None else _ids_of(unit[s:e], pieces)
            ids += one
            sizes.append(len(one))
    return Dictionary(number, np.cumsum(sizes), np.array(ids, np.int32))


def _roomy(table: np.ndarray, n: int) -> np.ndarray:
    """``table`` with room for ``n`` values."""
    if n <= len(table):
        return table
    return np.concatenate([table, np.empty(max(n, len(table) + len(table) // 8) - len(table), table.dtype)])


def _encoder(pieces: Pieces, known: Dictionary) -> Callable[[], Callable[[pa.Array], list[pa.Array]]]:
    def start():
        # The frequent units' ids and, behind them, those of the rare units that the task has met.
        n_known = len(known.number)
        ids, starts, sizes = known.ids, known.offsets[:-1].astype(np.int32), np.diff(known.offsets).astype(np.int32)
        rare: dict[str, int] = {}
        held = len(ids)

        def learn(found: list[str], missing: list[int], number: np.ndarray) -> None:
            nonlocal ids, starts, sizes, held
            # Rare units recur within a task; what is kept of them is bounded by number and length.
            if len(rare) > CACHED_UNITS or held > len(known.ids) + CACHED_UNITS * UNIT_CHARS:
                rare.clear()
                held = len(known.ids)
                ids, starts, sizes = ids[:held].copy(), starts[:n_known].copy(), sizes[:n_known].copy()
            new: list[list[int]] = []
            for i in missing:
                at = rare.get(found[i])
                if at is None:
                    at = rare[found[i]] = n_known + len(rare)
                    new.append(fold_unit(found[i], pieces))
                number[i] = at
            if new:
                each = np.array([len(one) for one in new], np.int32)
                first, last, end = n_known + len(rare) - len(new), n_known + len(rare), held + int(each.sum())
                ids, starts, sizes = _roomy(ids, end), _roomy(starts, last), _roomy(sizes, last)
                sizes[first:last] = each
                starts[first:last] = held + np.cumsum(each) - each
                ids[held:end] = [i for one in new for i in one]
                held = end

        def work(texts: pa.Array) -> list[pa.Array]:
            made, counts = [], []
            for _, _, data, offsets in slices(texts):
                found, bounds = units(_texts(data, offsets), pieces)
                number = np.fromiter(map(known.number.get, found, repeat(-1)), np.int32, len(found))
                if len(missing := np.flatnonzero(number < 0)):
                    learn(found, missing.tolist(), number)
                each = sizes[number]
                upto = np.zeros(len(each) + 1, np.int64)
                np.cumsum(each, out=upto[1:])
                # Position of each output id: its unit's first id plus its place in the unit.
                places = np.repeat(starts[number] - upto[:-1], each)
                places += np.arange(upto[-1])
                made.append(ids[places])
                counts.append(np.diff(upto[bounds]))
            ends = np.concatenate([[0], np.cumsum(np.concatenate(counts))]) if counts else np.zeros(1)
            flat = np.concatenate(made) if made else np.zeros(0)
            return [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int32()))]

        return work

    return start


def encode(docs: DataFrame, pieces: Pieces, text: str = "text", into: str = "_pieces", most: int = DICTIONARY) -> DataFrame:
    """``docs`` plus a struct ``into`` with ``ids``, the ids of the whole text.

    The ``most`` frequent units are encoded by the relational lattice and carried to the tasks, which is
    what bounds them; rarer and longer units are folded where they stand. NULL and empty texts have no
    ids. Characters without a piece become their bytes, or the unknown id where the model has no bytes.
    Rows, repeats and other columns stay as they are.
    """
    counted = stored(unit_counts(docs, text, pieces), "unit-counts")
    known = dictionary(encode_units(frequent(counted, most).select("unit"), pieces), pieces)
    return annotate(docs, text, into, FIELDS, _encoder(pieces, known), PART_BYTES)


def decode(encoded: DataFrame, pieces: Pieces, ids: str, into: str = "_decoded") -> DataFrame:
    """``encoded`` plus a struct ``into`` with ``text``: what the ids spell, without the leading mark.

    NULL and empty lists are the empty text; control ids spell nothing, and bytes that are no UTF-8 become
    replacement characters. An id outside of the table fails the job.
    """
    spelled = [p.encode() for p in pieces.spelled]
    if pieces.byte_ids is not None:
        for value, i in enumerate(pieces.byte_ids):
            spelled[int(i)] = bytes([value])
    plain = set(pieces.normal.tolist()) | (set(pieces.byte_ids.tolist()) if pieces.byte_ids is not None else set())
    spelled = [p if i in plain or i == pieces.unknown_id and pieces.byte_ids is None else b"" for i, p in enumerate(spelled)]
    sizes = np.array([len(p) for p in spelled], np.int64)
    starts = np.cumsum(sizes) - sizes
    table = np.frombuffer(b"".join(spelled), np.uint8)
    at = encoded.columns.index(ids)
    schema = StructType([*encoded.schema.fields]).add(into, StructType().add("text", StringType()))

    def one(numbers: np.ndarray) -> str:
        each = sizes[numbers]
        upto = np.cumsum(each)
        raw = table[np.repeat(starts[numbers] - upto + each, each) + np.arange(upto[-1] if len(upto) else 0)].tobytes()
        return raw.decode("utf-8", "replace").replace(SPACE, " ").removeprefix(" ")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in (p for batch in batches for p in parts(batch, at, PART_BYTES)):
            lists = part.column(at)
            offsets = lists.offsets.to_numpy()
            values = lists.values.to_numpy(zero_copy_only=False)
            texts = [one(values[a:b]) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
            made = pa.StructArray.from_arrays([pa.array(texts, pa.string())], ["text"])
            yield pa.RecordBatch.from_arrays([*part.columns, made], schema.names)
        give_back()

    return encoded.mapInArrow(run, schema)


def from_scores(table: dict[str, float], kind: str = "unigram") -> Pieces:
    """A piece table from spellings and scores alone, without bytes; id 0 is unknown."""
    spelled = ["<unk>", *table]
    return Pieces(spelled, np.array([0.0, *table.values()]), np.arange(1, len(spelled)), None, 0, kind)
