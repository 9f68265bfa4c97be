from __future__ import annotations

import itertools
import random
import re

import cases
import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F

from siltgate.llm import base, pieces

ODD = ["", " ", "  a", "a  b\n c  ", "日本語 と ﬁ Ａ", "x" * 300, "<s> hi </s>", "é\u0301", "a\tb\r\n", "\x00b", "1234567890 --- === ***", "http://a.b/c?d=e&f", "\U0001f642\U0001f642", "çéèaux" * 20, "the of and " * 30]


@pytest.fixture(scope="module")
def model():
    return pieces.load()


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL_PATH)


def folded(text, table):
    return [i for u in pieces.units([pieces.normalised(text)], table)[0] for i in pieces.fold_unit(u, table)]


def test_the_fold_in_place_against_the_library(model, library):
    rng = random.Random(3)
    texts = ODD + ["".join(rng.choice("abcdeéß  .\n-12日") for _ in range(rng.randint(0, 80))) for _ in range(400)]
    assert [t for t in texts if folded(t, model) != library.encode(t)] == []


@pytest.mark.parametrize("most", [1 << 19, 5, 0])
def test_encoding_against_the_library_and_back(spark, model, library, most):
    rows = cases.odd_rows() + [(300 + i, t, "en", "s", 1) for i, t in enumerate(ODD)]
    docs = cases.clashing(cases.frame(spark, rows), "ids", "unit", "edges")
    encoded = pieces.encode(docs, model, most=most).select("doc_id", "text", F.col("_pieces.ids").alias("numbers"))
    made = pieces.decode(encoded, model, "numbers").select("doc_id", "text", "numbers", "_decoded.text").collect()
    assert len(made) == len(rows)
    for r in made:
        assert r[2] == library.encode(r[1] or "") and r[3] == (r[1] or "")


def test_relational_merges_against_the_library(spark, model, library):
    rng = random.Random(7)
    texts = {"".join(rng.choice("thereintoanzé.") for _ in range(rng.randint(1, 40))) for _ in range(150)}
    made = pieces.encode_units(spark.createDataFrame([(pieces.SPACE + t,) for t in texts], "unit string"), model)
    known = pieces.dictionary(made, model)
    for t in texts:
        i = known.number[pieces.SPACE + t]
        assert known.ids[known.offsets[i] : known.offsets[i + 1]].tolist() == library.encode(t)


def test_viterbi_against_all_segmentations(spark):
    rng = random.Random(1)
    spelled = {p: -rng.random() * 9 for p in ["a", "b", "ab", "ba", "aba", "bb", "abb", "c", "▁", "▁a", "▁ab", "cab", "bca"]}
    table = pieces.from_scores(spelled)
    units = ["▁" + "".join(rng.choice("abcx") for _ in range(rng.randint(0, 8))) for _ in range(60)]
    worst = pieces.unknown_cost(table)

    def best(unit):
        least = None
        for cuts in itertools.product([0, 1], repeat=len(unit) - 1):
            at = [0, *[i + 1 for i, c in enumerate(cuts) if c], len(unit)]
            parts = [unit[a:b] for a, b in zip(at, at[1:], strict=False)]
            if all(p in spelled or len(p) == 1 for p in parts):
                cost = sum(-spelled[p] if p in spelled else worst for p in parts)
                least = min(least or (cost, parts), (cost, parts))
        return [table.ids.get(p, table.unknown_id) for p in least[1]]

    known = pieces.dictionary(pieces.encode_units(spark.createDataFrame([(u,) for u in set(units)], "unit string"), table), table)
    for u in units:
        i = known.number[u]
        assert known.ids[known.offsets[i] : known.offsets[i + 1]].tolist() == best(u) == pieces.fold_unit(u, table)


def test_cuts_never_separate_a_piece(model):
    for piece in random.Random(2).sample(sorted(model.ids), 3000):
        assert pieces.units([piece], model)[0] == [piece]


def test_empty_tables_and_a_character_that_is_a_mark(spark, model):
    docs = cases.frame(spark)
    assert pieces.encode(docs.limit(0), model).count() == 0
    marked = pieces.encode(cases.frame(spark, [(1, "a▁b", "en", "s", 3)]), model).select(F.col("_pieces.ids").alias("ids"))
    assert pieces.decode(marked, model, "ids").select("_decoded.text").first()[0] == "a b"
    nulls = spark.createDataFrame([(None,), ([],), ([1, 2],)], "ids array<int>")
    assert [r[0] for r in pieces.decode(nulls, model, "ids").select("_decoded.text").collect()] == ["", "", ""]


def test_the_fold_of_a_unit_is_worked_out_once(spark, model):
    plan = pieces.encode_units(spark.createDataFrame([("▁there",)], "unit string"), model)._jdf.queryExecution().optimizedPlan().toString()
    # Inlined into the filter of the boundaries, it would be folded anew for each of them.
    assert "aggregate(" in plan
    assert not re.search(r"filter\(sequence\(0, length[^\n]*lambdafunction\([^\n]*aggregate\(", plan)


def test_rows_travel_in_parts_and_rare_units_are_kept_within_bounds(spark, model, library, monkeypatch):
    rng = random.Random(5)
    texts = [None, "", *("".join(rng.choice("abcdeé .日") for _ in range(rng.randint(0, 300))) for _ in range(60))]
    batch = pa.record_batch({"text": pa.array(texts, pa.string())})
    made = list(base.parts(batch.slice(1), 0, 500))
    assert pa.Table.from_batches(made).column(0).to_pylist() == texts[1:]
    assert len(made) > 5 and all(len(p) == 1 or sum(len(t.encode()) for t in p.column(0).to_pylist()) <= 500 for p in made)
    lists = pa.record_batch({"ids": pa.array([[1] * 10, None, [], [2] * 300, [3]], pa.list_(pa.int32()))})
    assert [p.num_rows for p in base.parts(lists, 0, 50)] == [3, 1, 1]
    monkeypatch.setattr(pieces, "CACHED_UNITS", 3)
    monkeypatch.setattr(base, "SLICE_BYTES", 100)
    known = pieces.Dictionary({}, np.zeros(1, np.int64), np.zeros(0, np.int32))
    work = pieces._encoder(model, known)()
    got = [ids for p in base.parts(batch, 0, 100) for ids in work(p.column(0))[0].to_pylist()]
    assert got == [library.encode(t or "") for t in texts]


def test_short_and_long_units_merge_alike(model, library, monkeypatch):
    rng = random.Random(11)
    units = ["▁" + "".join(rng.choice("thereinoalsé1日") for _ in range(rng.randint(0, 47))) for _ in range(500)]
    short = [pieces.fold_unit(u, model) for u in units]
    # The heap takes units beyond the bound; scores and places decide in the same order.
    monkeypatch.setattr(pieces, "UNIT_CHARS", 0)
    assert short == [pieces.fold_unit(u, model) for u in units]
    assert pieces._merged("▁aaaa", {"aa": 1.0, "aaa": 0.5, "▁a": 2.0}) == ["▁", "aaa", "a"]
