from __future__ import annotations

import random

import cases
import pytest

import corpus_pipeline as pipeline
from siltgate.llm import pieces, queries
from siltgate.plans.sizing import scratch_path


def rows():
    rng = random.Random(6)
    words = [f"word{i}" for i in range(400)] + ["the", "of", "and"] * 20
    say = lambda n: " ".join(rng.choice(words) for _ in range(n))
    item, passage = say(40), say(120)
    docs = [(i, say(150), "en", "s", 1) for i in range(60)]
    docs += [(100 + i, docs[i][1], "en", "s", 1) for i in range(5)]  # copies
    docs += [(200 + i, say(60) + " " + passage + " " + say(60), "en", "s", 1) for i in range(4)]  # a shared passage
    docs += [(300, say(30) + " " + item + " " + say(30), "en", "s", 1)]  # a benchmark item
    docs += [(400 + i, "same line again and again " * 30, "en", "s", 1) for i in range(3)]  # repeated words
    return docs, item, passage


@pytest.fixture(scope="module")
def folder(spark):
    docs, item, _ = rows()
    path = scratch_path(spark, "tables")
    spark.createDataFrame(docs + cases.odd_rows(), cases.DOCS).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(1, item), (None, None)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    spark.createDataFrame([(i, 1, 0) for i in range(40)], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path


def test_each_stage_takes_effect(spark, folder):
    docs, _, passage = rows()
    by_id = {r[0]: r[1] for r in docs}
    now = spark.read.parquet(f"{folder}/documents.parquet")
    columns = now.dtypes
    seen = []
    for name, stage in pipeline.STAGES[:-1]:
        now = pipeline.stored(stage(spark, now, folder), name.replace(" ", "-"))
        assert now.dtypes == columns
        seen.append({r["doc_id"]: r["text"] for r in now.collect() if r["doc_id"] in by_id})
    quality, near, repeats, clean = seen
    assert {400, 401, 402} & set(quality) == set() and set(by_id) - {400, 401, 402} <= set(quality)
    assert {100, 101, 102, 103, 104} & set(near) == set() and set(range(60)) <= set(near)
    assert set(repeats) == set(near)
    assert all(passage not in repeats[200 + i] and len(repeats[200 + i]) < len(by_id[200 + i]) - 390 for i in range(4))
    assert all(repeats[i] == by_id[i] for i in range(60))
    assert 300 not in clean and set(range(60)) <= set(clean)
    table = pieces.load()
    last = pipeline.run(spark, folder).collect()
    assert {r["doc_id"] for r in last} >= set(range(60)) | {200, 201, 202, 203}
    assert all(r["round_trip"] for r in last) and all(r["n_pieces"] == len(r["ids"]) for r in last)
    some = next(r for r in last if r["doc_id"] == 7)
    assert some["ids"] == [i for u in pieces.units([pieces.normalised(by_id[7])], table)[0] for i in pieces.fold_unit(u, table)]


def test_stages_bear_odd_rows_and_empty_tables(spark, folder):
    odd = cases.clashing(cases.frame(spark), "_quality", "_cut", "_found", "_pieces", "f", "r", "ids")
    for _, stage in pipeline.STAGES[:-1]:
        assert stage(spark, odd, folder).dtypes == odd.dtypes
        assert stage(spark, odd, folder).count() <= odd.count()
        assert stage(spark, odd.limit(0), folder).count() == 0
    assert pipeline.STAGES[-1][1](spark, odd, folder).count() == odd.count()
    assert pipeline.STAGES[-1][1](spark, odd.limit(0), folder).count() == 0


def test_a_cut_character_goes_whole(spark, folder):
    shared = "日本語の長い文章" * 60
    docs = [(1, "é" + shared + "x", "en", "s", 1), (2, "ê" + shared + "y", "en", "s", 1), (3, None, None, None, None), (4, "\ufffd" + shared, "en", "s", 1), (5, "日" + "x" * 500, "en", "s", 1), (6, "早" + "x" * 500, "en", "s", 1), (7, "é" * 500 + "a", "en", "s", 1), (8, "ĩ" + "é" * 500, "en", "s", 1)]
    made = {r["doc_id"]: r for r in pipeline.repeated_passages(spark, cases.frame(spark, docs), folder).collect()}
    assert (made[1]["text"], made[2]["text"], made[3]["text"]) == ("éx", "êy", None)
    assert all(made[i]["text"].isprintable() and "\ufffd" not in made[i]["text"] for i in (1, 2, 5, 6, 7, 8))
    assert made[1]["n_chars"] == 2 and made[4]["text"].startswith("\ufffd")


def test_passages_of_over_fifty_words_go(spark, folder):
    """52 words in 285 bytes, which strings of 400 bytes would not reach."""
    passage = " ".join(f"w{i:03}" if i % 2 else f"word{i:02}" for i in range(52))
    assert 250 < len(passage) < 400
    rows = [(i, " ".join(f"own{i}{j}" for j in range(40)) + " " + passage + f" end{i}", "en", "s", 1) for i in range(3)]
    kept = pipeline.repeated_passages(spark, cases.frame(spark, rows), folder)
    assert all("word24" not in r["text"] and f"own{r['doc_id']}0" in r["text"] and r["text"].endswith(str(r["doc_id"])) for r in kept.collect())


def test_every_operator_is_registered():
    names = queries.queries()
    assert [sum(n.startswith(f"op{k}_") for n in names) for k in range(1, 14)] == [1] * 13
