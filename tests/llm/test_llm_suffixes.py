from __future__ import annotations

import random
from collections import Counter

import cases
import pytest

from siltgate.llm import suffixes

DOCS = "doc_id long, text string"


def brute(docs, length):
    seen = Counter()
    for _, text in docs:
        raw = (text or "").encode()
        seen.update(raw[i : i + length] for i in range(len(raw) - length + 1))
    out = []
    for doc, text in docs:
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for i in range(len(raw) - length + 1):
            if seen[raw[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        kept = bytes(b for b, g in zip(raw, gone, strict=True) if not g)
        out.append((doc, len(raw), sum(gone), sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone)), kept))
    return sorted(out, key=repr)


def made(df, length, **more):
    cut = suffixes.remove_repeats(df, length=length, **more)
    return sorted(((r[0], r[1], r[2], r[3], bytes(r[4])) for r in cut.select("doc_id", "_cut.n_bytes", "_cut.n_removed", "_cut.n_spans", "_cut.kept").collect()), key=repr)


def planted(seed, letters, long):
    rng = random.Random(seed)
    say = lambda n: "".join(rng.choice(letters) for _ in range(n))
    passages = [say(rng.randint(long - 60, long + 500)) for _ in range(8)]
    docs = []
    for i in range(60):
        text = say(rng.randint(0, 900))
        for _ in range(rng.randint(0, 3)):
            part = rng.choice(passages)
            at = rng.randint(0, 120)
            text += part[at : at + rng.randint(long - 40, long + 300)] + say(rng.randint(0, 200))
        docs.append((i, text))
    docs += [(100, docs[5][1]), (101, docs[5][1]), (102, docs[6][1] + docs[6][1]), (103, docs[7][1][3:])]
    return docs


@pytest.mark.parametrize(("seed", "letters", "task"), [(1, "abcdefghij klmnop", 4096), (2, "aé日 ", 4096), (3, "ab", 4096), (1, "abcdefghij klmnop", 1), (3, "ab", 3)])
def test_against_brute_force(spark, seed, letters, task):
    docs = planted(seed, letters, 400)
    assert made(spark.createDataFrame(docs, DOCS), 400, task_suffixes=task) == brute(docs, 400)


def test_strings_without_samples_and_periodic_ones(spark):
    docs = [(1, "a" * 2000), (2, "ab" * 700), (3, "x" * 399), (4, "y" * 400), (5, "z" * 401), (6, "b" * 500 + "q"), (7, "q" + "b" * 450)]
    assert made(spark.createDataFrame(docs, DOCS), 400) == brute(docs, 400)


def test_odd_rows_repeats_and_clashing_columns(spark):
    rows = [r for r in cases.odd_rows() if not r[1] or len(r[1]) < 5000]
    docs = cases.clashing(cases.frame(spark, rows), "kept", "n_bytes", "f", "r", "starts")
    assert made(docs, 400) == brute([(r[0], r[1]) for r in rows], 400)
    assert suffixes.remove_repeats(docs).select(*docs.columns).dtypes == docs.dtypes


def test_a_very_long_text_and_an_empty_table(spark):
    long_text = cases.odd_rows()[9][1]
    docs = [(1, long_text), (2, "before\x01" + long_text[100_000:101_000] + "\x02after"), (3, None)]
    by_id = {r[0]: r for r in made(spark.createDataFrame(docs, DOCS), 400)}
    assert by_id[1][2] == by_id[2][2] == 1000 and by_id[3][1:] == (0, 0, 0, b"")
    assert made(spark.createDataFrame([], DOCS), 400) == []


def test_a_join_below_is_no_plain_scan(spark, tmp_path):
    path = str(tmp_path / "docs")
    spark.createDataFrame([(1, "a" * 300), (2, "b" * 300)], DOCS).write.parquet(path)
    scan = spark.read.parquet(path)
    twice = scan.crossJoin(spark.range(2).withColumnRenamed("id", "n"))
    assert {r[2] for r in made(twice, 200)} == {300}
    assert sum(r[2] > 0 for r in made(twice, 200)) == 4
