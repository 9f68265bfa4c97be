from __future__ import annotations

import random
import re

import cases
import pytest
from pyspark.sql import functions as F

from siltgate.llm import decontam

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
ITEMS = "item_id long, text string"


def brute(docs, items, window=13):
    spans = {}
    for item, text in items:
        words = WORD.findall((text or "").translate(LOW))
        n = min(window, len(words))
        for j in range(len(words) - n + 1 if n else 0):
            spans.setdefault(tuple(words[j : j + n]), set()).add("" if item is None else str(item))
    out = []
    for doc, text in docs:
        words, hit, met = WORD.findall((text or "").translate(LOW)), set(), set()
        for n in {len(s) for s in spans}:
            for j in range(len(words) - n + 1):
                if found := spans.get(tuple(words[j : j + n])):
                    met |= found
                    hit |= set(range(j, j + n))
        out.append((doc, len(words), len(hit), ",".join(sorted(met))))
    return sorted(out, key=repr)


def found(docs, items, **more):
    made = decontam.find_items(docs, items, **more)
    return sorted((tuple(r) for r in made.select("doc_id", "_found.n_words", "_found.n_hit", F.array_join("_found.items", ",")).collect()), key=repr)


def planted(seed=3):
    rng = random.Random(seed)
    words = ["the", "a", "of", "Cat", "dog", "naïve", "x1", "über", "日本"]
    say = lambda n: " ".join(rng.choice(words) for _ in range(n))
    items = [(i, say(rng.choice([1, 2, 5, 12, 13, 14, 30, 60]))) for i in range(40)] + [(3, say(20)), (None, say(15)), (50, None), (51, ""), (52, "---")]
    docs = []
    for i in range(60):
        text = say(rng.randint(0, 80))
        for _ in range(rng.randint(0, 3)):
            part = (rng.choice(items)[1] or "").split()
            at = rng.randint(0, len(part))
            text += " , ".join(["", *part[at : at + rng.randint(1, 40)]]).upper() + " " + say(rng.randint(0, 9))
        docs.append((i, text))
    return docs, items


@pytest.mark.parametrize("block_bytes", [16 << 20, 700])
def test_against_brute_force_in_one_block_and_in_several(spark, block_bytes):
    docs, items = planted()
    docs += [(r[0], r[1]) for r in cases.odd_rows()]
    made = found(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, ITEMS), block_bytes=block_bytes)
    assert made == brute(docs, items)


@pytest.mark.parametrize("k", [1, 5, 13])
def test_every_window_is_found_whatever_the_gram(spark, k):
    docs, items = planted(8)
    made = found(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, ITEMS), k=k)
    assert made == brute(docs, items)


def test_spans_are_the_hit_words(spark):
    item = " ".join(f"w{i}" for i in range(15))
    docs = spark.createDataFrame([(1, f"a b {item} c {item}")], "doc_id long, text string")
    row = decontam.find_items(docs, spark.createDataFrame([(1, item)], ITEMS)).select("_found.spans").first()
    assert [tuple(s) for s in row["spans"]] == [(2, 17), (18, 33)]


def test_empty_tables_and_clashing_columns(spark):
    docs = cases.clashing(cases.frame(spark), "n_words", "items", "_found0")
    nothing = spark.createDataFrame([], ITEMS)
    made = decontam.find_items(docs, nothing)
    assert made.count() == docs.count() and made.where("_found.n_hit > 0").isEmpty()
    assert made.select(*docs.columns).schema == docs.schema
    assert decontam.find_items(docs.limit(0), nothing).count() == 0
