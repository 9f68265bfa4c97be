from __future__ import annotations

import random
from collections import Counter, defaultdict
from math import log2

import cases
import numpy as np
import pyarrow as pa
import pytest

from siltgate.llm import langid
from siltgate.llm.base import slices


class Brute:
    """Method C over nested contexts, one byte at a time."""

    def __init__(self, texts, order):
        self.order, self.seen = order, defaultdict(Counter)
        for text in texts:
            raw = b"\0" * order + text.encode().lower()
            for i in range(order, len(raw)):
                for k in range(order + 1):
                    self.seen[raw[i - k : i]][raw[i]] += 1

    def bits(self, text):
        raw, total = b"\0" * self.order + text.encode().lower(), 0.0
        for i in range(self.order, len(raw)):
            for k in range(self.order, -2, -1):
                if k < 0:
                    total += 8
                    break
                followers = self.seen.get(raw[i - k : i])
                if not followers:
                    continue
                n, distinct = sum(followers.values()), len(followers)
                if raw[i] in followers:
                    total -= log2(followers[raw[i]] / (n + distinct))
                    break
                total -= log2(distinct / (n + distinct))
        return total


@pytest.mark.parametrize("seed", [1, 2])
def test_code_lengths_against_brute_force(seed):
    rng = random.Random(seed)
    say = lambda letters, n: "".join(rng.choice(letters) for _ in range(n))
    train = {"a": [say("abcde ", 200) for _ in range(5)], "b": [say("cdefé ", 150) for _ in range(4)] + [""]}
    sample = pa.table({"lang": [k for k, v in train.items() for _ in v], "text": [t for v in train.values() for t in v]})
    trees = langid.Trees(*langid.gram_counts(sample, langid.ORDER))
    texts = [say("abcdefgé xyz", rng.randint(0, 60)) for _ in range(40)] + ["", "Q", "日本"]
    (_, _, data, offsets), = slices(pa.array(texts))
    made = trees.bits(data, offsets)
    for i, lang in enumerate(trees.langs):
        brute = Brute(train[lang], langid.ORDER)
        assert np.allclose(made[:, i], [brute.bits(t) for t in texts], rtol=1e-5, atol=1e-3)


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    test = langid.held_out(docs["doc_id"], 4, 2)
    made = langid.predict(docs.where(test), langid.fit(docs.where(~test))).select("lang", "_language.*").collect()
    assert len(made) > 200 and sum(r["lang"] == r["lang_pred"] for r in made) / len(made) > 0.98
    assert all(0 <= r["score"] <= 1 for r in made)


def test_odd_rows(spark):
    rows = [*cases.odd_rows(), (70, "12 34 -- !", "en", "s", 1), (71, "é", "fr", "s", 1), (72, "déjà été là où ça a été", "fr", "s", 1)]
    docs = cases.clashing(cases.frame(spark, rows), "lang_pred", "score", "r", "h")
    made = langid.predict(docs, langid.fit(docs)).select("doc_id", "text", "_language.*").collect()
    assert len(made) == len(rows)
    for r in made:
        letters = any(c.isalpha() for c in r["text"] or "")
        assert (r["lang_pred"] == "und") == (not letters) and (r["score"] == 0) == (not letters)
    nothing = langid.fit(docs.where("lang IS NULL"))
    assert nothing is None and {r["lang_pred"] for r in langid.predict(docs, nothing).select("_language.lang_pred").collect()} == {"und"}
    assert langid.predict(docs.limit(0), None).count() == 0


def test_the_sample_is_bounded_by_language(spark):
    rows = [(i, cases.PROSE * 20, "en" if i % 3 else "de", "s", 1) for i in range(300)]
    trees = langid.fit(cases.frame(spark, rows), trained_bytes=20_000)
    assert trees.langs == ["de", "en"]
