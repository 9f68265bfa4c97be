from __future__ import annotations

import math
import random
from collections import Counter

import cases
import numpy as np
import pandas as pd
import pyarrow as pa

from siltgate.llm import lm
from siltgate.llm.base import slices


def small_vocabulary(n=40):
    counts = np.arange(n, 0, -1) * 10
    words = [lm.END.encode(), *[f"w{i}".encode() for i in range(n - 1)]]
    return lm.Vocabulary({w: i for i, w in enumerate(words)}, counts, int(counts.sum()), n)


def test_outputs_are_a_distribution():
    w = lm.initial(small_vocabulary().own_counts)
    h = np.random.default_rng(0).standard_normal((1, lm.HIDDEN)).astype(np.float32)
    p = np.exp(lm.log_probability(w, np.repeat(h, lm.SYMBOLS, axis=0), np.arange(lm.SYMBOLS)))
    assert abs(p.sum() - 1) < 1e-3


def test_gradients_against_differences():
    rng = np.random.default_rng(1)
    w = {k: v.astype(np.float64) for k, v in lm.initial(small_vocabulary().own_counts).items()}
    ids = rng.integers(0, 40, 2 * lm.WINDOW)[: lm.WINDOW].astype(np.int64)
    ids[5] = 0

    def loss(weights):
        table, h, total = weights["embed"] @ weights["read"] + weights["bias"], np.zeros((1, lm.HIDDEN)), 0.0
        for i in ids:
            total -= lm.log_probability(weights, h, np.array([i]))[0]
            h = lm._step(table, weights["recur"], h, np.array([i]))[0] * (i != 0)
        return total

    # One plain step: Adam's first step is the sign of the gradient times the rate.
    stepped, mean = lm.train(w, np.concatenate([ids, ids])[: lm.WINDOW], rate=1e-3)
    assert abs(mean * lm.WINDOW - loss(w)) < 1e-3
    agree = checked = 0
    for k in ("embed", "read", "recur", "bias", "classes", "words", "class_bias", "word_bias"):
        for at in rng.permutation(w[k].size)[:60]:
            step = stepped[k].ravel()[at] - w[k].ravel()[at]
            up, down = ({**w, k: w[k].copy()} for _ in range(2))
            up[k].ravel()[at] += 1e-5
            down[k].ravel()[at] -= 1e-5
            slope = (loss(up) - loss(down)) / 2e-5
            if abs(slope) > 1e-3:
                checked += 1
                agree += np.sign(-slope) == np.sign(step)
    assert checked > 60 and agree == checked


def test_windows_carry_the_state():
    w = lm.initial(small_vocabulary().own_counts)
    # A strong recurrence amplifies rounding, so in double precision.
    w = {k: v.astype(np.float64) for k, v in w.items()}
    w["recur"] *= 20
    table = w["embed"] @ w["read"] + w["bias"]
    rng = np.random.default_rng(2)
    docs = [rng.integers(0, 40, n) for n in (1, 5, lm.WINDOW, lm.WINDOW + 1, 3 * lm.WINDOW + 7, 0, 200)]
    made = lm._score_slice(w, table, docs)
    for doc, got in zip(docs, made, strict=True):
        h, total = np.zeros((1, lm.HIDDEN)), 0.0
        for i in doc:
            total += lm.log_probability(w, h, np.array([i]))[0]
            h = lm._step(table, w["recur"], h, np.array([i]))[0]
        assert abs(total - got) < 1e-5


def base(rows, training):
    seen = Counter()
    for _, text, *_ in training:
        seen.update((text or "").encode().lower().split() + [b"\n"])
    n, v = sum(seen.values()), len(seen)
    out = []
    for doc, text, *_ in rows:
        tokens = (text or "").encode().lower().split() + [b"\n"]
        out.append((doc, len(tokens), sum(seen[t] > 0 for t in tokens), n, sum(math.log10((seen[t] + 0.1) / (n + 0.1 * (v + 1))) for t in tokens)))
    return sorted(out, key=repr)


def test_base_scores_with_odd_rows(spark):
    rows = [*cases.odd_rows(), (90, "never seen words The THE", "en", "s", 1)]
    docs = cases.clashing(cases.frame(spark, rows), "n_tokens", "word", "c").select("doc_id", "text")
    for training in (rows[:6], rows[3:]):
        made = lm.score(docs, cases.frame(spark, training)).collect()
        got = sorted(((r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"]) for r in made), key=repr)
        for a, b in zip(got, base(rows, training), strict=True):
            assert a[:4] == b[:4] and math.isclose(a[4], b[4], rel_tol=1e-9)
        assert all(r["score"] < 0 and math.isfinite(r["score"]) for r in made)


def test_nothing_to_learn_from_and_nothing_to_score(spark):
    docs = cases.frame(spark).select("doc_id", "text")
    made = lm.score(docs, docs.limit(0)).collect()
    assert len(made) == docs.count() and {(r["base_score"], r["score"], r["n_known"], r["train_tokens"]) for r in made} == {(0.0, 0.0, 0, 0)}
    assert lm.score(docs.limit(0), docs).count() == 0


def test_learning_lowers_the_held_out_loss(spark):
    rng = random.Random(0)
    words = [[f"l{k}w{i}" for i in range(60)] for k in range(4)]
    text = lambda: " ".join(rng.choice(words[k]) for k in [rng.randrange(4)] for _ in range(60))
    rows = [(i, text(), "en", "s", 1) for i in range(600)]
    docs = cases.frame(spark, rows)
    vocab = lm.vocabulary(lm.word_counts(docs, "text"))
    learned = lm.fit(docs, vocab, "doc_id", "text", share=1.0)
    test = [np.array([vocab.symbol[x.encode()] for x in text().split()] + [0]) for _ in range(50)]

    def loss(w):
        return -lm._score_slice(w, w["embed"] @ w["read"] + w["bias"], test).sum() / sum(map(len, test))

    assert loss(learned) < loss(lm.initial(vocab.own_counts)) - 0.3


def test_base_scores_where_the_end_is_a_rare_token(spark, monkeypatch):
    """Few long documents: more words than are carried are more frequent than documents."""
    real = lm.vocabulary
    monkeypatch.setattr(lm, "vocabulary", lambda counted: real(counted, 3))
    rows = [(i, "a b c d e " * 9 + f"only{i}", "en", "s", 1) for i in range(4)] + [(9, None, "en", "s", 0), (10, "z a", "en", "s", 3)]
    got = sorted((tuple(r) for r in lm.score(cases.frame(spark, rows).select("doc_id", "text"), cases.frame(spark, rows[:4])).select("doc_id", "n_tokens", "n_known", "train_tokens", "base_score").collect()), key=repr)
    for a, b in zip(got, base(rows, rows[:4]), strict=True):
        assert a[:4] == b[:4] and math.isclose(a[4], b[4], rel_tol=1e-9)


def test_every_training_document_is_learned_from(spark):
    vocab = small_vocabulary()
    for i in (1, 2, 3):
        one = cases.frame(spark, [(i, f"w{i} w1 w2 " * 40, "en", "s", 1)])
        assert np.abs(lm.fit(one, vocab, "doc_id", "text")["recur"] - lm.initial(vocab.own_counts)["recur"]).max() > 0


def test_thousands_of_words_have_outputs_of_their_own():
    vocab = small_vocabulary(16_000)
    assert len(set(vocab.symbol.values())) == 16_000


def test_words_of_a_slice_are_those_of_its_texts():
    texts = ["", "A b", "b", " \x0b", "ÄÖ x  Y\n", "", "c", None, "d\x0c"]
    (_, last, data, offsets), = slices(pa.array(texts), 1 << 20)
    words, upto = lm._words(data, offsets)
    split = [(t or "").encode().lower().split() for t in texts]
    assert last == len(texts) and words.to_pylist() == [w for t in split for w in t]
    assert upto.tolist() == np.cumsum([len(t) for t in split]).tolist()


def test_large_outputs_are_shifted_before_they_are_raised():
    w = lm.initial(small_vocabulary().own_counts)
    w["class_bias"] = w["class_bias"] + np.float32(500)
    w["words"] = w["words"] * np.float32(3000)
    found = lm.log_probability(w, np.full((50, lm.HIDDEN), 0.9, np.float32), np.arange(50))
    w = {k: v.astype(np.float64) for k, v in w.items()}
    assert np.isfinite(found).all()
    assert np.allclose(found, lm.log_probability(w, np.full((50, lm.HIDDEN), 0.9), np.arange(50)), rtol=1e-3, atol=1e-3)


def test_learned_weights_travel_in_blocks():
    vocab = small_vocabulary()
    sent = lm._learner(lm.initial(vocab.own_counts), vocab.symbol)(pd.DataFrame({"text": ["w1 w2 w3 " * 20]}))
    assert sum(map(len, sent["w"])) == lm._flat(lm.initial(vocab.own_counts)).size and len(sent) < 2000
