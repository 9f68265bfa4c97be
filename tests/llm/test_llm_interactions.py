from __future__ import annotations

import re
from collections import Counter
from itertools import permutations

import cases

from siltgate.llm import interactions

LABELS = "doc_id long, quality int, toxic int"


def failed(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    return {
        c
        for c, holds in {
            "A": len(words) < 100, "B": 100 * len(set(words)) < 80 * len(words),
            "C": 100 * len(re.findall("[A-Z]", text)) > 10 * len(text), "D": bool(re.search("[#$%&*|]", text)),
        }.items()
        if holds
    }


def brute(rows, labels):
    good = {k for k, q, _ in labels if q == 1 and k is not None}
    toxic = {k for k, _, t in labels if t == 1 and k is not None}
    first = {}
    for k, text, *_ in rows:
        if k is not None:
            first[text or ""] = min(k, first.get(text or "", k))
    fails = []
    for k, text, lang, *_ in rows:
        bad = failed(text or "")
        if k is not None and k > first[text or ""]:
            bad.add("E")
        fails.append((lang or "", bad, k in good, k in toxic))
    out, removed_by = {}, Counter()
    for part in {f[0] for f in fails}:
        for order in map("".join, permutations("ABCDE")):
            n = [Counter() for _ in order]
            for _, bad, is_good, is_toxic in (f for f in fails if f[0] == part):
                alive = True
                for i, c in enumerate(order):
                    hit = c in bad
                    n[i]["removed"] += alive and hit
                    n[i]["good_lost"] += alive and hit and is_good
                    n[i]["toxic_lost"] += alive and hit and is_toxic
                    n[i]["redundant"] += hit and not alive
                    n[i]["unique_fails"] += bad == {c}
                    alive = alive and not hit
                    n[i]["kept"] += alive
            for i, c in enumerate(order):
                out[part, order, i + 1] = [n[i][name] for name in interactions.COUNTS]
                removed_by[part, c] += n[i]["removed"]
    return {(p, o, i, *v, removed_by[p, o[i - 1]]) for (p, o, i), v in out.items()}


def test_against_brute_force_with_odd_rows(spark):
    rows = cases.odd_rows()
    clean = " ".join(f"word{i}" for i in range(120))
    more = [clean, clean + " #", clean.upper(), "SHOUT " * 120, clean, clean, clean + " #", None, "", cases.PROSE * 30]
    rows += [(200 + i, t, ("en", "de", None)[i % 3], "s", 1) for i, t in enumerate(more)]
    rows += [(None, clean, "de", None, None), (200, clean, "en", None, None), (200, clean, "fr", None, None)]
    labels = [(i, i % 2, i % 3 % 2) for i in range(205)] + [(3, 1, None), (3, None, 1), (None, 1, 1), (204, 1, 1), (204, 1, 1)]
    docs = cases.clashing(cases.frame(spark, rows), "part", "kept", "_mask", "_n", "good")
    made = interactions.audit(docs, spark.createDataFrame(labels, LABELS))
    assert made.columns == ["part", "filter_order", "step", *interactions.COUNTS, "shapley"]
    got = [tuple(r) for r in made.collect()]
    assert len(got) == len(set(got)) == 600 * len({r[2] or "" for r in rows})
    assert set(got) == brute(rows, labels)


def test_no_rows_and_no_labels(spark):
    labels = spark.createDataFrame([], LABELS)
    assert interactions.audit(cases.frame(spark).limit(0), labels).count() == 0
    one = interactions.audit(cases.frame(spark, [(1, "a", None, None, None)]), labels)
    assert {tuple(r) for r in one.collect()} == brute([(1, "a", None, None, None)], [])


def test_orders_are_all_of_them():
    made = interactions.orders("ABCDE")
    assert len(set(made)) == 120 and made[0] == "ABCDE" and made[-1] == "EDCBA"
