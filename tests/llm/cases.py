"""Rows with everything a text operator must bear."""

from __future__ import annotations

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
PROSE = "the cat that was in the house and it is on the mat with a dog of his own "


def odd_rows() -> list[tuple]:
    """NULLs in every column, empty and very long texts, ties, repeated rows, repeated keys, odd characters."""
    long_text = " ".join(f"word{i} of the {i * 7919 % 1000}" for i in range(30_000))
    texts = [None, "", " \n\t ", "one", PROSE * 3, PROSE * 3, "Zażółć gęślą jaźń 日本 \U0001f642 é", "\x00a\x0bb c", "aaaa" * 700, long_text]
    rows = [(i, t, "en", "src", len(t) if t else 0) for i, t in enumerate(texts)]
    return [*rows, rows[4], rows[4], (None, PROSE * 3, None, None, None), (None, None, None, None, None), (4, "another text", "en", "src", 12)]


def frame(spark, rows=None):
    return spark.createDataFrame(odd_rows() if rows is None else rows, DOCS)


def clashing(df, *names):
    """The same rows with more columns, named like those an operator makes."""
    from pyspark.sql import functions as F

    for name in names:
        df = df.withColumn(name, F.lit("mine"))
    return df


def as_set(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)
