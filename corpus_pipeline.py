"""The training-data pipeline over ``documents``: each stage reads what the one before has written.

Quality rules drop documents, near duplicates leave one row of each group, repeated passages are cut
out of the texts, contaminated documents go, and what is left is encoded into pieces.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltgate.llm import decontam, pieces, quality, simhash, suffixes
from siltgate.llm.base import free_name, table
from siltgate.plans.sizing import stored


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and score at the threshold or above; NULL and empty texts go."""
    verdict = free_name(docs, "_quality")
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    return quality.judge(docs, model, into=verdict).where(F.col(verdict)["kept"]).drop(verdict)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest doc_id of each group; texts without words are one group."""
    return simhash.keep_one(docs)


# A passage of more than 50 words is seldom shorter in UTF-8.
PASSAGE_BYTES = 250


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the bytes that repeat elsewhere in strings of PASSAGE_BYTES; characters cut in two go, n_chars follows.

    Every document stays, with an empty text if nothing is left; NULL texts stay NULL.
    """
    cut = free_name(docs, "_cut")
    shorter = suffixes.remove_repeats(docs, into=cut, length=PASSAGE_BYTES).withColumn("text", F.when(F.col("text").isNotNull(), F.when(F.col(cut)["n_removed"] > 0, F.col(cut)["text"]).otherwise(F.col("text"))))
    if "n_chars" in docs.columns:
        shorter = shorter.withColumn("n_chars", F.when(F.col(cut)["n_removed"] > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return shorter.select(*docs.columns)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than one word in twenty lies in a benchmark passage."""
    found = free_name(docs, "_found")
    marked = decontam.find_items(docs, table(spark, sf_dir, "benchmark"), into=found)
    return marked.where(~decontam.is_contaminated(F.col(found))).drop(found)


def into_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, the ids of the text, and whether they decode to it."""
    model = pieces.load()
    slim = docs.select("doc_id", "lang", "source", "text")
    encoded = pieces.encode(slim, model).select("doc_id", "lang", "source", F.sha2(F.coalesce("text", F.lit("")), 256).alias("_digest"), F.col("_pieces.ids").alias("ids"))
    # Stored between: a task runs one Python worker, and the encoder's tables are gone before decoding.
    encoded = stored(encoded, "pieces")
    decoded = pieces.decode(encoded, model, "ids")
    return decoded.select(
        "doc_id",
        "lang",
        "source",
        F.size("ids").cast("long").alias("n_pieces"),
        "ids",
        (F.sha2("_decoded.text", 256) == F.col("_digest")).alias("round_trip"),
    )


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", quality_rules),
    ("simhash near duplicates", near_duplicates),
    ("suffix-array dedup", repeated_passages),
    ("benchmark decontamination", benchmark_passages),
    ("sentencepiece encoding", into_pieces),
]
# Hashed scores, XXH64 and merges are beyond SQL; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
