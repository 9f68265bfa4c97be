"""The registered queries of this package over the given tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltgate.llm import decontam, html, interactions, jaccard, langid, lm, pieces, quality, resampling, sharding, simhash, suffixes, warc
from siltgate.llm.base import table
from siltgate.plans.sizing import scratch_path, stored

SHARDS = 40


def op1_block_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html.extract(pages).select("page_id", "url", "_main.text", F.length("_main.text").cast("long").alias("n_chars"))


def op2_dictionary_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "warc")
    stored(warc.write(table(spark, sf_dir, "pages"), folder), "warc-index")
    return warc.read(spark, folder).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op3_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontam.find_items(docs, table(spark, sf_dir, "benchmark"), into="_found")
    return found.select(
        "doc_id",
        "_found.n_words",
        "_found.n_hit",
        F.size("_found.items").cast("long").alias("n_items"),
        F.sha2(F.array_join("_found.items", ","), 256).alias("items_sha256"),
        decontam.is_contaminated(F.col("_found")).alias("contaminated"),
    )


def op4_merged_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return suffixes.remove_repeats(docs).select(
        "doc_id", "_cut.n_bytes", "_cut.n_removed", "_cut.n_spans", F.sha2("_cut.kept", 256).alias("kept_sha256"), "_cut.text"
    )


def op5_hypergeometric_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document in one of 40 shards, law ``rows``; NULL text counts no bytes, so size 16 and CRC 0."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    # The texts move with their rows; size and CRC are taken of what arrived.
    return sharding.shuffle_into(docs, SHARDS).select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 16).alias("size"),
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
        F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op6_ngram_likelihood(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    return quality.judge(docs, model).select("doc_id", "_quality.*")


def op7_simhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op8_lattice_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every whole document, and whether decoding them gives the text back (NULL text: empty)."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = pieces.load()
    encoded = pieces.encode(docs, model).select("doc_id", F.sha2(F.coalesce("text", F.lit("")), 256).alias("_digest"), F.col("_pieces.ids").alias("ids"))
    # Stored between: a task runs one Python worker, and the encoder's tables are gone before decoding.
    encoded = stored(encoded, "pieces")
    decoded = pieces.decode(encoded, model, "ids")
    return decoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_pieces"),
        "ids",
        (F.sha2("_decoded.text", 256) == F.col("_digest")).alias("round_trip"),
    )


def op9_ppm_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    test = langid.held_out(F.col("doc_id"), 4, 2)
    trees = langid.fit(docs.where(~test))
    return langid.predict(docs.select("doc_id", test.alias("held_out"), "text"), trees).select("doc_id", "held_out", "_language.*")


def op10_recurrent_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    test = langid.held_out(F.col("doc_id"), 10, 0)
    scored = lm.score(docs.select("doc_id", test.alias("held_out"), "text"), docs.where(~test).select("doc_id", "text"))
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op11_banded_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(table(spark, sf_dir, "documents"))


def op12_filter_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return interactions.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_importance_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: made for name, made in globals().items() if name.startswith("op") and callable(made)}
