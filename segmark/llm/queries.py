"""Registered queries of the corpus operators."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from segmark.llm import (
    ann, collocations, conversations, decontam, langid, line_dedup, packing, repetition, secrets, simhash, suffix_dedup, toxicity, url_filter,
)
from segmark.llm.common import table
from segmark.session import scratch_path

URL_RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)


TOKENIZER = "word_bpe_49k.json"


def tokenizer_json(name: str = TOKENIZER) -> str:
    import public_tokenizers

    with open(public_tokenizers.path(name), encoding="utf-8") as f:
        return f.read()


def op1_repetition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repetition.repetition(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify_languages(table(spark, sf_dir, "documents").select("doc_id", "lang", "text")).select(
        "doc_id", "held_out", "lang_pred", "score", "cross_entropy", "rejected")


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = line_dedup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return cut.select("doc_id", "n_lines", "n_removed", F.sha2("text", 256).alias("text_sha256"))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_components(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    return cut.select("doc_id", "n_bytes", (F.col("n_bytes") - F.length("kept")).alias("n_removed"),
                      F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels").select("doc_id", "toxic"))
    return toxicity.score_toxicity(docs.withColumn("held_out", langid.held_out("doc_id")), model).select(
        "doc_id", "held_out", "score", "predicted")


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(list(URL_RULES), "host string, path string, verdict string")
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter.filter_urls(pages, rules).select("page_id", "host", "path", "rule", "verdict")


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_json())


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return secrets.scan_secrets(docs, scratch_path(spark, "secret-ledger")).select(
        "doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans")


def op11_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    fixed = conversations.repaired_after_damage(table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text"))
    return fixed.select("conv_id", "gaps", *conversations.COUNTS, "audit", F.sha2("repaired", 256).alias("repaired_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_repetition": op1_repetition,
    "op2_decontamination": op2_decontamination,
    "op3_language_id": op3_language_id,
    "op4_line_dedup": op4_line_dedup,
    "op5_simhash": op5_simhash,
    "op6_suffix_dedup": op6_suffix_dedup,
    "op7_toxicity": op7_toxicity,
    "op8_url_filter": op8_url_filter,
    "op9_best_fit_packing": op9_best_fit_packing,
    "op10_secret_scan": op10_secret_scan,
    "op11_nearest_neighbours": op11_nearest_neighbours,
    "op12_collocations": op12_collocations,
    "op13_conversation_repair": op13_conversation_repair,
}
