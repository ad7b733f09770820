"""Corpus pipeline: documents to packed training sequences, one written table per stage.

1. language ID: documents rejected by every language model go;
2. line dedup: one line of each group of similar lines stays;
3. SimHash near-dedup: one document of each component of near copies stays;
4. benchmark decontamination: documents with too many words of test items go;
5. best-fit packing: what remains is tokenised and packed into sequences.

Each stage reads what its predecessor wrote; all but the last return the columns of
``documents``. The steps learn and count on their own input alone.
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from segmark.llm import decontam, langid, line_dedup, packing, simhash
from segmark.llm.common import handover, table
from segmark.llm.queries import tokenizer_json

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return langid.drop_rejected(docs)


def deduplicate_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    cut = line_dedup.dedup_lines(docs)
    if "n_chars" in docs.columns:
        cut = cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return cut.select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.drop_near_copies(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs, tokenizer_json())


STAGES: list[tuple[str, Stage]] = [
    ("language_id", identify_language),
    ("line_dedup", deduplicate_lines),
    ("near_dedup", drop_near_copies),
    ("decontamination", decontaminate),
    ("packing", pack_sequences),
]

#: Language models, union-find and tokenizers have no SQL form; tests compare with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each is written as Parquet and reread by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = handover(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
