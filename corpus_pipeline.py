"""A training corpus from raw documents: quality, language, near-duplicates, secrets, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes it to the shared folder and reads it
again for the next stage. All but the last return the columns of documents.

Defined results: a null or empty text fails the quality rules, as it has too few words; without labels the rules alone decide
on quality; without a language tag on three documents nothing is learned, and all documents go in language ID; documents
with a null doc_id are no near-duplicate of anything and stay; rows that repeat a doc_id stay or go together in that
stage; other columns go along to the last stage; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from millrace.llm import language_id, minhash_dedup, packing, quality, secret_scan
from millrace.llm.queries import tokenizer_path
from millrace.llm.shared import cut


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and look like the trusted target."""
    return quality.accepted(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the languages that the input's own tags teach."""
    return language_id.accepted(docs, language_id.fit(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near-duplicates."""
    return minhash_dedup.deduplicated(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets replaced by their kind and n_chars brought up to date."""
    return secret_scan.redact(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in windows of 4096 ids."""
    return packing.pack(docs, tokenizer_path())


STAGES = [
    ("quality_rules", quality_rules),
    ("language_id", languages),
    ("minhash_dedup", near_duplicates),
    ("secret_scan", secrets),
    ("packing", packed),
]

#: No SQL: language, near-duplicate and packing stages can't be put in it. tests/llm has a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
