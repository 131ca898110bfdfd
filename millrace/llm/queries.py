"""The registered queries of the training-data operators. Each runs its operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import collocations, embedding_dedup, html_extract, language_id, lm_scoring, minhash_dedup, packing, pii, prefix_trie, quality, secret_scan, sentencepiece_codec, token_store
from .oracle import oracle_sql as oracle_sql
from .shared import shared_dir, ship

#: Tokenizer file of the public tokenizers' package.
WORD_BPE = "word_bpe_49k.json"
PIECE_BPE = "piece_bpe_32k.model"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str = WORD_BPE) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of every document in windows of 4096 ids."""
    return packing.pack(_table(spark, sf_dir, "documents"), tokenizer_path())


def op2_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and groups of every embedding."""
    return embedding_dedup.near_duplicates(_table(spark, sf_dir, "embeddings"))


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded to pieces and decoded again."""
    return sentencepiece_codec.round_trip(_table(spark, sf_dir, "documents"), tokenizer_path(PIECE_BPE))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learned from those that aren't held out."""
    return language_id.identify(_table(spark, sf_dir, "documents"))


def op5_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's losses under the target and the background model, and their difference."""
    return lm_scoring.cross_entropy_difference(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op6_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return html_extract.extract(_table(spark, sf_dir, "pages"))


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of secrets in every document, from a fresh ledger."""
    return secret_scan.digest(secret_scan.scan_documents(_table(spark, sf_dir, "documents")))


def op8_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The near-duplicate group of every document."""
    return minhash_dedup.near_duplicates(_table(spark, sf_dir, "documents"))


def op9_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's place and checksum, read back from the store by its key."""
    docs, path = _table(spark, sf_dir, "documents"), shared_dir(spark, "token-store")
    token_store.write(docs, path, tokenizer_path())
    return token_store.lookup(spark, path, docs)


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base measures and the verdict on every document."""
    return quality.quality(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op11_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of personal data in every document."""
    return pii.digest(pii.find(_table(spark, sf_dir, "documents")))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 2000 collocations of each language."""
    return collocations.collocations(_table(spark, sf_dir, "documents"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the prefix trie of the rebuilt conversations."""
    return prefix_trie.trie(_table(spark, sf_dir, "conversations"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_packing": op1_packing,
        "op2_embedding_dedup": op2_embedding_dedup,
        "op3_sentencepiece": op3_sentencepiece,
        "op4_language_id": op4_language_id,
        "op5_lm_scoring": op5_lm_scoring,
        "op6_html_extraction": op6_html_extraction,
        "op7_secret_scan": op7_secret_scan,
        "op8_minhash_dedup": op8_minhash_dedup,
        "op9_token_store": op9_token_store,
        "op10_quality_rules": op10_quality_rules,
        "op11_pii": op11_pii,
        "op12_collocations": op12_collocations,
        "op13_prefix_trie": op13_prefix_trie,
    }
