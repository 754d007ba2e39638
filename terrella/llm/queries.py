"""The queries op1 to op10: each operator over its whole table, at production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from terrella.llm import bpe, embedding_dedup, language_id, mixing, near_dedup, oracles, pii, quality, secrets, suffix_dedup, token_counts
from terrella.llm.common import table


def _tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


def op1_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), _tokenizer("byte_bpe_multi_50k.tiktoken"), _pattern())


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.report(table(spark, sf_dir, "documents"))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.assess(table(spark, sf_dir, "documents")).select("doc_id", "quality.*")


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), _tokenizer("piece_bpe_32k.model"))


def op5_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.linked_vectors(table(spark, sf_dir, "embeddings"))


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(table(spark, sf_dir, "documents"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return language_id.identify(docs, language_id.fit(docs, "text", "lang"), host="source")


def op7_language_id_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages: their text, the language that their markup declares, host and suffix; the text model is of documents."""
    pages = language_id.markup(table(spark, sf_dir, "pages"))
    model = language_id.with_evidence(language_id.fit(table(spark, sf_dir, "documents"), "text", "lang"), pages, "page_id")
    return language_id.identify(pages, model, "page_id", declared="declared", host="host")


def op8_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"))


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.without_repeats(table(spark, sf_dir, "documents"))


def op10_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_bpe_round_trip": op1_bpe_round_trip,
    "op2_secret_scan": op2_secret_scan,
    "op3_quality_rules": op3_quality_rules,
    "op4_token_counts": op4_token_counts,
    "op5_embedding_near_dedup": op5_embedding_near_dedup,
    "op6_pii": op6_pii,
    "op7_language_id": op7_language_id,
    "op7_language_id_pages": op7_language_id_pages,
    "op8_minhash_near_dedup": op8_minhash_near_dedup,
    "op9_suffix_dedup": op9_suffix_dedup,
    "op10_source_mix": op10_source_mix,
}

ORACLES: dict[str, str] = {
    "op2_secret_scan": oracles.secret_scan(),
    "op3_quality_rules": oracles.quality_rules(),
    "op5_embedding_near_dedup": oracles.EMBEDDINGS,
    "op8_minhash_near_dedup": oracles.NEAR_DUPLICATES,
    "op10_source_mix": oracles.MIX,
}
