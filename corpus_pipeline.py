"""The corpus pipeline: quality rules, near-dedup, secrets, source mix, tokens.

Each stage takes (spark, docs, sf_dir) and works on all documents that its predecessor kept. All but the last
return the columns of documents.

Rules for odd rows, in every stage: an empty table gives an empty one; columns beyond those of documents pass
through all stages but the last, whatever their names; very long texts are taken whole. Nulls, ties and repeated
rows: see each stage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrella.llm import bpe, mixing, near_dedup, quality, secrets
from terrella.llm.common import small, staged, table

#: Words of a shingle in the near-dedup stage; two words are the query op8's.
SHINGLE_WORDS = 5


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go; the others lose their host's boilerplate lines.

    A null or empty text has under 20 words and goes. Rows with a null source are one host. Repeated rows are judged
    alike, so all stay or all go.
    """
    judged = quality.assess(docs, out="__quality", keep_text=True).filter("__quality.kept")
    changed = F.col("__quality.words_left") < F.col("__quality.n_words")
    fresh = {"text": F.col("__quality.text"), "n_chars": F.when(changed, F.length("__quality.text").cast("long")).otherwise(F.col("n_chars"))}
    return judged.select(*[fresh.get(c, F.col(c)).alias(c) for c in docs.columns])


def minhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies, by shingles of five words, the document with the least id stays.

    A text of fewer words is one shingle. Rows that repeat an id are one document and stay or go together; a row with
    a null id or without words stays. Ids don't tie, so each group keeps one id.
    """
    gone = staged(near_dedup.near_duplicates(docs, width=SHINGLE_WORDS).filter("not kept").select("doc_id").distinct())
    return docs.join(small(gone), "doc_id", "left_anti").select(*docs.columns)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark; a null text stays null. Repeated rows and null ids are treated like any others."""
    return secrets.redacted(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it; where a target ends inside of one, the words taken. Each file's rows
    stand in slot order.

    A text without words is never taken. A null source is a source. Repeated rows each have a place in their source;
    ties in the order of a source are broken by id, size and the row's hashes.
    """
    return mixing.mixed_documents(docs)


def bpe_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Tokens of each row, and hashes of the ids and of what they decode to; a null text counts as empty."""
    import public_tokenizers

    return bpe.digests(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules),
    ("minhash_near_dedup", minhash_near_dedup),
    ("secret_scan", secret_scan),
    ("source_mix", source_mix),
    ("bpe_tokens", bpe_tokens),
]

#: Near-dedup and tokens can't be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
