"""From raw documents to token ids: five stages, each over all that the one before it kept.

Every stage is a function of the session, its documents and the folder of the other tables. Its
result is written as Parquet to the shared folder and read again, so a lost executor costs at most one stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldbook.llm import bpe, decontaminate, jaccard_join, language, secret_scan
from fieldbook.llm.common import table
from fieldbook.session import stored


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the compressor can tell, learned from the rows with a label."""
    return language.accepted(docs, language.fit(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return jaccard_join.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of the benchmark."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets in their texts masked."""
    return secret_scan.redacted(docs, secret_scan.scan(docs))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids, n_bytes: the token ids of each text and the length of what they decode to."""
    import public_tokenizers

    coded = bpe.encode(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, decoded=True)
    return coded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", F.octet_length("decoded").cast("long").alias("n_bytes")
    )


STAGES = [
    ("language ID", known_language),
    ("near duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("secrets", secrets),
    ("tokens", tokens),
]

# The stages have no SQL form; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-').lower()}")
    return docs
