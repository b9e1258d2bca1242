"""The registered queries: each operator with production parameters over its whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from fieldbook.llm import oracles
from fieldbook.llm.common import table

QUERIES, ORACLES = {}, {}


def query(name: str, sql: str | None = None):
    def register(build):
        QUERIES[name] = build
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register


@query("op3_byte_bpe")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from fieldbook.llm import bpe

    coded = bpe.encode(
        table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, decoded=True
    )
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("ids", " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query("op4_language_id")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    from fieldbook.llm import language

    docs = table(spark, sf_dir, "documents")
    texts = language.fit(docs.where(~language.held_out(F.col("doc_id"))))
    told = language.predict(docs, texts)
    return told.select("doc_id", language.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "rejected")


@query("op8_license_scan", oracles.LICENSE_SCAN)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    from fieldbook.llm import license_scan

    return license_scan.scan(table(spark, sf_dir, "documents"))


@query("op5_fingerprints")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    from fieldbook.llm import fingerprint

    return fingerprint.report(table(spark, sf_dir, "documents"))


@query("op9_pii")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    from fieldbook.llm import pii

    docs = table(spark, sf_dir, "documents")
    found = pii.find(docs, pii.fit(docs))
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select(
        "doc_id", *[count(kind) for kind in pii.KINDS],
        F.sha2(pii.listed(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        pii.listed(F.concat("base", "extra")).alias("spans"),
        F.size("extra").cast("long").alias("n_extra"),
    )


@query("op10_quality_cotraining")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    from fieldbook.llm import cotrain

    docs, labels, pages = (table(spark, sf_dir, name) for name in ("documents", "labels", "pages"))
    return cotrain.score(docs, pages, cotrain.fit(docs, labels, pages))


@query("op1_secret_scan")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    from fieldbook.llm import secret_scan

    found = secret_scan.scan(table(spark, sf_dir, "documents"))
    return found.where("is_secret").select("doc_id", "kind", "start", "end", F.sha2("value", 256).alias("value_sha256"), "score")


@query("op2_jaccard_join", oracles.JACCARD_JOIN)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    from fieldbook.llm import jaccard_join

    found = jaccard_join.join(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.col("group_id").alias("class_id"), "copies", "n_links")


@query("op6_decontamination", oracles.DECONTAMINATION)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    from fieldbook.llm import decontaminate

    found = decontaminate.overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.groupBy("doc_id", "item_id").agg(
        F.count("*").alias("n_places"), F.min("first_word").cast("long").alias("first_word"),
        F.max("n_words").cast("long").alias("n_words"), F.max("n_same").cast("long").alias("n_same"),
    )


@query("pipeline", corpus_pipeline.ORACLE_SQL)
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)


@query("op7_suffix_dedup", oracles.SUFFIX_DEDUP)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    from fieldbook.llm import suffix_dedup

    left = suffix_dedup.dedup(table(spark, sf_dir, "documents"))
    return left.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query("op11_merkle_manifest", oracles.MERKLE_MANIFEST)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    from fieldbook.llm import merkle

    docs = table(spark, sf_dir, "documents")
    values = {name: F.col(name) for name in merkle.FIELDS}
    changed = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    tampered = merkle.leaf({**values, "text": F.replace(F.col("text"), F.lit("\n"), F.lit(""))})
    made = merkle.manifest(docs, {"tampered": F.when(changed, tampered)})
    made = made.withColumn("folded_root", merkle.folded(F.coalesce("tampered", "leaf"), F.col("proof")))
    return made.select(
        "doc_id", "leaf", "subroot", "root", merkle.digest(merkle.siblings(F.col("proof"))).alias("proof_sha256"),
        "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"),
    )


@query("op12_conversation_repair", oracles.CONVERSATION_REPAIR)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    from fieldbook.llm import conversations

    rows = table(spark, sf_dir, "conversations")
    return conversations.repair(conversations.damaged(rows), rows)


@query("op13_source_mixing")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    from fieldbook.llm import mixing

    return mixing.report(table(spark, sf_dir, "documents"))
