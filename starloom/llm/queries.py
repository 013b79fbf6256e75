"""The registered queries of this subpackage, one module-level function each."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm import (
    alignment,
    byte_bpe,
    conversation_repair,
    decontaminate,
    html_text,
    language_id,
    near_dedup,
    packing,
    quality_classifier,
    quality_rules,
    suffix_dedup,
    token_counts,
    warc,
)
from starloom.llm.frames import table


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, benchmark = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    found = decontaminate.with_leaks(docs.select("doc_id", "text"), benchmark, keep=["doc_id"])
    return found.select("doc_id", F.explode("leaks").alias("leak")).select(
        "doc_id",
        "leak.item_id",
        F.round("leak.cosine", 4).alias("cosine"),
        "leak.lcs_share",
        "leak.answer_share",
    )


def op2_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = html_text.extract(table(spark, sf_dir, "pages"), keep=["page_id", "url"])
    return found.withColumn("n_chars", F.length("text").cast("bigint"))


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.verdicts(table(spark, sf_dir, "documents"))
    return judged.select(
        "doc_id", *quality_rules.COUNTS, "base_failed", "kept", "words_left", F.size("removed").alias("lines_removed")
    )


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = warc.round_trip(table(spark, sf_dir, "pages"), payloads=False)
    return found.select(
        warc.page_number(F.col("record_id")).alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        warc.page_number(F.col("refers_to")).alias("refers_to"),
    )


#: Documents with more tokens are over the limit.
TOKEN_LIMIT = 4096


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", "text", F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint").alias("n_bytes")
    )
    return token_counts.count_tokens(docs, keep=["doc_id", "n_bytes"]).withColumn(
        "over_limit", F.col("n_tokens") > TOKEN_LIMIT
    )


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    decoded = byte_bpe.decode(byte_bpe.encode(docs, keep=["doc_id"]))
    return decoded.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join("ids", ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op8_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_dedup.classes(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "class_id", "class_size", "representative")


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(table(spark, sf_dir, "documents"))


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = suffix_dedup.deduplicate(table(spark, sf_dir, "documents").select("doc_id", "text"))
    removed = F.aggregate("removed_spans", F.lit(0).cast("bigint"), lambda n, s: n + s["stop"] - s["start"])
    return done.select(
        "doc_id",
        F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint").alias("n_bytes"),
        removed.alias("n_removed"),
        F.size("removed_spans").cast("bigint").alias("n_spans"),
        F.sha2("kept_bytes", 256).alias("kept_sha256"),
    )


def op11_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), keep=["doc_id"], ids=False)


def op12_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.compare(table(spark, sf_dir, "documents"), keep=["doc_id"])[0]


def op13_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    damaged = conversation_repair.damage(table(spark, sf_dir, "conversations"))
    return conversation_repair.repair(damaged, copies="copies")


def queries() -> dict:
    return {name: f for name, f in globals().items() if name.startswith("op")}


def oracle_sql() -> dict[str, str]:
    return {}
