"""The corpus pipeline: documents through the operators of ``starloom.llm``, stage after stage.

A stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read
again as the next stage's ``docs``. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm import byte_bpe, decontaminate, near_dedup, quality_rules, suffix_dedup
from starloom.llm.frames import free
from starloom.session import materialise


def _counted(docs: DataFrame) -> DataFrame:
    """``n_chars`` of the text as it is now."""
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules, without their boilerplate lines."""
    return _counted(quality_rules.apply(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates."""
    return near_dedup.keep_one(docs)


def repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the strings of 100 bytes that start earlier in the corpus."""
    return _counted(suffix_dedup.apply(docs))


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    leaks = free("leaks", docs.columns)
    found = decontaminate.with_leaks(docs, benchmark, out=leaks)
    return found.where(F.size(leaks) == 0).drop(leaks)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text that is left."""
    return byte_bpe.encode(docs)


STAGES = [
    ("quality rules", rules),
    ("MinHash near-dedup", near_duplicates),
    ("suffix-array dedup", repeated_strings),
    ("benchmark decontamination", benchmark_leaks),
    ("byte-level BPE encoding", encode),
]

#: No stage is plain SQL; each operator is tested against brute force, the pipeline for its shape and odd rows.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES):
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{number}")
    return docs
