"""Corpus pipeline: five stages over documents, each written as Parquet and read again.

Each stage works on all rows that its predecessor kept, and its decisions take effect. All but the last
return the columns of documents; the last returns the mix.
"""
from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kindling.llm.decontam import drop_contaminated_rows
from kindling.llm.langid import keep_identified
from kindling.llm.lines import drop_boilerplate
from kindling.llm.mixing import mix
from kindling.llm.simhash import keep_one
from kindling.session import work_dir
from kindling.sources.tables import table


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without letters, without a main language, or that fit no learned language, go."""
    return keep_identified(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Boilerplate lines of a source go from its documents' texts; all documents stay."""
    kept = drop_boilerplate(docs, counts=False)
    if "n_chars" in docs.columns:
        kept = kept.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return kept.select(*[F.col(f"`{c}`") for c in docs.columns])


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies stays: the one with the smallest doc_id."""
    return keep_one(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows in which a passage of a test item occurs go."""
    return drop_contaminated_rows(docs, table(spark, sf_dir, "benchmark"))


def mix_to_target_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The words that the mix takes of each document left."""
    return mix(docs)


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("simhash_near_dedup", simhash_near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("mix_to_target_weights", mix_to_target_weights),
]

#: Language mixtures, fingerprints and pseudorandom mixing aren't SQL; the tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each stage's rows are written to the shared folder and reread."""
    docs = table(spark, sf_dir, "documents")
    base = work_dir(spark, f"pipeline-{uuid.uuid4().hex}")
    for k, (name, stage) in enumerate(STAGES):
        path = f"{base}/{k}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
