"""From raw documents to packed training sequences: five stages, each one operator, each written and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lodeflow.llm import decontaminate, langid, linededup, packing, simhash
from lodeflow.llm.queries import tokenizer_file
from lodeflow.session import prepare, shared_path, table


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is accepted."""
    prepare(spark)
    return langid.accepted_rows(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without chunks of lines that occurred before."""
    prepare(spark)
    return linededup.dedup_lines(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    prepare(spark)
    return simhash.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark passages."""
    prepare(spark)
    return decontaminate.contaminated_rows(docs, table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents, with their places in sequences of 4096 tokens."""
    prepare(spark)
    return packing.pack(docs, tokenizer_file("word_bpe_49k.json"))


STAGES = [("language_id", language_id), ("line_dedup", line_dedup), ("near_dedup", near_dedup), ("decontamination", decontamination), ("packing", packed)]

#: Stages fit models, link fingerprints and pack bins; SQL can't express them. Tests hold each against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; what a stage returns is written to the shared folder and read for the next."""
    prepare(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = shared_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
