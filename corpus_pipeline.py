"""The corpus pipeline: quality, line dedup, near dedup, decontamination, packing.

Each stage takes the table its predecessor kept and returns, but for the last, the columns
of ``documents``.  Between stages the table is written to the shared folder and read back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rollcall.llm import decontaminate, line_dedup, near_dedup, packing, quality_knn
from rollcall.llm.common import pin, prepare, table


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that nearest-neighbour voting does not reject."""
    prepare(spark)
    model = quality_knn.fit_documents(docs, table(spark, sf_dir, "labels"))
    return quality_knn.keep_good(docs, model)


def line_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines that equal or nearly equal an earlier line."""
    prepare(spark)
    return line_dedup.drop_lines(docs)


def near_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies."""
    prepare(spark)
    return near_dedup.keep_one(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of at most 1024 tokens."""
    prepare(spark)
    return packing.pack(packing.pieces(docs))


STAGES = [
    ("quality_classifier", quality_classifier),
    ("line_dedup", line_deduplication),
    ("near_dedup", near_deduplication),
    ("benchmark_decontamination", benchmark_decontamination),
    ("best_fit_packing", best_fit_packing),
]

#: Voting over latent vectors, DartMinHash and the genetic algorithm are not SQL; tests/llm
#: holds the stages against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; returns the packed pieces."""
    docs = table(spark, sf_dir, "documents")
    for number, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number + 1 < len(STAGES):
            docs = pin(docs, name)
    return docs
