"""One registered query per operator, over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from rollcall.llm import decontaminate, fill_middle, fingerprint, hard_negatives, jaccard_join, license_scan, line_dedup, near_dedup, packing, pii, quality_knn, suffix_dedup, url_filter
from rollcall.llm.common import table


def op1_quality_knn(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality_knn.fit_documents(docs, table(spark, sf_dir, "labels"))
    return quality_knn.classify(docs, model)


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.removals(table(spark, sf_dir, "documents"))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.report(table(spark, sf_dir, "documents"))


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(packing.pieces(table(spark, sf_dir, "documents")))


def op5_url_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"), url_filter.outcomes(table(spark, sf_dir, "labels")))


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.summary(license_scan.scan(table(spark, sf_dir, "documents")))


def op7_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.fingerprints(table(spark, sf_dir, "documents"))


def op8_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.classes(table(spark, sf_dir, "documents")).select("doc_id", "class_id")


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.summary(pii.spans(table(spark, sf_dir, "documents")))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = hard_negatives.relabelled(table(spark, sf_dir, "embeddings"))
    return hard_negatives.mine(vectors, F.col("vec_id") % 100 == 0)


def op12_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.join(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_middle.digest(fill_middle.fill_in_middle(table(spark, sf_dir, "documents")))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {
    f.__name__: f
    for f in (
        op1_quality_knn, op2_suffix_dedup, op3_line_dedup, op4_best_fit_packing, op5_url_reputation, op6_license_scan,
        op7_fingerprints, op8_near_dedup, op9_decontamination, op10_pii, op11_hard_negatives, op12_jaccard_join, op13_fill_in_middle, pipeline,
    )
}
ORACLES = {"op5_url_reputation": url_filter.ORACLE_SQL}
