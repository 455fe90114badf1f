"""The corpus pipeline: filter, de-duplicate, decontaminate, redact and encode the ``documents`` table.

Each stage takes (spark, docs, sf_dir) and works on all that the one before it kept. ``run`` stores every stage's result as
Parquet in the shared folder and reads it back, so a lost executor costs no more than the stage at hand.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkloom.llm.decontaminate import contamination
from linkloom.llm.near_dup import near_duplicates
from linkloom.llm.quality_crf import keep_quality
from linkloom.llm.queries import piece_digests
from linkloom.llm.secrets import redact_secrets
from linkloom.session import find_package, stored


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the line labels accept."""
    find_package(spark)
    return keep_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group: that with the smallest id, a row without one only where no other has any.

    Rows are told apart by id and text together, so an id with two texts is two documents, and rows that repeat both are one
    (any of them stays). Null and empty texts are linked with nothing.
    """
    find_package(spark)
    rows = docs.withColumn("_row", F.xxhash64("doc_id", "text"))
    found = near_duplicates(rows.select(F.col("_row").alias("doc_id"), "text")).select(F.col("doc_id").alias("_row"), "component_id")
    order = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "_row")
    first = rows.select("_row", "doc_id").distinct().join(found, "_row").groupBy("component_id").agg(F.min(order).alias("first")).select("first._row")
    return rows.dropDuplicates(["_row"]).join(first, "_row", "left_semi").select(docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of the benchmark, told apart by their texts: ids may be missing or repeated."""
    find_package(spark)
    rows = docs.withColumn("_row", F.xxhash64("text"))
    found = contamination(rows.select(F.col("_row").alias("doc_id"), "text"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return rows.join(found.select(F.col("doc_id").alias("_row")), "_row", "left_anti").select(docs.columns)


def secret_redaction(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets cut out of their texts."""
    find_package(spark)
    return redact_secrets(docs)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Digests of each document's ids, spans and decoded text."""
    find_package(spark)
    return piece_digests(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality),
    ("dedup", dedup),
    ("decontamination", decontamination),
    ("secrets", secret_redaction),
    ("encoding", encoding),
]

#: SQL can't express the line labels or the piece encoding; tests hold the stages against plain versions.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs, _ = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
