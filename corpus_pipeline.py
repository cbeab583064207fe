"""The corpus pipeline: quality rules, line dedup, near-dedup, secret redaction, packing.

Every stage takes (spark, docs, sf_dir) and works on all that its predecessor
kept; all but the last return the columns of ``documents``, whatever further
ones there are and whatever they are called. ``n_chars`` follows the text where
a stage changes it. Null ids and repeated rows pass as rows of their own; an
empty table gives an empty result.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import line_dedup, minhash_dedup, packing, quality_rules, secret_scan
from tidemark.llm.textops import bound_batches
from tidemark.llm.workspace import Workspace


def _recount(docs: DataFrame) -> DataFrame:
    if "n_chars" not in docs.columns:
        return docs
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def _bounded(stage):
    """The stage, with the bytes of an Arrow batch bounded: stages follow each other in the same executors, whose tasks hold several batches."""

    @functools.wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        bound_batches(spark)
        return stage(spark, docs, sf_dir)

    return run_stage


@_bounded
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go, among them null and empty texts."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality_rules.keep_good(docs, quality_rules.fit(docs, labels))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that many documents share go; all documents stay, a null text as an empty one."""
    aside = {c: f"_own_{c}" for c in docs.columns if c in ("n_lines", "n_dropped")}  # the operator's own columns
    done = line_dedup.line_dedup(docs.withColumnsRenamed(aside)).withColumnsRenamed({"n_lines": "_n_lines", "n_dropped": "_n_dropped"})
    return _recount(done.withColumnsRenamed({v: k for k, v in aside.items()}).select(*docs.columns))


@_bounded
def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every near-duplicate group stays, the one with the smallest id; rows without an id or a word stay."""
    return minhash_dedup.drop_near_duplicates(docs)


@_bounded
def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark; all documents stay."""
    return _recount(secret_scan.redact_secrets(docs, secret_scan.learn_grammars(docs)))


@_bounded
def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents, placed in sequences; null texts are empty, repeated rows and null ids documents of their own."""
    return packing.best_fit_pack(docs)


STAGES = [("quality_rules", quality), ("line_dedup", lines), ("near_dedup", near_dedup), ("secret_scan", secrets), ("best_fit_packing", pack)]

#: Trained models and tokenizers are beyond SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    ws = Workspace(spark, "pipeline")
    for name, stage in STAGES[:-1]:
        done = ws.save(stage(spark, docs, sf_dir), name)
        ws.drop(docs)  # nothing reads the stage before any more; the input itself stays
        docs = done
    return STAGES[-1][1](spark, docs, sf_dir)
