"""Corpus pipeline: toxicity, line dedup, near duplicates, repeated passages, packing.

Each stage reads what the one before it wrote. All but the last return the
columns of their input; the last returns the packed pieces.

Defined results: a null text is empty. Rows with a null id are kept by every
stage, as no decision can name them. Rows that share an id share the decisions
taken for it. Texts that tie, as copies do, are told apart by the smallest id. A
very long text is worked on whole, by one task of a stage. Extra columns pass
through whatever they are called, as long as the names differ from each other. An
empty table gives an empty result.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.llm import jaccard_join, line_dedup, packing, suffix_dedup, toxicity
from tidemart.llm.common import apply_job_conf, documents, labels, lightened, pin, small_batches

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


def with_lengths(docs: DataFrame) -> DataFrame:
    """``docs`` with the length column, where there is one, as of the text."""
    if "n_chars" not in docs.columns:
        return docs
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def without_ids(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows whose id is not among ``ids`` (one column, whatever its name); null ids stay."""
    ids = pin(ids.select(F.col(ids.columns[0]).alias("gone")).distinct(), "gone")
    ids = lightened(ids, F.lit(1), 1_000_000)
    return docs.join(ids, docs["doc_id"] == ids["gone"], "left_anti")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    scores = toxicity.score(docs, labels(spark, sf_dir))
    return without_ids(docs, scores.where("predicted = 1").select("doc_id"))


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return with_lengths(line_dedup.dedup(docs))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    found = jaccard_join.join(docs)
    return without_ids(docs, found.where("doc_id <> class_id").select("doc_id"))


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return with_lengths(suffix_dedup.rewrite(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return packing.pack_documents(docs, VOCABULARY)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", dedup_lines),
    ("jaccard_join", drop_near_duplicates),
    ("suffix_dedup", cut_repeated_passages),
    ("packing", pack),
]

#: Learned scores, sketches and tokenizers are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents of ``sf_dir``; each stage's rows are written and read again."""
    apply_job_conf(spark)
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = pin(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
