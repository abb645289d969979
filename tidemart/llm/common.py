"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import sys
from collections.abc import Callable, Hashable
from types import ModuleType
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.session import apply_job_conf, checkpoint_root, scratch_dir

__all__ = ["apply_job_conf", "block_of", "carried", "components", "documents", "keyed", "labels", "lightened", "n_blocks",
           "per_process", "pin", "quoted", "release", "small_batches", "text_bytes", "unpacked"]

# what goes to a Python worker at once; a batch is held by the executor and by the worker at the same time
BATCH_CONF = {"spark.sql.execution.arrow.maxRecordsPerBatch": "1000", "spark.sql.execution.arrow.maxBytesPerBatch": "4m"}


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def keyed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only (doc_id, text), null text as empty: further columns, whatever their names, don't clash."""
    return docs.select(docs[id_col].cast("long").alias("doc_id"),
                       F.coalesce(docs[text_col], F.lit("")).alias("text"))


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def carried(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``keyed`` rows and, as one struct ``row``, all columns of ``docs``, so that no name of theirs can clash.

    The struct's fields are numbered; the text is in it only as whether it is null.
    """
    fields = [(F.col(quoted(c)).isNull() if c == text_col else F.col(quoted(c))).alias(f"c{i}")
              for i, c in enumerate(docs.columns)]
    return docs.select(F.struct(*fields).alias("row"), F.col(quoted(id_col)).cast("long").alias("doc_id"),
                       F.coalesce(F.col(quoted(text_col)), F.lit("")).alias("text"))


def unpacked(columns: list[str], text_col: str, text: Column) -> list[Column]:
    """The columns that ``carried`` packed, with another text; one that was null stays so while nothing is in it."""
    was_null = F.col(f"row.c{columns.index(text_col)}")
    return [(F.when(~(was_null & (text == "")), text) if c == text_col else F.col(f"row.c{i}")).alias(c)
            for i, c in enumerate(columns)]


def text_bytes(docs: DataFrame) -> int:
    """UTF-8 bytes of all texts of ``keyed`` rows."""
    return docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0


def n_blocks(docs: DataFrame, block_bytes: int) -> int:
    """How many hash blocks of about ``block_bytes`` of text the documents make; grows with the data."""
    return max(1, -(-text_bytes(docs) // block_bytes))


def block_of(n: int, *cols: str) -> Column:
    return F.pmod(F.xxhash64(*(cols or ("doc_id",))), F.lit(n)).cast("int")


def pin(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` under the shared folder and read it back: lineage ends, executors may be lost."""
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def lightened(written: DataFrame, weight: Column, most: int) -> DataFrame:
    """A written table for a join: broadcast if its total weight is checked to be small, else shuffled as planned."""
    total = written.agg(F.sum(weight)).first()[0] or 0
    return F.broadcast(written) if total <= most else written


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) of an undirected graph given as long pairs; root is the component's smallest node.

    Alternating large-star and small-star steps: each links a node's neighbours
    to the smallest of them, so paths halve until only stars are left. A step
    aggregates per node (combined before the shuffle) and joins, which AQE
    splits for a node with many links; nothing is gathered per node.
    """
    spark = edges.sparkSession
    checkpoint_root(spark)
    e = (edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
         .where("u <> v").distinct().checkpoint())
    mark = None
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        # large star: larger neighbours of u point to the smallest of u and its neighbours
        large = (both.where("v > u").join(low, "u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(low.select("u", F.col("m").alias("v"))).where("u <> v").distinct())
        # small star: smaller neighbours of u and u itself point to the smallest of them
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        e = (large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
             .unionByName(least.select("u", F.col("m").alias("v"))).distinct().checkpoint())
        new = tuple(e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if new == mark:
            break
        mark = new
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def small_batches(spark: SparkSession) -> None:
    """Whole texts go to Python workers a few MB at a time, not a scan split in one batch; no result depends on it."""
    for k, v in BATCH_CONF.items():
        spark.conf.set(k, v)


def release() -> None:
    """Give memory that earlier groups took back to the system: workers live on beside their executor's other tasks."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # where the C library has it
    if trim:
        trim(0)


def per_process(key: Hashable, make: Callable[[], Any]) -> Any:
    """An object that a Python worker keeps for its later tasks (vocabularies, memo tables)."""
    held = sys.modules.setdefault("_kept_by_worker", ModuleType("_kept_by_worker")).__dict__.setdefault("kept", {})
    if key not in held:
        held[key] = make()
    return held[key]
