"""Readers for the Parquet test tables, with the column lists each job needs.

Selecting columns right at the scan lets Catalyst prune the Parquet read
(``ReadSchema``) and push filters down (``PushedFilters``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def read_table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*columns) if columns else df
