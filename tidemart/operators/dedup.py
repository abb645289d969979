"""Latest version per key (W1/W2, P12) and duplicate-key counting."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column],
                   cluster: Sequence[str] = ()) -> DataFrame:
    """Keep the first row per key under ``order`` (``qualify row_number() = 1``).

    ``order`` must be a total order over the rows that differ, so the pick is
    stable across reruns. ``cluster`` may name a coarser column set that the
    key determines (e.g. ``order_id`` for an order-item key): the window then
    reuses a hash partitioning on it instead of shuffling again.

    Catalyst plans a WindowGroupLimit: a partial top-1 runs before the shuffle,
    so a hot key reaches the final task with at most one row per map partition.
    """
    part_cols = list(cluster) + [k for k in keys if k not in cluster]
    w = Window.partitionBy(*part_cols).orderBy(*order)
    return (df.withColumn("_rn", F.row_number().over(w))
              .where(F.col("_rn") == 1)
              .drop("_rn"))


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys (non-null) that occur more than once; partial aggregation before the shuffle."""
    not_null = None
    for k in keys:
        c = F.col(k).isNotNull()
        not_null = c if not_null is None else (not_null & c)
    return (df.where(not_null).groupBy(*keys).count().where(F.col("count") > 1))
