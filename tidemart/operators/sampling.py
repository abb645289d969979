"""Rerun-stable sampling (G3/X18) and per-day id blocks.

Two kinds of samples: ``stable_sample`` picks from a group's own rows, and
``sample_for_each`` gives every group rows of one common catalogue, as the order
generator does for each date.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window, functions as F

from ..functions.dates import ORDER_ID_BLOCK, day_index, iso_date
from .ranking import sequence_number


def stable_sample(df: DataFrame, group_col: str, key_col: str, k: int) -> DataFrame:
    """Pick ``least(k, n)`` rows per group without replacement, the same rows on every
    run: rank by md5(group_iso_date | key). Adds ``pick_rank`` (1..k).

    A top-k window plans a WindowGroupLimit, so before the shuffle each task
    keeps only its own k best rows of a group: a hot group stays cheap.
    """
    g = F.col(group_col)
    g_text = iso_date(g) if dict(df.dtypes)[group_col] == "date" else g.cast("string")
    h = F.md5(F.concat(g_text, F.lit("|"), F.col(key_col).cast("string")))
    w = Window.partitionBy(group_col).orderBy(h, F.col(key_col))
    return (df.withColumn("pick_rank", F.row_number().over(w))
              .where(F.col("pick_rank") <= F.lit(k)))


def next_prime(n: int) -> int:
    """The smallest prime that is at least ``n``."""
    c = max(n, 2)
    while any(c % d == 0 for d in range(2, math.isqrt(c) + 1)):
        c += 1
    return c


def sample_for_each(groups: DataFrame, group_col: str, catalogue: DataFrame, key_col: str, k: int) -> DataFrame:
    """For each group, least(k, n) distinct rows of a catalogue of n, the same on every run.

    The catalogue's keys are numbered 0..n-1 in key order. With p the smallest prime from n on,
    j -> (a j + b) mod p is a permutation of 0..p-1, and a (not 0) and b come from the group's md5.
    A group's picks are its first k values below n, so they differ by construction, and as at most
    p - n values lie beyond the catalogue, k + p - n slots always hold them. Groups and catalogue
    meet in an equi-join on the number: every group gets k rows, and no pair that is not a pick
    is ever made. Over all a and b any ordered pair of picks is equally likely.

    Groups are the distinct values of ``group_col``, null being one of them. Rows of the catalogue
    whose key is null can't be picked; its keys must not repeat. An empty catalogue gives no rows.
    Adds ``pick_rank`` (1..k).
    """
    numbered = sequence_number(catalogue.where(F.col(key_col).isNotNull()), [key_col], out_col="_number")
    n = numbered.count()
    p = next_prime(n)
    is_date = dict(groups.dtypes)[group_col] == "date"
    name = F.coalesce(iso_date(F.col(group_col)) if is_date else F.col(group_col).cast("string"), F.lit(""))
    digest = F.md5(name)
    part = lambda at: F.conv(F.substring(digest, at, 13), 16, 10).cast("bigint")
    a, b = F.lit(1) + F.pmod(part(1), F.lit(p - 1)), F.pmod(part(14), F.lit(p))
    slots = F.transform(F.sequence(F.lit(0), F.lit(min(p, k + p - n) - 1)), lambda j: F.pmod(a * j + b, F.lit(p)))
    picks = F.slice(F.filter(slots, lambda x: x < n), 1, k)
    chosen = (groups.select(group_col).distinct()
              .select(group_col, F.posexplode(picks).alias("_slot", "_pick")))
    return (chosen.join(numbered, F.col("_pick") + 1 == F.col("_number"))
            .withColumn("pick_rank", F.col("_slot") + 1).drop("_slot", "_pick", "_number"))


class BlockOverflowError(RuntimeError):
    pass


def order_id_blocks(orders: DataFrame, date_col: str = "extraction_date",
                    key_col: str = "order_id", block: int = ORDER_ID_BLOCK,
                    strict: bool = True) -> DataFrame:
    """``new_id = day_index * block + position in the day`` (1-based, by key).

    Numbering is distributed (see ``ranking.sequence_number``), so a day holding
    a third of all orders still spreads over many tasks. A day with more than
    ``block`` orders raises, as its ids would enter the next day's block; without
    ``strict`` that is left to ``quality.day_block_overlaps``.
    """
    seq = sequence_number(orders.select(date_col, key_col), [key_col], [date_col],
                          out_col="seq_in_day")
    out = seq.select(date_col, key_col,
                     day_index(F.col(date_col)).alias("day_index"), "seq_in_day",
                     (day_index(F.col(date_col)).cast("bigint") * F.lit(block)
                      + F.col("seq_in_day")).alias("block_id"))
    if strict:
        over = out.where(F.col("seq_in_day") > block).select(date_col).limit(1).collect()
        if over:
            raise BlockOverflowError(f"more than {block} orders on {over[0][0]}")
    return out
