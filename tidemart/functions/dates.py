"""Date helpers: spine (X11), calendar attributes (X8-X10), day index."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Fixed values that must equal the reference's: the default spine runs from
# 2025-01-01 (inclusive) to 2027-01-01 (exclusive), the day index counts days
# from 2026-01-01, and each day owns a block of 100 order ids.
DEFAULT_SPINE_START = "2025-01-01"
DEFAULT_SPINE_END_EXCLUSIVE = "2027-01-01"
DAY_INDEX_EPOCH = "2026-01-01"
ORDER_ID_BLOCK = 100


def day_index(d: Column) -> Column:
    """Days since the epoch date; negative before it."""
    return F.datediff(d, F.lit(DAY_INDEX_EPOCH).cast("date"))


def calendar_columns(d: Column) -> list[Column]:
    """dim_date attributes. ``day_of_week`` counts Sunday as 0."""
    return [
        d.alias("date_key"),
        F.year(d).alias("year"),
        F.month(d).alias("month"),
        F.dayofmonth(d).alias("day"),
        F.dayname(d).alias("day_name"),
        (F.dayofweek(d) - 1).alias("day_of_week"),
    ]


def spine_from_bounds(bounds: DataFrame, start: str = "start", end_exclusive: str = "end") -> DataFrame:
    """One row per day in [start, end). ``bounds`` holds one row per range.

    The day list of a range is bounded by the calendar, not by data volume.
    """
    days = F.sequence(F.col(start), F.date_sub(F.col(end_exclusive), 1), F.expr("interval 1 day"))
    return (bounds.where(F.col(start) < F.col(end_exclusive))
                  .select(F.explode(days).alias("date_day")))


def date_spine(spark: SparkSession, start: str = DEFAULT_SPINE_START,
               end_exclusive: str = DEFAULT_SPINE_END_EXCLUSIVE) -> DataFrame:
    """Day spine for fixed parameter bounds (the reference's default is 730 days)."""
    _dt.date.fromisoformat(start)
    _dt.date.fromisoformat(end_exclusive)
    n_days = (_dt.date.fromisoformat(end_exclusive) - _dt.date.fromisoformat(start)).days
    # Distributed: one row per day from a range, no array in a single row.
    return (spark.range(max(n_days, 0))
                 .select(F.date_add(F.lit(start).cast("date"), F.col("id").cast("int")).alias("date_day")))


def iso_date(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM-dd")


def parse_run_date(text: str | None) -> _dt.date:
    """A run date given as ``YYYY-MM-DD``; today in UTC when none is given."""
    if text is None:
        return _dt.datetime.now(_dt.timezone.utc).date()
    return _dt.datetime.strptime(text, "%Y-%m-%d").date()
