"""Star schema: dim_product (P5), dim_date (X8-X11), fact_order_items (P6), daily summary (A1)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions import pricing
from ..functions.dates import calendar_columns
from .dedup import latest_per_key

DIM_PRODUCT_COLUMNS = ["product_id", "title", "category", "price", "rating_rate", "rating_count"]


def dim_product(stg_products: DataFrame) -> DataFrame:
    return stg_products.select(*DIM_PRODUCT_COLUMNS)


def dim_date(spine: DataFrame, day_col: str = "date_day") -> DataFrame:
    return spine.select(*calendar_columns(F.col(day_col)))


FACT_COLUMNS = ["order_item_key", "order_id", "product_id", "date_key", "quantity", "unit_price",
                "line_total", "discount_percentage", "line_discounted_total", "loaded_at"]
FACT_MEASURES = ["quantity", "unit_price", "line_total", "discount_percentage",
                 "line_discounted_total"]


def item_key(order_id, product_id):
    """order_id || '_' || product_id; null when either side is null (unlike concat_ws)."""
    return F.concat(order_id.cast("string"), F.lit("_"), product_id.cast("string"))


def fact_rows(stg_items: DataFrame) -> DataFrame:
    """P6 projection: surrogate key, extraction_date renamed date_key. No dedup."""
    extra = [c for c in stg_items.columns
             if c not in ("order_id", "product_id", "extraction_date", "loaded_at", *FACT_MEASURES)]
    return stg_items.select(
        item_key(F.col("order_id"), F.col("product_id")).alias("order_item_key"),
        "order_id", "product_id",
        F.col("extraction_date").alias("date_key"),
        *[c for c in FACT_MEASURES if c in stg_items.columns], *extra,
        "loaded_at",
    )


def dedup_items(stg_items: DataFrame) -> DataFrame:
    """One row per (order, product): the latest load, then the largest of every other column,
    so equal picks are equal rows (the items view itself does not dedup, and a key repeated
    within a batch would break the merge). Rows without a full key are all kept.
    """
    rest = ["extraction_date", *[c for c in FACT_MEASURES if c in stg_items.columns],
            *[c for c in stg_items.columns if c not in ("order_id", "product_id", "extraction_date",
                                                        "loaded_at", *FACT_MEASURES)]]
    order = [F.col(c).desc_nulls_last() for c in ["loaded_at", *rest]]
    # a row without a full key is its own group, wherever it is
    lone = F.when(F.col("order_id").isNull() | F.col("product_id").isNull(), F.monotonically_increasing_id())
    return latest_per_key(stg_items.withColumn("_lone", lone), ["product_id", "_lone"], order,
                          cluster=["order_id"]).drop("_lone")


def build_fact(stg_items: DataFrame) -> DataFrame:
    """fact_order_items from staged items; the key is built after the dedup, which needs the ids only."""
    return fact_rows(dedup_items(stg_items))


SUMMARY_COLUMNS = ["date_key", "total_orders", "total_quantity", "total_revenue",
                   "total_discounted_revenue", "loaded_at"]


def daily_summary(fact: DataFrame) -> DataFrame:
    """A1: per date, distinct orders, quantity, rounded revenue sums, latest load.

    count(distinct) is planned as a two-level aggregate (date, order) -> date, so
    a date holding a third of all rows is still spread over many tasks.
    """
    return fact.groupBy("date_key").agg(
        F.countDistinct("order_id").alias("total_orders"),
        F.sum("quantity").cast("bigint").alias("total_quantity"),
        pricing.to_double(pricing.money_sum("line_total")).alias("total_revenue"),
        pricing.to_double(pricing.money_sum("line_discounted_total")).alias("total_discounted_revenue"),
        F.max("loaded_at").alias("loaded_at"),
    )
