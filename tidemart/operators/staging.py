"""Staging: typed, flattened frames from raw variant tables.

A raw table has ``raw_data variant`` holding ``{extraction_date, source_file,
record}`` and ``loaded_at timestamp_ntz``. Paths are cast by name; a missing
path gives null and a value that does not cast fails the query (ANSI), as in
the reference. Ids are cast before partitioning, so ``1`` and ``"1"`` are one
product here (a variant cannot be partitioned on).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.variant import path
from .dedup import latest_per_key

RAW = "raw_data"


def _lineage_cols() -> list:
    return [path(RAW, "$.extraction_date", "date").alias("extraction_date"), F.col("loaded_at")]


def _tie_break(columns: list[str]) -> list:
    # loaded_at ties are unbroken in the reference; ours falls back to the file
    # name, then to every typed output column, so the pick is the same on every
    # run (rows equal in all of them give the same output whichever is kept).
    rest = [c for c in columns if c != "loaded_at"]
    return ([F.col("loaded_at").desc_nulls_last(), F.col("_source_file").desc_nulls_last()]
            + [F.col(c).desc_nulls_last() for c in rest])


def _with_tie_cols(raw: DataFrame) -> DataFrame:
    return raw.select("*", path(RAW, "$.source_file", "string").alias("_source_file"))


PRODUCT_COLUMNS = ["product_id", "title", "category", "price", "rating_rate", "rating_count",
                   "extraction_date", "loaded_at"]


def typed_products(raw_products: DataFrame) -> DataFrame:
    return _with_tie_cols(raw_products).select(
        path(RAW, "$.record.id", "bigint").alias("product_id"),
        path(RAW, "$.record.title", "string").alias("title"),
        path(RAW, "$.record.category", "string").alias("category"),
        path(RAW, "$.record.price", "double").alias("price"),
        path(RAW, "$.record.rating.rate", "double").alias("rating_rate"),
        path(RAW, "$.record.rating.count", "int").alias("rating_count"),
        *_lineage_cols(), "_source_file",
    )


def typed_products_schema() -> str:
    return ("product_id bigint, title string, category string, price double, rating_rate double, "
            "rating_count int, extraction_date date, loaded_at timestamp_ntz, _source_file string")


def stage_products(raw_products: DataFrame) -> DataFrame:
    """stg_products: latest version per product id."""
    return merge_latest_products(None, raw_products).select(*PRODUCT_COLUMNS)


def merge_latest_products(latest: DataFrame | None, raw_new: DataFrame) -> DataFrame:
    """Latest version per product over a previous result plus new raw rows.

    "Latest" is associative, so latest(old + new) = latest(latest(old) + new):
    a run only reads the raw rows past the previous result's mark. Keeps the
    ``_source_file`` tie-break column so later merges pick as a full rebuild would.
    """
    typed = typed_products(raw_new)
    if latest is not None:
        typed = latest.select(*typed.columns).unionByName(typed)
    return latest_per_key(typed, ["product_id"], _tie_break(PRODUCT_COLUMNS))


ORDER_COLUMNS = ["order_id", "user_id", "order_total", "order_discounted_total",
                 "total_products", "total_quantity", "extraction_date", "loaded_at"]


def stage_orders(raw_orders: DataFrame) -> DataFrame:
    """stg_orders: order headers, latest version per order id."""
    typed = _with_tie_cols(raw_orders).select(
        path(RAW, "$.record.id", "bigint").alias("order_id"),
        path(RAW, "$.record.userId", "bigint").alias("user_id"),
        path(RAW, "$.record.total", "double").alias("order_total"),
        path(RAW, "$.record.discountedTotal", "double").alias("order_discounted_total"),
        path(RAW, "$.record.totalProducts", "int").alias("total_products"),
        path(RAW, "$.record.totalQuantity", "int").alias("total_quantity"),
        *_lineage_cols(), "_source_file",
    )
    return latest_per_key(typed, ["order_id"], _tie_break(ORDER_COLUMNS)).select(*ORDER_COLUMNS)


ITEM_COLUMNS = ["order_id", "product_id", "quantity", "unit_price", "line_total",
                "discount_percentage", "line_discounted_total", "extraction_date", "loaded_at"]


def stage_order_items(raw_orders: DataFrame) -> DataFrame:
    """stg_order_items: one row per element of ``record.products`` per load (no dedup).

    ``explode`` is the inner lateral flatten: an empty or missing array drops the order.
    """
    exploded = raw_orders.select(
        path(RAW, "$.record.id", "bigint").alias("order_id"),
        *_lineage_cols(),
        F.explode(path(RAW, "$.record.products", "array<variant>")).alias("item"),
    )
    return exploded.select(
        "order_id",
        path("item", "$.id", "bigint").alias("product_id"),
        path("item", "$.quantity", "int").alias("quantity"),
        path("item", "$.price", "double").alias("unit_price"),
        path("item", "$.total", "double").alias("line_total"),
        path("item", "$.discountPercentage", "double").alias("discount_percentage"),
        path("item", "$.discountedTotal", "double").alias("line_discounted_total"),
        "extraction_date", "loaded_at",
    )
