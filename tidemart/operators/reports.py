"""Reports over the star schema.

Each report is one aggregate plan; only the final report rows reach a caller.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import pricing

JOINED_COLUMNS = ["order_id", "product_id", "date_key", "quantity", "unit_price", "line_total",
                  "discount_percentage", "line_discounted_total", "title", "category",
                  "rating_rate", "rating_count"]


def fact_with_product(fact: DataFrame, dim_product: DataFrame) -> DataFrame:
    """Fact LEFT JOIN dim_product; facts without a product keep null product columns.

    The dimension grows with the catalogue, so there is no broadcast hint: the
    planner broadcasts it when its measured size is under the threshold and
    falls back to a sort-merge join beyond it.
    """
    dim = dim_product.select("product_id", "title", "category", "rating_rate", "rating_count")
    return fact.join(dim, "product_id", "left").select(*JOINED_COLUMNS)


def daily_trend(summary: DataFrame) -> DataFrame:
    """Revenue per day in date order, with the 'fewer than 2 days' flag.

    The day count is a scalar subquery, not a join or a global window.
    """
    n_days = summary.select(F.count(F.lit(1))).scalar()
    return (summary.select("date_key", "total_revenue", (n_days < 2).alias("few_days"))
                   .orderBy("date_key"))


# ------------------------------------------------------------------ pre-aggregated form
# R1-R4 from one per-product roll-up of the fact: the fact is scanned and
# combined map-side once, and the product join runs on one row per product
# instead of one per fact row. Exact decimal sums make the results identical
# to those of the joined rows.

EXACT = "decimal(30,12)"  # a discount as given, without rounding, summed in any order to the same value


def product_rollup(fact: DataFrame, dim_product: DataFrame) -> DataFrame:
    """One row per product: revenue, quantity, item count, sum of discounts, plus the product's
    dimension columns (left join: an unknown product keeps nulls)."""
    per = fact.groupBy("product_id").agg(
        F.sum(F.col("line_total").cast(pricing.MONEY)).cast(pricing.MONEY_SUM).alias("revenue"),
        F.sum("quantity").cast("bigint").alias("quantity"),
        F.count("discount_percentage").alias("n_pct"),
        F.sum(F.col("discount_percentage").cast(EXACT)).alias("pct"),
    )
    dim = dim_product.select("product_id", "title", "category", "rating_rate", "rating_count")
    return per.join(dim, "product_id", "left")


def kpi_row_from(rollup: DataFrame, fact: DataFrame) -> DataFrame:
    """R1 from the roll-up; distinct orders still need the fact (a one-column scan)."""
    sums = rollup.agg(
        F.coalesce(pricing.to_double(F.round(F.sum("revenue"), 2)), F.lit(0.0)).alias("total_revenue"),
        F.coalesce(F.sum("quantity").cast("bigint"), F.lit(0).cast("bigint")).alias("items_sold"),
        F.try_divide(F.sum("pct").cast("double"), F.sum("n_pct").cast("double")).alias("avg_discount"))
    orders = fact.select(F.countDistinct("order_id").alias("total_orders"))
    return sums.select("total_revenue", orders.scalar().alias("total_orders"), "items_sold",
                       "avg_discount")


def revenue_by_category_from(rollup: DataFrame) -> DataFrame:
    return (rollup.where(F.col("category").isNotNull()).groupBy("category")
                  .agg(pricing.to_double(F.round(F.sum("revenue"), 2)).alias("line_total"))
                  .orderBy(F.col("line_total").desc(), F.col("category")))


def top_products_from(rollup: DataFrame, n: int = 10) -> DataFrame:
    top = (rollup.where(F.col("title").isNotNull()).groupBy("title")
                 .agg(F.sum("quantity").cast("bigint").alias("quantity"))
                 .orderBy(F.col("quantity").desc(), F.col("title")).limit(n))
    return top.orderBy(F.col("quantity"), F.col("title").desc())


def first_row_key(date: Column, order_id: Column) -> Column:
    """One decimal that orders rows by (date, order id), nulls last: unlike a struct it fits a hash aggregate's buffer."""
    whole = lambda n: F.lit(str(n)).cast("decimal(21,0)")
    day = F.coalesce(F.unix_date(date), F.lit(2 ** 31 - 1)).cast("decimal(10,0)")
    order = F.coalesce((order_id.cast("decimal(19,0)") + whole(2 ** 63)).cast("decimal(21,0)"), whole(10 ** 20 - 1))
    return ((day * whole(10 ** 20)).cast("decimal(33,0)") + order).cast("decimal(34,0)")


def price_vs_rating(fact: DataFrame, dim_product: DataFrame) -> DataFrame:
    """One row per product, the first by date and order, with its price and rating.

    The fact has one row per order and product, so date and order tell a product's rows apart.
    One hash aggregate, combined in each task before the shuffle.
    """
    key = first_row_key(F.col("date_key"), F.col("order_id"))
    one = fact.groupBy("product_id").agg(F.min_by("unit_price", key).alias("unit_price"))
    dim = dim_product.select("product_id", "title", "rating_rate", "rating_count")
    return one.join(dim, "product_id", "left").select(
        "product_id", "rating_rate", "unit_price", "rating_count", "title")
