"""Mapping of the TPC-H-like test tables onto the order data model.

  product        <- part      (p_partkey, p_name, p_type, p_retailprice; p_size as rating)
  order header   <- orders    (o_orderkey, o_custkey, date = to_date(o_orderdate))
  order item     <- lineitem joined to part: quantity = l_quantity, unit price from the
                    catalogue (p_retailprice), discount percent = l_discount * 100
  loaded_at      <- o_orderdate (derived from data, never the clock)

Everything here is a lazy DataFrame; nothing is collected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import pricing
from .tables import read_table


def catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "part", "p_partkey", "p_name", "p_type",
                      "p_size", "p_retailprice").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("title"),
        F.col("p_type").alias("category"),
        F.col("p_size").alias("rating_rate_raw"),
        pricing.as_money("p_retailprice").alias("unit_price"),
    )


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as they are, without prices."""
    return read_table(spark, sf_dir, "lineitem", "l_orderkey", "l_partkey", "l_linenumber",
                      "l_quantity", "l_discount", "l_tax").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_linenumber").alias("line_number"),
        F.col("l_quantity").cast("int").alias("quantity"),
        pricing.fraction_to_percent("l_discount").alias("discount_percentage"),
        pricing.fraction_to_percent("l_tax").alias("tax_percentage"),
    )


def with_catalogue(lines: DataFrame, spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines with title and unit price. A line whose part is unknown stays, without a price."""
    # The catalogue grows with the data, so no broadcast hint: AQE broadcasts it
    # only when its shuffle stage turns out smaller than the broadcast threshold.
    return lines.join(catalogue(spark, sf_dir).select("product_id", "title", "unit_price"), "product_id", "left")


def priced_lines(spark: SparkSession, sf_dir: str, orders: DataFrame | None = None) -> DataFrame:
    """Order lines with catalogue prices and exact line totals (G1), of ``orders`` (order_id) only if given.

    Columns: order_id, product_id, line_number, title, quantity, unit_price,
    discount_percentage, line_total, line_discounted_total (money in decimal).
    """
    lines = order_lines(spark, sf_dir)
    if orders is not None:  # while lines are narrow; the catalogue then meets only those that are wanted
        lines = lines.join(orders.select("order_id"), "order_id", "left_semi")
    return pricing.price_lines(with_catalogue(lines, spark, sf_dir))


def order_headers(spark: SparkSession, sf_dir: str, date_range: tuple | None = None, undated: int = 0) -> DataFrame:
    """Order headers; ``date_range=(lo, hi)`` keeps order dates in [lo, hi) (either may
    be None), filtered on the raw column so the predicate reaches the Parquet scan. A range
    without a beginning also keeps orders without a date. ``undated`` plants such orders:
    the date of every order whose id it divides is taken away."""
    o = read_table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderdate")
    if undated:
        o = o.withColumn("o_orderdate", F.when(F.col("o_orderkey") % undated != 0, F.col("o_orderdate")))
    if date_range:
        o = o.where(in_range(F.col("o_orderdate"), date_range))
    return o.select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("user_id"),
        F.to_date("o_orderdate").alias("extraction_date"),
        F.col("o_orderdate").cast("timestamp_ntz").alias("loaded_at"),
    )


def in_range(date: F.Column, date_range: tuple) -> F.Column:
    """Whether a date lies in [lo, hi), None being open; a null date lies in the range without a beginning."""
    lo, hi = (d and F.lit(d).cast("timestamp_ntz") for d in date_range)
    if lo is not None:
        return (date >= lo) & (date < hi) if hi is not None else date >= lo
    return date.isNull() | (date < hi) if hi is not None else F.lit(True)


STAGED_ITEM_COLUMNS = ["order_id", "product_id", "quantity", "unit_price", "line_total",
                       "discount_percentage", "line_discounted_total", "extraction_date",
                       "loaded_at"]


def dated_lines(spark: SparkSession, sf_dir: str, date_range: tuple | None = None, undated: int = 0) -> DataFrame:
    """Priced lines with the date and stamp of their order. Ranges that cover all dates cover all
    lines: those without a date, or whose order is unknown, are in the range without a beginning."""
    lines = order_lines(spark, sf_dir)
    columns = ["order_id", "extraction_date", "loaded_at"]
    # totals come last, so that joins shuffle what they are made of only; with a range,
    # the catalogue meets only the lines in it
    if not date_range:
        return pricing.price_lines(with_catalogue(lines, spark, sf_dir).join(
            order_headers(spark, sf_dir, None, undated).select(columns), "order_id", "left"))
    if date_range[0] is not None:
        dated = lines.join(order_headers(spark, sf_dir, date_range, undated).select(columns), "order_id")
    else:
        dated = lines.join(order_headers(spark, sf_dir, None, undated).select(columns), "order_id", "left").where(
            in_range(F.col("loaded_at"), date_range))
    return pricing.price_lines(with_catalogue(dated, spark, sf_dir))


def staged_order_items(spark: SparkSession, sf_dir: str, date_range: tuple | None = None,
                       loaded_at: str | None = None, undated: int = 0) -> DataFrame:
    """The ``stg_order_items`` shape built straight from the flat tables.

    Equivalent to assembling nested orders and flattening them again (tested),
    without the round trip. ``loaded_at`` overrides the load stamp (one per load).
    """
    rows = dated_lines(spark, sf_dir, date_range, undated)
    if loaded_at:
        rows = rows.withColumn("loaded_at", F.lit(loaded_at).cast("timestamp_ntz"))
    return rows.select(
        "order_id", "product_id", "quantity",
        pricing.to_double("unit_price").alias("unit_price"),
        pricing.to_double("line_total").alias("line_total"),
        pricing.to_double("discount_percentage").alias("discount_percentage"),
        pricing.to_double("line_discounted_total").alias("line_discounted_total"),
        "extraction_date", "loaded_at",
    )


# ---------------------------------------------------------------- raw layers

def raw_orders(spark: SparkSession, sf_dir: str, page_size: int | None = None) -> DataFrame:
    """Raw order records (variant) assembled from orders + lineitem + part."""
    from ..operators.assembly import DEFAULT_PAGE_SIZE, assemble_orders
    from .raw import to_raw
    nested = assemble_orders(order_headers(spark, sf_dir), priced_lines(spark, sf_dir),
                             page_size or DEFAULT_PAGE_SIZE)
    return to_raw(nested, "orders")


def product_record(rating_count: F.Column) -> F.Column:
    """A catalogue record shaped like the reference's product contract."""
    return F.struct(
        F.col("product_id").alias("id"),
        F.col("title"),
        pricing.to_double("unit_price").alias("price"),
        F.col("brand").alias("description"),
        F.col("category"),
        F.concat(F.lit("img/"), F.col("product_id").cast("string"), F.lit(".png")).alias("image"),
        F.struct((F.col("rating_rate_raw").cast("double") / F.lit(10)).alias("rate"),
                 rating_count.alias("count")).alias("rating"),
    )


def product_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One catalogue record (variant) per part."""
    brands = read_table(spark, sf_dir, "part", "p_partkey", "p_brand").toDF("product_id", "brand")
    rows = catalogue(spark, sf_dir).join(brands, "product_id")
    return rows.select(F.to_variant_object(product_record(F.lit(0))).alias("record"))


# Fixed dates of the two catalogue extracts made from the part table.
SNAPSHOTS = ("1995-01-01", "1998-01-01")


def raw_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw product snapshots: every part at two extraction dates, whether sold or not;
    rating.count is 0 in the first and the number of its lines in the second."""
    cat = read_table(spark, sf_dir, "part", "p_partkey", "p_name", "p_brand", "p_type",
                     "p_size", "p_retailprice").select(
        F.col("p_partkey").alias("product_id"), F.col("p_name").alias("title"),
        F.col("p_brand").alias("brand"), F.col("p_type").alias("category"),
        F.col("p_size").alias("rating_rate_raw"),
        pricing.as_money("p_retailprice").alias("unit_price"))
    sales = (read_table(spark, sf_dir, "lineitem", "l_partkey")
             .groupBy(F.col("l_partkey").alias("product_id")).agg(F.count(F.lit(1)).cast("int").alias("sold")))
    first, last = (F.lit(d).cast("date") for d in SNAPSHOTS)
    snap = (cat.join(sales, "product_id", "left")
            .withColumn("extraction_date", F.explode(F.array(first, last)))
            .withColumn("n_lines", F.when(F.col("extraction_date") == last, F.coalesce("sold", F.lit(0))).otherwise(0))
            .select("extraction_date", F.col("extraction_date").cast("timestamp_ntz").alias("loaded_at"),
                    product_record(F.col("n_lines")).alias("record")))
    from .raw import to_raw
    return to_raw(snap, "products")


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events.props (JSON text) as a variant column."""
    return read_table(spark, sf_dir, "events", "event_id", "ts", "user_id", "event_type",
                      "value", "props").withColumn("props_v", F.parse_json("props"))


def product_records_with_defects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Catalogue records (variant) built from ``part``, with defects placed by p_size.

    Fixed defect plan (p_size -> defect): 1 price is "not_a_number"; 2 price is
    numeric text (passes); 3 title is null; 4 rating is missing; 5 rating.count
    is 2.5; 6 id is numeric text (passes); 7 category is a number; 8 description
    is missing. Other sizes are valid.
    """
    p = read_table(spark, sf_dir, "part", "p_partkey", "p_name", "p_brand", "p_type",
                   "p_size", "p_retailprice")
    s = F.col("p_size")
    var = lambda c: c.cast("variant")
    price = pricing.as_money("p_retailprice")
    rating = F.to_variant_object(F.create_map(
        F.lit("rate"), var(F.col("p_size").cast("double") / F.lit(10)),
        F.lit("count"), F.when(s == 5, var(F.lit(2.5))).otherwise(var(s))))
    fields = F.create_map(
        F.lit("id"), F.when(s == 6, var(F.col("p_partkey").cast("string")))
                      .otherwise(var(F.col("p_partkey"))),
        F.lit("title"), F.when(s == 3, F.parse_json(F.lit("null"))).otherwise(var(F.col("p_name"))),
        F.lit("price"), F.when(s == 1, var(F.lit("not_a_number")))
                         .when(s == 2, var(price.cast("string")))
                         .otherwise(var(price.cast("double"))),
        F.lit("description"), F.when(s != 8, var(F.col("p_brand"))),
        F.lit("category"), F.when(s == 7, var(s)).otherwise(var(F.col("p_type"))),
        F.lit("image"), var(F.concat(F.lit("img/"), F.col("p_partkey").cast("string"), F.lit(".png"))),
        F.lit("rating"), F.when(s != 4, rating),
    )
    record = F.to_variant_object(F.map_filter(fields, lambda k, v: v.isNotNull()))
    return p.select(F.col("p_partkey").alias("product_id"), record.alias("record"))


# ---------------------------------------------------------------- load plans

# Fixed split of the test orders into three loads, the last a backfill of the
# oldest dates: (first date, end date exclusive, load stamp).
THREE_LOADS = [
    ("1997-01-01", "1999-01-01", "2026-01-01 01:00:00"),
    ("1999-01-01", None, "2026-01-01 02:00:00"),
    (None, "1997-01-01", "2026-01-01 03:00:00"),
]


# Every order whose id this divides loses its date in the entries on undated orders.
UNDATED = 7


def load_items(spark: SparkSession, sf_dir: str, load: int, undated: int = 0) -> DataFrame:
    """One of ``THREE_LOADS``; together they are the whole table."""
    lo, hi, stamp = THREE_LOADS[load]
    return staged_order_items(spark, sf_dir, (lo, hi), stamp, undated)


def revised_items(spark: SparkSession, sf_dir: str, stamp: str) -> DataFrame:
    """A revision load: returned lines (l_returnflag = 'R') re-landed on their ship
    date with the discount withdrawn, so their key moves to another date."""
    li = read_table(spark, sf_dir, "lineitem", "l_orderkey", "l_partkey", "l_quantity",
                    "l_returnflag", "l_shipdate").where(F.col("l_returnflag") == "R")
    cat = catalogue(spark, sf_dir).select("product_id", "unit_price")
    rows = li.select(F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("product_id"),
                     F.col("l_quantity").cast("int").alias("quantity"),
                     F.to_date("l_shipdate").alias("extraction_date")).join(cat, "product_id", "left")
    total = pricing.line_total(F.col("unit_price"), F.col("quantity"))
    return rows.select(
        "order_id", "product_id", "quantity",
        pricing.to_double("unit_price").alias("unit_price"),
        pricing.to_double(total).alias("line_total"),
        F.lit(0.0).alias("discount_percentage"),
        pricing.to_double(total).alias("line_discounted_total"),
        "extraction_date", F.lit(stamp).cast("timestamp_ntz").alias("loaded_at"))


def loads_with_nulls(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """Three loads with null dates (order id divisible by 7), null products (by 11) and, in
    the first, null stamps (by 13); the last re-lands the orders divisible by 14, dated."""
    by = lambda n: F.col("order_id") % n == 0

    def damaged(df: DataFrame, dated: bool = False) -> DataFrame:
        df = df.withColumn("product_id", F.when(~by(11), F.col("product_id")))
        return df if dated else df.withColumn("extraction_date", F.when(~by(7), F.col("extraction_date")))

    stamps = [f"2026-01-01 0{i}:00:00" for i in (1, 2, 3)]
    first = damaged(staged_order_items(spark, sf_dir, (None, "1997-01-01"), stamps[0])).withColumn(
        "loaded_at", F.when(~by(13), F.col("loaded_at")))
    second = damaged(staged_order_items(spark, sf_dir, ("1997-01-01", None), stamps[1]))
    third = damaged(staged_order_items(spark, sf_dir, None, stamps[2]).where(by(14)), dated=True).withColumn(
        "quantity", F.col("quantity") + 1)
    return [first, second, third]


def items_with_tax(spark: SparkSession, sf_dir: str, date_range: tuple, stamp: str) -> DataFrame:
    """A load whose schema changed: ``tax_percentage`` added, ``discount_percentage`` dropped."""
    return dated_lines(spark, sf_dir, date_range).select(
        "order_id", "product_id", "quantity",
        pricing.to_double("unit_price").alias("unit_price"),
        pricing.to_double("line_total").alias("line_total"),
        pricing.to_double("line_discounted_total").alias("line_discounted_total"),
        pricing.to_double("tax_percentage").alias("tax_percentage"),
        "extraction_date", F.lit(stamp).cast("timestamp_ntz").alias("loaded_at"))
