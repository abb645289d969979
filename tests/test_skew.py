"""Correctness when one key, one date or one order holds a third of all rows.

Checked against brute force in pandas on a small fixture; partitions are kept
small so the hot group really spans many tasks.
"""

import datetime as dt
import random

import pandas as pd
from pyspark.sql import functions as F

from tidemart.operators import marts, reports, staging
from tidemart.operators.assembly import assemble_orders
from tidemart.operators.sampling import stable_sample
from tidemart.sources.raw import to_raw

ITEM = ("order_id bigint, product_id bigint, quantity int, unit_price double, line_total double, "
        "discount_percentage double, line_discounted_total double, extraction_date date, "
        "loaded_at timestamp_ntz")
HOT_DAY = dt.date(2026, 3, 15)


def skewed_rows(n=3000, seed=7):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        if i < n // 3:                       # one order holds a third of the rows
            o, p = 1, rng.randrange(400)     # ... with repeated products (duplicate keys)
        else:
            o, p = 2 + i // 4, rng.randrange(50)
        d = HOT_DAY if i % 3 else HOT_DAY - dt.timedelta(days=1 + i % 40)
        q = rng.randint(1, 4)
        t = dt.datetime(2026, 3, 16, rng.randrange(3))
        rows.append((o, p, q, 10.0, 10.0 * q, 5.0, round(9.5 * q, 2), d, t))
    return rows


def brute_fact(rows):
    df = pd.DataFrame(rows, columns=[c.split()[0] for c in ITEM.split(", ")])
    df = df.rename(columns={"extraction_date": "date_key"})
    df["order_item_key"] = df.order_id.astype(str) + "_" + df.product_id.astype(str)
    order = ["loaded_at", "date_key", "quantity", "unit_price", "line_total",
             "discount_percentage", "line_discounted_total"]
    df = df.sort_values(order, ascending=False, kind="mergesort")
    return df.drop_duplicates("order_item_key", keep="first")


def test_fact_and_summary_with_hot_order_and_hot_day(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        _check_fact_and_summary(spark)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def _check_fact_and_summary(spark):
    rows = skewed_rows()
    items = spark.createDataFrame(rows, ITEM).repartition(12)
    fact = marts.build_fact(items)
    want = brute_fact(rows)
    got = fact.toPandas()
    assert len(got) == len(want)
    key = lambda df: sorted(zip(df.order_item_key, df.quantity, df.date_key))
    assert key(got) == key(want)
    summ = {r.date_key: (r.total_orders, r.total_quantity) for r in marts.daily_summary(fact).collect()}
    bw = want.groupby("date_key").agg(o=("order_id", "nunique"), q=("quantity", "sum"))
    assert summ == {d: (int(r.o), int(r.q)) for d, r in bw.iterrows()}


def test_hot_order_assembles_in_pages_and_flattens_back(spark):
    rows = skewed_rows(1500)
    lines = (spark.createDataFrame([r + (i,) for i, r in enumerate(rows)], ITEM + ", line_number int")
             .withColumn("title", F.lit("t")))
    heads = lines.select("order_id", F.lit(3).cast("bigint").alias("user_id"),
                         "extraction_date", "loaded_at").dropDuplicates(["order_id"])
    nested = assemble_orders(heads, lines.drop("extraction_date", "loaded_at"), page_size=50)
    pages = nested.where("order_id = 1").count()
    assert pages >= 5                        # 500 items -> about 10 pages, not one array
    sizes = [r.n for r in nested.select(F.size("record.products").alias("n")).collect()]
    assert max(sizes) < 150
    back = staging.stage_order_items(to_raw(nested, "orders"))
    assert back.count() == len(rows)


def test_top_k_and_first_row_with_a_hot_group(spark):
    rows = skewed_rows()
    fact = marts.build_fact(spark.createDataFrame(rows, ITEM))
    picks = stable_sample(fact.select("date_key", "order_item_key"), "date_key", "order_item_key", 3)
    per_day = {r.date_key: r["count"] for r in picks.groupBy("date_key").count().collect()}
    assert per_day[HOT_DAY] == 3 and all(v <= 3 for v in per_day.values())
    dim = fact.select("product_id").distinct().selectExpr("product_id", "'t' AS title", "1.0D AS rating_rate",
                                                          "1 AS rating_count")
    one = reports.price_vs_rating(fact, dim)
    assert one.count() == fact.select("product_id").distinct().count()


def test_hot_order_is_split_over_envelopes(spark, workdir):
    from tidemart.sources import landing
    record = F.struct(F.col("order_id").alias("id"), F.array_repeat(F.lit(1), 10).alias("products"))
    hot = spark.range(1960).select(F.lit(7).alias("order_id"), F.col("id").cast("int").alias("page"))
    rest = spark.range(300).select((F.col("id") + 100).cast("int").alias("order_id"), F.lit(0).alias("page"))
    nested = hot.unionByName(rest).select("order_id", "page", F.lit(HOT_DAY).alias("extraction_date"), record.alias("record"))
    nested = nested.unionByName(nested.where("order_id = 105").withColumn("extraction_date", F.lit(None).cast("date")))
    folder = landing.land_orders(nested, workdir, page_records=1000)
    env = landing.judge(landing.read_files(spark, folder, "orders"), "orders")
    sizes = [r.n for r in env.select(F.size("data").alias("n")).collect()]
    assert max(sizes) < 200 and sum(sizes) == 1960 + 301
    per_day = {r.extraction_date: r.n for r in env.groupBy("extraction_date").agg(F.sum("record_count").alias("n")).collect()}
    assert per_day == {HOT_DAY.isoformat(): 301, None: 1}  # orders, not pages
    assert landing.count_mismatches(env).count() == 0
    assert landing.unwrap(env).count() == 1960 + 301
