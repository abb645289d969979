"""Registered queries: name -> (spark, sf_dir) -> DataFrame.

Each one reads the test tables (or data Spark derives from them) in full.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..operators import marts
from ..session import apply_job_conf
from ..sources import testdata

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}


def register(name: str):
    def deco(fn: QueryFn) -> QueryFn:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            apply_job_conf(spark)
            return fn(spark, sf_dir)
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        return run
    return deco


def fact_from_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.build_fact(testdata.staged_order_items(spark, sf_dir))


def written_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact written once (a reliable checkpoint), for queries that read it several times."""
    from ..session import checkpoint_root
    checkpoint_root(spark)
    return fact_from_tables(spark, sf_dir).checkpoint()


@register("fact_order_items")
def q_fact_order_items(spark, sf_dir):
    """P6 + X3 + dedup: the order-item fact, full build."""
    return fact_from_tables(spark, sf_dir).select(*marts.FACT_COLUMNS)


@register("daily_sales_summary")
def q_daily_sales_summary(spark, sf_dir):
    """A1 over the full fact: the flagship query."""
    return marts.daily_summary(fact_from_tables(spark, sf_dir))


# ------------------------------------------------------------------ staging

@register("stg_products_latest")
def q_stg_products_latest(spark, sf_dir):
    """P2 + W1 + P12: variant paths of product snapshots, latest per product."""
    from ..operators import staging
    return staging.stage_products(testdata.raw_products(spark, sf_dir))


@register("stg_orders_latest")
def q_stg_orders_latest(spark, sf_dir):
    """P3 + W2: order headers from nested variant records, latest per order."""
    from ..operators import staging
    return staging.stage_orders(testdata.raw_orders(spark, sf_dir))


@register("stg_order_items_flatten")
def q_stg_order_items_flatten(spark, sf_dir):
    """G2 -> J2 + P4: assemble nested orders, then lateral-flatten the items again."""
    from ..operators import staging
    return staging.stage_order_items(testdata.raw_orders(spark, sf_dir))


RELANDED = 14


def order_versions(spark, sf_dir):
    """Raw loads of the order headers: the years up to 1998, the later ones, then every 14th order again,
    a day later and by another user."""
    from pyspark.sql import functions as F
    from ..operators.assembly import assemble_orders
    from ..sources.raw import to_raw
    heads = testdata.order_headers(spark, sf_dir)
    again = F.col("order_id") % RELANDED == 0
    late = F.coalesce(F.year("extraction_date") > 1998, F.lit(False))
    parts = [heads.where(~late), heads.where(late), heads.where(again).withColumn("user_id", F.col("user_id") + 1)
             .withColumn("extraction_date", F.date_add("extraction_date", 1))]
    for i, part in enumerate(parts, 1):
        stamped = part.withColumn("loaded_at", F.lit(f"2026-01-01 0{i}:00:00").cast("timestamp_ntz"))
        yield to_raw(assemble_orders(stamped, testdata.priced_lines(spark, sf_dir, part)), "orders")


@register("stg_orders_incremental")
def q_stg_orders_incremental(spark, sf_dir):
    """W2 + P3 + I1: order headers kept as a table, three loads merged one by one, the last with new
    versions on other dates; ends equal to the window over all of them."""
    from ..operators.incremental import refresh_orders
    from ..operators.staging import ORDER_COLUMNS
    from ..session import scratch_dir
    from ..sources.storage import MartTable
    table = MartTable(spark, scratch_dir(spark, "stg-orders"), by="extraction_date", grain="year")
    for load in order_versions(spark, sf_dir):
        refresh_orders(table, load)
    return table.read().select(*ORDER_COLUMNS)


@register("stg_products_incremental")
def q_stg_products_incremental(spark, sf_dir):
    """W1 + P2 + I1: the latest products kept as a table over two catalogue snapshots."""
    from pyspark.sql import functions as F
    from ..operators.incremental import refresh_products
    from ..operators.staging import PRODUCT_COLUMNS
    from ..session import scratch_dir
    from ..sources.storage import MartTable
    raw = testdata.raw_products(spark, sf_dir)
    table = MartTable(spark, scratch_dir(spark, "stg-products"), by="extraction_date", grain="year")
    for day in testdata.SNAPSHOTS:
        refresh_products(table, raw.where(F.col("loaded_at") == F.lit(day).cast("timestamp_ntz")))
    return table.read().select(*PRODUCT_COLUMNS)


@register("variant_path_events")
def q_variant_path_events(spark, sf_dir):
    """X1 + X2: a typed path out of semi-structured text."""
    from ..functions.variant import path
    ev = testdata.raw_events(spark, sf_dir)
    return ev.select("event_id", "event_type", path("props_v", "$.k", "int").alias("k"))


# ------------------------------------------------------------------ dimensions

@register("dim_product")
def q_dim_product(spark, sf_dir):
    """P5: column-pruned projection of the latest product versions."""
    from ..operators import staging
    return marts.dim_product(staging.stage_products(testdata.raw_products(spark, sf_dir)))


def order_date_spine(spark, sf_dir):
    """Day spine over the order dates of the data (bounds derived, not fixed)."""
    from pyspark.sql import functions as F
    from ..functions.dates import spine_from_bounds
    bounds = testdata.order_headers(spark, sf_dir).agg(
        F.min("extraction_date").alias("start"),
        F.date_add(F.max("extraction_date"), 1).alias("end"))
    return spine_from_bounds(bounds)


@register("dim_date")
def q_dim_date(spark, sf_dir):
    """Calendar attributes over a day spine spanning the order dates."""
    return marts.dim_date(order_date_spine(spark, sf_dir))


@register("order_rollup")
def q_order_rollup(spark, sf_dir):
    """A8 + X7: per-order totals, item count and quantity from the flat lines."""
    from pyspark.sql import functions as F
    from ..operators.assembly import order_rollup
    from ..functions import pricing
    r = order_rollup(testdata.priced_lines(spark, sf_dir))
    heads = testdata.order_headers(spark, sf_dir).select("order_id", "user_id", "extraction_date")
    return heads.join(r, "order_id", "left").select(
        "order_id", "user_id", "extraction_date",
        F.coalesce(pricing.to_double("order_total"), F.lit(0.0)).alias("order_total"),
        F.coalesce(pricing.to_double("order_discounted_total"), F.lit(0.0)).alias("order_discounted_total"),
        F.coalesce("total_products", F.lit(0)).alias("total_products"),
        F.coalesce("total_quantity", F.lit(0)).alias("total_quantity"))


# ------------------------------------------------------------------ reports

def joined_fact(spark, sf_dir):
    from ..operators import reports, staging
    dim = marts.dim_product(staging.stage_products(testdata.raw_products(spark, sf_dir)))
    return reports.fact_with_product(fact_from_tables(spark, sf_dir), dim)


@register("fact_product_join")
def q_fact_product_join(spark, sf_dir):
    """Fact left-joined to the product dimension (8 fact + 4 product columns)."""
    return joined_fact(spark, sf_dir)


def rollup(spark, sf_dir, fact=None):
    from ..operators import reports, staging
    dim = marts.dim_product(staging.stage_products(testdata.raw_products(spark, sf_dir)))
    return reports.product_rollup(fact_from_tables(spark, sf_dir) if fact is None else fact, dim)


@register("kpi_row")
def q_kpi_row(spark, sf_dir):
    """R1 + A3 (from the per-product roll-up; distinct orders from the fact)."""
    from ..operators import reports
    fact = written_fact(spark, sf_dir)
    return reports.kpi_row_from(rollup(spark, sf_dir, fact), fact)


@register("revenue_by_category")
def q_revenue_by_category(spark, sf_dir):
    """R2 + A4 + O2 (from the per-product roll-up)."""
    from ..operators import reports
    return reports.revenue_by_category_from(rollup(spark, sf_dir))


@register("top10_products")
def q_top10_products(spark, sf_dir):
    """R3 + A5 + O3 + O4 (top-k is the feature: limit 10), from the roll-up."""
    from ..operators import reports
    return reports.top_products_from(rollup(spark, sf_dir), 10)


@register("price_vs_rating")
def q_price_vs_rating(spark, sf_dir):
    """R4 + A7: one row per product (first row by date, order, price)."""
    from ..operators import reports, staging
    dim = marts.dim_product(staging.stage_products(testdata.raw_products(spark, sf_dir)))
    return reports.price_vs_rating(fact_from_tables(spark, sf_dir), dim)


@register("daily_trend")
def q_daily_trend(spark, sf_dir):
    """R5 + O1: revenue per day plus the fewer-than-two-days flag."""
    from ..operators import reports
    return reports.daily_trend(marts.daily_summary(fact_from_tables(spark, sf_dir)))


# ------------------------------------------------------------------ quality

@register("quality_report")
def q_quality_report(spark, sf_dir):
    """Q1-Q4: the 12 declared checks over the star schema, as one report."""
    from ..operators import quality, staging
    fact = written_fact(spark, sf_dir)
    dim_p = marts.dim_product(staging.stage_products(testdata.raw_products(spark, sf_dir)))
    dim_d = marts.dim_date(order_date_spine(spark, sf_dir))
    checks = quality.star_schema_checks(dim_d, dim_p, fact, marts.daily_summary(fact))
    return quality.report(checks)


def all_order_totals(spark, sf_dir):
    from pyspark.sql import functions as F
    from ..operators.assembly import order_rollup
    from ..functions import pricing
    r = order_rollup(testdata.priced_lines(spark, sf_dir))
    heads = testdata.order_headers(spark, sf_dir).select("order_id")
    return heads.join(r, "order_id", "left").select(
        "order_id",
        F.coalesce(pricing.to_double("order_total"), F.lit(0.0)).alias("order_total"),
        F.coalesce(pricing.to_double("order_discounted_total"), F.lit(0.0)).alias("order_discounted_total"),
        F.coalesce("total_products", F.lit(0)).alias("total_products"))


@register("order_id_blocks")
def q_order_id_blocks(spark, sf_dir):
    """W4 + X12: dense per-day id blocks (distributed numbering)."""
    from ..operators.sampling import order_id_blocks
    heads = testdata.order_headers(spark, sf_dir).select("order_id", "extraction_date")
    return order_id_blocks(heads, strict=False)  # order_invariants reports an overflow


@register("order_invariants")
def q_order_invariants(spark, sf_dir):
    """Q5 + Q6: invariant violation counts and disjoint day id ranges."""
    from ..operators import quality
    from ..operators.sampling import order_id_blocks
    inv = quality.order_invariants(all_order_totals(spark, sf_dir),
                                   testdata.staged_order_items(spark, sf_dir))
    heads = testdata.order_headers(spark, sf_dir).select("order_id", "extraction_date")
    ids = order_id_blocks(heads, strict=False).select("extraction_date", "block_id")
    return inv.unionByName(quality.day_block_overlaps(ids, id_col="block_id"))


@register("validate_products")
def q_validate_products(spark, sf_dir):
    """Typed contract check of catalogue records; errors per record."""
    from ..operators.validation import validate
    recs = testdata.product_records_with_defects(spark, sf_dir)
    return validate(recs).select("product_id", "valid", "errors")


@register("stable_daily_sample")
def q_stable_daily_sample(spark, sf_dir):
    """G3 + X18: per day, least(3, n) order items picked by md5 rank, stable across runs."""
    from ..operators.sampling import stable_sample
    fact = fact_from_tables(spark, sf_dir).select("date_key", "order_item_key")
    return stable_sample(fact, "date_key", "order_item_key", 3)


SAMPLE_SIZE = 5  # as many items as the reference's orders have at most


@register("catalogue_sample_per_date")
def q_catalogue_sample_per_date(spark, sf_dir):
    """Five distinct products of the whole catalogue for every order date."""
    from ..functions.pricing import to_double
    from ..operators.sampling import sample_for_each
    dates = testdata.order_headers(spark, sf_dir).select("extraction_date")
    products = testdata.catalogue(spark, sf_dir).select(
        "product_id", "title", to_double("unit_price").alias("price"))
    return sample_for_each(dates, "extraction_date", products, "product_id", SAMPLE_SIZE)


# ------------------------------------------------------------------ incremental

def _union(frames):
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def incremental_summary(spark, sf_dir, undated=0):
    from ..operators.incremental import Marts
    from ..session import scratch_dir
    m = Marts(spark, scratch_dir(spark, "incremental"), fact_grain="year")
    loads = [testdata.load_items(spark, sf_dir, i, undated) for i in range(len(testdata.THREE_LOADS))]
    for i in range(len(loads)):
        # raw accumulates; the mark filter inside refresh picks the new load only
        m.refresh(_union(loads[: i + 1]))
    return m.summary.read().select(*marts.SUMMARY_COLUMNS)


@register("daily_summary_incremental")
def q_daily_summary_incremental(spark, sf_dir):
    """I1-I6 + A2: three loads (the last a backfill of the oldest dates) merged one by
    one into partitioned fact and summary tables; ends equal to a full rebuild."""
    return incremental_summary(spark, sf_dir)


@register("daily_summary_incremental_undated")
def q_daily_summary_incremental_undated(spark, sf_dir):
    """I5 + I6 + A2 with planted orders without a date, which the backfill brings."""
    return incremental_summary(spark, sf_dir, testdata.UNDATED)


REVISION_STAMPS = ("2026-01-01 01:00:00", "2026-01-01 02:00:00")


@register("fact_incremental_revision")
def q_fact_incremental_revision(spark, sf_dir):
    """A later version of a key replaces the earlier one, also across dates."""
    from ..operators.incremental import Marts
    from ..session import scratch_dir
    m = Marts(spark, scratch_dir(spark, "revision"), fact_grain="year")
    v1 = testdata.staged_order_items(spark, sf_dir, loaded_at=REVISION_STAMPS[0])
    v2 = testdata.revised_items(spark, sf_dir, REVISION_STAMPS[1])
    m.refresh(v1)
    m.refresh(v1.unionByName(v2))
    return m.fact.read().select(*marts.FACT_COLUMNS)


SCHEMA_SPLIT = "1998-01-01"


@register("fact_schema_sync")
def q_fact_schema_sync(spark, sf_dir):
    """I4: a load adds tax_percentage and drops discount_percentage; columns follow."""
    from ..operators.incremental import Marts
    from ..session import scratch_dir
    m = Marts(spark, scratch_dir(spark, "schema-sync"), fact_grain="year")
    m.refresh(testdata.staged_order_items(spark, sf_dir, (None, SCHEMA_SPLIT), REVISION_STAMPS[0]))
    m.refresh(testdata.items_with_tax(spark, sf_dir, (SCHEMA_SPLIT, None), REVISION_STAMPS[1]))
    return m.fact.read()


@register("fact_incremental_nulls")
def q_fact_incremental_nulls(spark, sf_dir):
    """Three loads with null dates, keys and stamps; no row is lost or doubled."""
    from ..operators.incremental import Marts
    from ..session import scratch_dir
    m = Marts(spark, scratch_dir(spark, "nulls"), fact_grain="year")
    loads = testdata.loads_with_nulls(spark, sf_dir)
    for i in range(len(loads)):
        m.refresh(_union(loads[: i + 1]))
    return m.fact.read().select(*marts.FACT_COLUMNS)


@register("quality_report_defects")
def q_quality_report_defects(spark, sf_dir):
    """Q1-Q4 over tables with planted duplicates, nulls and orphans: every check counts some."""
    from pyspark.sql import functions as F
    from ..operators import quality, staging
    good = fact_from_tables(spark, sf_dir)
    by = lambda c, n: F.col(c) % n == 0
    fact = good.unionByName(good.where(by("order_id", 50))).select(
        F.when(~by("order_id", 40), F.col("order_item_key")).alias("order_item_key"),
        F.when(~by("order_id", 60), F.col("product_id")).alias("product_id"),
        F.when(~by("order_id", 80), F.col("date_key")).alias("date_key"))
    parts = marts.dim_product(staging.stage_products(testdata.raw_products(spark, sf_dir))).select("product_id")
    dim_p = parts.where(~by("product_id", 17)).unionByName(parts.where(by("product_id", 19))).unionByName(
        parts.where(by("product_id", 23)).select(F.lit(None).cast("bigint").alias("product_id")))
    days = marts.dim_date(order_date_spine(spark, sf_dir)).select("date_key", "day")
    dim_d = (days.where("day <> 31").unionByName(days.where("day = 1"))
             .select(F.when(F.col("day") != 2, F.col("date_key")).alias("date_key")))
    summ = fact.select("date_key").distinct()
    summ = summ.unionByName(summ.where(F.dayofmonth("date_key") == 3))
    return quality.report(quality.star_schema_checks(dim_d, dim_p, fact, summ))


@register("affected_dates")
def q_affected_dates(spark, sf_dir):
    """A6 + P10 + P11: dates with fact rows newer than the summary's latest load."""
    from ..operators.incremental import affected_dates
    loads = [testdata.load_items(spark, sf_dir, i) for i in range(len(testdata.THREE_LOADS))]
    fact = marts.build_fact(_union(loads))
    summary_before_last = marts.daily_summary(marts.build_fact(_union(loads[:2])))
    return affected_dates(fact, summary_before_last)


@register("affected_summary_recompute")
def q_affected_summary_recompute(spark, sf_dir):
    """A2 + J3 + P11: summary rows of the dates the last load touched, recomputed
    over their full history (the incremental model's own query)."""
    from ..operators.incremental import recompute_affected
    loads = [testdata.load_items(spark, sf_dir, i) for i in range(len(testdata.THREE_LOADS))]
    fact = marts.build_fact(_union(loads))
    summary_before_last = marts.daily_summary(marts.build_fact(_union(loads[:2])))
    return recompute_affected(fact, summary_before_last)


@register("ledger_pending_files")
def q_ledger_pending_files(spark, sf_dir):
    """S4 + J4: landing files (one per source and date) not yet in the loaded-file ledger."""
    from pyspark.sql import functions as F
    from ..sources.landing import pending_files
    from ..sources.raw import landing_file_name
    files = (testdata.order_headers(spark, sf_dir).groupBy("extraction_date")
             .agg(F.count(F.lit(1)).alias("record_count"))
             .select(landing_file_name("orders", F.col("extraction_date")).alias("file_name"),
                     "extraction_date", "record_count"))
    # the ledger comes from other data: a file is loaded if a single piece was shipped on its date
    ledger = (testdata.read_table(spark, sf_dir, "lineitem", "l_shipdate", "l_quantity").where("l_quantity = 1")
              .select(landing_file_name("orders", F.to_date("l_shipdate")).alias("file_name")).distinct())
    return pending_files(files, ledger)


# ------------------------------------------------------------------ publish

@register("served_summary")
def q_served_summary(spark, sf_dir):
    """S6 + P7 + P9: the five served columns of the summary, names in lower case."""
    from ..operators.publish import summary_for_push
    summary = marts.daily_summary(fact_from_tables(spark, sf_dir))
    return summary_for_push(summary.toDF(*[c.upper() for c in summary.columns])).orderBy("date_key")


@register("push_payload_batches")
def q_push_payload_batches(spark, sf_dir):
    """S7 + P8 + W3: batches of at most 10 summary rows in date order."""
    from ..operators.publish import payload_batches
    b = payload_batches(marts.daily_summary(fact_from_tables(spark, sf_dir)))
    return b.select("batch_id", "n_records", "first_date", "last_date", "payload")


@register("push_upsert_counts")
def q_push_upsert_counts(spark, sf_dir):
    """S8 with a Parquet target already holding the dates of the first two loads:
    records created / updated per batch."""
    from pyspark.sql import functions as F
    from ..operators.publish import push_to_table
    from ..session import scratch_dir
    from ..sources.storage import MartTable
    summary = marts.daily_summary(fact_from_tables(spark, sf_dir))
    target = MartTable(spark, scratch_dir(spark, "push-target"), "date_key", "year")
    # an earlier push delivered the dates of the first two loads; now all dates go out
    push_to_table(summary.where(F.col("date_key") >= F.lit(testdata.THREE_LOADS[0][0]).cast("date")),
                  target)
    return push_to_table(summary, target)


@register("push_delivery")
def q_push_delivery(spark, sf_dir):
    """S7 + S8: the payloads delivered to a service that has the dates before 1997 and is busy
    at the first try of a batch; what it answered, from the sink's committed report."""
    import json
    from ..operators.publish import deliver, payload_batches
    batches = payload_batches(marts.daily_summary(fact_from_tables(spark, sf_dir)))
    busy, known_before = set(), testdata.THREE_LOADS[0][0]

    def service(method, payload):
        if payload not in busy:
            busy.add(payload)
            return 429, ""
        dates = [r["fields"]["date_key"] for r in json.loads(payload)["records"]]
        old = [d for d in dates if d < known_before]
        return 200, json.dumps({"createdRecords": dates[len(old):], "updatedRecords": old})

    return deliver(batches, service, sleep=lambda s: None)


def landed_orders(spark, sf_dir, undated=0):
    """The landing folder with a file for each order date, written by the named sink."""
    from ..operators.assembly import assemble_orders
    from ..session import scratch_dir
    from ..sources.landing import land_orders
    nested = assemble_orders(testdata.order_headers(spark, sf_dir, undated=undated), testdata.priced_lines(spark, sf_dir))
    return land_orders(nested, scratch_dir(spark, "landing"))


def base_name(file_name):
    """A file's name without its page."""
    from pyspark.sql import functions as F
    return F.regexp_replace(file_name, r"_p\d+\.json$", ".json")


@register("order_envelope")
def q_order_envelope(spark, sf_dir):
    """S5 + A10: the nested orders landed as one named file per date and read back; the records
    of ``data`` against the count that the file states, and their sums."""
    from pyspark.sql import functions as F
    from ..functions.variant import path
    from ..sources.landing import judge, read_files
    files = judge(read_files(spark, landed_orders(spark, sf_dir), "orders"), "orders")
    # one pass: what a file states counts on the first of its rows; a base name is of one date and source
    rows = files.select(base_name(F.col("file_name")).alias("file_name"), "extraction_date", "source", "record_count",
                        "reason", F.posexplode_outer("data").alias("at", "r"))
    first = F.coalesce(F.col("at") == 0, F.lit(True))
    return (rows.groupBy("file_name", "extraction_date", "source")
            .agg(F.sum(F.when(first, F.col("record_count"))).alias("record_count"),
                 F.count(F.when(first, F.col("reason"))).alias("broken_files"), F.count("at").alias("records"),
                 F.count_distinct(path("r", "$.id", "bigint")).alias("orders"),
                 F.sum(path("r", "$.totalQuantity", "bigint")).alias("quantity"),
                 F.sum(path("r", "$.total", "decimal(14,2)")).cast("double").alias("total"))
            .select(F.col("extraction_date").cast("date").alias("extraction_date"), "source", "record_count",
                    "broken_files", F.when(F.col("records") > 0, F.col("orders")).alias("orders"), "quantity", "total",
                    "file_name"))


@register("landed_order_items")
def q_landed_order_items(spark, sf_dir):
    """S5 + S1 + S2 + J2: every item of every record of the landed files, with the file it came from."""
    from pyspark.sql import functions as F
    from ..functions.variant import path
    from ..operators.staging import stage_order_items
    from ..sources.landing import judge, read_files, to_raw_rows, unwrap
    unwrapped = unwrap(judge(read_files(spark, landed_orders(spark, sf_dir), "orders"), "orders"))
    # from the records as they are: no raw row is built for a name
    names = unwrapped.select(path("record", "$.id", "bigint").alias("order_id"), base_name(F.col("source_file")).alias("source_file")).distinct()
    return stage_order_items(to_raw_rows(unwrapped, None)).drop("loaded_at").join(names, "order_id", "left")


@register("relanded_dates")
def q_relanded_dates(spark, sf_dir):
    """S4 + T1: all dates landed and loaded; then all landed again, and loaded by the same stream
    and by one with a new checkpoint. Each file of the ledger with its loads and its raw rows."""
    from pyspark.sql import functions as F
    from ..functions.variant import path
    from ..operators.assembly import assemble_orders
    from ..session import scratch_dir
    from ..sources.landing import land_orders
    from ..streaming.ingest import RawTable, ingest
    root = scratch_dir(spark, "relanded")
    nested = assemble_orders(testdata.order_headers(spark, sf_dir), testdata.priced_lines(spark, sf_dir))
    raw = RawTable(spark, f"{root}/raw_orders")
    for checkpoint in ("first", "first", "second"):
        folder = land_orders(nested, f"{root}/landing")
        ingest(spark, folder, "orders", raw, f"{root}/{checkpoint}")
    rows = (raw.read().groupBy(path("raw_data", "$.source_file", "string").alias("file_name"))
            .agg(F.count("*").alias("raw_rows")))
    return (raw.ledger().groupBy("file_name").agg(F.count("*").alias("loads"), F.sum("n_records").alias("records"))
            .join(rows, "file_name", "left"))


BROKEN_DAY = 13


@register("ingest_broken_files")
def q_ingest_broken_files(spark, sf_dir):
    """S3: the files of every 13th of a month are cut off in the middle of a record; the others load and
    the broken ones are reported. Landed anew, whole, they load as well. What each run did with each file."""
    from pyspark.sql import functions as F
    from ..operators.assembly import assemble_orders
    from ..session import scratch_dir
    from ..sources.landing import paged_records, source_folder, write_files, written_records
    from ..sources.storage import Folder
    from ..streaming.ingest import RawTable, ingest
    root = scratch_dir(spark, "broken")
    nested = assemble_orders(testdata.order_headers(spark, sf_dir), testdata.priced_lines(spark, sf_dir))
    text, written = written_records(nested)  # for the weights and both landings
    records = paged_records(text, "orders", weight=F.col("items"))
    hit = F.dayofmonth(F.to_date("extraction_date")) == BROKEN_DAY
    cut = records.withColumn("record", F.when(hit, F.substring("record", 1, 20)).otherwise(F.col("record")))
    raw, folder, seen = RawTable(spark, f"{root}/raw_orders"), source_folder(f"{root}/landing", "orders"), []
    for run, landed in enumerate((cut, records.where(hit)), 1):
        write_files(landed, folder)
        ingest(spark, folder, "orders", raw, f"{root}/checkpoint")
        told = raw.rejected().select(F.lit(run).alias("run"), "file_name", "reason", F.lit(None).cast("bigint").alias("records"))
        done = raw.ledger().select(F.lit(run).alias("run"), "file_name", F.lit(None).cast("string").alias("reason"),
                                   F.col("n_records").alias("records"))
        seen.append(done.unionByName(told).checkpoint())
    Folder(spark, written).delete("")
    return seen[0].unionByName(seen[1])


# ------------------------------------------------------------------ the daily job

@register("daily_job")
def q_daily_job(spark, sf_dir):
    """L1-L3 + O5 + X13 + X16: the job run for two dates and back-filled for a third. Each run extracts
    its part of the orders (its own years) and a catalogue snapshot, loads products before orders,
    transforms, passes the gate and pushes; the summary ends equal to a full build."""
    import datetime as dt
    import json
    from pyspark.sql import functions as F
    from ..operators.assembly import assemble_orders
    from ..session import scratch_dir
    from ..sources.landing import land_orders, land_products
    from . import pipeline
    root = scratch_dir(spark, "daily-job")
    layout = pipeline.Layout(f"{root}/landing", f"{root}/warehouse", grain="year")
    heads = testdata.order_headers(spark, sf_dir)
    records = testdata.product_records(spark, sf_dir)
    year = F.year("extraction_date")
    parts = {dt.date(2026, 1, 2): year == 1997, dt.date(2026, 1, 3): year > 1997,
             dt.date(2026, 1, 1): ~F.coalesce(year >= 1997, F.lit(False))}

    def extract(day):
        land_products(records, day.isoformat(), layout.landing)
        dated = heads.where(parts[day])
        land_orders(assemble_orders(dated, testdata.priced_lines(spark, sf_dir, dated)), layout.landing)

    def service(method, payload):
        return 200, json.dumps({"createdRecords": json.loads(payload)["records"], "updatedRecords": []})

    lo, hi = heads.agg(F.min("extraction_date"), F.date_add(F.max("extraction_date"), 1)).first()
    runs = dict(spine=(lo.isoformat(), hi.isoformat()), transport=service)
    first, second, third = parts
    for day in (first, second):
        pipeline.run(spark, layout, date=day.isoformat(), extract=extract, **runs)
    done = pipeline.backfill(spark, layout, [third], extract, **runs)[0]
    checks = sum(c["passed"] for c in done.report)
    files = sum(x.files for x in done.loaded.values())
    return pipeline.Marts(spark, layout.table("marts")).summary.read().drop("loaded_at").select(
        "*", F.lit(checks).alias("checks_passed"), (F.lit(files) > 1).alias("backfill_loaded"))


# ------------------------------------------------------------------ streaming

BACKFILL_BEFORE = "1997-01-01"


def streamed_summary(spark, sf_dir, undated=0):
    """The summary after two landings of the nested orders, each picked up by the stream."""
    from pyspark.sql import functions as F
    from ..operators import staging
    from ..operators.assembly import assemble_orders
    from ..operators.incremental import Marts
    from ..session import scratch_dir
    from ..sources.landing import land_orders
    from ..streaming.ingest import RawTable, ingest

    root = scratch_dir(spark, "stream")
    heads = testdata.order_headers(spark, sf_dir, undated=undated)
    m = Marts(spark, f"{root}/marts", fact_grain="year")
    raw = RawTable(spark, f"{root}/raw_orders")

    def refresh(_raw_df):
        after = m.fact.mark() if m.fact.exists() else None
        m.refresh(staging.stage_order_items(raw.read(after)))

    # two parts that are the whole table: undated orders land first
    late = F.coalesce(F.col("extraction_date") < F.lit(BACKFILL_BEFORE).cast("date"), F.lit(False))
    for part in (~late, late):
        dated = heads.where(part)
        folder = land_orders(assemble_orders(dated, testdata.priced_lines(spark, sf_dir, dated)), f"{root}/landing")
        ingest(spark, folder, "orders", raw, f"{root}/ckpt/orders", on_batch=refresh)
    return m.summary.read().drop("loaded_at")


@register("stream_file_ingest_summary")
def q_stream_file_ingest_summary(spark, sf_dir):
    """S1-S3 + T1 + T2: nested orders landed as named files, picked up by an
    availableNow file stream into a raw variant table, merged into the marts;
    then older dates land (a backfill) and a second run picks up only those."""
    return streamed_summary(spark, sf_dir)


@register("stream_undated")
def q_stream_undated(spark, sf_dir):
    """T1 + T2 + S1 + S2 with planted orders without a date: they have a file, and a row of the summary."""
    return streamed_summary(spark, sf_dir, testdata.UNDATED)
