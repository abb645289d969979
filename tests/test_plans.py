"""Physical-plan properties the scale design relies on (checked with explain)."""

import re

from pyspark.sql import functions as F

from tidemart.operators import reports
from tidemart.operators.incremental import Marts
from tidemart.plans.catalog import QUERIES, fact_from_tables
from tidemart.session import scratch_dir
from tidemart.sources import testdata

from shared import SF_SMALL


def plan(df, capsys, mode="formatted"):
    capsys.readouterr()
    df.explain(mode)
    return capsys.readouterr().out


def test_scans_read_only_needed_columns(spark, capsys):
    p = plan(QUERIES["daily_sales_summary"](spark, SF_SMALL), capsys)
    schemas = re.findall(r"ReadSchema: (struct<[^>]*>)", p)
    assert "struct<l_orderkey:bigint,l_partkey:bigint,l_quantity:double,l_discount:double>" in schemas
    assert "struct<p_partkey:bigint,p_retailprice:double>" in schemas
    assert "struct<o_orderkey:bigint,o_orderdate:timestamp_ntz>" in schemas


def test_no_python_in_the_hot_path(spark, capsys):
    p = plan(QUERIES["daily_sales_summary"](spark, SF_SMALL), capsys)
    assert "EvalPython" not in p and "PythonUDF" not in p


def test_load_range_reaches_the_parquet_scan(spark, capsys):
    p = plan(testdata.load_items(spark, SF_SMALL, 0), capsys)
    pushed = re.findall(r"PushedFilters: \[([^\]]*)\]", p)
    assert any("GreaterThanOrEqual(o_orderdate" in x and "LessThan(o_orderdate" in x for x in pushed)


def test_dedup_limits_each_key_before_the_shuffle(spark, capsys):
    p = plan(fact_from_tables(spark, SF_SMALL), capsys, "simple")
    assert re.search(r"WindowGroupLimit .*Partial", p) and re.search(r"WindowGroupLimit .*Final", p)
    # the partial limit sits below the exchange
    assert p.index("Partial") > p.index("Exchange hashpartitioning(order_id")


def test_distinct_count_is_two_level(spark, capsys):
    p = plan(QUERIES["daily_sales_summary"](spark, SF_SMALL), capsys, "simple")
    assert re.search(r"Exchange hashpartitioning\(date_key#\d+, order_id#\d+L", p)
    assert "partial_count(distinct order_id" in p


def test_top10_is_take_ordered(spark, capsys):
    fact = fact_from_tables(spark, SF_SMALL)
    dim = spark.createDataFrame([(1, "t", "c", 1.0, 1)],
                                "product_id bigint, title string, category string, "
                                "rating_rate double, rating_count int")
    top = (reports.fact_with_product(fact, dim).groupBy("title").agg(F.sum("quantity").alias("q"))
           .orderBy(F.col("q").desc(), "title").limit(10))
    assert "TakeOrderedAndProject" in plan(top, capsys, "simple")


def test_merge_reads_only_affected_partitions(spark, capsys):
    m = Marts(spark, scratch_dir(spark, "t-plan"), fact_grain="month")
    m.refresh(testdata.load_items(spark, SF_SMALL, 0))
    import datetime as dt
    p = plan(m.fact.read_partitions([dt.date(1997, 3, 1)]), capsys)
    assert re.search(r"PartitionFilters: \[.*date_key_(month|year)", p)


def test_history_branch_is_pruned_once_past_the_mark(spark, capsys):
    """After the mark filter, the already-loaded branch of the union vanishes from the plan,
    so an incremental run scans only the new load."""
    loads = [testdata.load_items(spark, SF_SMALL, i) for i in range(2)]
    both = loads[0].unionByName(loads[1])
    after = both.where(F.col("loaded_at") > F.lit(testdata.THREE_LOADS[0][2]).cast("timestamp_ntz"))
    full, inc = plan(both, capsys, "simple"), plan(after, capsys, "simple")
    assert full.count("FileScan parquet") == 2 * inc.count("FileScan parquet")


def test_raw_variants_are_shredded_and_scans_read_single_paths(spark, workdir, capsys):
    """A stored record has a column per path, and staging reads those it needs only."""
    import glob

    import pyarrow.parquet as pq

    from tidemart.operators import staging
    from tidemart.sources import testdata
    path = f"{workdir}/raw"
    testdata.raw_products(spark, SF_SMALL).coalesce(1).write.parquet(path)
    meta = pq.ParquetFile(glob.glob(f"{path}/*.parquet")[0]).metadata.row_group(0)
    size = {meta.column(i).path_in_schema: meta.column(i).total_compressed_size for i in range(meta.num_columns)}
    title = "raw_data.typed_value.record.typed_value.title.typed_value"
    assert title in size and size["raw_data.value"] < size[title]
    raw = spark.read.schema("raw_data VARIANT, loaded_at TIMESTAMP_NTZ").parquet(path)
    one = plan(raw.select(staging.path(staging.RAW, "$.record.price", "double").alias("price")), capsys)
    assert "ReadSchema: struct<raw_data:struct<0:double>>" in one
    staged = plan(staging.stage_products(raw), capsys)
    assert "variant_get" not in staged.lower() and "raw_data:struct<0:bigint" in staged


def test_landing_files_are_read_and_parsed_once(spark, capsys, workdir):
    from tidemart.sources import landing
    files = spark.createDataFrame([("orders_x.json", "x", "{}")], "file_name string, file_path string, content string")
    p = plan(landing.unwrap(landing.judge(files, "orders")), capsys, "simple")
    assert p.count("parseJson") == 1 and p.count("$.data") == 1
    assert plan(QUERIES["order_envelope"](spark, SF_SMALL), capsys, "simple").count("FileScan binaryFile") == 1


def test_records_are_not_shuffled_by_date_to_be_paged(spark, capsys):
    from tidemart.sources import landing
    records = spark.range(9).select(F.col("id").alias("order_id"), F.lit("{}").alias("record"),
                                    F.date_add(F.lit("2026-01-01").cast("date"), F.col("id").cast("int")).alias("extraction_date"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "SortMergeJoin" not in plan(landing.paged_records(records, "orders"), capsys, "simple")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_order_totals_are_summed_once(spark, capsys):
    from tidemart.operators.assembly import assemble_orders
    nested = assemble_orders(testdata.order_headers(spark, SF_SMALL), testdata.priced_lines(spark, SF_SMALL))
    p = plan(nested, capsys, "simple")
    assert p.count("partial_count(1)") == 1 and len(re.findall(r"FileScan parquet.*l_orderkey", p)) == 2
