"""Checks (Q1-Q6), the gate (L3), edge validation (P1), reports (R1-R5), sampling."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from tidemart.operators import quality, reports, sampling, validation
from tidemart.operators.ranking import sequence_number

D = dt.date


def test_checks_fail_on_duplicate_null_and_orphan_keys(spark):
    dim_d = spark.createDataFrame([(D(2026, 1, 1),), (D(2026, 1, 2),)], "date_key date")
    dim_p = spark.createDataFrame([(1,), (1,), (None,)], "product_id bigint")
    fact = spark.createDataFrame(
        [("1_1", 1, D(2026, 1, 1)), ("1_1", 1, D(2026, 1, 1)), (None, 9, D(2030, 1, 1)),
         ("2_1", None, None)],
        "order_item_key string, product_id bigint, date_key date")
    summ = spark.createDataFrame([(D(2026, 1, 1),)], "date_key date")
    rep = {(r.check_name, r.table_name, r.column_name): r.failures
           for r in quality.report(quality.star_schema_checks(dim_d, dim_p, fact, summ)).collect()}
    assert len(rep) == 12
    assert rep[("unique", "dim_product", "product_id")] == 1
    assert rep[("not_null", "dim_product", "product_id")] == 1
    assert rep[("unique", "fact_order_items", "order_item_key")] == 1
    assert rep[("not_null", "fact_order_items", "order_item_key")] == 1
    assert rep[("relationships", "fact_order_items", "product_id")] == 1   # 9 has no parent
    assert rep[("relationships", "fact_order_items", "date_key")] == 1     # 2030 outside the spine
    assert rep[("not_null", "fact_order_items", "date_key")] == 1
    with pytest.raises(quality.QualityGateError):
        quality.gate(quality.report(quality.star_schema_checks(dim_d, dim_p, fact, summ)))


def _records(spark, docs):
    df = spark.createDataFrame([(i, json.dumps(d)) for i, d in enumerate(docs)], "product_id int, j string")
    return df.select("product_id", F.parse_json("j").alias("record"))


GOOD = {"id": 1, "title": "t", "price": 9.5, "description": "d", "category": "c", "image": "i",
        "rating": {"rate": 4.5, "count": 3}, "extra": "ignored"}


def test_validation_lax_typing(spark):
    docs = [GOOD,
            dict(GOOD, price="not_a_number"),
            dict(GOOD, price="12.5", id="7"),                     # numeric text passes
            {k: v for k, v in GOOD.items() if k != "title"},       # missing
            dict(GOOD, title=None),                                # null
            dict(GOOD, category=5),                                # number for text
            dict(GOOD, id=1.5),                                    # fraction for int
            dict(GOOD, id=2.0),                                    # whole float for int passes
            dict(GOOD, rating={"rate": 1}),                        # nested missing count
            dict(GOOD, rating="x")]
    got = {r.product_id: r.errors for r in validation.validate(_records(spark, docs)).collect()}
    assert got == {0: "", 1: "price", 2: "", 3: "title", 4: "title", 5: "category", 6: "id",
                   7: "", 8: "rating.count", 9: "rating"}
    valid, rejected = validation.split_valid(_records(spark, docs))
    assert valid.count() == 3 and rejected.count() == 7
    with pytest.raises(validation.ValidationError):
        validation.split_valid(_records(spark, docs), strict=True)


def test_unknown_product_forms_no_category_group(spark):
    fact = spark.createDataFrame(
        [(1, 1, D(2026, 1, 1), 2, 5.0, 10.0, 10.0), (1, 2, D(2026, 1, 1), 1, 1.0, 1.0, 0.0)],
        "order_id bigint, product_id bigint, date_key date, quantity int, unit_price double, line_total double, "
        "discount_percentage double")
    dim = spark.createDataFrame([(1, "a", "cat", 4.0, 3)],
                                "product_id bigint, title string, category string, rating_rate double, rating_count int")
    roll = reports.product_rollup(fact, dim)
    assert [r.category for r in reports.revenue_by_category_from(roll).collect()] == ["cat"]
    assert [r.title for r in reports.top_products_from(roll).collect()] == ["a"]
    k = reports.kpi_row_from(roll, fact).first()
    assert (k.total_revenue, k.total_orders, k.items_sold, k.avg_discount) == (11.0, 1, 3, 5.0)
    empty = reports.kpi_row_from(reports.product_rollup(fact.limit(0), dim), fact.limit(0)).first()
    assert (empty.total_revenue, empty.items_sold, empty.avg_discount) == (0.0, 0, None)


def test_daily_trend_flag(spark):
    one = spark.createDataFrame([(D(2026, 1, 1), 1.0)], "date_key date, total_revenue double")
    assert reports.daily_trend(one).first().few_days is True
    two = one.union(spark.createDataFrame([(D(2026, 1, 2), 2.0)], one.schema))
    assert {r.few_days for r in reports.daily_trend(two).collect()} == {False}


def test_sequence_number_spreads_a_hot_group(spark):
    # one group holds most rows; numbering is still dense and ordered
    rows = [(0 if i % 4 else 1, i) for i in range(2000)]
    df = spark.createDataFrame(rows, "g int, k int")
    out = sequence_number(df, ["k"], ["g"]).collect()
    by_g = {}
    for r in out:
        by_g.setdefault(r.g, []).append((r.k, r.seq))
    for g, pairs in by_g.items():
        pairs.sort()
        assert [s for _, s in pairs] == list(range(1, len(pairs) + 1))


def test_stable_sample_is_rerun_stable_and_capped(spark):
    df = spark.createDataFrame([(D(2026, 3, 15), f"k{i}") for i in range(7)] +
                               [(D(2026, 3, 16), "only")], "d date, key string")
    a = {(r.d, r.key) for r in sampling.stable_sample(df, "d", "key", 3).collect()}
    b = {(r.d, r.key) for r in sampling.stable_sample(df.repartition(3), "d", "key", 3).collect()}
    assert a == b and len(a) == 4  # least(3, 7) + least(3, 1)


def test_id_blocks_disjoint_and_overflow(spark):
    days = [(D(2026, 3, 15), i) for i in range(5)] + [(D(2026, 3, 16), 100 + i) for i in range(3)] + \
           [(D(2025, 12, 27), 7)]
    df = spark.createDataFrame(days, "extraction_date date, order_id bigint")
    ids = sampling.order_id_blocks(df)
    got = {(r.extraction_date, r.order_id): r.block_id for r in ids.collect()}
    assert got[(D(2026, 3, 15), 0)] == 73 * 100 + 1
    assert got[(D(2025, 12, 27), 7)] == -5 * 100 + 1     # negative day index
    assert quality.day_block_overlaps(ids, id_col="block_id").first().failures == 0
    with pytest.raises(sampling.BlockOverflowError):
        sampling.order_id_blocks(df, block=4, strict=True)


def test_run_date_parsing():
    from tidemart.functions.dates import parse_run_date
    assert parse_run_date("2026-03-15") == D(2026, 3, 15)
    assert isinstance(parse_run_date(None), D)
    with pytest.raises(ValueError):
        parse_run_date("15-03-2026")


def test_scale_conf_sizes_partitions_to_the_data():
    from tidemart.session import scale_conf
    big = scale_conf(100 * 1024 ** 4, 8000)
    assert int(big["spark.sql.shuffle.partitions"]) == 819200
    small = scale_conf(10 * 1024 ** 2, 8)
    assert int(small["spark.sql.shuffle.partitions"]) == 16


def test_rollup_reports_equal_row_level_reports(spark):
    from tidemart.plans.catalog import fact_from_tables
    from shared import SF_SMALL
    fact = fact_from_tables(spark, SF_SMALL)
    # a dimension missing some products: unknown products must not form groups
    dim = (fact.select("product_id").distinct().where("product_id % 7 <> 0")
           .select("product_id", F.concat(F.lit("t"), (F.col("product_id") % 13).cast("string")).alias("title"),
                   F.concat(F.lit("c"), (F.col("product_id") % 3).cast("string")).alias("category"),
                   F.lit(4.5).alias("rating_rate"), F.lit(9).alias("rating_count")))
    rows = reports.fact_with_product(fact, dim).collect()
    roll = reports.product_rollup(fact, dim)
    kpi = reports.kpi_row_from(roll, fact).first()
    assert kpi.total_orders == len({r.order_id for r in rows}) and kpi.items_sold == sum(r.quantity for r in rows)
    assert abs(kpi.total_revenue - sum(r.line_total for r in rows)) < 0.01
    assert abs(kpi.avg_discount - sum(r.discount_percentage for r in rows) / len(rows)) < 1e-9
    by_category, by_title, first = {}, {}, {}
    for r in rows:
        if r.category is not None:
            by_category[r.category] = by_category.get(r.category, 0) + r.line_total
            by_title[r.title] = by_title.get(r.title, 0) + r.quantity
        place = (r.date_key, r.order_id, r.unit_price)
        first[r.product_id] = min(first.get(r.product_id, place), place)
    got = {r.category: r.line_total for r in reports.revenue_by_category_from(roll).collect()}
    assert got.keys() == by_category.keys() and all(abs(got[c] - v) < 0.01 for c, v in by_category.items())
    top = [(r.title, r.quantity) for r in reports.top_products_from(roll).collect()]
    assert top[::-1] == sorted(by_title.items(), key=lambda x: (-x[1], x[0]))[:10]
    assert {r.product_id: r.unit_price for r in reports.price_vs_rating(fact, dim).collect()} == {
        p: x[2] for p, x in first.items()}


def test_discounts_are_not_rounded_before_the_mean(spark):
    fact = spark.createDataFrame([(1, 1, 1, 1.0, 0.125), (1, 2, 1, 1.0, 1234.0)],
                                 "order_id int, product_id int, quantity int, line_total double, discount_percentage double")
    dim = spark.createDataFrame([], "product_id int, title string, category string, rating_rate double, rating_count int")
    assert reports.kpi_row_from(reports.product_rollup(fact, dim), fact).first().avg_discount == 617.0625


def test_a_nearly_whole_number_is_no_integer(spark):
    from tidemart.operators.validation import validate
    doc = dict(id=2.0000000001, title="t", price=1, description="d", category="c", image="i", rating=dict(rate=1, count=3))
    good = dict(doc, id=2.0)
    assert [r.errors for r in validate(_records(spark, [doc, good])).orderBy("product_id").collect()] == ["id", ""]


def test_work_folders_live_under_the_sessions_checkpoint_dir(spark):
    from tidemart.session import apply_scale_conf, checkpoint_root, scratch_dir
    root = checkpoint_root(spark)
    configured = spark.conf.get("spark.checkpoint.dir", None)
    assert configured and root == configured.rstrip("/")
    a, b = scratch_dir(spark, "x"), scratch_dir(spark, "x")
    assert a.startswith(root) and b.startswith(root) and a != b
    from tidemart.session import scale_conf
    keys = list(scale_conf(1, 1))
    before = {k: spark.conf.get(k, None) for k in keys}
    try:
        conf = apply_scale_conf(spark, 10 * 1024 ** 3, 4)
        assert spark.conf.get("spark.sql.shuffle.partitions") == conf["spark.sql.shuffle.partitions"] == "80"
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_strict_validation_counts_in_parallel(spark):
    from tidemart.operators import validation
    docs = [{"id": i, "title": "t", "price": 1.0, "description": "d", "category": "c", "image": "i",
             "rating": {"rate": 1.0, "count": 1}} for i in range(40)]
    one_task, seen = _records(spark, docs).coalesce(1), []
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("strict-validation", "")
    try:
        validation.split_valid(one_task, strict=True)
        for job in tracker.getJobIdsForGroup("strict-validation"):
            seen += [tracker.getStageInfo(s).numTasks for s in tracker.getJobInfo(job).stageIds if tracker.getStageInfo(s)]
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert max(seen) >= spark.sparkContext.defaultParallelism > 1
