"""Samples of a common catalogue for each group."""

import datetime as dt
import hashlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidemart.operators.sampling import next_prime, sample_for_each
from tidemart.plans.catalog import QUERIES

from shared import SF_SMALL


def brute(groups, keys, k):
    """{(group, rank): key} by the documented rule."""
    keys, out = sorted(keys), {}
    n = len(keys)
    p = next(c for c in range(max(n, 2), 10 ** 6) if all(c % d for d in range(2, c)))
    for g in groups:
        h = hashlib.md5(("" if g is None else str(g)).encode()).hexdigest()
        a, b = 1 + int(h[:13], 16) % (p - 1), int(h[13:26], 16) % p
        picks = [x for x in ((a * j + b) % p for j in range(p)) if x < n][:k]
        out |= {(g, i + 1): keys[x] for i, x in enumerate(picks)}
    return out


@pytest.mark.parametrize(("n", "k"), [(20, 5), (1, 3), (2, 2), (7, 7), (90, 40), (5, 9)])
def test_equals_the_rule(spark, n, k):
    days = [dt.date(2025, 12, 27) + dt.timedelta(days=i) for i in range(12)] + [None]
    groups = spark.createDataFrame([(d,) for d in days + days], "day date")
    items = spark.createDataFrame([(3 * i, f"t{i}") for i in range(n)] + [(None, "no key")], "id long, title string")
    got = sample_for_each(groups, "day", items.repartition(3), "id", k).collect()
    assert {(r["day"], r["pick_rank"]): r["id"] for r in got} == brute(days, [3 * i for i in range(n)], k)
    assert len(got) == len(days) * min(n, k)
    assert all(r["title"] == f"t{r['id'] // 3}" for r in got)


def test_empty_catalogue_and_no_groups(spark):
    groups = spark.createDataFrame([(1,)], "g int")
    items = spark.createDataFrame([], "id long")
    assert sample_for_each(groups, "g", items, "id", 3).count() == 0
    one = spark.createDataFrame([(4,)], "id long")
    assert sample_for_each(groups.limit(0), "g", one, "id", 3).count() == 0


def test_every_product_is_picked_about_equally_often(spark):
    groups = spark.range(4000).select(F.col("id").alias("g"))
    items = spark.range(50).select("id")
    times = Counter(r["id"] for r in sample_for_each(groups, "g", items, "id", 5).collect())
    assert len(times) == 50 and min(times.values()) > 300 and max(times.values()) < 500  # 400 expected


def test_plan_has_no_cross_join_and_a_rerun_is_the_same(spark):
    df = QUERIES["catalogue_sample_per_date"](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    again = QUERIES["catalogue_sample_per_date"](spark, SF_SMALL)
    assert sorted(df.collect()) == sorted(again.collect())
    per_day = df.groupBy("extraction_date").agg(F.count_distinct("product_id").alias("n"), F.count("*").alias("rows"))
    assert per_day.where("n <> 5 or rows <> 5").count() == 0


def test_next_prime():
    assert [next_prime(n) for n in (0, 1, 2, 3, 4, 90, 97, 20_000)] == [2, 2, 2, 3, 5, 97, 97, 20_011]
