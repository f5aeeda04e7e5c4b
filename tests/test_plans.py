"""What the plans must look like to hold at scale: no pair products, early cuts for hot keys, pruned scans."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from tillstream.operators import gold
from tillstream.operators.ranking import exact_percentiles, with_rank
from tillstream.operators.rows import deduplicate
from tillstream.plans import dashboards, views
from tillstream.registry import QUERIES


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def small_joins_shuffle(spark):
    """Broadcasts off and small partitions, as with tables too large for them."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.mark.parametrize("name", ["daily_revenue", "product_performance", "product_sales", "revenue_by_day", "funnel",
                                  "kpi_summary", "rank_over_time", "page_flow", "merge_orders", "fact_changes"])
def test_no_pair_products(spark, folder, name):
    text = plan(QUERIES[name](spark, folder))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_dedup_cuts_before_the_shuffle(spark, folder):
    text = plan(QUERIES["daily_revenue"](spark, folder))
    assert re.search(r"Exchange hashpartitioning\(order_id[^\n]*\n[^\n]*WindowGroupLimit[^\n]*Partial", text)


def test_scans_read_only_what_is_used(spark, folder):
    text = plan(QUERIES["sessions_by_device"](spark, folder))
    assert "event_type" not in re.search(r"FileScan parquet \[([^\]]*)\][^\n]*events.parquet", text).group(1)
    text = plan(QUERIES["live_order_feed"](spark, folder))
    assert "EqualTo(event_type,purchase)" in text


def test_rank_reads_its_input_once(spark, folder):
    df = QUERIES["product_performance"](spark, folder)
    df.collect()
    assert "ReusedExchange" in plan(df)


def test_windows_of_the_ranks_are_per_bucket(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), F.col("id").cast("double").alias("v"))
    for d in (with_rank(df, ["k"], "v", "r"), exact_percentiles(df, ["k"], F.col("v"), {"p": 0.5})):
        windows = [w for w in plan(d).splitlines() if re.search(r"Window \[", w)]
        # "_w" marks the table of bucket totals
        assert len(windows) >= 2 and all("_bucket" in w or "sum(_w" in w for w in windows)


def test_an_order_with_a_third_of_all_items_is_split(spark, small_joins_shuffle):
    n = 30000
    orders = spark.range(200).select(F.concat(F.lit("ORD-"), "id").alias("order_id"), F.lit(1).alias("year"), F.col("id").alias("t"))
    orders = deduplicate(orders, ["order_id"], "t")
    key = F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 200)
    text = F.md5(F.col("id").cast("string"))
    items = spark.range(n, numPartitions=8).select(
        F.concat(F.lit("ORD-"), key).alias("order_id"), *[text.alias(c) for c in ("product_id", "product_name", "category", "brand")],
        F.lit(1).alias("quantity"), *[F.lit(1.0).alias(c) for c in ("unit_price", "discount_pct", "final_price")])
    df = gold.item_rows(orders, items, ["order_id", "year"]).groupBy("product_id").agg(F.count(F.lit(1)).alias("n"))
    assert df.agg(F.sum("n")).first()[0] == n
    df.collect()
    assert "SortMergeJoin(skew=true)" in plan(df)


def test_days_outside_the_calendar_stay(spark):
    cols = "order_id string, date_key int, order_timestamp timestamp, country string, order_status string, order_total double"
    fact = spark.createDataFrame([("a", 20310305, dt.datetime(2031, 3, 5), "US", "delivered", 5.0)], cols)
    assert [r.order_date for r in views.revenue_delta_30d(fact).collect()] == ["2031-03-05"]
    calendar = gold.dim_time(spark, dt.date(2024, 1, 1), dt.date(2024, 1, 3))
    assert [(r.order_date, r.revenue_7d_avg) for r in dashboards.revenue_7d_avg(fact, calendar).collect()] == [("2031-03-05", 5.0)]


def test_histogram_width(spark):
    df = spark.createDataFrame([(0.95,), (0.9,), (0.3,), (0.29,)], "v double")
    got = {r.bucket: r.n for r in dashboards.histogram(df, "v", 0.3, "n").collect()}
    assert got == {0.9: 2, 0.3: 1, 0.0: 1}
