"""The ten analytical queries over silver tables. ``as_of`` stands for "now", so a run can be repeated."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillstream.functions import exprs as x
from tillstream.operators.gold import by_product, item_rows
from tillstream.operators.ranking import exact_percentiles
from tillstream.operators.rows import in_month, join_on, on_day


def top_products(orders: DataFrame, as_of: dt.datetime, items: DataFrame | None = None, days: int = 30,
                 limit: int = 50, calendar_predicate: bool = False, products: DataFrame | None = None) -> DataFrame:
    """Best sellers of the last ``days`` days.

    ``calendar_predicate`` uses "same year and month >= last month" instead, which finds nothing of December in January.
    """
    if calendar_predicate:
        last_month = as_of.month - 1 or 12
        recent = orders.filter((F.col("year") == as_of.year) & (F.col("month") >= last_month))
    else:
        recent = orders.filter((F.col("event_timestamp") > F.lit(as_of - dt.timedelta(days=days)))
                               & (F.col("event_timestamp") <= F.lit(as_of)))
    rows = item_rows(recent.filter(x.is_completed()), items, ["order_id"])
    keys = ["product_id", "product_name", "category", "brand"]
    sums = by_product(rows, products, keys, {
        "units_sold": (F.sum("quantity"), F.sum),
        # rows that go together are of one product and have its orders
        "order_count": (F.countDistinct("order_id"), F.max),
        "_revenue": (F.sum(x.units("final_price") * F.col("quantity")), F.sum),
        "_price": (F.sum(x.units("unit_price")), F.sum), "_prices": (F.count("unit_price"), F.sum),
        "_discount": (F.sum(x.units("discount_pct")), F.sum), "_discounts": (F.count("discount_pct"), F.sum)})
    best = sums.select(*keys, "units_sold", "order_count", (F.col("_revenue") / 100.0).alias("total_revenue"),
                       x.fixed_avg_of("_price", "_prices").alias("avg_unit_price"),
                       x.fixed_avg_of("_discount", "_discounts").alias("avg_discount_pct"),
                       ).orderBy(F.col("total_revenue").desc(), "product_id").limit(limit)
    # a dense rank needs only the rows above, so ranking the kept rows gives the same numbers
    return best.withColumn("revenue_rank", F.dense_rank().over(Window.orderBy(F.col("total_revenue").desc()))
                           .cast("long"))


def conversion_by_channel(clicks: DataFrame, orders: DataFrame, as_of: dt.date, null_safe: bool = False) -> DataFrame:
    keys = ["utm_source", "utm_medium", "device_type"]
    sessions = in_month(clicks, as_of).groupBy(*keys).agg(
        F.countDistinct("session_id").alias("total_sessions"), F.countDistinct("user_id").alias("unique_users"))
    bought = in_month(orders, as_of).filter(x.is_completed()).groupBy(*keys).agg(
        F.countDistinct("session_id").alias("converting_sessions"), F.countDistinct("order_id").alias("total_orders"),
        x.fixed_sum("total_amount").alias("revenue"))
    out = join_on(sessions, bought, keys, "left", null_safe).fillna(
        0, subset=["converting_sessions", "total_orders", "revenue"])
    return out.select(*keys, "total_sessions", "unique_users", F.col("total_orders").alias("orders"), "revenue",
                      x.pct("converting_sessions", "total_sessions").alias("conversion_rate_pct"),
                      x.ratio("revenue", "total_orders", 2).alias("avg_order_value")
                      ).orderBy(F.col("conversion_rate_pct").desc(), *keys)


def hourly_revenue_trend(orders: DataFrame, as_of: dt.date) -> DataFrame:
    """Today's revenue by hour and country with a running total; everything but cancelled orders."""
    out = on_day(orders, as_of).filter(F.col("order_status") != "cancelled").groupBy("hour", "country").agg(
        F.count("order_id").alias("orders"), F.countDistinct("user_id").alias("buyers"),
        x.fixed_sum("total_amount").alias("gross_revenue"),
        x.fixed_sum(F.col("total_amount") - F.col("discount_amount")).alias("net_revenue"),
        x.fixed_avg("total_amount").alias("avg_order_value"))
    w = Window.partitionBy("country").orderBy("hour").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return out.withColumn("cumulative_revenue", F.sum(x.units("gross_revenue")).over(w) / 100.0).orderBy("country", "hour")


def cart_sessions(carts: DataFrame, as_of: dt.date | None, last_total: bool = False) -> DataFrame:
    """Sessions that added something: one row per session, user, country, device and segment.

    ``last_total`` takes the largest cart total instead of summing the running total of every add.
    """
    money = x.rnd(F.max("cart_total"), 2) if last_total else x.fixed_sum("cart_total")
    return in_month(carts, as_of).filter(F.col("action") == "item_added").groupBy(
        "session_id", "user_id", "country", "device_type", "customer_segment").agg(
        F.countDistinct("product_id").alias("products_added"), money.alias("potential_revenue"),
        F.max("event_timestamp").alias("last_activity"))


def abandoned_carts(carts: DataFrame, orders: DataFrame, as_of: dt.date, last_total: bool = False,
                    by: tuple[str, ...] = ("country", "device_type", "customer_segment")) -> DataFrame:
    bought = in_month(orders, as_of).select("session_id").distinct().withColumn("converted", F.lit(1))
    rows = cart_sessions(carts, as_of, last_total).join(bought, "session_id", "left")
    lost = F.when(F.col("converted").isNull(), F.col("potential_revenue")).otherwise(0.0)
    out = rows.groupBy(*by).agg(
        F.count("session_id").alias("cart_sessions"), F.count("converted").alias("converted_sessions"),
        x.fixed_sum(lost).alias("lost_revenue"))
    gone = F.col("cart_sessions") - F.col("converted_sessions")
    return out.select(*by, "cart_sessions", "converted_sessions", gone.alias("abandoned_carts"),
                      x.pct(gone, "cart_sessions").alias("abandonment_rate_pct"), "lost_revenue"
                      ).orderBy(F.col("lost_revenue").desc(), *by)


def abandoned_cart_list(carts: DataFrame, orders: DataFrame, as_of: dt.date) -> DataFrame:
    """The abandoned sessions themselves."""
    bought = in_month(orders, as_of).select("session_id")
    return cart_sessions(carts, as_of).join(bought, "session_id", "left_anti")


def _active_months(orders: DataFrame) -> DataFrame:
    """One row per user and active month (first of month), with the user's first one."""
    months = orders.filter(x.is_completed()).select(
        "user_id", F.trunc("event_timestamp", "month").alias("order_month")).distinct()
    return months.withColumn("cohort_month", F.min("order_month").over(Window.partitionBy("user_id")))


def cohort_retention(orders: DataFrame, months: int = 12) -> DataFrame:
    """Active customers per cohort and month since the first order.

    The cohort size counts the same joined rows as the active customers, so the rate is always 100 %; see
    ``cohort_retention_true``.
    """
    since = x.month_diff("order_month", "cohort_month")
    out = _active_months(orders).withColumn("months_since_acquisition", since).filter(
        F.col("months_since_acquisition").between(0, months - 1)).groupBy(
        F.date_format("cohort_month", "yyyy-MM").alias("cohort_label"), "months_since_acquisition").agg(
        F.count(F.lit(1)).alias("active_customers"))
    return out.select("cohort_label", "months_since_acquisition", "active_customers",
                      F.col("active_customers").alias("cohort_size"),
                      x.pct("active_customers", "active_customers").alias("retention_rate_pct")
                      ).orderBy("cohort_label", "months_since_acquisition")


def cohort_retention_true(orders: DataFrame, months: int = 12) -> DataFrame:
    """As above with the cohort's full size: its customers at month 0."""
    out = cohort_retention(orders, months).drop("cohort_size", "retention_rate_pct")
    whole = F.max(F.when(F.col("months_since_acquisition") == 0, F.col("active_customers"))).over(
        Window.partitionBy("cohort_label"))
    return out.withColumn("cohort_size", whole).withColumn(
        "retention_rate_pct", x.pct("active_customers", "cohort_size")).orderBy("cohort_label", "months_since_acquisition")


def active_users(clicks: DataFrame, as_of: dt.datetime, minutes: int = 15) -> DataFrame:
    bounced = F.sum(F.when(F.col("is_bounce"), 1).otherwise(0))
    recent = clicks.filter(F.col("event_timestamp") >= F.lit(as_of - dt.timedelta(minutes=minutes)))
    out = recent.groupBy(F.date_trunc("minute", "event_timestamp").alias("minute_bucket"), "device_type", "page_type").agg(
        F.countDistinct("session_id").alias("active_sessions"), F.countDistinct("user_id").alias("active_users"),
        F.count("event_id").alias("page_views"), x.int_avg("time_on_page_seconds", 1).alias("avg_time_on_page"),
        bounced.alias("bounces"))
    return out.withColumn("bounce_rate_pct", x.pct("bounces", "page_views")).orderBy(
        F.col("minute_bucket").desc(), F.col("active_users").desc(), "device_type", "page_type")


def aov_by_segment(orders: DataFrame, year: int | None, min_orders: int = 10, exact: bool = True) -> DataFrame:
    """Order value by segment and country. ``exact=False`` uses sketches: one pass, small state."""
    keys = ["customer_segment", "country"]
    wanted = {"aov_p25": 0.25, "aov_median": 0.5, "aov_p75": 0.75, "aov_p95": 0.95}
    rows = orders.filter(x.is_completed())
    if year is not None:
        rows = rows.filter(F.col("year") == year)
    aggs = [F.countDistinct("user_id").alias("customers"), F.count("order_id").alias("orders"),
            x.fixed_avg("total_amount").alias("avg_order_value"),
            x.fixed_sum("total_amount").alias("total_revenue"),
            x.int_avg("item_count", 1).alias("avg_items_per_order")]
    if exact:
        base = rows.groupBy(*keys).agg(*aggs).filter(F.col("orders") >= min_orders)
        p = exact_percentiles(rows, keys, F.col("total_amount"), wanted)
        out = join_on(base, p, keys, "inner", null_safe=True).withColumns({n: x.rnd(n, 2) for n in wanted})
    else:
        sketch = F.percentile_approx("total_amount", list(wanted.values()), 10000).alias("_p")
        out = rows.groupBy(*keys).agg(*aggs, sketch).filter(F.col("orders") >= min_orders)
        out = out.withColumns({n: x.rnd(F.col("_p")[i], 2) for i, n in enumerate(wanted)}).drop("_p")
    return out.orderBy(F.col("avg_order_value").desc(), *keys)


def payment_success(payments: DataFrame, as_of: dt.date | None) -> DataFrame:
    status = F.col("payment_status")
    out = in_month(payments, as_of).groupBy("payment_method", "payment_gateway", "country", "failure_reason").agg(
        F.count("payment_id").alias("total_transactions"), F.count_if(status == "success").alias("successful"),
        F.count_if(status == "failed").alias("failed"), F.count_if(status == "declined").alias("declined"),
        x.int_avg("processing_time_ms", 0).alias("avg_processing_ms"),
        x.fixed_avg("amount").alias("avg_transaction_amount"),
        x.fixed_sum(F.when(status == "success", F.col("amount")).otherwise(0.0)).alias("successful_volume"),
        F.count_if(F.col("failure_reason") == "fraud_detected").alias("fraud_count"))
    return out.withColumn("success_rate_pct", x.pct("successful", "total_transactions")).orderBy(
        F.col("total_transactions").desc(), "payment_method", "payment_gateway", "country", "failure_reason")


def search_performance(clicks: DataFrame, as_of: dt.date | None, min_searches: int = 5, limit: int = 100) -> DataFrame:
    terms = in_month(clicks, as_of).filter(
        (F.col("page_type") == "search_results") & F.col("search_query").isNotNull()).groupBy(
        F.lower(F.trim("search_query")).alias("query")).agg(
        F.count("event_id").alias("search_count"), F.countDistinct("session_id").alias("searching_sessions"),
        x.int_avg("search_result_count", 0).alias("avg_results"),
        F.count_if(F.col("search_result_count") == 0).alias("zero_result_searches"),
    ).filter(F.col("search_count") >= min_searches)
    # the grand total is one row; as a scalar subquery no task has to see all terms
    total = terms.agg(F.sum("search_count")).scalar()
    return terms.select(
        "query", "search_count", "searching_sessions", "avg_results", "zero_result_searches",
        x.pct("zero_result_searches", "search_count").alias("zero_result_rate_pct"),
        x.pct("search_count", total, 3).alias("search_share_pct"),
    ).orderBy(F.col("search_count").desc(), "query").limit(limit)


def dq_monitor(orders: DataFrame, as_of: dt.date | None, approximate: bool = True,
               run_ts: dt.datetime | None = None) -> DataFrame:
    """Daily profile of a silver orders table."""
    amount, country = F.col("total_amount"), F.col("country")
    distinct = F.approx_count_distinct if approximate else F.countDistinct
    name = "approx_distinct" if approximate else "distinct"
    audit = [] if run_ts is None else [F.lit(run_ts).alias("report_generated_at")]
    out = in_month(orders, as_of).groupBy("year", "month", "day").agg(
        F.count(F.lit(1)).alias("total_records"), F.count_if(F.col("order_id").isNull()).alias("null_order_ids"),
        F.count_if(F.col("user_id").isNull()).alias("null_user_ids"), F.count_if(amount <= 0).alias("invalid_amounts"),
        F.count_if(amount > 10000).alias("suspicious_amounts"),
        F.count_if(country.isNull() | (country == "UNKNOWN")).alias("unknown_country"),
        x.fixed_avg("total_amount").alias("avg_order_value"), F.min("event_timestamp").alias("earliest_event"),
        F.max("event_timestamp").alias("latest_event"), distinct("order_id").alias(f"{name}_orders"),
        distinct("user_id").alias(f"{name}_users"))
    return out.select(F.lit("silver_orders").alias("table_name"), *out.columns, *audit).orderBy(
        F.col("year").desc(), F.col("month").desc(), F.col("day").desc())
