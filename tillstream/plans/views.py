"""The warehouse views. Facts carry device_type and country; date parts come from the calendar's rules."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillstream.functions import exprs as x
from tillstream.operators.ranking import exact_percentiles, with_rank
from tillstream.operators.rows import join_on


def on_calendar(fact: DataFrame, *cols: str) -> DataFrame:
    """Calendar columns of a fact, worked out from its date key: no join, and no day that a calendar could lack."""
    parts = x.calendar_parts(F.to_date(F.col("date_key").cast("string"), "yyyyMMdd"))
    return fact.withColumns({c: parts[c] for c in cols})


def orders_enriched(fact_orders: DataFrame, dim_users: DataFrame, dim_devices: DataFrame) -> DataFrame:
    users = dim_users.select(
        "user_sk", "customer_segment", F.col("total_orders").alias("customer_total_orders"),
        F.col("total_spend").alias("customer_total_spend"), F.col("avg_order_value").alias("customer_aov"),
        "churn_risk_score", "ltv_score", "preferred_category", F.col("is_active").alias("customer_is_active"))
    devices = dim_devices.select("device_sk", "device_type", "device_os", "browser", "device_class", "is_mobile")
    fact = fact_orders.select(
        "order_id", "event_id", "user_id", "session_id", "order_timestamp", "order_status", "payment_method", "currency",
        "item_count", "order_total", "subtotal", "tax_amount", "shipping_cost", "discount_amount",
        "effective_discount_pct", "order_value_tier", "primary_category", "distinct_products", "is_prime", "is_gift",
        "is_weekend", "order_hour_bucket", "utm_source", "utm_medium", "country", "user_sk", "device_sk", "date_key")
    dated = on_calendar(fact, "full_date", "year", "month", "day", "week_of_year", "day_name", "month_name", "quarter")
    return (dated.withColumnRenamed("full_date", "order_date")
            .join(users, "user_sk", "left").join(devices, "device_sk", "left")
            .withColumn("is_completed", F.coalesce(x.is_completed(), F.lit(False)))
            .drop("user_sk", "device_sk", "date_key"))


REVENUE_KEYS = ["order_date", "year", "month", "month_name", "quarter", "country", "payment_method", "order_value_tier"]


def revenue_by_day(fact_orders: DataFrame, lag_rows: int = 30) -> DataFrame:
    """Daily KPIs. ``revenue_delta_30d`` compares with the row 30 places earlier within the country (not 30 days)."""
    done = on_calendar(fact_orders.filter(x.is_completed()), "full_date", "year", "month", "month_name",
                         "quarter").withColumnRenamed("full_date", "order_date")
    total = x.fixed_sum("order_total")
    out = done.groupBy(*REVENUE_KEYS).agg(
        F.count("order_id").alias("total_orders"), F.count_if("is_weekend").alias("weekend_orders"),
        F.countDistinct("user_id").alias("unique_buyers"), F.sum("item_count").alias("total_units"),
        total.alias("gross_revenue"),
        x.fixed_sum(F.col("order_total") - F.col("discount_amount")).alias("net_revenue"),
        x.fixed_sum("discount_amount").alias("total_discounts"),
        x.fixed_sum("shipping_cost").alias("total_shipping"),
        x.fixed_sum("tax_amount").alias("total_tax"), x.fixed_avg("order_total").alias("aov"))
    median = exact_percentiles(done, REVENUE_KEYS, F.col("order_total"), {"median_order_value": 0.5})
    out = join_on(out, median, REVENUE_KEYS, "inner", null_safe=True)
    w = Window.partitionBy("country").orderBy("order_date", "payment_method", "order_value_tier")
    return out.withColumns({
        "median_order_value": x.rnd("median_order_value", 2),
        "revenue_per_customer": x.ratio("gross_revenue", "unique_buyers", 2),
        "revenue_delta_30d": x.rnd(F.col("gross_revenue") - F.lag("gross_revenue", lag_rows).over(w), 2)})


def revenue_delta_30d(fact_orders: DataFrame, days: int = 30) -> DataFrame:
    """Daily revenue per country against the same country exactly ``days`` days earlier (0 where nothing was sold)."""
    done = on_calendar(fact_orders.filter(x.is_completed()), "full_date")
    daily = done.groupBy("country", F.col("full_date").cast("date").alias("order_date")).agg(
        x.fixed_sum("order_total").alias("revenue"))
    earlier = daily.select("country", F.date_add("order_date", days).alias("order_date"),
                           F.col("revenue").alias("revenue_before"))
    out = join_on(daily, earlier, ["country", "order_date"], "left", null_safe=True).fillna(0.0, ["revenue_before"])
    return out.select("country", F.col("order_date").cast("string").alias("order_date"), "revenue", "revenue_before",
                      x.rnd(F.col("revenue") - F.col("revenue_before"), 2).alias("revenue_delta_30d"))


def _category_sales(fact_orders: DataFrame, keys: list[str]) -> DataFrame:
    """Per category: what the category join needs, small before products are attached."""
    # summed as decimals: as longs, some hundred million large orders of a category would overflow
    per_item = F.round(F.col("order_total") * 1e6 / F.nullif(F.col("item_count"), F.lit(0))).cast("decimal(20,0)")
    return fact_orders.groupBy(F.col("primary_category").alias("category"), *keys).agg(
        F.count("order_id").alias("order_count"), F.sum("item_count").alias("units_sold"),
        x.fixed_sum("order_total").alias("total_revenue"),
        x.rnd(F.sum(per_item).cast("double") / 1e6 / F.nullif(F.count(per_item), F.lit(0)), 2).alias("avg_item_price"),
        x.fixed_avg("effective_discount_pct").alias("avg_discount_pct")).filter(F.col("category").isNotNull())


def _by_category(fact_orders: DataFrame, products: DataFrame, keys: list[str],
                 ranks: dict[str, list[str]]) -> DataFrame:
    """Facts joined with products on category: every product of a category gets the whole category's figures.

    All rows of a category carry equal figures per product, so sums and ranks are worked out per category (a row
    standing for as many rows as the category has products) and the products are attached at the very end.
    """
    size = products.groupBy("category").agg(F.count(F.lit(1)).alias("_products"))
    sales = _category_sales(fact_orders, keys).join(size, "category")
    for name, within in ranks.items():
        sales = with_rank(sales, within, "total_revenue", name, weight="_products")
    return products.join(sales.drop("_products"), "category")


def product_sales(fact_orders: DataFrame, dim_products: DataFrame) -> DataFrame:
    """Category-joined product figures, as the view defines them; ``product_performance`` is the item-level answer."""
    done = on_calendar(fact_orders.filter(x.is_completed()), "year", "month", "month_name", "quarter")
    products = dim_products.select("product_id", "product_name", "category", "brand")
    return _by_category(done, products, ["year", "month", "month_name", "quarter", "country", "device_type"],
                        {"category_rank": ["year", "month", "category"], "overall_rank": ["year", "month"]})


def rpt_product_performance(fact_orders: DataFrame, dim_products: DataFrame) -> DataFrame:
    done = fact_orders.filter(x.is_completed()).drop("year", "month").withColumns(
        {"year": F.year("order_timestamp"), "month": F.month("order_timestamp")})
    products = dim_products.select("product_id", "product_name", "category", "brand")
    out = _by_category(done, products, ["year", "month"], {"revenue_rank": ["year", "month", "category"]})
    return out.withColumnRenamed("avg_item_price", "avg_selling_price")


def rpt_daily_revenue(fact_orders: DataFrame) -> DataFrame:
    keys = ["report_date", "country", "device_type", "payment_method", "customer_segment"]
    out = fact_orders.filter(x.is_completed()).withColumn(
        "report_date", F.to_date("order_timestamp").cast("string")).groupBy(*keys).agg(
        F.count("order_id").alias("total_orders"), F.countDistinct("user_id").alias("unique_customers"),
        x.fixed_sum("order_total").alias("gross_revenue"),
        x.fixed_sum(F.col("order_total") - F.col("discount_amount")).alias("net_revenue"),
        x.fixed_sum("discount_amount").alias("total_discounts"),
        x.fixed_avg("order_total").alias("avg_order_value"),
        x.fixed_sum("shipping_cost").alias("total_shipping"),
        x.fixed_sum("tax_amount").alias("total_tax"))
    return out.withColumn("revenue_per_customer", x.ratio("gross_revenue", "unique_customers", 2))


def conversion_funnel(fact_clicks: DataFrame, fact_orders: DataFrame, null_safe: bool = False) -> DataFrame:
    keys = ["session_date", "country", "device_type", "utm_source", "customer_segment"]

    def dated(fact):
        return on_calendar(fact, "full_date").withColumnRenamed("full_date", "session_date")

    sessions = dated(fact_clicks).groupBy(*keys).agg(
        F.countDistinct("session_id").alias("total_sessions"), F.countDistinct("user_id").alias("unique_users"),
        F.count("event_id").alias("page_views"), F.count_if("is_bounce").alias("bounces"),
        x.int_avg("time_on_page_seconds", 1).alias("avg_time_on_page"))
    bought = dated(fact_orders.filter(x.is_completed())).groupBy(*keys).agg(
        F.countDistinct("session_id").alias("converting_sessions"), F.count("order_id").alias("orders"),
        x.fixed_sum("order_total").alias("revenue"))
    out = join_on(sessions, bought, keys, "left", null_safe).fillna(0, ["converting_sessions", "orders", "revenue"])
    return out.withColumns({
        # per session, so several bounces in a session can pass 100 %
        "bounce_rate_pct": x.pct("bounces", "total_sessions"),
        "conversion_rate_pct": x.pct("converting_sessions", "total_sessions"),
        "aov": x.ratio("revenue", "orders", 2)})


def payment_analytics(fact_payments: DataFrame) -> DataFrame:
    rows = on_calendar(fact_payments, "full_date", "year", "month").withColumnRenamed(
        "full_date", "payment_date")
    status = F.col("payment_status")
    out = rows.groupBy("payment_date", "year", "month", "payment_method", "payment_gateway", "payment_status",
                       "failure_reason", "country").agg(
        F.count("payment_id").alias("transactions"), x.fixed_sum("amount").alias("volume"),
        x.fixed_avg("amount").alias("avg_amount"), x.int_avg("processing_time_ms", 0).alias("avg_processing_ms"),
        F.count_if("is_3ds_authenticated").alias("authenticated_3ds"),
        F.count_if(status == "success").alias("successful"),
        F.count_if(status.isin("failed", "declined")).alias("failed"))
    return out.withColumn("success_rate_pct", x.pct("successful", "transactions"))


def user_segments(dim_users: DataFrame) -> DataFrame:
    return dim_users.filter("is_active").select(
        "user_id", "customer_segment", "country", "is_prime", "total_orders", "total_spend", "avg_order_value",
        F.col("first_order_date").cast("string").alias("first_order_date"),
        F.col("last_order_date").cast("string").alias("last_order_date"), "days_since_last_order",
        "preferred_category", "churn_risk_score", "ltv_score", x.churn_band().alias("churn_risk_band"),
        x.ltv_band().alias("ltv_band"),
        F.date_diff("last_order_date", "first_order_date").alias("customer_lifespan_days"))


def hourly_activity(fact_orders: DataFrame, as_of: dt.datetime, days: int = 7) -> DataFrame:
    """Orders of the last days by hour, country and device, with a running revenue per country."""
    recent = fact_orders.filter(x.is_completed() & (F.col("order_timestamp") >= F.lit(as_of - dt.timedelta(days=days))))
    out = recent.groupBy(F.date_trunc("hour", "order_timestamp").alias("hour_bucket"), "country", "device_type").agg(
        F.count("order_id").alias("orders"), F.countDistinct("user_id").alias("buyers"),
        x.fixed_sum("order_total").alias("revenue"), x.fixed_avg("order_total").alias("aov"))
    w = (Window.partitionBy("country").orderBy("hour_bucket", "device_type")
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return out.withColumn("cumulative_revenue", F.sum(x.units("revenue")).over(w) / 100.0)


def pipeline_health(tables: dict[str, DataFrame], as_of: dt.datetime, loaded_at: str = "loaded_at") -> DataFrame:
    """Row count, last load, its age in minutes and rows of the last hour, per table."""
    now = F.lit(as_of)
    parts = [df.agg(F.count(F.lit(1)).alias("total_rows"), F.max(loaded_at).alias("last_load"),
                    F.count_if(F.col(loaded_at) >= now - F.expr("interval 1 hour")).alias("rows_last_hour"))
             .select(F.lit(name).alias("table_name"), "total_rows", "last_load",
                     x.minute_diff(now, "last_load").alias("minutes_since_load"), "rows_last_hour")
             for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
