"""BI measures and the queries behind the dashboard pages."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillstream.functions import exprs as x
from tillstream.operators.gold import by_product, item_rows
from tillstream.operators.rows import join_on, transitions
from tillstream.plans import lake


def completed(fact_orders: DataFrame) -> DataFrame:
    return fact_orders.filter(x.is_completed())


def _revenue() -> Column:
    return x.fixed_sum("order_total")


def _measures(df: DataFrame, **aggs: Column) -> DataFrame:
    """One aggregate pass as (measure, value) rows."""
    row = df.agg(*[c.cast("double").alias(n) for n, c in aggs.items()])
    pairs = F.array(*[F.struct(F.lit(n).alias("measure"), F.col(n).alias("value")) for n in aggs])
    return row.select(F.inline(pairs))


def _one_row(parts: list[DataFrame], names: list[str]) -> DataFrame:
    """(measure, value) rows of several sources as one wide row."""
    rows = reduce(DataFrame.unionByName, parts)
    return rows.agg(*[F.max(F.when(F.col("measure") == n, F.col("value"))).alias(n) for n in names])


# ---- measures ------------------------------------------------------------------------------

def kpi_summary(fact_orders: DataFrame, dim_users: DataFrame, fact_payments: DataFrame,
                fact_clicks: DataFrame) -> DataFrame:
    done, total = x.is_completed(), F.col("order_total")
    segment, status = F.col("customer_segment"), F.col("payment_status")
    buyers = fact_orders.select("user_id").distinct().join(dim_users.select("user_id", "customer_segment"), "user_id")
    parts = [
        _measures(fact_orders, total_revenue=x.fixed_sum(F.when(done, total)),
                  discounts=x.fixed_sum(F.when(done, F.col("discount_amount"))), total_orders=F.count_if(done),
                  cancelled=F.count_if(F.col("order_status") == "cancelled"), all_orders=F.count(F.lit(1)),
                  unique_customers=F.countDistinct("user_id"), units_sold=F.sum("item_count")),
        _measures(buyers, new_customers=F.count_if(segment == "new"),
                  returning_customers=F.count_if(segment.isin("returning", "vip"))),
        _measures(dim_users, avg_ltv=x.fixed_avg("ltv_score"),
                  high_churn_risk=F.count_if(F.col("churn_risk_score") >= 0.65)),
        _measures(fact_payments, paid=F.count_if(status == "success"), payments=F.count(F.lit(1)),
                  failed_payments=F.count_if(status.isin("failed", "declined")),
                  avg_processing_ms=x.int_avg("processing_time_ms", 2),
                  gmv=x.fixed_sum(F.when(status == "success", F.col("amount")))),
        _measures(fact_clicks, total_sessions=F.countDistinct("session_id"), bounces=F.count_if("is_bounce"),
                  views=F.count(F.lit(1)), avg_time_on_page=x.int_avg("time_on_page_seconds", 2)),
    ]
    names = ["total_revenue", "discounts", "total_orders", "cancelled", "all_orders", "unique_customers", "units_sold",
             "new_customers", "returning_customers", "avg_ltv", "high_churn_risk", "paid", "payments",
             "failed_payments", "avg_processing_ms", "gmv", "total_sessions", "bounces", "views", "avg_time_on_page"]

    def percent(a, b):
        return x.rnd(x.divide_or_zero(F.col(a) * 100, b), 2)

    return _one_row(parts, names).select(
        "total_revenue", x.rnd(F.col("total_revenue") - F.col("discounts"), 2).alias("net_revenue"), "total_orders",
        x.rnd(x.divide_or_zero("total_revenue", "total_orders"), 2).alias("aov"),
        percent("cancelled", "all_orders").alias("cancel_rate_pct"), "unique_customers", "new_customers",
        "returning_customers", "avg_ltv", "high_churn_risk", percent("paid", "payments").alias("payment_success_pct"),
        "failed_payments", "avg_processing_ms", "gmv", "total_sessions",
        percent("total_orders", "total_sessions").alias("conversion_rate_pct"),
        percent("bounces", "views").alias("bounce_rate_pct"), "avg_time_on_page", "units_sold")


def month_over_month(fact_orders: DataFrame, measure: str = "revenue") -> DataFrame:
    """Change against the calendar month before; 0 where that month has nothing."""
    value = {"revenue": _revenue(), "orders": F.count(F.lit(1)).cast("double")}[measure]
    monthly = completed(fact_orders).groupBy(F.trunc("order_timestamp", "month").alias("m")).agg(value.alias(measure))
    prior = monthly.select(F.add_months("m", 1).alias("m"), F.col(measure).alias("prior"))
    out = monthly.join(prior, "m", "left")
    return out.select(F.date_format("m", "yyyy-MM").alias("month"), measure, F.col("prior").alias(f"prior_{measure}"),
                      x.rnd(F.coalesce(F.try_divide((F.col(measure) - F.col("prior")) * 100, "prior"), F.lit(0.0)), 2)
                      .alias("mom_pct"))


def _daily(fact_orders: DataFrame) -> DataFrame:
    return completed(fact_orders).groupBy(F.to_date("order_timestamp").alias("order_date")).agg(
        _revenue().alias("revenue"))


def revenue_7d_avg(fact_orders: DataFrame, dim_time: DataFrame, days: int = 7) -> DataFrame:
    """Rolling mean over the last calendar days, for every day of the calendar; days without sales do not count."""
    daily = _daily(fact_orders)
    on = F.unix_date("order_date")
    w = Window.orderBy(on).rangeBetween(-(days - 1), 0)
    calendar = dim_time.select(F.col("full_date").cast("date").alias("order_date"))
    # one row per day of the calendar or with sales outside it: a small, bounded frame
    dense = daily.join(calendar, "order_date", "full_outer")
    mean = F.sum(x.units("revenue")).over(w) / 100.0 / F.nullif(F.count("revenue").over(w), F.lit(0))
    return dense.withColumn("revenue_7d_avg", x.rnd(mean, 2)).filter(F.col("revenue_7d_avg").isNotNull()).select(
        F.col("order_date").cast("string").alias("order_date"), "revenue", "revenue_7d_avg")


def top_category(fact_orders: DataFrame) -> DataFrame:
    return completed(fact_orders).groupBy("primary_category").agg(_revenue().alias("revenue")).orderBy(
        F.col("revenue").desc(), "primary_category").limit(1)


def revenue_rag(fact_orders: DataFrame, target: float = 100_000) -> DataFrame:
    return _daily(fact_orders).select(F.col("order_date").cast("string").alias("order_date"), "revenue",
                                      x.rag_status("revenue", target).alias("status"))


# ---- executive overview and sales ----------------------------------------------------------

def orders_by_status(fact_orders: DataFrame) -> DataFrame:
    return fact_orders.groupBy("order_status").agg(F.count(F.lit(1)).alias("orders"))


def revenue_by(fact_orders: DataFrame, *keys: str) -> DataFrame:
    return completed(fact_orders).groupBy(*keys).agg(_revenue().alias("revenue"), F.count(F.lit(1)).alias("orders"))


def revenue_trend_top_countries(fact_orders: DataFrame, n: int = 5) -> DataFrame:
    """Daily revenue of the ``n`` countries with the highest revenue."""
    best = revenue_by(fact_orders, "country").orderBy(F.col("revenue").desc(), "country").limit(n).select("country")
    return completed(fact_orders).join(best, "country", "left_semi").groupBy(
        F.to_date("order_timestamp").cast("string").alias("order_date"), "country").agg(_revenue().alias("revenue"))


def revenue_heatmap(fact_orders: DataFrame) -> DataFrame:
    """Revenue by weekday and hour, one column per hour."""
    hours = list(range(24))
    out = (completed(fact_orders).groupBy(F.date_format("order_timestamp", "EEEE").alias("day_name"))
           .pivot("hour", hours).agg(_revenue()))
    return out.select("day_name", *[F.coalesce(F.col(str(h)), F.lit(0.0)).alias(f"h{h:02d}") for h in hours])


def histogram(df: DataFrame, col: str, width: float, name: str) -> DataFrame:
    """Counts in buckets of fixed width, labelled by their lower edge."""
    step = F.lit(Decimal(str(width)))
    edge = F.floor(F.col(col).cast("decimal(28,8)") / step) * step  # as decimals, so that edges belong to their bucket
    return df.groupBy(edge.cast("double").alias("bucket")).agg(F.count(F.lit(1)).alias(name))


# ---- real-time page ------------------------------------------------------------------------

def live_order_feed(fact_orders: DataFrame, limit: int = 50) -> DataFrame:
    return fact_orders.select("order_id", "order_timestamp", "user_id", "country", "order_status", "order_total").orderBy(
        F.col("order_timestamp").desc(), "order_id").limit(limit)


def sessions_by(fact_clicks: DataFrame, key: str) -> DataFrame:
    return fact_clicks.groupBy(key).agg(F.countDistinct("session_id").alias("sessions"))


def events_per_minute(fact_clicks: DataFrame) -> DataFrame:
    return fact_clicks.groupBy(F.date_trunc("minute", "view_timestamp").alias("minute_bucket")).agg(
        F.count(F.lit(1)).alias("events"))


def last_hour(fact_orders: DataFrame, fact_clicks: DataFrame, as_of: dt.datetime, minutes: int = 60) -> DataFrame:
    """The three live cards: orders, revenue and active sessions of the last hour."""
    since = F.lit(as_of - dt.timedelta(minutes=minutes))
    parts = [_measures(completed(fact_orders).filter(F.col("order_timestamp") >= since),
                       orders=F.count(F.lit(1)), revenue=F.coalesce(_revenue(), F.lit(0.0))),
             _measures(fact_clicks.filter(F.col("view_timestamp") >= since),
                       active_sessions=F.countDistinct("session_id"))]
    return _one_row(parts, ["orders", "revenue", "active_sessions"])


# ---- behaviour -----------------------------------------------------------------------------

def bounce_by_page(fact_clicks: DataFrame) -> DataFrame:
    return fact_clicks.groupBy("page_type").agg(F.count(F.lit(1)).alias("views"), F.count_if("is_bounce").alias("bounces")
                                                ).withColumn("bounce_rate_pct", x.pct("bounces", "views"))


def time_by_page(fact_clicks: DataFrame) -> DataFrame:
    return fact_clicks.groupBy("page_type").agg(x.int_avg("time_on_page_seconds", 2).alias("avg_time_on_page"))


def page_flow(fact_clicks: DataFrame) -> DataFrame:
    return transitions(fact_clicks, "session_id", "page_type", ["event_id"], "view_timestamp").withColumnsRenamed(
        {"from_value": "from_page", "to_value": "to_page"})


def new_vs_returning(fact_orders: DataFrame) -> DataFrame:
    segment = F.col("customer_segment")
    kind = F.when(segment == "new", "new").when(segment.isin("returning", "vip"), "returning").otherwise("other")
    return fact_orders.groupBy(kind.alias("customer_type")).agg(F.countDistinct("user_id").alias("customers"))


# ---- products ------------------------------------------------------------------------------

def _item_revenue() -> Column:
    return F.sum(x.units("final_price") * F.col("quantity")) / 100.0


def best_products(orders: DataFrame, items: DataFrame | None = None, limit: int = 20,
                  products: DataFrame | None = None) -> DataFrame:
    rows = item_rows(orders.filter(x.is_completed()), items, ["order_id"])
    keys = ["product_id", "product_name", "category"]
    sums = by_product(rows, products, keys, {"_revenue": (F.sum(x.units("final_price") * F.col("quantity")), F.sum),
                                             "units": (F.sum("quantity"), F.sum)})
    return sums.select(*keys, (F.col("_revenue") / 100.0).alias("revenue"), "units").orderBy(
        F.col("revenue").desc(), "product_id").limit(limit)


def revenue_by_category(orders: DataFrame, items: DataFrame | None = None) -> DataFrame:
    rows = item_rows(orders.filter(x.is_completed()), items, ["order_id"])
    return rows.groupBy("category").agg(_item_revenue().alias("revenue"), F.sum("quantity").alias("units"))


def brand_performance(orders: DataFrame, items: DataFrame | None = None) -> DataFrame:
    rows = item_rows(orders.filter(x.is_completed()), items, ["order_id"])
    return rows.groupBy("brand").agg(
        _item_revenue().alias("revenue"), F.sum("quantity").alias("units"), F.countDistinct("order_id").alias("orders")
    ).withColumn("aov", x.ratio("revenue", "orders", 2))


def rank_over_time(orders: DataFrame, items: DataFrame | None = None, n: int = 5) -> DataFrame:
    """Monthly revenue rank of the ``n`` best products.

    A rank is one plus the number of products with more revenue in the month, so the other products are only counted
    against these few; no month is ever sorted as a whole.
    """
    if not 0 < n <= 1000:  # n rows a month are broadcast
        raise ValueError(f"unsuitable number of products: {n}")
    rows = item_rows(orders.filter(x.is_completed()), items, ["order_id", "year", "month"])
    monthly = rows.groupBy("product_id", "year", "month").agg(_item_revenue().alias("revenue"))
    best = (monthly.groupBy("product_id").agg(x.fixed_sum("revenue").alias("total"))
            .orderBy(F.col("total").desc(), "product_id").limit(n).select("product_id"))
    mine = monthly.join(best, "product_id", "left_semi")
    theirs = monthly.select("year", "month", F.col("revenue").alias("other"))
    # broadcast: at most n rows per calendar month
    ranked = theirs.join(F.broadcast(mine), ["year", "month"]).groupBy("product_id", "year", "month").agg(
        F.max("revenue").alias("revenue"), (F.count_if(F.col("other") > F.col("revenue")) + 1).alias("revenue_rank"))
    return ranked


def category_mix(orders: DataFrame, items: DataFrame | None = None) -> DataFrame:
    """Share of each category in a country's item revenue."""
    rows = item_rows(orders.filter(x.is_completed()), items, ["order_id", "country"])
    out = rows.groupBy("country", "category").agg(_item_revenue().alias("revenue"))
    whole = F.sum(x.units("revenue")).over(Window.partitionBy("country")) / 100.0
    return out.withColumn("share_pct", x.pct("revenue", whole))


# ---- funnel --------------------------------------------------------------------------------

def funnel_stages(clicks: DataFrame, carts: DataFrame, orders: DataFrame, payments: DataFrame) -> DataFrame:
    """Distinct sessions per stage: visited, added to cart, ordered, paid."""
    stages = [("sessions", clicks), ("cart_adds", carts.filter(F.col("action") == "item_added")), ("orders", orders),
              ("paid", payments.filter(F.col("payment_status") == "success"))]
    parts = [df.agg(F.countDistinct("session_id").alias("sessions")).select(
        F.lit(i + 1).alias("stage_no"), F.lit(name).alias("stage"), "sessions") for i, (name, df) in enumerate(stages)]
    rows = reduce(DataFrame.unionByName, parts)
    first = F.max(F.when(F.col("stage_no") == 1, F.col("sessions"))).over(Window.partitionBy())
    return rows.withColumn("of_sessions_pct", x.pct("sessions", first))


def conversion_by(clicks: DataFrame, orders: DataFrame, key: str, null_safe: bool = False) -> DataFrame:
    sessions = clicks.groupBy(key).agg(F.countDistinct("session_id").alias("sessions"))
    bought = orders.filter(x.is_completed()).groupBy(key).agg(F.countDistinct("session_id").alias("order_sessions"))
    out = join_on(sessions, bought, [key], "left", null_safe).fillna(0, ["order_sessions"])
    return out.withColumn("conversion_rate_pct", x.pct("order_sessions", "sessions"))


def abandonment_trend(carts: DataFrame, orders: DataFrame) -> DataFrame:
    rows = lake.cart_sessions(carts, None).withColumn("day", F.to_date("last_activity").cast("string"))
    bought = orders.select("session_id").distinct().withColumn("converted", F.lit(1))
    out = rows.join(bought, "session_id", "left").groupBy("day").agg(
        F.count("session_id").alias("cart_sessions"), F.count("converted").alias("converted_sessions"))
    gone = F.col("cart_sessions") - F.col("converted_sessions")
    return out.withColumn("abandonment_rate_pct", x.pct(gone, "cart_sessions"))
