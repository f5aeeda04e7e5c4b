"""Every query by name, over a data folder: ``QUERIES[name](spark, folder) -> DataFrame``."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstream.operators import dq, gold, merge, rollups, rows, silver
from tillstream.plans import dashboards, lake, views
from tillstream.sources import payloads as pl
from tillstream.sources import retail_tables as rt
from tillstream.streaming import ingest, windows

# "Now" for the event tables and for the order tables
AS_OF = dt.datetime(2024, 1, 30, 23, 59, 59)
ORDERS_AS_OF = dt.datetime(2001, 8, 2)
# earlier loads of the merge queries
ORDERS_LOADED = dt.datetime(2001, 6, 1)
EVENTS_LOADED = dt.datetime(2024, 1, 20)
USERS_LOADED = dt.datetime(2000, 1, 1)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


# ---- frames the queries start from ---------------------------------------------------------

def _fact_orders(spark, folder, with_items=True):
    orders = rt.silver_orders(spark, folder, with_items)
    if not with_items:
        orders = orders.withColumns({"item_count": F.lit(None).cast("int"), "distinct_products": F.lit(None).cast("long"),
                                     "primary_category": F.lit(None).cast("string")})
    return gold.fact_orders(orders)


def _fact_orders_ev(spark, folder):
    return gold.fact_orders(rt.silver_orders_ev(spark, folder))


def _fact_clicks(spark, folder):
    return gold.fact_clickstream(rt.silver_clickstream(spark, folder))


def _fact_payments(spark, folder):
    return gold.fact_payments(rt.silver_payments(spark, folder))


def _calendar(spark):
    return gold.dim_time(spark, dt.date(1995, 1, 1), dt.date(2027, 12, 31))


def _sales(spark, folder, with_customer=False):
    """Deduplicated orders for item queries, which need neither the item rollup nor (mostly) the customer."""
    return rt.silver_orders(spark, folder, with_items=False, with_customer=with_customer)


def _dates_as_text(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("string") for c in cols})


# ---- silver --------------------------------------------------------------------------------

@query
def silver_orders(spark, folder):
    return rt.silver_orders(spark, folder)


@query
def silver_orders_ev(spark, folder):
    return rt.silver_orders_ev(spark, folder).drop("items", "e")


@query
def silver_payments(spark, folder):
    return rt.silver_payments(spark, folder).drop("e")


@query
def silver_clickstream(spark, folder):
    return rt.silver_clickstream(spark, folder).drop("e")


@query
def silver_carts(spark, folder):
    return rt.silver_carts(spark, folder).drop("e")


@query
def silver_variants(spark, folder):
    """The other policies: payments without an order id kept, time on page capped, carts needing only an event id."""
    p = silver.transform_payments(rt.raw_payments(spark, folder), require_order_id=False).agg(
        F.count(F.lit(1)).alias("n"), F.count("order_id").alias("x"))
    c = silver.transform_clickstream(rt.raw_clickstream(spark, folder), over_limit="cap").agg(
        F.count(F.lit(1)).alias("n"), F.sum("time_on_page_seconds").alias("x"))
    k = silver.transform_carts(rt.raw_carts(spark, folder), event_id_only=True).agg(
        F.count(F.lit(1)).alias("n"), F.count_if("is_abandonment").alias("x"))
    parts = [df.select(F.lit(name).alias("variant"), "n", "x") for name, df in
             [("payments", p), ("clickstream", c), ("carts", k)]]
    return reduce(DataFrame.unionByName, parts)


# ---- gold ----------------------------------------------------------------------------------

@query
def fact_orders(spark, folder):
    return _fact_orders(spark, folder)


@query
def fact_orders_ev(spark, folder):
    return _fact_orders_ev(spark, folder)


@query
def fact_payments(spark, folder):
    return _fact_payments(spark, folder)


@query
def fact_clickstream(spark, folder):
    return _fact_clicks(spark, folder)


@query
def dim_users(spark, folder):
    return gold.dim_users(rt.silver_orders_ev(spark, folder), rt.silver_clickstream(spark, folder))


@query
def dim_products(spark, folder):
    return gold.dim_products(_sales(spark, folder), rt.order_lines(spark, folder), products=rt.products(spark, folder))


@query
def dim_products_ev(spark, folder):
    return gold.dim_products(rt.silver_orders_ev(spark, folder))


# ---- the same from kept state: a first load, whose last days are then made anew ----------------

STATE_CUT = dt.date(2024, 1, 16)


def _kept(rule, final, first):
    """Totals of a first load that take the days after a cut as they are in the end; keys that lost an extreme are made anew."""
    late = F.make_date("year", "month", "day") >= F.lit(STATE_CUT)
    done, partials = rule.partials(first), rule.partials(final)
    applied = rule.applied(rule.totals(done), done.where(late), partials.where(late))
    return rule.repaired(applied, lambda: partials)


def _first_orders(spark, folder):
    """What a first load held: of the orders behind the cut every third is missing, every tenth is from an hour later."""
    e, late = F.col("e"), F.col("event_timestamp") >= F.lit(STATE_CUT)
    moved = F.col("event_timestamp") + F.expr("interval 1 hour")
    return rt.silver_orders_ev(spark, folder).where(~late | (e % 3 != 0)).withColumn(
        "event_timestamp", F.when(late & (e % 10 == 0), moved).otherwise(F.col("event_timestamp")))


@query
def dim_users_by_state(spark, folder):
    clicks = rt.silver_clickstream(spark, folder)
    final = rollups.user_rows(rt.silver_orders_ev(spark, folder), clicks)
    return rollups.dim_users(_kept(rollups.USERS, final, rollups.user_rows(_first_orders(spark, folder), clicks)))


@query
def dim_products_by_state(spark, folder):
    """The first load had other prices, of which some were the lowest or highest of their product."""
    dearer = F.transform("items", lambda i: i.withField("unit_price", i["unit_price"] * F.when(F.col("e") % 2 == 0, 2).otherwise(0.5)))
    late = (F.col("event_timestamp") >= F.lit(STATE_CUT)) & (F.col("e") % 7 == 0)
    first = _first_orders(spark, folder).withColumn("items", F.when(late, dearer).otherwise(F.col("items")))
    final = rt.silver_orders_ev(spark, folder)
    return rollups.dim_products(_kept(rollups.PRODUCTS, rollups.product_rows(final), rollups.product_rows(first)))


@query
def product_performance_by_state(spark, folder):
    """Months made of daily partials."""
    return rollups.agg_product_performance(rollups.SALES.partials(rollups.sale_rows(rt.silver_orders_ev(spark, folder))))


@query
def order_value_quantiles(spark, folder):
    """Months of all orders, made of daily bucket counts."""
    days = rollups.ORDER_VALUES.partials(rollups.order_value_rows(rt.silver_orders(spark, folder, with_items=False)))
    return rollups.agg_order_values(days)


@query
def monthly_active_users(spark, folder):
    """Months made of daily sketches."""
    rows = rollups.active_rows(rt.silver_orders_ev(spark, folder), rt.silver_clickstream(spark, folder))
    return rollups.agg_active_users(rollups.ACTIVE.partials(rows))


@query
def dim_time(spark, folder):
    return gold.dim_time_of(rt.table(spark, folder, "orders"), "o_orderdate")


@query
def dim_devices(spark, folder):
    return gold.dim_devices(_sales(spark, folder))


@query
def daily_revenue(spark, folder):
    return gold.agg_daily_revenue(rt.silver_orders(spark, folder, with_items=False))


@query
def product_performance(spark, folder):
    return gold.agg_product_performance(_sales(spark, folder), rt.order_lines(spark, folder), products=rt.products(spark, folder))


@query
def funnel(spark, folder):
    return gold.agg_funnel(rt.silver_clickstream(spark, folder), rt.silver_carts(spark, folder),
                           rt.silver_orders_ev(spark, folder))


@query
def rpt_funnel(spark, folder):
    return _dates_as_text(gold.rpt_funnel(funnel(spark, folder)), "report_date")


@query
def funnel_null_safe(spark, folder):
    """The funnel with null countries matching each other. Clicks know no country where orders say UNKNOWN."""
    orders = rt.silver_orders_ev(spark, folder).withColumn("country", F.nullif("country", F.lit("UNKNOWN")))
    return gold.agg_funnel(rt.silver_clickstream(spark, folder), rt.silver_carts(spark, folder), orders, null_safe=True)


@query
def hourly_revenue(spark, folder):
    return gold.agg_hourly_revenue(rt.silver_orders(spark, folder, with_items=False))


# ---- lake queries --------------------------------------------------------------------------

@query
def top_products(spark, folder):
    return lake.top_products(rt.silver_orders_ev(spark, folder), AS_OF)


@query
def top_products_calendar(spark, folder):
    return lake.top_products(_sales(spark, folder), ORDERS_AS_OF, rt.order_lines(spark, folder), calendar_predicate=True,
                             products=rt.products(spark, folder))


@query
def conversion_by_channel(spark, folder):
    return lake.conversion_by_channel(rt.silver_clickstream(spark, folder), rt.silver_orders_ev(spark, folder), AS_OF)


@query
def hourly_revenue_trend(spark, folder):
    return lake.hourly_revenue_trend(rt.silver_orders_ev(spark, folder), AS_OF)


@query
def abandoned_carts(spark, folder):
    return lake.abandoned_carts(rt.silver_carts(spark, folder), rt.silver_orders_ev(spark, folder), AS_OF)


@query
def abandoned_carts_last_total(spark, folder):
    return lake.abandoned_carts(rt.silver_carts(spark, folder), rt.silver_orders_ev(spark, folder), AS_OF, last_total=True)


@query
def abandoned_cart_list(spark, folder):
    return lake.abandoned_cart_list(rt.silver_carts(spark, folder), rt.silver_orders_ev(spark, folder), AS_OF)


@query
def cohort_retention(spark, folder):
    return lake.cohort_retention(_sales(spark, folder))


@query
def cohort_retention_true(spark, folder):
    return lake.cohort_retention_true(_sales(spark, folder))


@query
def active_users(spark, folder):
    """All days of the event table; the 15-minute window of the function's default holds a handful of events."""
    return lake.active_users(rt.silver_clickstream(spark, folder), AS_OF, minutes=31 * 24 * 60)


@query
def aov_by_segment(spark, folder):
    return lake.aov_by_segment(rt.silver_orders(spark, folder), None)


@query
def aov_by_segment_approx(spark, folder):
    return lake.aov_by_segment(rt.silver_orders(spark, folder), None, exact=False)


@query
def payment_success(spark, folder):
    return lake.payment_success(rt.silver_payments(spark, folder), AS_OF)


@query
def search_performance(spark, folder):
    return lake.search_performance(rt.silver_clickstream(spark, folder), AS_OF)


@query
def dq_monitor(spark, folder):
    return lake.dq_monitor(rt.silver_orders(spark, folder, with_items=False), None, approximate=False)


@query
def dq_monitor_approx(spark, folder):
    return lake.dq_monitor(rt.silver_orders(spark, folder, with_items=False), None, run_ts=ORDERS_AS_OF)


# ---- warehouse views and reports -----------------------------------------------------------

@query
def orders_enriched(spark, folder):
    fact = _fact_orders(spark, folder)
    users = merge.user_metrics(fact, ORDERS_AS_OF.date())
    return views.orders_enriched(fact, users, gold.dim_devices(_sales(spark, folder)))


@query
def revenue_by_day(spark, folder):
    return views.revenue_by_day(_fact_orders(spark, folder))


@query
def revenue_delta_30d(spark, folder):
    return views.revenue_delta_30d(_fact_orders(spark, folder, with_items=False))


@query
def product_sales(spark, folder):
    return views.product_sales(_fact_orders_ev(spark, folder), gold.dim_products(rt.silver_orders_ev(spark, folder)))


@query
def conversion_funnel(spark, folder):
    return views.conversion_funnel(_fact_clicks(spark, folder), _fact_orders_ev(spark, folder))


@query
def payment_analytics(spark, folder):
    return views.payment_analytics(_fact_payments(spark, folder))


@query
def user_segments(spark, folder):
    return views.user_segments(merge.user_metrics(_fact_orders(spark, folder), ORDERS_AS_OF.date()))


@query
def hourly_activity(spark, folder):
    return views.hourly_activity(_fact_orders_ev(spark, folder), AS_OF)


@query
def pipeline_health(spark, folder):
    def loaded(df, ts):
        return df.select((F.col(ts) + F.expr("interval 15 minutes")).alias("loaded_at"))

    return views.pipeline_health({
        "fact_orders": loaded(_fact_orders_ev(spark, folder), "order_timestamp"),
        "fact_payments": loaded(_fact_payments(spark, folder), "payment_timestamp"),
        "fact_clickstream": loaded(_fact_clicks(spark, folder), "view_timestamp")}, AS_OF)


@query
def rpt_daily_revenue(spark, folder):
    return views.rpt_daily_revenue(_fact_orders(spark, folder, with_items=False))


@query
def rpt_product_performance(spark, folder):
    return views.rpt_product_performance(_fact_orders_ev(spark, folder),
                                         gold.dim_products(rt.silver_orders_ev(spark, folder)))


# ---- merges --------------------------------------------------------------------------------

def _loaded_orders(spark, folder):
    """What an earlier load left: first sends only, up to a day."""
    first = silver.transform_orders(rt.raw_orders(spark, folder, resend=False), rollup=rt.item_rollup(spark, folder))
    return gold.fact_orders(first).filter(F.col("order_timestamp") < F.lit(ORDERS_LOADED)).withColumn(
        "loaded_at", F.lit(ORDERS_LOADED))


_MERGED_ORDER = ["order_id", "order_status", "order_total", "country", "date_key", "primary_category", "loaded_at"]


@query
def merge_orders(spark, folder):
    return merge.merge_fact_orders(_loaded_orders(spark, folder), _fact_orders(spark, folder), ORDERS_AS_OF).select(
        *_MERGED_ORDER)


@query
def fact_changes(spark, folder):
    old = _loaded_orders(spark, folder).select("order_id", "order_status", "order_total", "country")
    new = _fact_orders(spark, folder, with_items=False).select("order_id", "order_status", "order_total", "country")
    return merge.changes(old, new, "order_id")


@query
def merge_payments(spark, folder):
    fact = _fact_payments(spark, folder)
    open_ones = F.col("payment_status").isin("failed", "declined")
    old = fact.filter(F.col("payment_timestamp") < F.lit(EVENTS_LOADED)).withColumns({
        "payment_status": F.when(open_ones, "pending").otherwise(F.col("payment_status")),
        "failure_reason": F.when(~open_ones, F.col("failure_reason")), "loaded_at": F.lit(EVENTS_LOADED)})
    return merge.merge_fact_payments(old, fact, AS_OF).select(
        "payment_id", "payment_status", "failure_reason", "amount", "loaded_at")


@query
def merge_clickstream(spark, folder):
    fact = _fact_clicks(spark, folder)
    old = fact.filter(F.col("view_timestamp") < F.lit(EVENTS_LOADED)).withColumn("loaded_at", F.lit(EVENTS_LOADED))
    new = fact.filter(F.col("view_timestamp") >= F.lit(EVENTS_LOADED - dt.timedelta(days=5)))
    return merge.merge_fact_clickstream(old, new, AS_OF).select("event_id", "session_id", "page_type", "loaded_at")


@query
def merge_dim_users(spark, folder):
    fact = _fact_orders(spark, folder)
    known = merge.user_metrics(fact.filter(F.col("order_timestamp") < F.lit(USERS_LOADED)), USERS_LOADED.date())
    stamp = F.lit(USERS_LOADED)
    old = known.select(*merge.DIM_USER_COLUMNS, stamp.alias("created_at"), stamp.alias("updated_at"))
    return _dates_as_text(merge.merge_dim_users(old, fact, ORDERS_AS_OF), "first_order_date", "last_order_date")


@query
def merge_dim_products(spark, folder):
    sales, lines, products = _sales(spark, folder), rt.order_lines(spark, folder), rt.products(spark, folder)
    early = sales.filter(F.col("event_timestamp") < F.lit(USERS_LOADED))
    stamp = F.lit(USERS_LOADED)
    old = gold.dim_products(early, lines, products=products).withColumnRenamed("dim_product_sk", "product_sk").withColumns(
        {"created_at": stamp, "updated_at": stamp})
    return merge.merge_dim_products(old, gold.dim_products(sales, lines, products=products), ORDERS_AS_OF)


# ---- dashboards ----------------------------------------------------------------------------

@query
def kpi_summary(spark, folder):
    fact = _fact_orders_ev(spark, folder)
    users = merge.user_metrics(fact, AS_OF.date())
    return dashboards.kpi_summary(fact, users, _fact_payments(spark, folder), _fact_clicks(spark, folder))


@query
def revenue_mom(spark, folder):
    return dashboards.month_over_month(_fact_orders(spark, folder, with_items=False), "revenue")


@query
def orders_mom(spark, folder):
    return dashboards.month_over_month(_fact_orders(spark, folder, with_items=False), "orders")


@query
def revenue_7d_avg(spark, folder):
    return dashboards.revenue_7d_avg(_fact_orders(spark, folder, with_items=False), _calendar(spark))


@query
def top_category(spark, folder):
    return dashboards.top_category(_fact_orders(spark, folder))


@query
def revenue_rag(spark, folder):
    return dashboards.revenue_rag(_fact_orders(spark, folder, with_items=False))


@query
def orders_by_status(spark, folder):
    return dashboards.orders_by_status(_fact_orders(spark, folder, with_items=False))


@query
def revenue_by_country(spark, folder):
    return dashboards.revenue_by(_fact_orders(spark, folder, with_items=False), "country")


@query
def revenue_by_payment_method(spark, folder):
    return dashboards.revenue_by(_fact_orders(spark, folder, with_items=False), "payment_method")


@query
def revenue_by_segment(spark, folder):
    return dashboards.revenue_by(_fact_orders(spark, folder, with_items=False), "customer_segment")


@query
def revenue_trend_top_countries(spark, folder):
    return dashboards.revenue_trend_top_countries(_fact_orders(spark, folder, with_items=False))


@query
def revenue_heatmap(spark, folder):
    return dashboards.revenue_heatmap(_fact_orders(spark, folder, with_items=False))


@query
def order_value_histogram(spark, folder):
    return dashboards.histogram(dashboards.completed(_fact_orders(spark, folder, with_items=False)), "order_total",
                                1000, "orders")


@query
def churn_histogram(spark, folder):
    users = merge.user_metrics(_fact_orders(spark, folder), ORDERS_AS_OF.date())
    return dashboards.histogram(users, "churn_risk_score", 0.1, "customers")


@query
def live_order_feed(spark, folder):
    return dashboards.live_order_feed(_fact_orders_ev(spark, folder))


@query
def sessions_by_page_type(spark, folder):
    return dashboards.sessions_by(_fact_clicks(spark, folder), "page_type")


@query
def sessions_by_device(spark, folder):
    return dashboards.sessions_by(_fact_clicks(spark, folder), "device_type")


@query
def events_per_minute(spark, folder):
    return dashboards.events_per_minute(_fact_clicks(spark, folder))


@query
def last_hour(spark, folder):
    return dashboards.last_hour(_fact_orders_ev(spark, folder), _fact_clicks(spark, folder), AS_OF)


@query
def bounce_by_page(spark, folder):
    return dashboards.bounce_by_page(_fact_clicks(spark, folder))


@query
def time_by_page(spark, folder):
    return dashboards.time_by_page(_fact_clicks(spark, folder))


@query
def page_flow(spark, folder):
    return dashboards.page_flow(_fact_clicks(spark, folder))


@query
def new_vs_returning(spark, folder):
    return dashboards.new_vs_returning(_fact_orders(spark, folder, with_items=False))


@query
def top_products_20(spark, folder):
    return dashboards.best_products(_sales(spark, folder), rt.order_lines(spark, folder), 20, rt.products(spark, folder))


@query
def top_products_10(spark, folder):
    return dashboards.best_products(rt.silver_orders_ev(spark, folder), None, 10)


@query
def revenue_by_category(spark, folder):
    return dashboards.revenue_by_category(_sales(spark, folder), rt.order_items(spark, folder))


@query
def brand_performance(spark, folder):
    return dashboards.brand_performance(_sales(spark, folder), rt.order_items(spark, folder))


@query
def rank_over_time(spark, folder):
    return dashboards.rank_over_time(_sales(spark, folder), rt.order_items(spark, folder))


@query
def category_mix(spark, folder):
    return dashboards.category_mix(_sales(spark, folder, with_customer=True), rt.order_items(spark, folder))


@query
def funnel_stages(spark, folder):
    return dashboards.funnel_stages(rt.silver_clickstream(spark, folder), rt.silver_carts(spark, folder),
                                    rt.silver_orders_ev(spark, folder), rt.silver_payments(spark, folder))


@query
def conversion_by_device(spark, folder):
    return dashboards.conversion_by(rt.silver_clickstream(spark, folder), rt.silver_orders_ev(spark, folder), "device_type")


@query
def conversion_by_utm(spark, folder):
    return dashboards.conversion_by(rt.silver_clickstream(spark, folder), rt.silver_orders_ev(spark, folder), "utm_source")


@query
def conversion_by_utm_null_safe(spark, folder):
    return dashboards.conversion_by(rt.silver_clickstream(spark, folder), rt.silver_orders_ev(spark, folder),
                                    "utm_source", null_safe=True)


@query
def abandonment_by_country(spark, folder):
    return lake.abandoned_carts(rt.silver_carts(spark, folder), rt.silver_orders_ev(spark, folder), AS_OF, by=("country",))


@query
def abandonment_trend(spark, folder):
    return dashboards.abandonment_trend(rt.silver_carts(spark, folder), rt.silver_orders_ev(spark, folder))


@query
def lost_revenue(spark, folder):
    return lake.abandoned_carts(rt.silver_carts(spark, folder), rt.silver_orders_ev(spark, folder), AS_OF, by=()).select(
        "abandoned_carts", "lost_revenue")


@query
def sliced_revenue(spark, folder):
    """The global slicers: two years, two devices, one segment."""
    fact = rows.slice_rows(_fact_orders(spark, folder, with_items=False), dt.datetime(1999, 1, 1), dt.datetime(2001, 1, 1),
                           "order_timestamp", device_type=["mobile", "tablet"], customer_segment="vip")
    return dashboards.revenue_by(fact, "country", "device_type")


@query
def visible_orders(spark, folder):
    """Row-level security: the manager of a region sees the orders of its nations."""
    n, r = rt.table(spark, folder, "nation"), rt.table(spark, folder, "region")
    mapping = n.join(r, n.n_regionkey == r.r_regionkey).select(
        F.concat(F.lit("manager-"), F.lower("r_name")).alias("principal"), F.col("n_name").alias("country"))
    mine = rows.visible_rows(_fact_orders(spark, folder, with_items=False), mapping, "manager-asia")
    return dashboards.revenue_by(mine, "country")


# ---- data quality --------------------------------------------------------------------------

def _parsed(spark, folder, stream):
    """Typed records of a stream before validation, without the undecodable ones."""
    return ingest.decode(pl.payloads(spark, folder, stream, copies=False), stream).filter("fields is not null").select("rec.*", "arrival_ts")


@query
def dq_orders(spark, folder):
    return dq.validate(_parsed(spark, folder, "orders"), "orders", AS_OF).select(*dq.REPORT)


@query
def dq_payments(spark, folder):
    return dq.validate(_parsed(spark, folder, "payments"), "payments", AS_OF).select(*dq.REPORT)


@query
def dq_clickstream(spark, folder):
    return dq.validate(_parsed(spark, folder, "clickstream"), "clickstream", AS_OF).select(*dq.REPORT)


@query
def dq_summary(spark, folder):
    return reduce(DataFrame.unionByName, [dq.summary(_parsed(spark, folder, e), e, AS_OF) for e in dq.CHECK_SETS])


@query
def dq_metrics(spark, folder):
    return dq.metrics(dq_summary(spark, folder), AS_OF)


@query
def dq_alerts(spark, folder):
    profiles = [dq.profile(_parsed(spark, folder, e), e, AS_OF) for e in dq.CHECK_SETS]
    return dq.profile_alerts(reduce(DataFrame.unionByName, profiles), AS_OF, above_pct=1.0)


@query
def dq_check_failures(spark, folder):
    return reduce(DataFrame.unionByName, [dq.check_failures(_parsed(spark, folder, e), e, AS_OF) for e in dq.CHECK_SETS])


@query
def dq_category_failures(spark, folder):
    return reduce(DataFrame.unionByName,
                  [dq.check_failures(_parsed(spark, folder, e), e, AS_OF, by="category") for e in dq.CHECK_SETS])


@query
def dq_top_failures(spark, folder):
    return dq.top_failures(_parsed(spark, folder, "orders"), "orders", AS_OF)


# ---- stream batches ------------------------------------------------------------------------

def _outcome(spark, folder, stream):
    return ingest.process(ingest.classify(pl.payloads(spark, folder, stream), stream), stream)


@query
def ingest_orders(spark, folder):
    return _outcome(spark, folder, "orders").accepted.select(
        "event_id", "order_id", "user_id", "total_amount", "item_count", "average_item_value", "day_of_week", "is_weekend",
        "year", "month", "day", "hour", "environment")


@query
def ingest_payments(spark, folder):
    return _outcome(spark, folder, "payments").accepted.select(
        "event_id", "payment_id", "amount", "payment_status", "is_fraud_flagged",
        F.array_join("fraud_signals", ",").alias("fraud_signals"), "year", "month", "day", "hour")


@query
def ingest_clickstream(spark, folder):
    return _outcome(spark, folder, "clickstream").accepted.select(
        "event_id", "user_id", "page_type", "year", "month", "day", "hour", "ingestion_timestamp")


@query
def ingest_carts(spark, folder):
    return _outcome(spark, folder, "carts").accepted.select(
        "event_id", "user_id", "action", "cart_value", "year", "month", "day", "hour", "ingestion_timestamp")


@query
def ingest_dead_letters(spark, folder):
    parts = [_outcome(spark, folder, s).failed for s in ingest.ENTITIES]
    return reduce(DataFrame.unionByName, parts).groupBy("stream", "reason").agg(F.count(F.lit(1)).alias("records"))


@query
def batch_summary(spark, folder):
    return reduce(DataFrame.unionByName, [ingest.batch_summary(_outcome(spark, folder, s), s) for s in ingest.ENTITIES])


@query
def failure_alerts(spark, folder):
    return ingest.failure_alerts(batch_summary(spark, folder), AS_OF)


@query
def fraud_signals(spark, folder):
    accepted = _outcome(spark, folder, "payments").accepted
    return accepted.select(F.explode("fraud_signals").alias("signal"), "amount").groupBy("signal").agg(
        F.count(F.lit(1)).alias("payments"))


@query
def cart_abandonment(spark, folder):
    return ingest.cart_abandonment(_outcome(spark, folder, "carts").accepted)


@query
def dlq_triage(spark, folder):
    return ingest.triage_counts(pl.dead_letter_rows(spark, folder))


@query
def dlq_redrive(spark, folder):
    letters = pl.dead_letter_rows(spark, folder)
    again = ingest.decode(ingest.redrive(letters, "orders"), "orders")
    return again.select(F.col("fields")["event_id"].alias("event_id"), "arrival_ts")


@query
def ingestion_lag(spark, folder):
    clicks = _outcome(spark, folder, "clickstream").accepted
    return windows.ingestion_lag(clicks.withColumn("event_timestamp", F.try_to_timestamp("event_timestamp")), "1 day", exact=True)


@query
def ingestion_lag_approx(spark, folder):
    clicks = _outcome(spark, folder, "clickstream").accepted
    return windows.ingestion_lag(clicks.withColumn("event_timestamp", F.try_to_timestamp("event_timestamp")), "1 day")


@query
def ingestion_lag_merged(spark, folder):
    """Days made of five-minute histograms."""
    clicks = _outcome(spark, folder, "clickstream").accepted
    stamped = clicks.withColumn("event_timestamp", F.try_to_timestamp("event_timestamp"))
    return windows.lag_quantiles(windows.lag_histogram(stamped))


@query
def dq_pass_rate_series(spark, folder):
    """By arrival, when records are checked: those without a readable event time count too."""
    return windows.pass_rate_series(dq.validate(_parsed(spark, folder, "orders"), "orders", AS_OF), "orders", "arrival_ts")
