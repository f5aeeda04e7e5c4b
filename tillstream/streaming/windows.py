"""Windowed series. The same functions serve a batch and, with ``watermark`` set, a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstream.functions import exprs as x
from tillstream.operators import sketches
from tillstream.operators.ranking import exact_percentiles


def _late(df: DataFrame, ts: str, watermark: str | None) -> DataFrame:
    return df.withWatermark(ts, watermark) if watermark else df


def active_users_series(clicks: DataFrame, watermark: str | None = None) -> DataFrame:
    """Users and sessions per minute, device and page. Distinct counts are sketches, which a stream can keep."""
    return _late(clicks, "event_timestamp", watermark).groupBy(
        F.window("event_timestamp", "1 minute"), "device_type", "page_type").agg(
        F.approx_count_distinct("session_id").alias("active_sessions"),
        F.approx_count_distinct("user_id").alias("active_users"), F.count("event_id").alias("page_views"),
        F.count_if("is_bounce").alias("bounces")).select(
        F.col("window.start").alias("minute_bucket"), "device_type", "page_type", "active_sessions", "active_users",
        "page_views", "bounces")


def events_per_minute(events: DataFrame, ts: str = "event_timestamp", watermark: str | None = None) -> DataFrame:
    return _late(events, ts, watermark).groupBy(F.window(ts, "1 minute")).agg(F.count(F.lit(1)).alias("events")).select(
        F.col("window.start").alias("minute_bucket"), "events")


def revenue_per_window(orders: DataFrame, ts: str = "event_timestamp", size: str = "1 hour",
                       watermark: str | None = None) -> DataFrame:
    done = _late(orders, ts, watermark).filter(x.is_completed())
    return done.groupBy(F.window(ts, size)).agg(
        F.count(F.lit(1)).alias("orders"), x.fixed_sum("total_amount").alias("revenue")).select(
        F.col("window.start").alias("window_start"), "orders", "revenue")


def pass_rate_series(validated: DataFrame, entity: str, ts: str, size: str = "5 minutes",
                     watermark: str | None = None) -> DataFrame:
    """Pass rate, mean score and critical failures of validated records per window."""
    return _late(validated, ts, watermark).groupBy(F.window(ts, size)).agg(
        F.count(F.lit(1)).alias("records"), F.count_if(F.col("dq_status") == "PASS").alias("passed"),
        F.count_if("dq_critical").alias("critical_failures"), x.fixed_avg("dq_score", 4, 4).alias("avg_quality_score")
    ).select(F.lit(entity).alias("entity"), F.col("window.start").alias("window_start"), "records",
             x.pct("passed", "records").alias("pass_rate_pct"), "critical_failures", "avg_quality_score")


def _lag_us(df: DataFrame) -> DataFrame:
    return df.withColumn("lag_us", F.unix_micros("ingestion_timestamp") - F.unix_micros("event_timestamp"))


def lag_histogram(accepted: DataFrame, size: str = "5 minutes", watermark: str | None = None) -> DataFrame:
    """Counts of lag buckets by window of the event time: what a stream keeps and stores. Windows merge into longer ones."""
    rows = _lag_us(_late(accepted, "event_timestamp", watermark))
    out = sketches.histogram(rows, [F.window("event_timestamp", size)], F.col("lag_us"))
    return out.select(F.col("window.start").alias("window_start"), "bucket", "n")


def lag_quantiles(histogram: DataFrame, unit: str = "day") -> DataFrame:
    """Median and 95th percentile of the lag in seconds for each hour, day, month, ... from windows' histograms."""
    longer = histogram.withColumn("window_start", F.date_trunc(unit, "window_start"))
    out = sketches.quantiles(longer, ["window_start"], {"lag_p50": 0.5, "lag_p95": 0.95}, scale=6)
    return out.withColumnRenamed("n", "records")


def ingestion_lag(accepted: DataFrame, size: str = "5 minutes", watermark: str | None = None,
                  exact: bool = False) -> DataFrame:
    """Seconds from event to arrival per window of the event time: percentiles and maximum.

    Percentiles are sketches, which a stream can keep, or (``exact``, batch only) interpolated between the lags in microseconds.
    """
    lag = F.unix_micros("ingestion_timestamp") - F.unix_micros("event_timestamp")
    rows = _late(accepted, "event_timestamp", watermark).withColumn("lag", (lag / 1_000_000).cast("double"))
    rows = rows.filter("lag is not null")
    if exact:
        rows = rows.select(F.window("event_timestamp", size).getField("start").alias("window_start"), "lag")
        totals = rows.groupBy("window_start").agg(F.count(F.lit(1)).alias("records"), F.max("lag").alias("lag_max"))
        p = exact_percentiles(rows, ["window_start"], F.col("lag"), {"lag_p50": 0.5, "lag_p95": 0.95}, scale=6)
        return totals.join(p, "window_start").select("window_start", "records", x.rnd("lag_p50", 6).alias("lag_p50"),
                                                     x.rnd("lag_p95", 6).alias("lag_p95"), "lag_max")
    p = F.percentile_approx("lag", [0.5, 0.95], 1000)
    return rows.groupBy(F.window("event_timestamp", size)).agg(
        F.count(F.lit(1)).alias("records"), p[0].alias("lag_p50"), p[1].alias("lag_p95"), F.max("lag").alias("lag_max")
    ).select(F.col("window.start").alias("window_start"), "records", "lag_p50", "lag_p95", "lag_max")
