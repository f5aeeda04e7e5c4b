"""Row-level building blocks: latest-per-key, null filling, slicing, row security, transitions."""

from __future__ import annotations

import datetime as dt
from collections.abc import Collection, Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def deduplicate(df: DataFrame, keys: Sequence[str], order_col: str, tie_breakers: Sequence[str] = ()) -> DataFrame:
    """Keep the latest row per key.

    The ``row_number() = 1`` filter lets Spark cut every map task's output to one row per key before the shuffle
    (WindowGroupLimit), so a key that holds a large share of the rows does not land on one task.
    """
    order = [F.col(c).desc_nulls_last() for c in (order_col, *tie_breakers)]
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Keep the earliest row per key (first-wins)."""
    w = Window.partitionBy(*keys).orderBy(*[F.col(c).asc_nulls_last() for c in order])
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def standardize_nulls(df: DataFrame, columns: Iterable[str], fill: str = "UNKNOWN") -> DataFrame:
    """Null or empty text becomes ``fill``; absent columns are skipped."""
    return df.withColumns({c: F.when(F.col(c).isNull() | (F.col(c) == ""), F.lit(fill)).otherwise(F.col(c))
                           for c in columns if c in df.columns})


Days = dt.date | Collection[dt.date | None] | None


def on_day(df: DataFrame, day: Days) -> DataFrame:
    """Partition filter on year/month/day: one day or several; ``None`` keeps every day (full run). ``None`` among several
    days stands for the rows without a day."""
    if day is None:
        return df
    if isinstance(day, dt.date):
        return df.filter((F.col("year") == day.year) & (F.col("month") == day.month) & (F.col("day") == day.day))
    wanted = F.make_date("year", "month", "day").isin([d for d in day if d is not None])
    return df.filter(wanted | F.col("year").isNull() if None in day else wanted)


def in_month(df: DataFrame, day: Days) -> DataFrame:
    if day is None:
        return df
    if isinstance(day, dt.date):
        return df.filter((F.col("year") == day.year) & (F.col("month") == day.month))
    wanted = (F.col("year") * 12 + F.col("month")).isin(sorted({d.year * 12 + d.month for d in day if d is not None}))
    return df.filter(wanted | F.col("year").isNull() if None in day else wanted)


def days_back(df: DataFrame, as_of: dt.date, days: int, date_col: str = "event_timestamp") -> DataFrame:
    """Rows of the last ``days`` days, with a partition predicate that pruning can use next to the exact one."""
    start = as_of - dt.timedelta(days=days)
    out = df.filter(F.col(date_col) >= F.lit(dt.datetime(start.year, start.month, start.day)))
    if {"year", "month", "day"} <= set(df.columns):
        months = sorted({((start + dt.timedelta(n)).year, (start + dt.timedelta(n)).month) for n in range(days + 1)})
        keep = F.lit(False)
        for y, m in months:
            keep = keep | ((F.col("year") == y) & (F.col("month") == m))
        out = out.filter(keep)
    return out


def slice_rows(df: DataFrame, since: dt.datetime | None = None, until: dt.datetime | None = None,
               ts_col: str = "event_timestamp", **members: str | Sequence[str]) -> DataFrame:
    """Dashboard slicers: a time range plus ``column=value`` or ``column=[values]`` filters."""
    if since is not None:
        df = df.filter(F.col(ts_col) >= F.lit(since))
    if until is not None:
        df = df.filter(F.col(ts_col) < F.lit(until))
    for name, wanted in members.items():
        df = df.filter(F.col(name).isin([wanted] if isinstance(wanted, str) else list(wanted)))
    return df


def visible_rows(df: DataFrame, mapping: DataFrame, principal: str, column: str = "country") -> DataFrame:
    """Row-level security: rows whose country the principal is mapped to in a (principal, country) table."""
    allowed = mapping.filter(F.col("principal") == principal).select(F.col("country").alias(column))
    return df.join(allowed, column, "left_semi")


def null_safe_on(left: DataFrame, right: DataFrame, keys: Sequence[str], null_safe: bool = True) -> Column:
    cond = F.lit(True)
    for k in keys:
        cond = cond & (left[k].eqNullSafe(right[k]) if null_safe else (left[k] == right[k]))
    return cond


def join_on(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left",
            null_safe: bool = False) -> DataFrame:
    """Equi-join that keeps the left keys once; optionally null keys match each other."""
    if not null_safe:
        return left.join(right, list(keys), how)
    right = right.select(*[F.col(c).alias(f"_r_{c}") if c in keys else F.col(c) for c in right.columns])
    cond = F.lit(True)
    for k in keys:
        cond = cond & left[k].eqNullSafe(right[f"_r_{k}"])
    return left.join(right, cond, how).drop(*[f"_r_{k}" for k in keys])


def transitions(df: DataFrame, session: str, value: str, order: Sequence[str], ts: str,
                bucket_minutes: int = 60) -> DataFrame:
    """Counts of consecutive (value, next value) pairs within a session.

    A session may be arbitrarily long, so ``lead`` runs per (session, time bucket). The one pair that crosses from a
    bucket to the session's next one comes from the buckets' first and last values, which a plain aggregate gives.
    """
    b = F.window(F.col(ts), f"{bucket_minutes} minutes").getField("start")
    rows = df.select(session, *[F.col(c) for c in dict.fromkeys([value, ts, *order]) if c != session])
    rows = rows.withColumn("_b", b)
    key = F.struct(*[F.col(c) for c in (ts, *order)])

    inner_w = Window.partitionBy(session, "_b").orderBy(ts, *order)
    inner = (rows.withColumn("next", F.lead(value).over(inner_w))
             .withColumn("has_next", F.lead(F.lit(1)).over(inner_w)).filter("has_next = 1")
             .groupBy(F.col(value).alias("from_value"), F.col("next").alias("to_value"))
             .agg(F.count(F.lit(1)).alias("n")))

    edges = rows.groupBy(session, "_b").agg(F.min_by(value, key).alias("first"), F.max_by(value, key).alias("last"))
    edge_w = Window.partitionBy(session).orderBy("_b")
    crossing = (edges.withColumn("next", F.lead("first").over(edge_w))
                .withColumn("has_next", F.lead(F.lit(1)).over(edge_w)).filter("has_next = 1")
                .groupBy(F.col("last").alias("from_value"), F.col("next").alias("to_value"))
                .agg(F.count(F.lit(1)).alias("n")))
    return inner.unionByName(crossing).groupBy("from_value", "to_value").agg(F.sum("n").alias("transitions"))
