"""The batch jobs: bronze -> silver, silver -> gold, gold -> warehouse."""

from __future__ import annotations

import datetime as dt
import os
from collections.abc import Iterable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstream.functions.schemas import WAREHOUSE, conform
from tillstream.operators import gold, merge, rows, silver
from tillstream.operators.rollups import KEPT
from tillstream.plans import rollups, views
from tillstream.sources import lake, snapshots, stage


def bronze_to_silver(spark: SparkSession, root: str, day: dt.date | None, run_ts: dt.datetime,
                     entities: Iterable[str] = tuple(silver.TRANSFORMS)) -> dict[str, set[dt.date | None]]:
    """The arrivals of one day (or all there are). Returns the event days that changed, of each entity with arrivals.

    A record has one row, that of its latest version, on that version's event day; so days may be loaded in any order, and
    again. A daily run opens only its own arrival folders. The event days it rewrites are those of its records and those
    that hold other versions of them, which an index of the keys tells; a day whose last row moved away goes. Each
    entity's new version is committed at once: until then, and if the run dies, readers see the old one.
    """
    changed = {}
    for entity in entities:
        raw = lake.read_bronze(spark, root, entity, day)
        if raw.isEmpty():  # looks at the first records only
            continue
        set_aside(raw, root, entity, day)
        new = silver.TRANSFORMS[entity](raw.drop("_corrupt_record", *lake.ARRIVAL, "run_id", "batch_id"), run_ts)
        key, _ = silver.KEYS[entity]
        held = None if day is None else lake.known_days(spark, root, entity, new.select(key), key)
        if held is None:
            changed[entity] = lake.write_silver(new, root, entity, None, key)
            continue
        new = new.persist(StorageLevel.MEMORY_AND_DISK)  # one day's arrivals
        try:
            days = held | {lake.as_day(*r) for r in new.select(*lake.DAY).distinct().collect()}  # a row a day, not a row a record
            both = lake.read_silver(spark, root, entity, days).unionByName(new, allowMissingColumns=True)
            lake.write_silver(silver.latest(both, entity), root, entity, days, key, new.select(key))
            changed[entity] = days
        finally:
            new.unpersist()
    return changed


def set_aside(raw: DataFrame, root: str, entity: str, day: dt.date | None) -> int:
    """Unreadable lines of bronze, with what could be read of them, kept by arrival day in ``corrupt/<entity>``; returns how
    many there are. A run replaces what earlier runs found on its day."""
    cols = lake.ARRIVAL[:3]
    fields = [c for c in raw.columns if c not in (*lake.ARRIVAL, "_corrupt_record", "run_id", "batch_id")]
    bad = raw.where("_corrupt_record is not null").select(
        F.col("_corrupt_record").alias("line"), F.to_json(F.struct(*fields)).alias("readable"), *cols, "run_id", "batch_id")
    part = None if day is None else [snapshots.part_name(dict(zip(cols, (day.year, day.month, day.day))))]
    path = os.path.join(root, "corrupt", entity)
    done = snapshots.replace(raw.sparkSession, path, bad, cols, part)
    return snapshots.read(raw.sparkSession, path, part, done).count()  # from the footers


def silver_to_gold(spark: SparkSession, root: str, day: rows.Days, run_ts: dt.datetime) -> None:
    """All facts, dimensions and KPI tables of a day, of several days (what ``bronze_to_silver`` changed) or of every day.
    The shared inputs are read once. Tables over all days are kept as state, which takes what silver has written since."""
    orders, clicks, carts, payments = (lake.read_silver(spark, root, e) for e in ("orders", "clickstream", "carts", "payments"))
    today = gold.on_day(orders, day).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        by_day = lake.DAY
        lake.write_gold(gold.fact_orders(today, None, run_ts), root, "fact_orders", by_day, day)
        lake.write_gold(gold.agg_daily_revenue(today, None, run_ts), root, "agg_daily_revenue", by_day, day)
        lake.write_gold(gold.agg_hourly_revenue(today, None, run_ts), root, "agg_hourly_revenue", by_day, day)
        funnel = gold.agg_funnel(gold.on_day(clicks, day), gold.on_day(carts, day), today, None, run_ts)
        lake.write_gold(funnel, root, "agg_funnel", by_day, day)
    finally:
        today.unpersist()
    lake.write_gold(gold.fact_payments(payments, day, run_ts), root, "fact_payments", by_day, day)
    lake.write_gold(gold.fact_clickstream(clicks, day, run_ts), root, "fact_clickstream", by_day, day)
    lake.write_gold(gold.dim_time(spark), root, "dim_time")
    for name in KEPT:
        rollups.refresh(spark, root, name, run_ts)


def daily(spark: SparkSession, root: str, day: dt.date, run_ts: dt.datetime) -> set[dt.date | None]:
    """One arrival day through silver into gold; returns the event days that changed."""
    changed = set().union(*bronze_to_silver(spark, root, day, run_ts).values())
    if changed:
        silver_to_gold(spark, root, changed, run_ts)
    return changed


def load_fact(spark: SparkSession, root: str, name: str, run_ts: dt.datetime) -> snapshots.Snapshot:
    """Merge what changed in a gold fact since the last load into the warehouse. The gold version read is committed with the
    merge, so a load that is cut short is done again and a load without news does nothing."""
    path, rule = f"{root}/warehouse/{name}", merge.FACTS[name]
    done, upto = snapshots.load(spark, path), snapshots.load(spark, f"{root}/gold/{name}").version
    if done.marks.get("gold", 0) == upto:
        return done
    source = rule.decided(stage.stage_load(spark, root, name, run_ts, done.marks.get("gold"), upto))
    now = {"loaded_at": F.lit(run_ts)}
    return snapshots.upsert(spark, path, source, rule.key, ["date_key"], rule.update, rule.changed if rule.update else None,
                            now if rule.update else None, now, marks={"gold": upto})


def full_load(spark: SparkSession, root: str, run_ts: dt.datetime) -> DataFrame:
    """Warehouse load: merge the facts, then the dimensions, then the reports. Returns one status row.

    Facts take the changes of gold only. The daily report is made anew for the days whose orders changed, and the
    dimensions and the monthly report, which depend on all orders, only if any did.
    """
    started = dt.datetime.now(dt.timezone.utc)
    base = os.path.join(root, "warehouse")

    def current(name: str) -> DataFrame:
        return lake.read_version(spark, f"{base}/{name}", WAREHOUSE[name])

    def publish(name: str, df: DataFrame) -> None:
        lake.write_version(spark, conform(df, WAREHOUSE[name]), f"{base}/{name}")

    loaded = {name: load_fact(spark, root, name, run_ts) for name in merge.FACTS}
    orders = loaded["fact_orders"]
    report_daily_revenue(spark, base, orders)
    report = f"{base}/rpt_product_performance"
    if snapshots.load(spark, report).marks.get("fact_orders") != orders.version:
        fact = snapshots.read(spark, f"{base}/fact_orders", None, orders)
        publish("dim_users", merge.merge_dim_users(current("dim_users"), fact, run_ts))
        publish("dim_products", merge.merge_dim_products(current("dim_products"), lake.read_gold(spark, root, "dim_products"), run_ts))
        publish("dim_time", lake.read_gold(spark, root, "dim_time"))
        publish("dim_devices", lake.read_gold(spark, root, "dim_devices"))
        snapshots.replace(spark, report, views.rpt_product_performance(fact, current("dim_products")), marks={"fact_orders": orders.version})
    publish("rpt_funnel", gold.rpt_funnel(lake.read_gold(spark, root, "agg_funnel")))
    ended = dt.datetime.now(dt.timezone.utc)
    return spark.range(1).select(F.to_json(F.struct(
        F.lit("SUCCESS").alias("status"), F.lit(started.isoformat()).alias("started_at"),
        F.lit(ended.isoformat()).alias("completed_at"), F.lit(int((ended - started).total_seconds())).alias("duration_secs")
    )).alias("result"))


def report_daily_revenue(spark: SparkSession, base: str, orders: snapshots.Snapshot) -> snapshots.Snapshot:
    """The daily report, by day: the days of the fact that changed since the version it was made of are made anew."""
    path, columns = f"{base}/rpt_daily_revenue", ["report_date"]
    s = snapshots.load(spark, path)
    done = s.marks.get("fact_orders", 0)
    if done == orders.version:
        return s
    days = snapshots.written_since(spark, f"{base}/fact_orders", orders, done) if done else None
    fact = snapshots.read(spark, f"{base}/fact_orders", days, orders)
    parts = None if days is None else {f"report_date={_report_date(p)}" for p in days}
    return snapshots.replace(spark, path, views.rpt_daily_revenue(fact), columns, parts, marks={"fact_orders": orders.version})


def _report_date(part: str) -> str:
    key = snapshots.part_values(part)["date_key"]
    return snapshots.NO_VALUE if key is None else f"{key[:4]}-{key[4:6]}-{key[6:]}"


def refresh_window(as_of: dt.date, refresh_days: int = 3, archive_days: int = 90) -> tuple[dt.date, dt.date]:
    """First day to reload and first day to keep in an incremental refresh."""
    return as_of - dt.timedelta(days=refresh_days - 1), as_of - dt.timedelta(days=archive_days - 1)


def changed_since(df: DataFrame, mark: dt.datetime | None, loaded_at: str = "loaded_at") -> DataFrame:
    """Rows loaded after the high-water mark of the last refresh."""
    return df if mark is None else df.filter(F.col(loaded_at) > F.lit(mark))


def high_water_mark(df: DataFrame, loaded_at: str = "loaded_at") -> dt.datetime | None:
    return df.agg(F.max(loaded_at)).first()[0]


def refresh(spark: SparkSession, root: str, name: str, as_of: dt.date, refresh_days: int = 3, archive_days: int = 90) -> DataFrame:
    """A gold fact as a BI model holds it: an archive of ``archive_days`` days, kept as a table of its own (``bi/<name>``).

    A refresh reads the days of the refresh window that gold has written since the version the archive has as its mark, days
    the archive has never had, and nothing else; days before the archive's window go. Days inside the archive but before the
    refresh window are kept as they were when their own window closed.
    """
    source, path = os.path.join(root, "gold", name), os.path.join(root, "bi", name)
    reload, keep = refresh_window(as_of, refresh_days, archive_days)
    now, model = snapshots.load(spark, source), snapshots.load(spark, path)
    news = snapshots.written_since(spark, source, now, model.marks.get("gold", 0))
    until = model.marks.get("as_of")  # days after it are new to the archive
    first = keep if until is None else min(reload, dt.date.fromisoformat(until) + dt.timedelta(days=1))
    late = keep if until is None or model.marks["keep"] <= keep.isoformat() else dt.date.fromisoformat(model.marks["keep"])

    def wanted(part: str) -> bool:
        day = lake.day_of(part)
        if day is None or not keep <= day <= as_of:
            return False
        missing = until is None or day.isoformat() > until or day < late
        return missing or (day >= first and part in news)

    window = {p for p in {*now.parts, *model.parts, *news} if wanted(p)}
    old = {p for p in model.parts if lake.day_of(p) is None or not keep <= lake.day_of(p) <= as_of}
    marks = {"gold": now.version, "as_of": as_of.isoformat(), "keep": keep.isoformat()}
    if window or old or not model.version:
        snapshots.replace(spark, path, snapshots.read(spark, source, window, now), lake.DAY, window, drop=old, marks=marks)
    return snapshots.read(spark, path)
