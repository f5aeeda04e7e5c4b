"""Gold tables made from kept state: silver is read for the days that changed, and for no others.

``state/<name>`` holds a rollup's partials by day, ``state/<name>_total`` its totals. Each table notes the version of the table it
was made of (a mark, committed with its rows), so a run that is cut short between two of them is made up for by the next.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession

from tillstream.operators.rollups import DAY, KEPT, LOST, Kept
from tillstream.sources import snapshots


def partials(spark: SparkSession, root: str, name: str) -> snapshots.Snapshot:
    """Make the partials of the days that silver has written, or dropped, since the versions noted."""
    kept, path = KEPT[name], f"{root}/state/{name}"
    s = snapshots.load(spark, path)
    silver = {e: snapshots.load(spark, f"{root}/silver/{e}") for e in kept.entities}
    marks = {e: now.version for e, now in silver.items()}
    if s.version and all(s.marks.get(e) == v for e, v in marks.items()):
        return s
    days = None
    if s.version and all(snapshots.keeps(spark, f"{root}/silver/{e}", s.marks[e] + 1, v) for e, v in marks.items()):
        days = set().union(*(snapshots.written_since(spark, f"{root}/silver/{e}", now, s.marks[e]) for e, now in silver.items()))
    rows = kept.rows(*[snapshots.read(spark, f"{root}/silver/{e}", days, now) for e, now in silver.items()])
    return snapshots.replace(spark, path, kept.rollup.partials(rows), DAY, days, marks=marks)


def totals(spark: SparkSession, root: str, name: str) -> snapshots.Snapshot:
    """Bring the totals up to the partials. Reads the old and the new partials of changed days, and all partials of a key
    only where it lost an extreme."""
    kept, path, source = KEPT[name], f"{root}/state/{name}_total", f"{root}/state/{name}"
    now, s = snapshots.load(spark, source), snapshots.load(spark, path)
    done = s.marks.get("days", 0)
    if s.version and done == now.version:
        return s

    def every() -> DataFrame:
        return snapshots.read(spark, source, None, now)

    if not s.version or not snapshots.keeps(spark, source, done, now.version):
        return snapshots.replace(spark, path, kept.rollup.totals(every()), marks={"days": now.version})
    days, work = snapshots.written_since(spark, source, now, done), f"{path}/work/commit=c{uuid.uuid4().hex}"
    old, new = (snapshots.read(spark, source, days, v) for v in (snapshots.load(spark, source, done), now))
    applied = kept.rollup.applied(snapshots.read(spark, path, None, s), old, new)
    applied.write.parquet(work)
    applied = spark.read.schema(applied.schema).parquet(work)
    all_held = applied.where(LOST).isEmpty()
    out = applied.drop(LOST) if all_held else kept.rollup.repaired(applied, every)
    result = snapshots.replace(spark, path, out, marks={"days": now.version})
    snapshots.remove(spark, work)
    return result


def refresh(spark: SparkSession, root: str, name: str, run_ts: dt.datetime) -> snapshots.Snapshot:
    """A gold table from its state. Without news in silver nothing is written; a monthly one is made anew for months with news."""
    kept, path = KEPT[name], f"{root}/gold/{name}"
    days = partials(spark, root, name)
    s = snapshots.load(spark, path)
    if kept.monthly:
        return _refresh_months(spark, root, name, kept, days, s, run_ts)
    state = totals(spark, root, name)
    if s.version and s.marks.get("state") == state.version:
        return s
    made = kept.made(snapshots.read(spark, f"{root}/state/{name}_total", None, state), run_ts)
    return snapshots.replace(spark, path, made, marks={"state": state.version})


def _refresh_months(spark: SparkSession, root: str, name: str, kept: Kept, days: snapshots.Snapshot, s: snapshots.Snapshot,
                    run_ts: dt.datetime) -> snapshots.Snapshot:
    source, done = f"{root}/state/{name}", s.marks.get("state", 0)
    if s.version and done == days.version:
        return s
    known = bool(done) and snapshots.keeps(spark, source, done + 1, days.version)
    months = {_month(p) for p in snapshots.written_since(spark, source, days, done)} if known else None
    wanted = None if months is None else {p for p in days.parts if _month(p) in months}
    made = kept.made(snapshots.read(spark, source, wanted, days), run_ts)
    return snapshots.replace(spark, f"{root}/gold/{name}", made, DAY[:2], months, marks={"state": days.version})


def _month(part: str) -> str:
    values = snapshots.part_values(part)
    return snapshots.part_name({c: values[c] for c in DAY[:2]})
