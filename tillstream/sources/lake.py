"""Reading and writing the lake zones: bronze NDJSON, silver and gold snapshot tables, catalog tables."""

from __future__ import annotations

import datetime as dt
import os
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstream.functions.schemas import BRONZE, struct_of
from tillstream.operators.rows import Days, on_day
from tillstream.sources import snapshots

DAY = ["year", "month", "day"]
# arrival-time folders; their names must differ from the event-time columns of the records
ARRIVAL = ["ingest_year", "ingest_month", "ingest_day", "ingest_hour"]


def _missing_path(error: AnalysisException) -> bool:
    return error.getCondition() == "PATH_NOT_FOUND"


def empty(spark: SparkSession, layout: str) -> DataFrame:
    return spark.createDataFrame([], struct_of(layout))


def read_bronze(spark: SparkSession, root: str, entity: str, arrival_day: dt.date | None = None,
                allow_missing: bool = True) -> DataFrame:
    """Bronze records of a stream: one arrival day (partition pruning) or all of them.

    Unreadable lines are kept in ``_corrupt_record``. A path that does not exist yet gives an empty typed frame.
    """
    layout = BRONZE[entity] + ", _corrupt_record string"
    parts = ", ".join(f"{c} int" for c in ARRIVAL) + ", run_id string, batch_id long"
    try:
        df = (spark.read.schema(f"{layout}, {parts}").option("mode", "PERMISSIVE")
              .option("columnNameOfCorruptRecord", "_corrupt_record").json(os.path.join(root, "bronze", entity)))
    except AnalysisException as error:
        if allow_missing and _missing_path(error):
            return empty(spark, f"{layout}, {parts}")
        raise
    if arrival_day is not None:
        df = df.filter((F.col("ingest_year") == arrival_day.year) & (F.col("ingest_month") == arrival_day.month)
                       & (F.col("ingest_day") == arrival_day.day))
    return df


def with_arrival_parts(df: DataFrame, arrival: str = "ingestion_timestamp") -> DataFrame:
    ts = F.col(arrival).cast("timestamp")
    return df.withColumns({"ingest_year": F.year(ts), "ingest_month": F.month(ts), "ingest_day": F.dayofmonth(ts),
                           "ingest_hour": F.hour(ts)})


def write_bronze(df: DataFrame, root: str, entity: str, batch_id: int, run_id: str = "batch") -> None:
    """One batch of enriched records as NDJSON by arrival hour. A replay of the batch replaces its own files only."""
    out = with_arrival_parts(df).withColumns({"run_id": F.lit(run_id), "batch_id": F.lit(batch_id)})
    (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*ARRIVAL, "run_id", "batch_id")
     .json(os.path.join(root, "bronze", entity)))


def as_day(year: int | None, month: int | None, day: int | None) -> dt.date | None:
    return None if year is None else dt.date(year, month, day)


def _part(day: dt.date | None, cols: Sequence[str]) -> str:
    return snapshots.part_name({c: None if day is None else getattr(day, c) for c in cols})


def _parts(days: Days, cols: Sequence[str]) -> set[str] | None:
    if days is None or not cols:
        return None
    return {_part(d, cols) for d in ({days} if isinstance(days, dt.date) else days)}


def day_of(part: str) -> dt.date | None:
    """The day, or the first of the month, a partition stands for."""
    v = snapshots.part_values(part)
    return None if v.get("year") is None else dt.date(int(v["year"]), int(v["month"]), int(v.get("day", 1)))


def replace_days(df: DataFrame, path: str, days: Days, partition_cols: Sequence[str] = tuple(DAY),
                 sort_cols: Sequence[str] = (), **options) -> set[dt.date | None]:
    """Commit a frame that holds all rows of ``days`` (``None``: of all days) as a new version of a table; days without a row
    go. The old version is read until then, and if the run dies. Returns the days written."""
    s = snapshots.replace(df.sparkSession, path, df, partition_cols, _parts(days, partition_cols), sort_cols, **options)
    return {day_of(p) for p in s.changed if p in s.parts}


def partition_days(spark: SparkSession, path: str) -> list[dt.date | None]:
    """The days (or months) a table has rows of, from its manifest."""
    return [day_of(p) for p in snapshots.load(spark, path).parts]


def write_silver(df: DataFrame, root: str, entity: str, days: Days = None, key: str | None = None,
                 placed: DataFrame | None = None) -> set[dt.date | None]:
    """Replace these days (``None``: all) of a silver table by a frame; returns the days it has rows of. With ``key``, an
    index of that column says on which day a record lies; ``placed`` holds the keys that may have moved."""
    return replace_days(df, os.path.join(root, "silver", entity), days, index=key, placed=placed)


def read_silver(spark: SparkSession, root: str, entity: str, day: Days = None) -> DataFrame:
    """A silver table, all of it or some days, of which only the folders are listed."""
    return on_day(snapshots.read(spark, os.path.join(root, "silver", entity), _parts(day, DAY)), day)


def known_days(spark: SparkSession, root: str, entity: str, keys: DataFrame, key: str) -> set[dt.date | None] | None:
    """The days of silver that hold any of these keys, by the index; nothing before the first load."""
    path = os.path.join(root, "silver", entity)
    s = snapshots.load(spark, path)
    if not s.version:
        return None
    return {day_of(r[0]) for r in snapshots.homes(spark, path, keys, key, s).select("home").distinct().collect()}  # a row a day


# clustering columns of the warehouse facts: row groups then skip on them
GOLD_SORT = {"fact_orders": ["country", "order_status"], "fact_payments": ["payment_status", "payment_method"],
             "fact_clickstream": ["page_type", "country"]}


# facts log what a run changed, under these keys, for the consumers downstream
GOLD_KEYS = {"fact_orders": "order_id", "fact_payments": "payment_id", "fact_clickstream": "event_id"}


def write_gold(df: DataFrame, root: str, name: str, partition_cols: Sequence[str] = (), days: Days = None) -> None:
    """A gold table in full, or the given days of one that is partitioned by date."""
    replace_days(df, os.path.join(root, "gold", name), days if partition_cols else None, partition_cols, GOLD_SORT.get(name, ()),
                 key=GOLD_KEYS.get(name), but=["gold_processed_at"])


def read_gold(spark: SparkSession, root: str, name: str, day: Days = None) -> DataFrame:
    path = os.path.join(root, "gold", name)
    s = snapshots.load(spark, path)
    return on_day(snapshots.read(spark, path, _parts(day, s.columns), s), day)


def register(spark: SparkSession, table: str, path: str, layout: str, partition_cols: Sequence[str] = ()) -> None:
    """Make a plain Parquet folder a catalog table, or look for its partitions; ``snapshots.publish`` is for snapshot tables."""
    if not spark.catalog.tableExists(table):
        parts = f"PARTITIONED BY ({', '.join(partition_cols)})" if partition_cols else ""
        spark.sql(f"CREATE TABLE {table} ({layout}) USING parquet {parts} LOCATION '{path}'")
    if partition_cols:
        spark.catalog.recoverPartitions(table)
    spark.catalog.refreshTable(table)


def existing(spark: SparkSession, paths: Sequence[str]) -> list[str]:
    """Those of some given folders that are there; nothing is listed."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    found = [(p, jvm.org.apache.hadoop.fs.Path(p)) for p in paths]
    return [p for p, folder in found if folder.getFileSystem(conf).exists(folder)]


def expire(spark: SparkSession, path: str, column: str, before: dt.date) -> list[str]:
    """Delete the day folders ``column=day`` of a table that lie before a day; returns their names."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(root) if s.isDirectory()]
    old = sorted(n for n in names if f"{column}=" <= n < f"{column}={before.isoformat()}")
    for name in old:
        fs.delete(jvm.org.apache.hadoop.fs.Path(root, name), True)
    return old


def vacuum(spark: SparkSession, root: str, keep: int = 10, grace_seconds: float = 86_400) -> int:
    """Drop old versions, and folders that no kept version names, of all tables of the lake; returns how many folders went."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(root)
    found = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(jvm.org.apache.hadoop.fs.Path(f"{root}/*/*/manifests"))
    return sum(len(snapshots.expire(spark, str(f.getPath().getParent()), keep, grace_seconds)) for f in found or ())


def read_version(spark: SparkSession, path: str, layout: str) -> DataFrame:
    """The newest version of a table, or an empty frame."""
    s = snapshots.load(spark, path)
    return snapshots.read(spark, path, None, s) if s.version else empty(spark, layout)


def write_version(spark: SparkSession, df: DataFrame, path: str) -> int:
    """Commit a frame as the next version of a whole table."""
    return snapshots.replace(spark, path, df).version
