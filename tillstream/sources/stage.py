"""Gold files -> typed staging frames of the warehouse, as a batch or as continuous file ingest."""

from __future__ import annotations

import datetime as dt
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tillstream.functions import exprs as x
from tillstream.functions.schemas import WAREHOUSE, conform
from tillstream.sources import lake, snapshots

FACTS = ("fact_orders", "fact_payments", "fact_clickstream")


def to_stage(gold: DataFrame, name: str, loaded_at: dt.datetime) -> DataFrame:
    """Surrogate keys, date key, defaults and the warehouse types."""
    if name == "fact_orders":
        out = gold.withColumns({
            "order_sk": x.surrogate_key("order_id"), "user_sk": x.surrogate_key("user_id"), "device_sk": x.device_key(),
            "date_key": x.date_key("order_timestamp"), "currency": F.coalesce("currency", F.lit("USD"))})
    elif name == "fact_payments":
        out = gold.withColumns({"payment_sk": x.surrogate_key("payment_id"), "date_key": x.date_key("payment_timestamp")})
    elif name == "fact_clickstream":
        out = gold.withColumns({"click_sk": x.surrogate_key("event_id"), "date_key": x.date_key("view_timestamp")})
    else:
        raise ValueError(f"no staging rule for {name}")
    return conform(out.withColumn("loaded_at", F.lit(loaded_at)), WAREHOUSE[name])


def gold_rows(spark: SparkSession, root: str, name: str, after: int | None = None, upto: int | None = None) -> DataFrame:
    """The rows of a gold fact, or the last state of those that changed after a version. Where the log does not reach back
    that far, all rows are given: merging rows that are known changes nothing."""
    path = os.path.join(root, "gold", name)
    if after:
        try:
            return snapshots.latest_changes(spark, path, lake.GOLD_KEYS[name], after, upto)
        except snapshots.Expired:
            pass
    return snapshots.read(spark, path, None, snapshots.load(spark, path, upto), ignoreCorruptFiles="true")


def stage_load(spark: SparkSession, root: str, name: str, loaded_at: dt.datetime, after: int | None = None,
               upto: int | None = None) -> DataFrame:
    """Gold rows of a fact in the layout of the warehouse; a full load skips unreadable files (see ``skipped_files``)."""
    return to_stage(gold_rows(spark, root, name, after, upto), name, loaded_at)


def skipped_files(spark: SparkSession, root: str, name: str) -> DataFrame:
    """(file): files of a gold fact that a full load cannot read, as their footers are damaged. Reads footers only."""
    df = snapshots.read(spark, os.path.join(root, "gold", name), ignoreCorruptFiles="true")
    files = spark.createDataFrame([(f,) for f in df.inputFiles()], "file string")
    read = df.select(F.col("_metadata.file_path").alias("_f")).distinct()
    same = lambda c: F.regexp_replace(c, "^file:/+", "file:///")
    return files.join(read, same("file") == same("_f"), "left_anti")


def start_stage(spark: SparkSession, root: str, name: str, loaded_at: dt.datetime, checkpoint: str,
                max_versions: int | None = None, available_now: bool = True, interval: str = "15 minutes") -> StreamingQuery:
    """Continuous ingest of a gold fact into its staging table ``stage/<name>``: one row a key, the last one.

    The stream is fed by the gold table's commits. What a commit changed is merged into the stage together with the version it
    stands for, so a day that is written anew brings only rows that differ, and a batch that is replayed brings none.
    """
    path, key = os.path.join(root, "stage", name), lake.GOLD_KEYS[name]

    def load(batch: DataFrame, _: int) -> None:
        between, s = snapshots.span(batch), snapshots.load(spark, path)
        done = s.marks.get("gold", 0)
        if between is None or between[1] <= done:
            return
        rows = stage_load(spark, root, name, loaded_at, done, between[1])
        names = [c for c in rows.columns if c not in (key, "loaded_at")]
        differs = lambda src, tgt: ~F.struct(*map(src, names)).eqNullSafe(F.struct(*map(tgt, names)))
        snapshots.upsert(spark, path, rows, key, ["date_key"], [*names, "loaded_at"], differs, marks={"gold": between[1]})

    writer = (snapshots.fed(spark, os.path.join(root, "gold", name), max_versions).writeStream.foreachBatch(load)
              .option("checkpointLocation", checkpoint))
    return (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=interval)).start()
