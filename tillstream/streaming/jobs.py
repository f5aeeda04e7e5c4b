"""Structured Streaming around the batch functions of ``ingest``.

Each micro-batch writes, in this order: bronze records, dead letters, summary and alerts, and last the dedup keys. All
outputs carry the run id and the batch id, all but the dead letters as partitions. A replayed batch overwrites its own
partitions and ignores its own keys, so a failure at any point is repaired by the replay; dead letters, which other streams
read, are committed once a batch. The run id lives in the checkpoint: a stream that starts
with a new checkpoint, or a second one on the same root, numbers its batches anew without touching older output.
"""

from __future__ import annotations

import datetime as dt
import os
import uuid

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tillstream.sources import lake, snapshots
from tillstream.streaming import ingest

KEYS = "key string, seen_at timestamp, run_id string, batch_id long, seen_date date"
BY_BATCH = ("run_id", "batch_id")


def run_id_of(spark: SparkSession, checkpoint: str) -> str:
    """The id of the run a checkpoint belongs to, made and kept beside its offsets at the first start."""
    path = os.path.join(checkpoint, "run_id")
    kept = spark.read.text(path).first() if lake.existing(spark, [path]) else None
    if kept is None:  # new, or the first start was cut short before the id was there
        kept = [f"run-{uuid.uuid4().hex}"]
        spark.createDataFrame([tuple(kept)], "value string").coalesce(1).write.mode("overwrite").text(path)
    return kept[0]


def _append_batch(df: DataFrame, path: str, run_id: str, batch_id: int, *partition_cols: str) -> None:
    out = df.withColumns({"run_id": F.lit(run_id), "batch_id": F.lit(batch_id).cast("long")})
    (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition_cols, *BY_BATCH)
     .parquet(path))


def seen_keys(spark: SparkSession, root: str, entity: str, first: dt.datetime, last: dt.datetime,
              days: tuple[dt.date, dt.date], run_id: str, batch_id: int) -> DataFrame:
    """Keys that other batches accepted less than a key's life before or after a batch's span of arrivals.

    Only the folders of ``days`` are opened, however many older ones there are; ``expire_keys`` removes those.
    """
    base = os.path.join(root, "keys", entity)
    wanted = [days[0] + dt.timedelta(days=i) for i in range((days[1] - days[0]).days + 1)]
    found = lake.existing(spark, [f"{base}/seen_date={day.isoformat()}" for day in wanted])
    if not found:
        return lake.empty(spark, KEYS)
    own = (F.col("run_id") == run_id) & (F.col("batch_id") == batch_id)
    return spark.read.schema(KEYS).option("basePath", base).parquet(*found).filter(
        (F.col("seen_at") > F.lit(first - ingest.DEDUP_TTL)) & (F.col("seen_at") < F.lit(last + ingest.DEDUP_TTL)) & ~own)


def expire_keys(spark: SparkSession, root: str, entity: str, now: dt.datetime) -> list[str]:
    """Remove the key folders that no batch arriving from ``now`` on can ask for."""
    return lake.expire(spark, os.path.join(root, "keys", entity), "seen_date", (now - ingest.DEDUP_TTL).date())


def process_batch(batch: DataFrame, batch_id: int, entity: str, root: str, environment: str = "prod",
                  run_id: str = "batch") -> None:
    """Everything a consumer does with one micro-batch of (data, arrival_ts)."""
    spark = batch.sparkSession
    classified = ingest.classify(batch, entity).persist(StorageLevel.MEMORY_AND_DISK)
    passed = None
    try:
        life = F.make_dt_interval(secs=F.lit(ingest.DEDUP_TTL.total_seconds()).cast("decimal(18,6)"))
        first, last = F.min("arrival_ts"), F.max("arrival_ts")
        span = classified.agg(first.alias("first"), last.alias("last"), F.to_date(first - life).alias("from_day"),
                              F.to_date(last + life).alias("to_day")).first()
        if span["first"] is None:
            return
        seen = None
        if entity in ingest.DEDUP_KEYS:
            seen = seen_keys(spark, root, entity, span["first"], span["last"], (span["from_day"], span["to_day"]), run_id,
                             batch_id)
        out = ingest.process(classified, entity, seen, environment, batch_id, StorageLevel.MEMORY_AND_DISK)
        passed = out.passed
        lake.write_bronze(out.accepted, root, entity, batch_id, run_id)

        def land(df: DataFrame, folder: str, *partition_cols: str) -> None:
            _append_batch(df, os.path.join(root, folder), run_id, batch_id, *partition_cols)

        letters = out.failed.withColumns({"failed_date": F.to_date("failed_at"), "run_id": F.lit(run_id), "batch_id": F.lit(batch_id).cast("long")})
        snapshots.append(spark, letters_path(root, entity), letters, ["failed_date"], run_id, batch_id)
        summary = ingest.batch_summary(out, entity, batch_id)
        land(summary, f"summaries/{entity}")
        land(ingest.failure_alerts(summary, span["last"]), f"alerts/{entity}")
        if entity == "carts":
            land(ingest.cart_abandonment(out.accepted), "abandonments")
        if out.keys is not None:
            land(out.keys, f"keys/{entity}", "seen_date")
    finally:
        if passed is not None:
            passed.unpersist()
        classified.unpersist()


def start_ingest(stream: DataFrame, entity: str, root: str, checkpoint: str, environment: str = "prod",
                 available_now: bool = True, interval: str = "1 minute") -> StreamingQuery:
    """Run a consumer over a stream of (data, arrival_ts) - whatever the source."""
    run_id = run_id_of(stream.sparkSession, checkpoint)
    writer = stream.writeStream.foreachBatch(
        lambda df, batch_id: process_batch(df, batch_id, entity, root, environment, run_id)).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=interval)).start()


def land_keyed(rows: DataFrame, batch_id: int, entity: str, root: str, environment: str, run_id: str) -> None:
    """Write what a trigger's keyed state gave: bronze, dead letters, summary and alerts."""
    rows = rows.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        last = rows.agg(F.max("arrival_ts")).first()[0]
        accepted, letters, summary = ingest.split_keyed(rows, entity, environment, batch_id)
        if last is None and rows.isEmpty():
            return
        lake.write_bronze(accepted, root, entity, batch_id, run_id)
        letters = letters.withColumns({"failed_date": F.to_date("failed_at"), "run_id": F.lit(run_id)})
        snapshots.append(rows.sparkSession, letters_path(root, entity), letters, ["failed_date"], run_id, batch_id)
        _append_batch(summary, os.path.join(root, f"summaries/{entity}"), run_id, batch_id)
        raised = last or dt.datetime(1970, 1, 1)  # a trigger of duplicates raises nothing
        _append_batch(ingest.failure_alerts(summary, raised), os.path.join(root, f"alerts/{entity}"), run_id, batch_id)
    finally:
        rows.unpersist()


def start_keyed_ingest(stream: DataFrame, entity: str, root: str, checkpoint: str, environment: str = "prod",
                       available_now: bool = True, interval: str = "1 minute") -> StreamingQuery:
    """``start_ingest`` for orders and payments with the known keys in Spark's state store instead of key folders: no key is looked
    up in files, none has to be expired, and a key's life is counted from its own record. A replayed batch starts from the same
    state, so it gives the same rows and overwrites its output."""
    if entity not in ingest.DEDUP_KEYS:
        raise ValueError(f"No key to deduplicate {entity} by. Choose from {sorted(ingest.DEDUP_KEYS)}")
    run_id = run_id_of(stream.sparkSession, checkpoint)
    writer = ingest.keyed_rows(stream, entity).writeStream.foreachBatch(
        lambda df, batch_id: land_keyed(df, batch_id, entity, root, environment, run_id)).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=interval)).start()


def start_redrive(spark: SparkSession, root: str, entity: str, checkpoint: str, environment: str = "prod") -> StreamingQuery:
    """Feed the recoverable dead letters that triage set aside through the consumer again, each once: the stream is fed by the
    commits of triage, and a batch of triage that is replayed commits nothing."""
    run_id, path = run_id_of(spark, checkpoint), redrive_path(root, entity)

    def handle(batch: DataFrame, batch_id: int) -> None:
        if (between := snapshots.span(batch)) is not None:
            letters = snapshots.changes(spark, path, between[0] - 1, between[1]).select("data", "arrival_ts")
            process_batch(letters, batch_id, entity, root, environment, run_id)

    return (snapshots.fed(spark, path).writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def payload_stream(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Payload files (Parquet with data, arrival_ts) as a stream."""
    reader = spark.readStream.schema("data string, arrival_ts timestamp")
    return (reader.option("maxFilesPerTrigger", max_files) if max_files else reader).parquet(path)


def dedup_stream(records: DataFrame, key: str, arrival: str = "arrival_ts", ttl: str = "24 hours") -> DataFrame:
    """First-wins deduplication kept in Spark's state store instead of a key table (gives no duplicate counts)."""
    return records.withWatermark(arrival, ttl).dropDuplicatesWithinWatermark([key])


def letters_path(root: str, entity: str) -> str:
    return os.path.join(root, "dlq", entity)


def redrive_path(root: str, entity: str) -> str:
    return os.path.join(root, "redrive", entity)


def read_letters(spark: SparkSession, root: str, entity: str) -> DataFrame:
    """All dead letters of a consumer."""
    return snapshots.read(spark, letters_path(root, entity))


def start_triage(spark: SparkSession, root: str, entity: str, checkpoint: str) -> StreamingQuery:
    """Classify new dead letters: counts per disposition, alerts for permanent failures, recoverable ones for re-drive."""
    run_id, path = run_id_of(spark, checkpoint), letters_path(root, entity)

    def handle(batch: DataFrame, batch_id: int) -> None:
        between = snapshots.span(batch)
        if between is None:
            return
        df = snapshots.changes(spark, path, between[0] - 1, between[1])

        def land(out: DataFrame, folder: str) -> None:
            _append_batch(out, os.path.join(root, folder, entity), run_id, batch_id)

        land(ingest.triage_counts(df), "triage")
        alerts = ingest.triage_alerts(df, dt.datetime(1970, 1, 1)).withColumn("raised_at", F.current_timestamp())
        land(alerts, "triage_alerts")
        snapshots.append(spark, redrive_path(root, entity), ingest.redrive(df, entity), [], run_id, batch_id)

    return (snapshots.fed(spark, path).writeStream.foreachBatch(handle)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
