"""Raw stream payloads made of the event table's entities, with defects by event number.

Every 97th is not JSON, 89th lacks a required key, 83rd has a null user id, 79th a bad code (currency, status, action),
73rd a bad timestamp (a word, a year, a month or a time of day), 71st a negative amount; every 67th is sent twice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstream.sources import retail_tables as rt

# Fixed values of the derived records: texts that are no ISO timestamps
BAD_TIMES = ["not-a-time", "2024", "2024-01", "10:30"]

# stream -> (entity frame, key dropped by the 89th, coded field spoilt by the 79th, amount negated by the 71st)
_PLAN = {
    "orders": (rt.raw_orders_ev, "currency", "currency", "total_amount"),
    "payments": (rt.raw_payments, "currency", "payment_status", "amount"),
    "clickstream": (rt.raw_clickstream, "page_type", None, None),
    "carts": (rt.raw_carts, "cart_id", "action", "unit_price"),
}


def payloads(spark: SparkSession, folder: str, stream: str, copies: bool = True) -> DataFrame:
    """(data, arrival_ts) of one stream."""
    source, dropped, coded, amount = _PLAN[stream]
    df, e = source(spark, folder), F.col("e")
    changed: dict[str, Column] = {
        "event_timestamp": F.when(e % 73 == 0, rt.pick(BAD_TIMES, F.floor(e / 73) % 4)).otherwise(
            F.date_format("event_timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")),
        "user_id": F.when(e % 83 != 0, F.col("user_id"))}
    if coded:
        changed[coded] = F.when(e % 79 == 0, "XYZ").otherwise(F.col(coded))
    if amount:
        changed[amount] = F.when(e % 71 == 0, -F.col(amount)).otherwise(F.col(amount))
    arrival = F.col("event_timestamp") + F.make_dt_interval(mins=(e % 7).cast("int"))
    df = df.withColumn("arrival_ts", arrival).withColumns(changed)
    # the fraud flag is the consumer's to add
    fields = [c for c in df.columns if c not in ("e", "arrival_ts", "is_fraud_flagged")]
    keep_nulls = {"ignoreNullFields": "false"}
    text = (F.when(e % 97 == 0, F.concat(F.lit("not json "), e.cast("string")))
            .when(e % 89 == 0, F.to_json(F.struct(*[c for c in fields if c != dropped]), keep_nulls))
            .otherwise(F.to_json(F.struct(*fields), keep_nulls)))
    times = F.when(e % 67 == 0, 2).otherwise(1) if copies else F.lit(1)
    out = df.select("arrival_ts", F.posexplode(F.array_repeat(F.base64(text.cast("binary")), times)).alias("copy", "data"))
    return out.select("data", (F.col("arrival_ts") + F.make_dt_interval(secs=F.col("copy").cast("decimal(18,6)")))
                      .alias("arrival_ts"))


def dead_letter_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Dead letters made of the error events, with reasons of both kinds."""
    reasons = ["S3 write failed: timeout", "Schema error: Missing required fields: currency",
               "ServiceUnavailableException: slow down", "JSON decode error",
               "ProvisionedThroughputExceededException: keys"]
    e = rt.table(spark, folder, "events").filter("event_type = 'error'")
    i = F.col("event_id")
    return e.select(
        F.to_json(F.struct(F.concat(F.lit("EVT-"), i.cast("string")).alias("event_id"), "value")).alias("original_record"),
        F.when(i % 13 != 0, rt.pick(reasons, i % 5)).alias("reason"), F.col("ts").cast("timestamp").alias("failed_at"),
        F.when(i % 17 != 0, rt.pick(["orders", "payments", "clickstream", "carts"], i % 4)).alias("stream"),
        F.lit("prod").alias("environment"), F.lit(0).cast("long").alias("batch_id"))
