"""What a stream consumer does with a batch: decode, validate, deduplicate, enrich, split.

Everything here is frame in, frame out and works the same on a static batch and inside ``foreachBatch``. The input has
``data`` (base64 of a JSON object) and ``arrival_ts``.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstream.functions import domains as d
from tillstream.functions import exprs as x
from tillstream.functions.schemas import WIRE
from tillstream.operators.rows import first_per_key
from tillstream.streaming import keyed

ENTITIES = ("orders", "payments", "clickstream", "carts")
DEDUP_KEYS = {"orders": "order_id", "payments": "payment_id"}
DEDUP_TTL = dt.timedelta(hours=24)
FAILURE_RATE_ALERT, FAILURE_RATE_MIN_RECORDS = 0.10, 10

_REQUIRED = {"orders": d.REQUIRED_ORDER_FIELDS, "payments": d.REQUIRED_PAYMENT_FIELDS,
             "clickstream": d.REQUIRED_CLICK_FIELDS, "carts": d.REQUIRED_CART_FIELDS}


def decode(batch: DataFrame, entity: str) -> DataFrame:
    """Add ``payload`` (text), ``fields`` (key presence; null when not a JSON object) and ``rec`` (typed record)."""
    text = F.try_to_binary("data", F.lit("base64")).cast("string")
    out = batch.withColumn("payload", text)
    # A one-row generator: later filters read its output, so a record is parsed once and not again in every predicate.
    parsed = F.struct(F.from_json("payload", "map<string,string>").alias("fields"),
                      F.from_json("payload", WIRE[entity]).alias("rec"))
    return out.select(*out.columns, F.inline(F.array(parsed)))


def _listed(names: Column) -> Column:
    return F.array_join(names, ", ")


def _missing(entity: str) -> Column:
    return F.array_compact(F.array(*[F.when(~F.map_contains_key("fields", f), F.lit(f)) for f in sorted(_REQUIRED[entity])]))


def _nulls(entity: str) -> Column:
    return F.array_compact(F.array(*[F.when(F.col("fields")[f].isNull(), F.lit(f)) for f in sorted(_REQUIRED[entity])]))


def _shown(field: str) -> Column:
    return F.coalesce(F.col("fields")[field], F.lit("null"))


def event_time() -> Column:
    return x.iso_timestamp("rec.event_timestamp")


def failure_reason(entity: str) -> Column:
    """The first rule a record breaks, or null."""
    missing, nulls = _missing(entity), _nulls(entity)
    bad_time = event_time().isNull()
    reason = F.when(F.col("fields").isNull(), F.lit("JSON decode error"))
    if entity == "orders":
        total, n = F.col("rec.total_amount"), F.size("rec.items")
        reason = (reason
                  .when(F.size(missing) > 0, F.concat(F.lit("Schema error: Missing required fields: "), _listed(missing)))
                  .when(F.size(nulls) > 0, F.concat(F.lit("Schema error: Null values in required fields: "), _listed(nulls)))
                  .when(total.isNull() | (total <= 0), F.concat(F.lit("Business rule: Invalid total_amount: "), _shown("total_amount")))
                  .when(total > d.MAX_ORDER_TOTAL, F.concat(F.lit("Business rule: Suspiciously high total_amount: "), _shown("total_amount")))
                  .when(F.col("rec.items").isNull() | (n == 0), F.lit("Business rule: Order has no items"))
                  .when(n > d.MAX_ORDER_ITEMS, F.concat(F.lit("Business rule: Unrealistic item count: "), n.cast("string")))
                  .when(~F.col("rec.currency").isin(d.CURRENCIES), F.concat(F.lit("Business rule: Unsupported currency: "), _shown("currency")))
                  .when(bad_time, F.concat(F.lit("Business rule: Invalid event_timestamp: "), _shown("event_timestamp"))))
    elif entity == "payments":
        amount = F.col("rec.amount")
        reason = (reason
                  .when(F.size(missing) > 0, F.concat(F.lit("Schema: Missing fields: "), _listed(missing)))
                  .when(F.size(nulls) > 0, F.concat(F.lit("Schema: Null required fields: "), _listed(nulls)))
                  .when(amount.isNull() | (amount <= 0), F.concat(F.lit("Validation: Invalid amount: "), _shown("amount")))
                  .when(amount > d.MAX_PAYMENT_AMOUNT, F.concat(F.lit("Validation: Amount exceeds limit: "), _shown("amount")))
                  .when(~F.col("rec.payment_status").isin(d.PAYMENT_STATUSES), F.concat(F.lit("Validation: Invalid status: "), _shown("payment_status")))
                  .when(bad_time, F.concat(F.lit("Validation: Invalid timestamp: "), _shown("event_timestamp"))))
    elif entity == "clickstream":
        # only the presence of the keys counts here: a null user id passes, an unknown page type too
        reason = (reason.when(F.size(missing) > 0, F.concat(F.lit("Missing: "), _listed(missing)))
                  .when(bad_time, F.lit("Invalid timestamp")))
    else:
        price = F.col("rec.unit_price")
        reason = (reason.when(F.size(missing) > 0, F.concat(F.lit("Missing: "), _listed(missing)))
                  .when(~F.coalesce(F.col("rec.action").isin(d.CART_ACTIONS), F.lit(False)),
                        F.concat(F.lit("Invalid action: "), _shown("action")))
                  .when(price.isNull() | (price <= 0), F.concat(F.lit("Invalid unit_price: "), _shown("unit_price"))))
    return reason


def classify(batch: DataFrame, entity: str) -> DataFrame:
    """``decode`` plus ``reason`` (null = accepted)."""
    if entity not in ENTITIES:
        raise ValueError(f"Unknown entity: {entity}. Choose from {list(ENTITIES)}")
    return decode(batch, entity).withColumn("reason", failure_reason(entity))


def fraud_signals(prefix: str = "") -> Column:
    """Names of the signals that hold; an unknown 3DS state is not "not authenticated"."""
    def c(name):
        return F.col(prefix + name)

    amount = c("amount")
    return F.array_compact(F.array(
        F.when(amount > 5000, F.lit("high_value_transaction")),
        F.when(c("failure_reason") == "fraud_detected", F.lit("gateway_fraud_flag")),
        F.when(c("is_3ds_authenticated").eqNullSafe(F.lit(False)) & (amount > 500), F.lit("no_3ds_high_value")),
        F.when(c("gateway_response_code").isin(d.SUSPICIOUS_GATEWAY_CODES), F.lit("suspicious_response_code"))))


def enrich(accepted: DataFrame, entity: str, environment: str = "prod") -> DataFrame:
    """Flatten the record and add ingestion time, ids, event-time parts (arrival time where unknown) and measures.

    The processing id is a hash of the payload and its arrival, so a recomputed task gives the same value.
    """
    when = F.coalesce(event_time(), F.col("arrival_ts"))
    extra = {**x.event_parts(when), "environment": F.lit(environment), "ingestion_timestamp": F.col("arrival_ts")}
    if entity in ("orders", "payments"):
        digest = F.md5(F.concat_ws("|", "payload", F.col("arrival_ts").cast("string")))
        extra["processing_id"] = F.concat(F.lit("PROC-"), F.upper(F.substring(digest, 1, 8)))
    if entity == "orders":
        n = F.size("rec.items")
        extra["item_count"] = n
        extra["average_item_value"] = F.when(n > 0, x.rnd(F.coalesce("rec.subtotal", F.lit(0.0)) / n, 2)).otherwise(0.0)
        extra["day_of_week"] = F.date_format(when, "EEEE")
        extra["is_weekend"] = x.is_weekend(when)
    elif entity == "payments":
        extra["fraud_signals"] = fraud_signals("rec.")
        extra["is_fraud_flagged"] = F.size(fraud_signals("rec.")) > 0
    elif entity == "carts":
        extra["cart_value"] = x.rnd(F.col("rec.unit_price") * F.coalesce("rec.quantity", F.lit(1)), 2)
    names = [f.name for f in accepted.schema["rec"].dataType.fields if f.name not in extra]
    return accepted.select(*[F.col(f"rec.{n}").alias(n) for n in names], *[c.alias(n) for n, c in extra.items()])


def dead_letters(classified: DataFrame, stream: str, environment: str = "prod", batch_id: int = 0) -> DataFrame:
    """The one envelope of all streams. The raw text is kept even where it cannot be parsed."""
    return classified.filter(F.col("reason").isNotNull()).select(
        F.coalesce("payload", "data").alias("original_record"), "reason", F.col("arrival_ts").alias("failed_at"),
        F.lit(stream).alias("stream"), F.lit(environment).alias("environment"),
        F.lit(batch_id).cast("long").alias("batch_id"))


@dataclass
class Outcome:
    """The frames a batch falls into. All are lazy views of ``classified``."""
    classified: DataFrame
    accepted: DataFrame
    failed: DataFrame
    keys: DataFrame | None
    passed: DataFrame | None = None
    seen: DataFrame | None = None
    held: bool = False


def process(classified: DataFrame, entity: str, seen: DataFrame | None = None, environment: str = "prod",
            batch_id: int = 0, hold: StorageLevel | None = None) -> Outcome:
    """Split a classified batch; orders and payments are deduplicated first-wins.

    ``seen`` has one row per known key (``key``); a batch is expected to span less than the 24 h life of a key. The
    first-wins filter is applied before the shuffle as well, so a key that fills the batch stays cheap. With ``hold`` the
    records that are left are persisted, since several outputs are made of them; the caller releases ``passed``.
    """
    passed = classified.filter(F.col("reason").isNull())
    keys = None
    if entity in DEDUP_KEYS:
        passed = passed.withColumn("key", F.col(f"rec.{DEDUP_KEYS[entity]}"))
        passed = first_per_key(passed, ["key"], ["arrival_ts", "payload"])
        if seen is not None:
            passed = passed.join(seen.select("key"), "key", "left_anti")
        if hold is not None:
            passed = passed.persist(hold)
        keys = passed.select("key", F.col("arrival_ts").alias("seen_at"),
                             F.to_date("arrival_ts").alias("seen_date"), F.lit(batch_id).cast("long").alias("batch_id"))
    return Outcome(classified, enrich(passed, entity, environment),
                   dead_letters(classified, entity, environment, batch_id), keys, passed, seen, hold is not None)


def split_keyed(rows: DataFrame, entity: str, environment: str = "prod", batch_id: int = 0) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Accepted records, dead letters and summary of a trigger's rows of ``keyed_rows``."""
    good = F.col("reason").isNull()
    won = rows.filter(good & F.col("duplicates").isNull())
    again = decode(won.select(F.base64(F.col("payload").cast("binary")).alias("data"), "arrival_ts"), entity)
    accepted, zero = enrich(again, entity, environment), F.lit(0).cast("long")
    valid, failed = F.count_if(good & F.col("duplicates").isNull()), F.count_if(~good)
    counts = rows.agg((valid + failed + F.coalesce(F.sum("duplicates"), zero)).alias("total"), failed.alias("failed"),
                      valid.alias("valid"), zero.alias("fraud"))
    if entity == "payments":
        counts = counts.withColumn("fraud", accepted.agg(F.count_if("is_fraud_flagged")).scalar())
    return accepted, dead_letters(rows, entity, environment, batch_id), summary_row(
        counts.withColumn("gone", zero), entity, batch_id)


def keyed_rows(stream: DataFrame, entity: str) -> DataFrame:
    """A stream of (data, arrival_ts), validated, its keys' first records found by keyed state: accepted rows, numbers of
    duplicates, and failed rows with their reason."""
    classified = classify(stream, entity)
    passed = classified.filter(F.col("reason").isNull()).select(
        F.col(f"rec.{DEDUP_KEYS[entity]}").alias("key"), "arrival_ts", "payload")
    failed = classified.filter(F.col("reason").isNotNull()).select("payload", "data", "arrival_ts", "reason")
    return keyed.first_wins(passed, DEDUP_TTL).unionByName(failed, allowMissingColumns=True)


def _counted_once(outcome: Outcome, entity: str) -> DataFrame:
    """Counts of a deduplicated batch from one pass: rows a key, of which the first is accepted where the key is not seen.

    Failed records are one group. Partial counts leave the map tasks, so neither they nor a hot key weigh on the shuffle.
    """
    failed = F.col("reason").isNotNull()
    rows = outcome.classified.select(
        failed.alias("bad"), F.when(~failed, F.col(f"rec.{DEDUP_KEYS[entity]}")).alias("key"), "arrival_ts", "payload",
        (F.size(fraud_signals("rec.")) > 0 if entity == "payments" else F.lit(False)).alias("flagged"))
    n, fraud = F.count(F.lit(1)).alias("n"), F.lit(False)
    if entity == "payments":
        # a key is flagged if its first record is
        fraud = F.min(F.struct("arrival_ts", "payload", "flagged"))["flagged"]
    keys = rows.groupBy("bad", "key").agg(n, fraud.alias("flagged"))
    if outcome.seen is not None:
        known = outcome.seen.select("key", F.lit(True).alias("known")).distinct()
        keys = keys.join(known, "key", "left")
    else:
        keys = keys.withColumn("known", F.lit(None).cast("boolean"))
    new = ~F.col("bad") & F.col("known").isNull()
    total = F.coalesce(F.sum("n"), F.lit(0)).alias("total")
    return keys.agg(total, F.coalesce(F.sum(F.when(F.col("bad"), F.col("n"))), F.lit(0)).alias("failed"),
                    F.count_if(new).alias("valid"), F.count_if(new & F.col("flagged")).alias("fraud"))


def batch_summary(outcome: Outcome, entity: str, batch_id: int = 0) -> DataFrame:
    """total / valid / failed / duplicate / fraud-flagged counts and the failure rate, as one row."""
    zero = F.lit(0).cast("long")
    total, failed = F.count(F.lit(1)).alias("total"), F.count_if(F.col("reason").isNotNull()).alias("failed")
    if outcome.keys is None:
        # nothing is dropped after validation, so the classified batch tells everything in one pass
        passed = F.col("reason").isNull()
        gone = F.count_if(passed & (F.col("rec.action") == "cart_abandoned")) if entity == "carts" else zero
        s = outcome.classified.agg(total, failed, F.count_if(passed).alias("valid"), gone.alias("gone")).withColumn("fraud", zero)
    elif outcome.held:
        # the accepted records are at hand
        fraud = F.count_if("is_fraud_flagged") if entity == "payments" else zero
        seen = outcome.classified.agg(total, failed).select("total", "failed", zero.alias("valid"), zero.alias("fraud"))
        kept = outcome.accepted.agg(F.count(F.lit(1)).alias("valid"), fraud.alias("fraud")).select(
            zero.alias("total"), zero.alias("failed"), "valid", "fraud")
        s = seen.unionByName(kept).agg(*[F.sum(c).alias(c) for c in ("total", "failed", "valid", "fraud")]).withColumn(
            "gone", zero)
    else:
        s = _counted_once(outcome, entity).withColumn("gone", zero)
    return summary_row(s, entity, batch_id)


def summary_row(counts: DataFrame, entity: str, batch_id: int = 0) -> DataFrame:
    """The summary of a batch from its total, valid, failed, fraud and gone counts."""
    return counts.select(
        F.lit(entity).alias("stream"), F.lit(batch_id).cast("long").alias("batch_id"),
        F.col("total").alias("total_records"), F.col("valid").alias("valid_records"),
        F.col("failed").alias("failed_records"),
        (F.col("total") - F.col("failed") - F.col("valid")).alias("duplicate_records"),
        F.col("fraud").alias("fraud_flagged"), F.col("gone").alias("abandonments"),
        F.coalesce(x.pct("failed", "total"), F.lit(0.0)).alias("failure_rate_pct"))


def failure_alerts(summaries: DataFrame, raised_at: dt.datetime) -> DataFrame:
    """Order and payment batches of at least 10 records with more than 10 % failures."""
    n, bad = F.col("total_records"), F.col("failed_records")
    return summaries.filter(F.col("stream").isin("orders", "payments") & (n >= FAILURE_RATE_MIN_RECORDS)
                            & (bad > n * FAILURE_RATE_ALERT)).select(
        F.lit(raised_at).alias("raised_at"), "stream", F.lit("High failure rate").alias("subject"),
        F.concat(F.lit("Batch "), "batch_id", F.lit(": "), "failed_records", F.lit("/"), "total_records")
        .alias("message")).withColumnRenamed("stream", "source")


def cart_abandonment(carts: DataFrame) -> DataFrame:
    """One message per abandoned cart."""
    body = F.struct("user_id", "session_id", "cart_id", "cart_total",
                    F.col("event_timestamp").alias("abandoned_at"), "country")
    return carts.filter(F.col("action") == "cart_abandoned").select("event_id", F.to_json(body).alias("message"))


# ---- dead letters --------------------------------------------------------------------------

def triage(letters: DataFrame) -> DataFrame:
    """Sort dead letters into recoverable ones (infrastructure trouble) and permanent ones."""
    reason = F.coalesce("reason", F.lit("unknown"))
    recoverable = F.lit(False)
    for text in d.RECOVERABLE_REASONS:
        recoverable = recoverable | reason.contains(text)
    return letters.withColumns({"reason": reason, "stream": F.coalesce("stream", F.lit("unknown")),
                                "disposition": F.when(recoverable, "recoverable").otherwise("permanent")})


def triage_counts(letters: DataFrame) -> DataFrame:
    return triage(letters).groupBy("stream", "disposition").agg(F.count(F.lit(1)).alias("records"))


def triage_alerts(letters: DataFrame, raised_at: dt.datetime) -> DataFrame:
    """One alert per permanent failure, with the start of the record as a reading aid."""
    return triage(letters).filter("disposition = 'permanent'").select(
        F.lit(raised_at).alias("raised_at"), F.lit("dead_letters").alias("source"),
        F.concat(F.lit("Permanent failure in "), "stream").alias("subject"),
        F.concat(F.lit("Reason: "), "reason", F.lit("\nRecord: "), F.substring("original_record", 1, 500)).alias("message"))


def redrive(letters: DataFrame, stream: str) -> DataFrame:
    """Recoverable records of a stream in the input layout of ``classify``, to be fed in again."""
    return triage(letters).filter((F.col("disposition") == "recoverable") & (F.col("stream") == stream)).select(
        F.base64(F.col("original_record").cast("binary")).alias("data"), F.col("failed_at").alias("arrival_ts"))
