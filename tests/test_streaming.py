import base64
import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from tillstream.operators import dq
from tillstream.plans import jobs as batch_jobs
from tillstream.sources import lake, payloads, snapshots, stage
from tillstream.streaming import ingest, jobs, windows

T0 = dt.datetime(2024, 1, 6, 9)
ORDER = dict(event_id="EVT-1", event_type="order_placed", event_timestamp="2024-01-06T08:00:00+00:00", session_id="SES-1",
             user_id="USR-1", order_id="ORD-1", total_amount=120.5, subtotal=100.0, payment_method="paypal", currency="USD",
             country="US", items=[dict(product_id="PRD-1", quantity=1, final_price=100.0)] * 2)


def b64(value):
    return base64.b64encode((value if isinstance(value, str) else json.dumps(value)).encode()).decode()


def batch(spark, *records, at=T0):
    return spark.createDataFrame([(b64(r) if not isinstance(r, bytes) else r.decode(), at) for r in records],
                                 "data string, arrival_ts timestamp")


def reason(spark, record, entity="orders"):
    return ingest.classify(batch(spark, record), entity).first().reason


def without(record, *keys):
    return {k: v for k, v in record.items() if k not in keys}


@pytest.mark.parametrize("record,expected", [
    (ORDER, None), ("this is not json", "JSON decode error"), (b"%%%", "JSON decode error"), ("[1]", "JSON decode error"),
    (without(ORDER, "currency", "items"), "Schema error: Missing required fields: currency, items"),
    ({**ORDER, "user_id": None}, "Schema error: Null values in required fields: user_id"),
    ({**ORDER, "total_amount": -1}, "Business rule: Invalid total_amount: -1"),
    ({**ORDER, "total_amount": "12"}, "Business rule: Invalid total_amount: 12"),
    ({**ORDER, "total_amount": 50000}, None), ({**ORDER, "total_amount": 50001}, "Business rule: Suspiciously high total_amount: 50001"),
    ({**ORDER, "items": []}, "Business rule: Order has no items"),
    ({**ORDER, "items": ORDER["items"] * 51}, "Business rule: Unrealistic item count: 102"),
    ({**ORDER, "currency": "XYZ"}, "Business rule: Unsupported currency: XYZ"),
    ({**ORDER, "event_timestamp": "2024-01-06T08:00:00Z"}, None),
    ({**ORDER, "event_timestamp": "2024-01-06"}, None), ({**ORDER, "event_timestamp": "2024-01-06 08:00:00.5+02:00"}, None),
    *[({**ORDER, "event_timestamp": t}, f"Business rule: Invalid event_timestamp: {t}")
      for t in ("yesterday", "2024", "2024-01", "10:30", "2024-13-06")]])
def test_order_rules(spark, record, expected):
    assert reason(spark, record) == expected


def test_light_validation_of_clicks_and_carts(spark):
    click = dict(event_id="E", session_id="S", user_id=None, page_type="unheard_of", event_timestamp="2024-01-06T08:00:00Z")
    assert reason(spark, click, "clickstream") is None
    assert reason(spark, without(click, "user_id"), "clickstream") == "Missing: user_id"
    cart = dict(event_id="E", session_id="S", user_id="U", cart_id="C", action="cart_viewed", product_id="P", unit_price=2.5,
                quantity=None, event_timestamp="nonsense")
    assert reason(spark, cart, "carts") is None
    assert reason(spark, {**cart, "unit_price": 0}, "carts") == "Invalid unit_price: 0"
    r = ingest.process(ingest.classify(batch(spark, cart), "carts"), "carts").accepted.first()
    assert (r.cart_value, r.hour) == (2.5, 9)
    with pytest.raises(ValueError):
        ingest.classify(batch(spark, cart), "nope")


def test_enrichment_and_first_wins(spark):
    out = ingest.process(ingest.classify(batch(spark, ORDER, ORDER, {**ORDER, "order_id": "ORD-2"}, "x"), "orders"), "orders")
    r = out.accepted.filter("order_id = 'ORD-1'").first()
    assert (r.item_count, r.average_item_value, r.day_of_week, r.is_weekend, r.hour) == (2, 50.0, "Saturday", True, 8)
    assert r.processing_id.startswith("PROC-") and len(r.processing_id) == 13
    s = ingest.batch_summary(out, "orders").first()
    assert (s.total_records, s.valid_records, s.failed_records, s.duplicate_records, s.failure_rate_pct) == (4, 2, 1, 1, 25.0)
    assert ingest.failure_alerts(ingest.batch_summary(out, "orders"), T0).count() == 0


def test_fraud_signals(spark):
    rows = [(6000.0, None, None, "00"), (600.0, None, False, "00"), (400.0, None, False, "00"), (10.0, "fraud_detected", None, "59")]
    df = spark.createDataFrame(rows, "amount double, failure_reason string, is_3ds_authenticated boolean, gateway_response_code string")
    assert [r[0] for r in df.select(ingest.fraud_signals()).collect()] == [
        ["high_value_transaction"], ["no_3ds_high_value"], [], ["gateway_fraud_flag", "suspicious_response_code"]]


def test_triage_and_redrive(spark):
    rows = [("{}", "S3 write failed: x", T0, "orders", "prod", 0), ("y" * 900, "JSON decode error", T0, "orders", "prod", 0),
            ("{}", None, T0, None, "prod", 0)]
    df = spark.createDataFrame(rows, "original_record string, reason string, failed_at timestamp, stream string, environment string, batch_id long")
    assert [(r.stream, r.disposition) for r in ingest.triage(df).collect()] == [
        ("orders", "recoverable"), ("orders", "permanent"), ("unknown", "permanent")]
    assert max(len(r.message) for r in ingest.triage_alerts(df, T0).collect()) < 560
    assert ingest.redrive(df, "orders").first().data == b64("{}")


def three_days(spark, folder, entity):
    return payloads.payloads(spark, folder, entity).filter("arrival_ts < timestamp'2024-01-04'")


def run(spark, tmp, entity):
    q = jobs.start_ingest(jobs.payload_stream(spark, f"{tmp}/in/{entity}", 1), entity, f"{tmp}/lake", f"{tmp}/cp/{entity}")
    q.awaitTermination(300)
    assert q.exception() is None


def test_stream_equals_batch(spark, folder, tmp_path):
    """Files one by one through the stream: the same records as in one static batch, and nothing new on a replay."""
    entity = "payments"
    data = three_days(spark, folder, entity)
    data.orderBy("arrival_ts").repartitionByRange(3, "arrival_ts").write.parquet(f"{tmp_path}/in/{entity}")
    run(spark, tmp_path, entity)
    static = ingest.process(ingest.classify(data, entity), entity)
    got = lake.read_bronze(spark, f"{tmp_path}/lake", entity)
    assert got.filter("_corrupt_record is not null").select("payment_id", "_corrupt_record").collect() == []
    ids = sorted(r.payment_id for r in got.select("payment_id").collect())
    assert ids == sorted(r.payment_id for r in static.accepted.select("payment_id").collect())
    total = spark.read.parquet(f"{tmp_path}/lake/summaries/{entity}").agg(
        *[F.sum(c).alias(c) for c in ("total_records", "valid_records", "failed_records", "duplicate_records")]).first()
    want = ingest.batch_summary(static, entity).first()
    assert tuple(total) == (want.total_records, want.valid_records, want.failed_records, want.duplicate_records)
    assert total.total_records == total.valid_records + total.failed_records + total.duplicate_records
    assert jobs.read_letters(spark, f"{tmp_path}/lake", entity).count() == want.failed_records

    # a replayed batch replaces its own output; the same records in a later batch are duplicates
    first = spark.read.parquet(f"{tmp_path}/in/{entity}/part-00000*")
    before = len(ids)
    jobs.process_batch(first, 0, entity, f"{tmp_path}/lake")
    assert lake.read_bronze(spark, f"{tmp_path}/lake", entity).count() == before
    jobs.process_batch(first, 99, entity, f"{tmp_path}/lake")
    assert lake.read_bronze(spark, f"{tmp_path}/lake", entity).count() == before
    q = jobs.start_triage(spark, f"{tmp_path}/lake", entity, f"{tmp_path}/cp/triage")
    q.awaitTermination(120)
    assert spark.read.parquet(f"{tmp_path}/lake/triage/{entity}").agg(F.sum("records")).first()[0] >= want.failed_records


@pytest.mark.parametrize("entity", ["orders", "payments"])
def test_summary_reads_a_batch_once(spark, folder, tmp_path, entity):
    data = three_days(spark, folder, entity)
    data.write.parquet(f"{tmp_path}/in")
    classified = ingest.classify(spark.read.parquet(f"{tmp_path}/in"), entity)
    seen = ingest.process(classified, entity).keys.filter("crc32(cast(key as binary)) % 3 = 0")
    plain = ingest.process(classified, entity)
    plan = ingest.batch_summary(plain, entity)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1
    for known in (None, seen):
        out = ingest.process(classified, entity, known)
        got, kept = ingest.batch_summary(out, entity).first(), out.accepted
        assert got.valid_records == kept.count() and got.failed_records == out.failed.count()
        assert got.total_records == data.count()
        if entity == "payments":
            assert got.fraud_flagged == kept.filter("is_fraud_flagged").count()
    empty = ingest.process(classified.filter("false"), entity)
    assert ingest.batch_summary(empty, entity).first().total_records == 0


def test_key_expires_after_a_day(spark, tmp_path):
    lakes = f"{tmp_path}/lake"
    for i, hours in enumerate([0, 23, 25]):
        jobs.process_batch(batch(spark, ORDER, at=T0 + dt.timedelta(hours=hours)), i, "orders", lakes)
    got = spark.read.parquet(f"{lakes}/summaries/orders").orderBy("batch_id").collect()
    assert [(r.valid_records, r.duplicate_records) for r in got] == [(1, 0), (0, 1), (1, 0)]


RECORDS = {
    "orders": [{**ORDER, "event_id": f"EVT-{i}", "order_id": f"ORD-{i}"} for i in range(4)],
    "payments": [dict(event_id=f"EVT-{i}", payment_id=f"PAY-{i}", order_id="ORD-1", user_id="USR-1", amount=10.0, currency="USD",
                      payment_status="success", payment_method="paypal", event_timestamp="2024-01-06T08:00:00Z") for i in range(4)],
    "clickstream": [dict(event_id=f"EVT-{i}", session_id="S", user_id="U", page_type="home",
                         event_timestamp="2024-01-06T08:00:00Z") for i in range(4)],
    "carts": [dict(event_id=f"EVT-{i}", session_id="S", user_id="U", cart_id="C", action="item_added", product_id="P", unit_price=2.5,
                   quantity=1, event_timestamp="2024-01-06T08:00:00Z") for i in range(4)]}


@pytest.mark.parametrize("entity", ingest.ENTITIES)
def test_a_new_checkpoint_loses_nothing(spark, tmp_path, entity):
    """Started anew, batches count from 0 again: the old output stays, known orders and payments are still known."""
    lakes, records = f"{tmp_path}/lake", RECORDS[entity]
    for n, part in enumerate([records[:2], records[1:]]):
        batch(spark, *part).coalesce(1).write.parquet(f"{tmp_path}/in{n}")
        for _ in range(2):  # the second start with the same checkpoint finds nothing new
            q = jobs.start_ingest(jobs.payload_stream(spark, f"{tmp_path}/in{n}"), entity, lakes, f"{tmp_path}/cp{n}")
            q.awaitTermination(120)
            assert q.exception() is None
    ids = sorted(r.event_id for r in lake.read_bronze(spark, lakes, entity).select("event_id").collect())
    twice = [] if entity in ingest.DEDUP_KEYS else ["EVT-1"]
    assert ids == sorted(["EVT-0", "EVT-1", "EVT-2", "EVT-3"] + twice)
    assert spark.read.parquet(f"{lakes}/summaries/{entity}").agg(F.sum("total_records")).first()[0] == 5


def test_key_folders_opened_do_not_grow(spark, tmp_path):
    lakes, opened = f"{tmp_path}/lake", []
    for day in range(4):
        at = T0 + dt.timedelta(days=day)
        jobs.process_batch(batch(spark, {**ORDER, "order_id": f"ORD-{day}"}, at=at), day, "orders", lakes)
        near = (at.date() - dt.timedelta(days=1), at.date() + dt.timedelta(days=1))
        opened.append(len(jobs.seen_keys(spark, lakes, "orders", at, at, near, "other", 0).inputFiles()))
    assert opened == [1, 2, 2, 2]
    assert jobs.expire_keys(spark, lakes, "orders", T0 + dt.timedelta(days=3)) == ["seen_date=2024-01-06", "seen_date=2024-01-07"]
    assert spark.read.parquet(f"{lakes}/keys/orders").count() == 2


def test_redrive_ends_in_bronze_once(spark, tmp_path):
    lakes = f"{tmp_path}/lake"
    letter = [(json.dumps(ORDER), "S3 write failed: x", T0, "orders", "prod", dt.date(2024, 1, 6))]
    letter = spark.createDataFrame(letter, "original_record string, reason string, failed_at timestamp, stream string, environment string, "
                                   "failed_date date")
    for again in range(2):
        for batch_id in (0, 0):  # a batch that is replayed is not read twice
            snapshots.append(spark, jobs.letters_path(lakes, "orders"), letter, ["failed_date"], "run-0", batch_id)
        if again:
            jobs.start_triage(spark, lakes, "orders", f"{tmp_path}/cp/triage2").awaitTermination(120)
        jobs.start_triage(spark, lakes, "orders", f"{tmp_path}/cp/triage").awaitTermination(120)
        q = jobs.start_redrive(spark, lakes, "orders", f"{tmp_path}/cp/redrive")
        q.awaitTermination(120)
        assert q.exception() is None
    assert [r.order_id for r in lake.read_bronze(spark, lakes, "orders").select("order_id").collect()] == ["ORD-1"]
    assert jobs.read_letters(spark, lakes, "orders").count() == 1


def test_state_store_dedup(spark, tmp_path):
    rows = [("a", T0), ("a", T0), ("b", T0)]
    spark.createDataFrame(rows, "k string, arrival_ts timestamp").write.parquet(f"{tmp_path}/in")
    s = spark.readStream.schema("k string, arrival_ts timestamp").parquet(f"{tmp_path}/in")
    q = (jobs.dedup_stream(s, "k").writeStream.format("parquet").option("path", f"{tmp_path}/out")
         .option("checkpointLocation", f"{tmp_path}/cp").trigger(availableNow=True).start())
    q.awaitTermination(120)
    assert sorted(r.k for r in spark.read.parquet(f"{tmp_path}/out").collect()) == ["a", "b"]


def test_windows_stream_equals_batch(spark, tmp_path):
    rows = [("e%d" % i, "s%d" % (i % 3), "u", "mobile", "home", i % 2 == 0, T0 + dt.timedelta(seconds=20 * i)) for i in range(12)]
    cols = "event_id string, session_id string, user_id string, device_type string, page_type string, is_bounce boolean, event_timestamp timestamp"
    df = spark.createDataFrame(rows, cols)
    df.write.parquet(f"{tmp_path}/in")
    stream = windows.active_users_series(spark.readStream.schema(cols).parquet(f"{tmp_path}/in"), "10 minutes")
    q = stream.writeStream.format("memory").queryName("active_now").outputMode("update").trigger(availableNow=True).option(
        "checkpointLocation", f"{tmp_path}/cp").start()
    q.awaitTermination(120)
    want = windows.active_users_series(df).collect()
    assert sorted(spark.table("active_now").collect()) == sorted(want) and len(want) == 4
    assert windows.events_per_minute(df).agg(F.sum("events")).first()[0] == 12


def test_whole_pipeline_and_reruns(spark, folder, tmp_path):
    """Payloads -> bronze -> silver -> gold -> warehouse; repeating the batch jobs changes nothing."""
    root, run_ts = f"{tmp_path}/lake", dt.datetime(2024, 2, 1)
    for entity in ingest.ENTITIES:
        jobs.process_batch(three_days(spark, folder, entity), 0, entity, root)
    for _ in range(2):
        assert sorted(batch_jobs.bronze_to_silver(spark, root, None, run_ts)) == sorted(ingest.ENTITIES)
        batch_jobs.silver_to_gold(spark, root, None, run_ts)
    counts = {n: lake.read_gold(spark, root, n).count() for n in ("fact_orders", "fact_payments", "fact_clickstream")}
    assert counts["fact_orders"] == lake.read_silver(spark, root, "orders").count()
    assert counts["fact_clickstream"] == lake.read_silver(spark, root, "clickstream").count()

    # one day again: the other days stay
    day = dt.date(2024, 1, 2)
    batch_jobs.bronze_to_silver(spark, root, day, run_ts)
    batch_jobs.silver_to_gold(spark, root, day, run_ts)
    assert {n: lake.read_gold(spark, root, n).count() for n in counts} == counts
    plan = lake.read_silver(spark, root, "orders", day)._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(year" in plan

    for _ in range(2):
        result = json.loads(batch_jobs.full_load(spark, root, run_ts).first().result)
        assert result["status"] == "SUCCESS"
        from tillstream.functions.schemas import WAREHOUSE
        fact = lake.read_version(spark, f"{root}/warehouse/fact_orders", WAREHOUSE["fact_orders"])
        assert fact.count() == counts["fact_orders"]
        assert fact.filter("date_key is null or order_total is null or device_sk is null").count() == 0
    for checkpoint in ("cp", "cp", "cp2"):  # started again, and with a new checkpoint
        q = stage.start_stage(spark, root, "fact_payments", run_ts, f"{tmp_path}/{checkpoint}", max_versions=1)
        q.awaitTermination(120)
        assert q.exception() is None
        staged = snapshots.read(spark, f"{root}/stage/fact_payments")
        assert (staged.count(), staged.select("payment_id").distinct().count()) == (counts["fact_payments"],) * 2
    snapshots.publish(spark, "silver_orders_t", f"{root}/silver/orders")
    assert spark.table("silver_orders_t").count() == counts["fact_orders"]
    spark.sql("DROP TABLE silver_orders_t")
    assert batch_jobs.refresh(spark, root, "fact_orders", day).count() <= counts["fact_orders"]


@pytest.mark.parametrize("runs", [(1, 2, 1), (2, 1)])
def test_silver_does_not_depend_on_the_order_of_runs(spark, tmp_path, runs):
    """Order 1 is sent again on the next day and moves there, alone on its first day; order 2 stays; order 3 is late."""
    root, run_ts, first = f"{tmp_path}/lake", dt.datetime(2024, 2, 1), dt.date(2024, 1, 6)

    def sent(n, day, status="placed"):
        return {**ORDER, "event_id": f"EVT-{n}-{day}", "order_id": f"ORD-{n}", "order_status": status,
                "event_timestamp": f"2024-01-0{day}T08:00:00+00:00"}

    days = {1: [sent(1, 6), sent(2, 5)], 2: [sent(1, 7, "completed"), sent(3, 5)]}
    for n, records in days.items():
        at = T0 + dt.timedelta(days=n - 1)
        accepted = ingest.process(ingest.classify(batch(spark, *records, at=at), "orders"), "orders").accepted
        lake.write_bronze(accepted, root, "orders", n)
        for entity in ("clickstream", "carts", "payments"):
            click = batch(spark, *RECORDS[entity][:1], at=at)
            lake.write_bronze(ingest.process(ingest.classify(click, entity), entity).accepted, root, entity, n)
    for n in runs:
        opened = lake.read_bronze(spark, root, "orders", first + dt.timedelta(days=n - 1))
        assert {r.ingest_day for r in opened.select("ingest_day").collect()} == {5 + n}
        changed = batch_jobs.daily(spark, root, first + dt.timedelta(days=n - 1), run_ts)
        assert changed >= {dt.date(2024, 1, 5)}
    silver_rows = {(r.order_id, r.day, r.order_status) for r in lake.read_silver(spark, root, "orders").collect()}
    assert silver_rows == {("ORD-1", 7, "completed"), ("ORD-2", 5, "placed"), ("ORD-3", 5, "placed")}
    facts = lake.read_gold(spark, root, "fact_orders")
    assert sorted((r.order_id, r.day) for r in facts.collect()) == [("ORD-1", 7), ("ORD-2", 5), ("ORD-3", 5)]
    revenue = lake.read_gold(spark, root, "agg_daily_revenue").groupBy("day").agg(F.sum("total_orders").alias("n")).collect()
    assert {r.day: r.n for r in revenue} == {5: 2, 7: 1}


def test_unreadable_lines_are_set_aside(spark, tmp_path):
    root, day = f"{tmp_path}/lake", dt.date(2024, 1, 6)
    lake.write_bronze(ingest.process(ingest.classify(batch(spark, ORDER), "orders"), "orders").accepted, root, "orders", 0)
    at = f"{root}/bronze/orders/ingest_year=2024/ingest_month=1/ingest_day=6/ingest_hour=9/run_id=r/batch_id=9"
    spark.createDataFrame([('{"order_id": "ORD-9", "event_id": ',), ("no json",)], "value string").coalesce(1).write.text(at)
    for _ in range(2):
        batch_jobs.bronze_to_silver(spark, root, day, dt.datetime(2024, 2, 1), ["orders"])
        kept = snapshots.read(spark, f"{root}/corrupt/orders")
        assert sorted(r.line for r in kept.collect()) == ["no json", '{"order_id": "ORD-9", "event_id": ']
    assert lake.read_silver(spark, root, "orders").count() == 1


def lake_of(spark, tmp_path, days):
    """Silver orders of some days, n a day, written straight."""
    root = f"{tmp_path}/lake"
    for entity in ingest.ENTITIES:
        records = [{**r, "event_timestamp": f"2024-01-{d:02d}T08:00:00+00:00", "event_id": f"{r['event_id']}-{d}",
                    **({"order_id": f"{r['order_id']}-{d}", "order_status": "placed"} if entity == "orders" else {}),
                    **({"payment_id": f"{r['payment_id']}-{d}"} if entity == "payments" else {})}
                   for d in days for r in RECORDS[entity]]
        lake.write_bronze(ingest.process(ingest.classify(batch(spark, *records), entity), entity).accepted, root, entity, 0)
    batch_jobs.bronze_to_silver(spark, root, None, dt.datetime(2024, 2, 1))
    batch_jobs.silver_to_gold(spark, root, None, dt.datetime(2024, 2, 1))
    return root


def test_loads_take_what_changed(spark, tmp_path):
    """A day of gold is written anew, one of its orders changed: the stage has every row once, the warehouse rewrites one day."""
    root, run_ts = lake_of(spark, tmp_path, [1, 2, 3, 4]), dt.datetime(2024, 2, 1)
    batch_jobs.full_load(spark, root, run_ts)
    stage.start_stage(spark, root, "fact_orders", run_ts, f"{tmp_path}/cp").awaitTermination(120)
    first = snapshots.load(spark, f"{root}/warehouse/fact_orders")
    facts = lake.read_gold(spark, root, "fact_orders", dt.date(2024, 1, 2))
    changed = facts.withColumn("order_status", F.when(F.col("order_id") == "ORD-1-2", "cancelled").otherwise(F.col("order_status")))
    lake.write_gold(changed, root, "fact_orders", lake.DAY, dt.date(2024, 1, 2))
    assert [r.order_id for r in stage.stage_load(spark, root, "fact_orders", run_ts, 1).collect()] == ["ORD-1-2"]

    later = dt.datetime(2024, 2, 2)
    batch_jobs.full_load(spark, root, later)
    second = snapshots.load(spark, f"{root}/warehouse/fact_orders")
    assert {p for p in second.parts if second.parts[p] != first.parts[p]} == {"date_key=20240102"}
    fact = snapshots.read(spark, f"{root}/warehouse/fact_orders")
    assert {(r.order_id, r.order_status) for r in fact.filter(F.col("loaded_at") == F.lit(later)).collect()} == {("ORD-1-2", "cancelled")}
    feed = snapshots.changes(spark, f"{root}/warehouse/fact_orders", first.version).collect()
    assert [(r.change, r.order_id) for r in feed] == [("update", "ORD-1-2")]
    report = snapshots.load(spark, f"{root}/warehouse/rpt_daily_revenue")
    from tillstream.plans import views
    key = lambda r: tuple(map(str, r))
    columns = sorted(views.rpt_daily_revenue(fact).columns)
    assert sorted(map(key, snapshots.read(spark, f"{root}/warehouse/rpt_daily_revenue").select(*columns).collect())) == sorted(
        map(key, views.rpt_daily_revenue(fact).select(*columns).collect()))
    batch_jobs.full_load(spark, root, later)  # nothing new
    assert snapshots.load(spark, f"{root}/warehouse/fact_orders") == second
    assert snapshots.load(spark, f"{root}/warehouse/rpt_daily_revenue") == report

    for checkpoint in ("cp", "other"):
        q = stage.start_stage(spark, root, "fact_orders", run_ts, f"{tmp_path}/{checkpoint}")
        q.awaitTermination(120)
        staged = snapshots.read(spark, f"{root}/stage/fact_orders")
        assert staged.count() == 16 and staged.select("order_id").distinct().count() == 16
        assert staged.filter("order_status = 'cancelled'").count() == 1
    assert lake.vacuum(spark, root, 1, -10) > 0 and snapshots.read(spark, f"{root}/warehouse/fact_orders").count() == 16


def test_refresh_reads_its_window(spark, tmp_path):
    root = lake_of(spark, tmp_path, [1, 2, 3, 4, 5, 6])
    path, days = f"{root}/bi/fact_orders", lambda df: {r.day: r.n for r in df.groupBy("day").agg(F.count("*").alias("n")).collect()}
    got = batch_jobs.refresh(spark, root, "fact_orders", dt.date(2024, 1, 4), refresh_days=2, archive_days=4)
    assert days(got) == {1: 4, 2: 4, 3: 4, 4: 4}
    before = snapshots.load(spark, path)
    for day in (1, 2, 4):  # gold loses a row on each of these days
        rows = lake.read_gold(spark, root, "fact_orders", dt.date(2024, 1, day)).filter(f"order_id <> 'ORD-0-{day}'")
        lake.write_gold(rows, root, "fact_orders", lake.DAY, dt.date(2024, 1, day))
    got = batch_jobs.refresh(spark, root, "fact_orders", dt.date(2024, 1, 5), refresh_days=2, archive_days=4)
    assert days(got) == {2: 4, 3: 4, 4: 3, 5: 4}  # 1 left the archive, 2 is behind the window, 4 was read anew, 5 is new
    after = snapshots.load(spark, path)
    assert {p for p in after.parts if after.parts[p] == before.parts.get(p)} == {f"year=2024/month=1/day={d}" for d in (2, 3)}
    assert set(after.changed) == {f"year=2024/month=1/day={d}" for d in (1, 4, 5)}
    assert batch_jobs.refresh(spark, root, "fact_orders", dt.date(2024, 1, 5), refresh_days=2, archive_days=4).count() == 15
    assert days(batch_jobs.refresh(spark, root, "fact_orders", dt.date(2024, 1, 5), 2, 5)) == {1: 3, 2: 4, 3: 4, 4: 3, 5: 4}


def test_days_of_keys_with_and_without_an_index(spark, tmp_path):
    rows = spark.createDataFrame([("a", 2024, 1, 1), ("b", 2024, 1, 2), ("c", None, None, None)], "k string, year int, month int, day int")
    keys = spark.createDataFrame([("b",), ("c",), ("x",)], "k string")
    assert lake.known_days(spark, f"{tmp_path}", "orders", keys, "k") is None
    for key in (None, "k"):
        lake.write_silver(rows, f"{tmp_path}", "orders", None, key)
        assert lake.known_days(spark, f"{tmp_path}", "orders", keys, "k") == {dt.date(2024, 1, 2), None}


def test_files_that_cannot_be_read_are_told(spark, tmp_path):
    root = lake_of(spark, tmp_path, [1, 2])
    file = lake.read_gold(spark, root, "fact_payments", dt.date(2024, 1, 2)).inputFiles()[0]
    assert stage.skipped_files(spark, root, "fact_payments").count() == 0
    with open(file.removeprefix("file://"), "wb") as f:
        f.write(b"damaged" * 100)
    crc = os.path.join(os.path.dirname(file.removeprefix("file://")), f".{os.path.basename(file)}.crc")
    if os.path.exists(crc):
        os.truncate(crc, 0)
    assert stage.stage_load(spark, root, "fact_payments", T0).count() == 4
    assert [r.file.rsplit("/", 1)[1] for r in stage.skipped_files(spark, root, "fact_payments").collect()] == [os.path.basename(file)]


def test_missing_bronze_is_empty(spark, tmp_path):
    assert lake.read_bronze(spark, str(tmp_path), "orders").isEmpty()
    assert batch_jobs.bronze_to_silver(spark, str(tmp_path), None, T0) == {}
    assert dq.CHECK_SETS.keys() == {"orders", "payments", "clickstream"}
