import datetime as dt

import pytest
from pyspark.sql import functions as F

from tillstream.functions.schemas import WIRE, struct_of
from tillstream.operators import dq

NOW = dt.datetime(2024, 1, 10)
ITEM = dict(product_id="PRD-1", product_name="n", quantity=1, unit_price=1.0, final_price=1.0)
ORDER = dict(event_id="EVT-1", event_type="order_placed", event_timestamp="2024-01-06T09:00:00+00:00", order_id="ORD-1",
             user_id="USR-1", session_id="SES-1", total_amount=99.0, currency="USD", order_status="confirmed", items=[ITEM])


def frame(spark, *records):
    schema = struct_of(WIRE["orders"])
    return spark.createDataFrame([[r.get(f.name) for f in schema.fields] for r in records], schema)


def report(spark, **change):
    r = dq.validate(frame(spark, {**ORDER, **change}), "orders", NOW).first()
    return r, {x.check_name: x for x in r.dq_results if x.status == "FAIL"}


def test_valid_order(spark):
    r, failed = report(spark)
    assert (r.dq_status, r.dq_score, r.dq_total_checks, r.dq_record_id) == ("PASS", 1.0, 16, "ORD-1") and not failed


@pytest.mark.parametrize("change,check,status", [
    ({"order_id": None}, "not_null.order_id", "CRITICAL"), ({"order_id": ""}, "not_null.order_id", "CRITICAL"),
    ({"total_amount": -50.0}, "positive.total_amount", "CRITICAL"),
    ({"total_amount": 99999.99}, "max_value.total_amount", "FAIL"), ({"currency": "XYZ"}, "valid_enum.currency", "FAIL"),
    ({"items": []}, "order_items_not_empty", "CRITICAL"), ({"items": [ITEM] * 101}, "order_items_max", "FAIL"),
    ({"event_timestamp": "not-a-date"}, "valid_timestamp.event_timestamp", "FAIL"),
    ({"event_timestamp": "2024-01-10T00:02:00Z"}, "no_future.event_timestamp", "FAIL"),
    ({"order_id": "BAD-1"}, "format.order_id", "FAIL"), ({"session_id": None}, "not_null.session_id", "FAIL")])
def test_one_defect(spark, change, check, status):
    r, failed = report(spark, **change)
    assert check in failed and r.dq_status == status
    assert 0 < r.dq_score < 1 and r.dq_passed + r.dq_failed == 16


def test_future_tolerance_and_limit_edges(spark):
    assert report(spark, event_timestamp="2024-01-10T00:01:00Z")[0].dq_status == "PASS"
    assert report(spark, total_amount=50000.0)[0].dq_status == "PASS"


def test_a_check_that_cannot_run_fails_high(spark):
    r, failed = report(spark, items=None)
    assert failed["order_items_max"].severity == "HIGH"
    assert r.dq_warnings == 0


def test_batch_summary(spark):
    df = frame(spark, *[{**ORDER, "order_id": f"ORD-{i}"} for i in range(4)], {**ORDER, "total_amount": -1.0})
    s = dq.summary(df, "orders", NOW).first()
    assert (s.total_records, s.passed_records, s.failed_records, s.critical_failures, s.pass_rate_pct, s.alert) == (5, 4, 1, 1, 80.0, True)
    assert dq.check_failures(df, "orders", NOW).collect()[0].check_name == "positive.total_amount"
    assert [r.category for r in dq.check_failures(df, "orders", NOW, by="category").collect()] == ["validity"]
    assert {m.metric: m.value for m in dq.metrics(dq.summary(df, "orders", NOW), NOW).collect()}["PassRate"] == 80.0
    assert dq.alerts(dq.summary(df, "orders", NOW), NOW).count() == 1
    alert = dq.alerts(dq.summary(df, "orders", NOW), NOW, dq.check_failures(df, "orders", NOW)).first()
    assert alert.message == "Failed records: 1/5 (20.0%); worst checks: positive.total_amount=1"
    v = dq.validate(df, "orders", NOW)
    assert dq.records_by_status(v, True).count() == 4 and dq.records_by_status(v, False).count() == 1
    assert '"overall_status"' not in dq.report_json(v, "orders").first().report


def test_empty_batch(spark):
    s = dq.summary(frame(spark, ORDER).filter("false"), "orders", NOW).first()
    assert (s.total_records, s.pass_rate_pct, s.avg_quality_score, s.alert) == (0, 0.0, 0.0, False)


def test_unknown_entity_and_own_checks(spark):
    with pytest.raises(ValueError):
        dq.check_set("carts", NOW)
    own = [dq.DQCheck("even_total", dq.LOW, "custom", F.col("total_amount") % 2 == 0)]
    r = dq.validate(frame(spark, ORDER), "orders", NOW, own).first()
    assert (r.dq_status, r.dq_warnings, r.dq_results[0].message) == ("FAIL", 1, "Check failed")


def test_each_check_is_evaluated_once(spark):
    marks = [dq.DQCheck(f"c{i}", dq.HIGH, "custom", F.col("total_amount") != 7000 + i) for i in range(70)]
    df = frame(spark, ORDER, {**ORDER, "total_amount": 7069.0}, {**ORDER, "total_amount": None})
    profile = dq.profile(df, "orders", NOW, marks)
    plan = profile._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("7069.0") == 1
    r = profile.first()
    assert (r.total_records, r.passed_records) == (3, 1)
    # the record without a total fails every check, the one of 7069 the last
    assert [f.failures for f in r.check_failures] == [1] * 69 + [2]


def test_alerts_from_profiles(spark):
    df = frame(spark, *[{**ORDER, "order_id": f"ORD-{i}"} for i in range(4)], {**ORDER, "total_amount": -1.0})
    one = dq.alerts(dq.summary(df, "orders", NOW), NOW, dq.check_failures(df, "orders", NOW)).collect()
    assert dq.profile_alerts(dq.profile(df, "orders", NOW), NOW).collect() == one
    assert dq.profile_alerts(dq.profile(df.filter("false"), "orders", NOW), NOW).collect() == []
