"""Data-quality checks as column expressions.

A check is a name, a severity, a category and a boolean column; ``raises`` marks rows on which the check itself cannot
be evaluated, which counts as a failure of severity HIGH whatever the check declares. A typed frame does not tell an
absent field from an explicit null: both are null here and fail the range checks.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstream.functions import domains as d
from tillstream.functions import exprs as x

CRITICAL, HIGH, MEDIUM, LOW = "CRITICAL", "HIGH", "MEDIUM", "LOW"


@dataclass(frozen=True, eq=False)
class DQCheck:
    name: str
    severity: str
    category: str
    passed: Column
    message: Column | None = None
    raises: Column | None = None
    description: str = ""

    def ok(self) -> Column:
        ok = F.coalesce(self.passed, F.lit(False))
        return ok if self.raises is None else ok & ~self.raises

    def result(self, ok: Column, raised: Column) -> Column:
        """Outcome as a struct, from the two answers of the check."""
        text, severity = F.lit("Check failed") if self.message is None else self.message, F.lit(self.severity)
        if self.raises is not None:
            text = F.when(raised, "Check could not be evaluated").otherwise(text)
            severity = F.when(raised, HIGH).otherwise(severity)
        return F.struct(
            F.lit(self.name).alias("check_name"), F.lit(self.category).alias("category"), severity.alias("severity"),
            F.when(ok, "PASS").otherwise("FAIL").alias("status"), F.when(ok, "OK").otherwise(text).alias("message"))


def _shown(field: str) -> Column:
    return F.coalesce(F.col(field).cast("string"), F.lit("null"))


def not_null(field: str, severity: str = HIGH) -> DQCheck:
    c = F.col(field)
    return DQCheck(f"not_null.{field}", severity, "completeness", c.isNotNull() & (c.cast("string") != ""),
                   F.lit(f"'{field}' is null or empty"))


def positive_number(field: str, severity: str = HIGH) -> DQCheck:
    return DQCheck(f"positive.{field}", severity, "validity", F.col(field).try_cast("double") > 0,
                   F.concat(F.lit(f"'{field}' is not positive: "), _shown(field)))


def max_value(field: str, limit: float, severity: str = MEDIUM) -> DQCheck:
    c = F.col(field)
    return DQCheck(f"max_value.{field}", severity, "validity", c <= limit,
                   F.concat(F.lit(f"'{field}' is above {limit}: "), _shown(field)), c.isNull())


def valid_enum(field: str, allowed: Sequence[str], severity: str = MEDIUM) -> DQCheck:
    return DQCheck(f"valid_enum.{field}", severity, "validity", F.col(field).isin(list(allowed)),
                   F.concat(F.lit(f"'{field}' is not an allowed value: "), _shown(field)))


def _as_ts(field: str) -> Column:
    return x.iso_timestamp(field)


def valid_timestamp(field: str) -> DQCheck:
    return DQCheck(f"valid_timestamp.{field}", HIGH, "validity", _as_ts(field).isNotNull(),
                   F.concat(F.lit(f"'{field}' is not a timestamp: "), _shown(field)))


def no_future_timestamp(field: str, as_of: dt.datetime, tolerance_seconds: int = 60) -> DQCheck:
    """A missing or unreadable timestamp passes; other checks report it."""
    limit = F.lit(as_of + dt.timedelta(seconds=tolerance_seconds))
    return DQCheck(f"no_future.{field}", MEDIUM, "timeliness", _as_ts(field).isNull() | (_as_ts(field) <= limit),
                   F.concat(F.lit(f"'{field}' lies in the future: "), _shown(field)))


def string_format(field: str, prefix: str) -> DQCheck:
    return DQCheck(f"format.{field}", MEDIUM, "consistency", F.col(field).startswith(prefix),
                   F.concat(F.lit(f"'{field}' does not start with '{prefix}': "), _shown(field)))


def order_checks(as_of: dt.datetime) -> list[DQCheck]:
    n = F.size("items")
    return [
        not_null("event_id", CRITICAL), not_null("order_id", CRITICAL), not_null("user_id", CRITICAL),
        not_null("session_id", HIGH), not_null("total_amount", CRITICAL), not_null("currency", HIGH),
        positive_number("total_amount", CRITICAL), max_value("total_amount", d.MAX_ORDER_TOTAL, HIGH),
        valid_enum("currency", d.CURRENCIES), valid_enum("order_status", d.ORDER_STATUSES),
        valid_timestamp("event_timestamp"), no_future_timestamp("event_timestamp", as_of),
        string_format("order_id", "ORD-"), string_format("user_id", "USR-"),
        DQCheck("order_items_not_empty", CRITICAL, "completeness", F.col("items").isNotNull() & (n > 0),
                F.lit("Order has no items")),
        DQCheck("order_items_max", MEDIUM, "validity", n <= d.MAX_ORDER_ITEMS, F.lit("Order has too many items"),
                F.col("items").isNull()),
    ]


def payment_checks(as_of: dt.datetime) -> list[DQCheck]:
    return [
        not_null("payment_id", CRITICAL), not_null("order_id", CRITICAL), not_null("amount", CRITICAL),
        positive_number("amount", CRITICAL), max_value("amount", d.MAX_PAYMENT_AMOUNT, HIGH),
        valid_enum("payment_status", d.PAYMENT_STATUSES, HIGH), valid_timestamp("event_timestamp"),
        string_format("payment_id", "PAY-"),
    ]


def clickstream_checks(as_of: dt.datetime) -> list[DQCheck]:
    t = F.col("time_on_page_seconds")
    return [
        not_null("event_id"), not_null("session_id"), valid_enum("page_type", d.PAGE_TYPES, LOW),
        valid_timestamp("event_timestamp"),
        DQCheck("time_on_page_valid", LOW, "validity", t.between(0, d.MAX_TIME_ON_PAGE),
                F.concat(F.lit("time_on_page_seconds is "), _shown("time_on_page_seconds")), t.isNull()),
    ]


CHECK_SETS: dict[str, Callable[[dt.datetime], list[DQCheck]]] = {
    "orders": order_checks, "payments": payment_checks, "clickstream": clickstream_checks}
RECORD_IDS = {"orders": ["order_id", "event_id"], "payments": ["order_id", "payment_id", "event_id"],
              "clickstream": ["event_id"]}


def check_set(entity: str, as_of: dt.datetime) -> list[DQCheck]:
    if entity not in CHECK_SETS:
        raise ValueError(f"Unknown entity: {entity}. Choose from {sorted(CHECK_SETS)}")
    return CHECK_SETS[entity](as_of)


_WORD = 62  # checks in one mask


def _masked(df: DataFrame, checks: list[DQCheck]) -> DataFrame:
    """Evaluate every check once: bit i of ``_failed`` says that check i failed, of ``_raised`` that it could not be evaluated.

    The masks are longs in arrays, so there may be any number of checks. The one-row generator keeps Spark from spelling the
    checks out again wherever the masks are read.
    """
    def words(condition: Callable[[DQCheck], Column | None]) -> Column:
        out = []
        for at in range(0, max(len(checks), 1), _WORD):
            bits = [F.when(c, F.lit(1 << i)).otherwise(F.lit(0)).cast("long")
                    for i, c in enumerate(map(condition, checks[at:at + _WORD])) if c is not None]
            out.append(reduce(Column.bitwiseOR, bits, F.lit(0).cast("long")))
        return F.array(*out)

    masks = F.struct(words(lambda c: ~c.ok()).alias("_failed"), words(lambda c: c.raises).alias("_raised"))
    return df.select(*df.columns, F.inline(F.array(masks)))


def _bit(mask: str, i: int) -> Column:
    return F.col(mask)[i // _WORD].bitwiseAND(F.lit(1 << i % _WORD).cast("long")) != 0


def _failed_of(checks: list[DQCheck], *severities: str) -> Column:
    """Number of failed checks of some severities. A check that could not be evaluated counts as HIGH."""
    counts = []
    for at in range(0, max(len(checks), 1), _WORD):
        wanted = sum(1 << i for i, c in enumerate(checks[at:at + _WORD]) if c.severity in severities)
        failed, raised = F.col("_failed")[at // _WORD], F.col("_raised")[at // _WORD]
        of_level = failed.bitwiseAND(F.lit(wanted).cast("long")).bitwiseAND(F.bitwise_not(raised))
        counts.append(F.bit_count(of_level) + (F.bit_count(failed.bitwiseAND(raised)) if HIGH in severities else 0))
    return reduce(Column.__add__, counts)


def validate(df: DataFrame, entity: str, as_of: dt.datetime, checks: list[DQCheck] | None = None) -> DataFrame:
    """One report per record. ``dq_results`` holds every check's outcome; unused columns are pruned away."""
    checks = check_set(entity, as_of) if checks is None else checks
    ids = [F.nullif(F.col(c), F.lit("")) for c in RECORD_IDS.get(entity, ["event_id"]) if c in df.columns]
    out = _masked(df, checks).withColumns({
        "dq_record_id": F.coalesce(*ids, F.lit("unknown")), "dq_total_checks": F.lit(len(checks)),
        "dq_failed": _failed_of(checks, CRITICAL, HIGH, MEDIUM, LOW),
        "dq_warnings": _failed_of(checks, LOW, MEDIUM),
        "dq_critical": _failed_of(checks, CRITICAL) > 0,
        "dq_results": F.array(*[c.result(~_bit("_failed", i), _bit("_raised", i)) for i, c in enumerate(checks)])})
    out = out.withColumn("dq_passed", F.col("dq_total_checks") - F.col("dq_failed"))
    return out.withColumns({
        "dq_score": x.rnd(F.col("dq_passed") / F.col("dq_total_checks"), 4),
        "dq_status": F.when(F.col("dq_failed") == 0, "PASS").when(F.col("dq_critical"), "CRITICAL").otherwise("FAIL")})


REPORT = ["dq_record_id", "dq_total_checks", "dq_passed", "dq_failed", "dq_warnings", "dq_status", "dq_score"]


def report_json(validated: DataFrame, entity: str) -> DataFrame:
    """The per-record reports as JSON text."""
    fields = F.struct(F.lit(entity).alias("entity"), *REPORT, F.col("dq_results").alias("results"))
    return validated.select("dq_record_id", F.to_json(fields).alias("report"))


def records_by_status(validated: DataFrame, passed: bool) -> DataFrame:
    """Ids of the valid (or the invalid) records, as a frame."""
    ok = F.col("dq_status") == "PASS"
    return validated.filter(ok if passed else ~ok).select("dq_record_id", "dq_status", "dq_score")


def profile(df: DataFrame, entity: str, as_of: dt.datetime, checks: list[DQCheck] | None = None) -> DataFrame:
    """Totals and failures of every check as one row, from one pass in which each check is evaluated once."""
    checks = check_set(entity, as_of) if checks is None else checks
    failures = [F.count_if(_bit("_failed", i)).alias(f"_c{i}") for i in range(len(checks))]
    totals = validate(df, entity, as_of, checks).agg(
        F.count(F.lit(1)).alias("total_records"), F.count_if(F.col("dq_status") == "PASS").alias("passed_records"),
        F.count_if("dq_critical").alias("critical_failures"), x.fixed_avg("dq_score", 4, 4).alias("avg_quality_score"), *failures)
    rows = F.array(*[F.struct(F.lit(c.name).alias("check_name"), F.lit(c.category).alias("category"),
                              F.col(f"_c{i}").alias("failures")) for i, c in enumerate(checks)])
    return totals.select(F.lit(entity).alias("entity"), "total_records", "passed_records", "critical_failures",
                         "avg_quality_score", rows.alias("check_failures"))


def summary_of(profiles: DataFrame) -> DataFrame:
    """Batch totals of profiles. ``alert`` = more than 10 % of the records failed."""
    n = F.col("total_records")
    return profiles.select(
        "entity", "total_records", "passed_records", (n - F.col("passed_records")).alias("failed_records"),
        "critical_failures", F.coalesce(x.pct("passed_records", n), F.lit(0.0)).alias("pass_rate_pct"),
        F.coalesce("avg_quality_score", F.lit(0.0)).alias("avg_quality_score"),
        F.coalesce((n - F.col("passed_records")) * 10 > n, F.lit(False)).alias("alert"))


def summary(df: DataFrame, entity: str, as_of: dt.datetime, checks: list[DQCheck] | None = None) -> DataFrame:
    """Batch totals in one aggregate pass."""
    return summary_of(profile(df, entity, as_of, checks))


def check_failures(df: DataFrame, entity: str, as_of: dt.datetime, by: str = "check_name",
                   checks: list[DQCheck] | None = None) -> DataFrame:
    """Failures per check (or per ``category``): one counter per check in a single pass, turned into rows afterwards."""
    rows = profile(df, entity, as_of, checks).select("entity", F.inline("check_failures")).filter("failures > 0")
    return rows.groupBy("entity", by).agg(F.sum("failures").alias("failures"))


def top_failures(df: DataFrame, entity: str, as_of: dt.datetime, limit: int = 5) -> DataFrame:
    return check_failures(df, entity, as_of).orderBy(F.col("failures").desc(), "check_name").limit(limit)


def metrics(summaries: DataFrame, measured_at: dt.datetime) -> DataFrame:
    """Summary rows as (measured_at, entity, metric, value)."""
    pairs = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(c).cast("double").alias("value")) for m, c in
                      [("PassRate", "pass_rate_pct"), ("CriticalFailures", "critical_failures"),
                       ("AvgQualityScore", "avg_quality_score")]])
    return summaries.select(F.lit(measured_at).alias("measured_at"), "entity", F.inline(pairs))


def _worst(ordered: Column, worst: int) -> Column:
    return F.array_join(F.transform(F.slice(ordered, 1, worst), lambda c: F.concat(c["check_name"], F.lit("="), -c["n"])), ", ")


def _alert_rows(rows: DataFrame, raised_at: dt.datetime, above_pct: float, worst: Column | None) -> DataFrame:
    rate = F.format_string("%.1f", 100.0 - F.col("pass_rate_pct"))
    text = F.concat(F.lit("Failed records: "), "failed_records", F.lit("/"), "total_records", F.lit(" ("), rate, F.lit("%)"))
    if worst is not None:
        text = F.concat(text, F.lit("; worst checks: "), F.coalesce(worst, F.lit("")))
    return rows.filter(F.col("failed_records") * 100 > F.col("total_records") * above_pct).select(
        F.lit(raised_at).alias("raised_at"), F.lit("dq").alias("source"),
        F.concat(F.lit("High DQ failure rate: "), "entity").alias("subject"), text.alias("message"))


def alerts(summaries: DataFrame, raised_at: dt.datetime, failures: DataFrame | None = None, worst: int = 5,
           above_pct: float = 10.0) -> DataFrame:
    """An alert for each entity of which more than a share of the records fail. With ``failures`` (rows of ``check_failures``, one a check)
    the message names the checks that fail most, the first in alphabetical order where equally often."""
    if failures is None:
        return _alert_rows(summaries, raised_at, above_pct, None)
    ordered = F.sort_array(F.collect_list(F.struct((-F.col("failures")).alias("n"), "check_name")))
    named = failures.groupBy("entity").agg(_worst(ordered, worst).alias("_worst"))
    return _alert_rows(summaries.join(named, "entity", "left"), raised_at, above_pct, F.col("_worst"))


def profile_alerts(profiles: DataFrame, raised_at: dt.datetime, worst: int = 5, above_pct: float = 10.0) -> DataFrame:
    """``alerts`` with the worst checks, from profiles alone: the records are not read a second time."""
    counted = F.filter("check_failures", lambda c: c["failures"] > 0)
    ordered = F.sort_array(F.transform(counted, lambda c: F.struct((-c["failures"]).alias("n"), c["check_name"].alias("check_name"))))
    named = profiles.select("*", _worst(ordered, worst).alias("_worst"))
    rows = named.select("*", (F.col("total_records") - F.col("passed_records")).alias("failed_records"),
                        F.coalesce(x.pct("passed_records", "total_records"), F.lit(0.0)).alias("pass_rate_pct"))
    return _alert_rows(rows, raised_at, above_pct, F.col("_worst"))
