"""Column expressions shared by the jobs and queries. All stay inside JVM code generation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tillstream.functions import domains as d


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


# ---- numbers -------------------------------------------------------------------------------

def rnd(col, digits: int) -> Column:
    """Half-up rounding through a decimal, so binary noise below 1e-8 cannot flip a tie."""
    return F.round(_c(col).cast("decimal(28,8)"), digits).cast("double")


def units(col, digits: int = 2) -> Column:
    """A fixed-point value as a whole number of its smallest unit (money -> cents).

    ``floor(v + 0.5)`` is one machine operation; ``round`` on a double goes through a BigDecimal per row. The input has
    no more than ``digits`` decimals, so there are no ties that the two could treat differently.
    """
    return F.floor(_c(col) * F.lit(float(10 ** digits)) + F.lit(0.5))


def fixed_sum(col, digits: int = 2) -> Column:
    """Sum of a fixed-point double over whole units: exact, order-free, and a plain long in the hash map."""
    return F.sum(units(col, digits)) / F.lit(float(10 ** digits))


def fixed_sum_of(plus, minus, digits: int = 2) -> Column:
    """sum(plus) - sum(minus), exact like ``fixed_sum``."""
    return (F.sum(units(plus, digits)) - F.sum(units(minus, digits))) / F.lit(float(10 ** digits))


def fixed_avg(col, digits: int = 2, scale: int = 2) -> Column:
    """Mean of a fixed-point double, rounded to ``digits``."""
    col = _c(col)
    return rnd(fixed_sum(col, scale) / F.nullif(F.count(col), F.lit(0)), digits)


def fixed_avg_of(total, n, digits: int = 2, scale: int = 2) -> Column:
    """``fixed_avg`` of a sum in whole units and the number of its values."""
    return rnd(_c(total) / F.lit(float(10 ** scale)) / F.nullif(_c(n), F.lit(0)), digits)


def int_avg(col, digits: int) -> Column:
    col = _c(col)
    return rnd(F.sum(col) / F.nullif(F.count(col), F.lit(0)), digits)


def ratio(num, den, digits: int) -> Column:
    """num / den, null when the denominator is 0 or null."""
    return rnd(_c(num) / F.nullif(_c(den), F.lit(0)), digits)


def pct(num, den, digits: int = 2) -> Column:
    """num as a percentage of den, null when the denominator is 0 or null."""
    return rnd(_c(num) * F.lit(100) / F.nullif(_c(den), F.lit(0)), digits)


def divide_or_zero(num, den) -> Column:
    return F.coalesce(F.try_divide(_c(num), _c(den)), F.lit(0.0))


# ---- time texts and the calendar ------------------------------------------------------------

# Fixed value: a date, or a date and a time of day with optional seconds, fraction and offset
ISO_TIME = r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}(\.\d{1,6})?)?(Z|[+-]\d{2}:\d{2})?)?\z"


def iso_timestamp(col) -> Column:
    """Timestamp of an ISO text, else null. Spark's own parser would also take a bare year, or a time as one of today."""
    text = _c(col).cast("string")
    return F.when(text.rlike(ISO_TIME), F.try_to_timestamp(text))


def calendar_parts(day) -> dict[str, Column]:
    """The columns of the calendar as functions of a date."""
    day = _c(day)
    return {"date_key": date_key(day), "full_date": day.cast("string"), "year": F.year(day), "month": F.month(day),
            "day": F.dayofmonth(day), "week_of_year": F.weekofyear(day), "day_name": F.date_format(day, "EEEE"),
            "month_name": F.date_format(day, "MMMM"), "quarter": F.quarter(day), "is_weekend": is_weekend(day)}


# ---- order, payment, click, cart labels ----------------------------------------------------

def is_completed(status="order_status") -> Column:
    return _c(status).isin(d.COMPLETED_STATUSES)


def hour_bucket(hour) -> Column:
    hour = _c(hour)
    return (F.when(hour.between(0, 5), "late_night").when(hour.between(6, 11), "morning")
            .when(hour.between(12, 17), "afternoon").when(hour.between(18, 21), "evening").otherwise("night"))


def order_value_tier(total="total_amount") -> Column:
    total = _c(total)
    return F.when(total < 50, "low").when(total <= 200, "medium").when(total <= 500, "high").otherwise("premium")


def effective_discount_pct(discount="discount_amount", subtotal="subtotal") -> Column:
    subtotal = _c(subtotal)
    return F.when(subtotal > 0, rnd(_c(discount) * 100 / subtotal, 2)).otherwise(F.lit(0.0))


def payment_amount_tier(amount="amount") -> Column:
    amount = _c(amount)
    return F.when(amount < 50, "micro").when(amount < 200, "small").when(amount < 1000, "medium").otherwise("large")


def processing_tier(ms="processing_time_ms") -> Column:
    ms = _c(ms)
    return F.when(ms < 500, "fast").when(ms < 1500, "normal").otherwise("slow")


def engagement_level(time="time_on_page_seconds", scroll="scroll_depth_pct", bounce="is_bounce") -> Column:
    time, scroll, bounce = _c(time), _c(scroll), _c(bounce)
    return (F.when((time > 120) & (scroll > 70) & ~bounce, "high")
            .when((time > 30) & (scroll > 40), "medium").otherwise("low"))


def engagement_score(time="time_on_page_seconds", scroll="scroll_depth_pct", bounce="is_bounce") -> Column:
    time, scroll, bounce = _c(time), _c(scroll), _c(bounce)
    return (F.when((time > 60) & (scroll > 50) & ~bounce, "high")
            .when((time > 20) | (scroll > 25), "medium").otherwise("low"))


def page_category(page="page_type") -> Column:
    page = _c(page)
    return (F.when(page.isin("home", "category"), "browsing").when(page == "product_detail", "product")
            .when(page == "search_results", "search").when(page.isin("cart", "checkout"), "purchase_funnel")
            .when(page == "order_confirmation", "post_purchase").otherwise("account"))


def device_class(device="device_type") -> Column:
    device = _c(device)
    return F.when(device == "mobile", "smartphone").when(device == "tablet", "tablet").otherwise("computer")


# ---- customer scores -----------------------------------------------------------------------

def churn_risk_score(days) -> Column:
    days = _c(days)
    return (F.when(days > 180, 0.90).when(days > 90, 0.65).when(days > 45, 0.35).when(days > 21, 0.15)
            .otherwise(0.05))


def ltv_score(spend, orders, days) -> Column:
    return rnd(_c(spend) * 0.5 + _c(orders) * 10 + F.when(_c(days) < 30, 100).otherwise(0), 2)


def churn_band(score="churn_risk_score") -> Column:
    score = _c(score)
    return F.when(score >= 0.65, "High").when(score >= 0.35, "Medium").otherwise("Low")


def ltv_band(score="ltv_score") -> Column:
    score = _c(score)
    return F.when(score >= 1000, "Champion").when(score >= 500, "Loyal").when(score >= 200, "Potential").otherwise("New")


def rag_status(actual, target: float) -> Column:
    actual = _c(actual)
    return F.when(actual >= target, "Green").when(actual >= target * 0.8, "Amber").otherwise("Red")


# ---- time ----------------------------------------------------------------------------------

def event_parts(ts) -> dict[str, Column]:
    ts = _c(ts)
    return {"year": F.year(ts), "month": F.month(ts), "day": F.dayofmonth(ts), "hour": F.hour(ts)}


def is_weekend(ts) -> Column:
    return F.dayofweek(_c(ts)).isin(1, 7)


def date_key(ts) -> Column:
    """yyyymmdd as an int."""
    ts = _c(ts)
    return F.year(ts) * 10000 + F.month(ts) * 100 + F.dayofmonth(ts)


def month_diff(later, earlier) -> Column:
    """Calendar-month boundaries crossed."""
    later, earlier = _c(later), _c(earlier)
    return (F.year(later) - F.year(earlier)) * 12 + F.month(later) - F.month(earlier)


def minute_diff(later, earlier) -> Column:
    """Minute boundaries crossed."""
    def minutes(ts):
        return F.floor(F.unix_seconds(ts) / 60)
    return (minutes(_c(later)) - minutes(_c(earlier))).cast("long")


# ---- keys ----------------------------------------------------------------------------------

def surrogate_key(col) -> Column:
    return F.md5(_c(col).cast("string"))


def device_key(device="device_type", os="device_os", browser="browser") -> Column:
    """md5 of the three parts; a missing part stays in its place, so (a, null, c) and (a, c, null) differ."""
    return F.md5(F.concat_ws("|", *[F.coalesce(_c(x), F.lit("")) for x in (device, os, browser)]))


# ---- items ---------------------------------------------------------------------------------

def items_first_category(items="items") -> Column:
    return F.get(_c(items), F.lit(0)).getField("category")


def items_product_count(items="items") -> Column:
    """Items that carry a product id; null for a missing or empty list."""
    items = _c(items)
    return F.when(F.size(items) > 0, F.size(F.filter(items, lambda i: i["product_id"].isNotNull())).cast("long"))


def items_total(items="items") -> Column:
    """Sum of price x quantity; null for a missing or empty list."""
    items = _c(items)
    return F.when(F.size(items) > 0, F.aggregate(
        items, F.lit(0.0), lambda acc, i: acc + F.coalesce(i["final_price"] * i["quantity"], F.lit(0.0))))
