"""Aggregates that are kept as state and take deltas.

A rollup cuts rows to one partial row per key and day: counts and sums, least and greatest values. Partials of a day can be made
without any other day, and partials merge into totals. When days are made anew, a total takes the old partials out and the
new ones in: sums by subtraction, extremes by comparison. Only where a key's extreme was in a partial that is gone, and no
new one is as good, must its other partials be looked at again; such keys are marked as lost.

Defined results: null keys are keys; null values count in no sum and are no extreme; a key whose last row goes is dropped. A greatest
value may be a struct, whose later fields decide ties, nulls last: so the latest row of a key is an extreme like any other.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstream.functions import exprs as x
from tillstream.operators import gold, sketches
from tillstream.operators.ranking import with_rank

DAY = ("year", "month", "day")
ROWS = "rows_n"  # rows behind a partial
LOST = "_lost"


@dataclass(frozen=True)
class Rollup:
    """Columns of the rows to aggregate, by what is kept of them."""
    keys: tuple[str, ...]
    sums: tuple[str, ...] = ()  # of whole numbers
    least: tuple[str, ...] = ()
    most: tuple[str, ...] = ()
    distinct: tuple[str, ...] = ()  # values to count, kept as sketches: they merge, but no partial can be taken out

    @property
    def values(self) -> list[str]:
        return [ROWS, *self.sums, *self.least, *self.most, *self.distinct]

    def partials(self, rows: DataFrame, by: tuple[str, ...] = DAY) -> DataFrame:
        """One row for each key and day."""
        return rows.groupBy(*by, *self.keys).agg(
            F.count(F.lit(1)).alias(ROWS), *[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in self.sums],
            *[F.min(n).alias(n) for n in self.least], *[F.max(n).alias(n) for n in self.most],
            *[sketches.distinct_state(n).alias(n) for n in self.distinct])

    def totals(self, partials: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
        """Partials merged into one row for each key (and ``by``)."""
        return partials.groupBy(*by, *self.keys).agg(
            *[F.sum(n).alias(n) for n in (ROWS, *self.sums)], *[F.min(n).alias(n) for n in self.least],
            *[F.max(n).alias(n) for n in self.most], *[sketches.merged_state(n).alias(n) for n in self.distinct])

    def applied(self, totals: DataFrame, old: DataFrame, new: DataFrame) -> DataFrame:
        """``totals`` after the partials ``old`` were replaced by ``new``, and whether a key is lost. One shuffle, combined in the
        map tasks; the sums of lost keys are right, their extremes are not."""
        if self.distinct:
            raise ValueError("Sketches take no deltas: merge the partials of the range instead")
        sources = {"total": (totals, 1), "old": (old, -1), "new": (new, 1)}
        tagged = [df.select(*self.keys, *[(F.col(n) * sign).alias(n) for n in (ROWS, *self.sums)], *self.least, *self.most,
                            F.lit(tag).alias("_tag")) for tag, (df, sign) in sources.items()]
        ways = {**dict.fromkeys(self.least, F.min), **dict.fromkeys(self.most, F.max)}
        both = tagged[0].unionByName(tagged[1]).unionByName(tagged[2]).groupBy(*self.keys).agg(
            *[F.sum(n).alias(n) for n in (ROWS, *self.sums)],
            *[way(F.when(F.col("_tag") == tag, F.col(n))).alias(f"_{tag}_{n}") for n, way in ways.items() for tag in sources])
        lost, extremes = F.lit(False), []
        for n in ways:
            had, gone, came = (F.col(f"_{tag}_{n}") for tag in sources)
            worse = came > gone if n in self.least else came < gone
            lost = lost | (gone.isNotNull() & gone.eqNullSafe(had) & F.coalesce(worse, F.lit(True)))
            extremes.append((F.least if n in self.least else F.greatest)(had, came).alias(n))
        return both.where(F.col(ROWS) > 0).select(*self.keys, ROWS, *self.sums, *extremes, lost.alias(LOST))

    def repaired(self, applied: DataFrame, partials: Callable[[], DataFrame]) -> DataFrame:
        """``applied`` with its lost keys made anew from all partials."""
        lost = applied.where(LOST).select(F.struct(*self.keys).alias("_key"))
        rows = partials()
        theirs = rows.join(lost, F.struct(*[rows[k] for k in self.keys]).eqNullSafe(F.col("_key")), "left_semi")
        return applied.where(~F.col(LOST)).drop(LOST).unionByName(self.totals(theirs))


# ---- the gold tables that are kept this way -------------------------------------------------

_SEEN = ["country", "city", "device_type", "customer_segment"]
USERS = Rollup(("user_id",), most=("latest",))
PRODUCTS = Rollup(("product_id", "product_name", "category", "brand"), ("prices", "price"), ("lowest",), ("highest",))
DEVICES = Rollup(("device_type", "device_os", "browser"))
SALES = Rollup(PRODUCTS.keys, ("orders", "quantities", "quantity", "paid_n", "paid", "prices", "price", "discounts", "discount"))


ORDER_VALUES = Rollup(("customer_segment", "country", "bucket"))
ACTIVE = Rollup(("device_type",), distinct=("user_id", "session_id"))
QUARTILES = {"aov_p25": 0.25, "aov_median": 0.5, "aov_p75": 0.75, "aov_p95": 0.95}


def user_rows(orders: DataFrame, clicks: DataFrame) -> DataFrame:
    columns = [*DAY, "user_id", *_SEEN, "event_timestamp", "event_id"]
    seen = orders.select(*columns, "is_prime").unionByName(clicks.select(*columns), allowMissingColumns=True)
    return seen.select(*DAY, "user_id", F.struct("event_timestamp", "event_id", "is_prime", *_SEEN).alias("latest"))


def _there(column: Column) -> Column:
    return column.isNotNull().cast("long")


def product_rows(orders: DataFrame) -> DataFrame:
    price = F.col("unit_price")
    return gold.item_rows(orders, None, list(DAY)).select(
        *DAY, *PRODUCTS.keys, _there(price).alias("prices"), x.units(price).alias("price"), price.alias("lowest"), price.alias("highest"))


def sale_rows(orders: DataFrame) -> DataFrame:
    price, discount, quantity = F.col("final_price"), F.col("discount_pct"), F.col("quantity").cast("long")
    paid = x.units(price) * quantity
    return gold.item_rows(orders.filter(x.is_completed()), None, ["order_id", *DAY]).select(
        *DAY, *SALES.keys, _there(F.col("order_id")).alias("orders"), _there(quantity).alias("quantities"), quantity.alias("quantity"),
        _there(paid).alias("paid_n"), paid.alias("paid"), _there(price).alias("prices"), x.units(price).alias("price"),
        _there(discount).alias("discounts"), x.units(discount).alias("discount"))


def dim_users(totals: DataFrame, run_ts: dt.datetime | None = None) -> DataFrame:
    """As ``gold.dim_users``, from the kept state."""
    return totals.select("user_id", *[F.col(f"latest.{c}").alias(c) for c in (*_SEEN, "is_prime")],
                         x.surrogate_key("user_id").alias("dim_user_sk"), F.lit(True).alias("is_active"),
                         *gold._audit("updated_at", run_ts))


def _mean(total: str, n: str) -> Column:
    return x.rnd(F.col(total) / F.lit(100.0) / F.nullif(F.col(n), F.lit(0)), 2)


def dim_products(totals: DataFrame, run_ts: dt.datetime | None = None) -> DataFrame:
    """As ``gold.dim_products``, from the kept state."""
    return totals.select(*PRODUCTS.keys, _mean("price", "prices").alias("avg_unit_price"), x.rnd("lowest", 2).alias("min_unit_price"),
                         x.rnd("highest", 2).alias("max_unit_price"), x.surrogate_key("product_id").alias("dim_product_sk"),
                         F.lit(True).alias("is_active"), *gold._audit("updated_at", run_ts))


def dim_devices(totals: DataFrame, run_ts: dt.datetime | None = None) -> DataFrame:
    """As ``gold.dim_devices``, from the kept state."""
    return gold.dim_devices(totals, run_ts)


def agg_product_performance(partials: DataFrame, run_ts: dt.datetime | None = None) -> DataFrame:
    """As ``gold.agg_product_performance``, from the partials of whole months."""
    month = ("year", "month")
    out = SALES.totals(partials, month).select(
        *SALES.keys, *month, F.when(F.col("quantities") > 0, F.col("quantity")).alias("units_sold"),
        F.col("orders").alias("order_count"), F.when(F.col("paid_n") > 0, F.col("paid") / F.lit(100.0)).alias("total_revenue"),
        _mean("price", "prices").alias("avg_selling_price"), _mean("discount", "discounts").alias("avg_discount_pct"))
    ranked = with_rank(out, [*month, "category"], "total_revenue", "revenue_rank")
    return ranked.select(*out.columns, "revenue_rank", *gold._audit("processed_at", run_ts))


def order_value_rows(orders: DataFrame) -> DataFrame:
    cents = x.units("total_amount")
    return orders.filter(x.is_completed() & cents.isNotNull()).select(
        *DAY, "customer_segment", "country", sketches.bucket(cents).alias("bucket"))


def agg_order_values(partials: DataFrame, run_ts: dt.datetime | None = None) -> DataFrame:
    """Quantiles of completed orders by month, segment and country, from daily counts of value buckets."""
    keys = ["year", "month", "customer_segment", "country"]
    out = sketches.quantiles(partials, keys, QUARTILES, n=ROWS).withColumnRenamed("n", "orders")
    return out.select("*", *gold._audit("processed_at", run_ts))


def active_rows(orders: DataFrame, clicks: DataFrame) -> DataFrame:
    columns = [*DAY, "device_type", "user_id", "session_id"]
    return orders.select(*columns).unionByName(clicks.select(*columns))


def agg_active_users(partials: DataFrame, run_ts: dt.datetime | None = None) -> DataFrame:
    """Events, and users and sessions about, by month and device, from daily sketches."""
    return ACTIVE.totals(partials, ("year", "month")).select(
        "year", "month", "device_type", F.col(ROWS).alias("events"), sketches.distinct("user_id").alias("approx_users"),
        sketches.distinct("session_id").alias("approx_sessions"), *gold._audit("processed_at", run_ts))


@dataclass(frozen=True)
class Kept:
    """A rollup of silver tables: their rows, and the gold table made of the totals."""
    rollup: Rollup
    entities: tuple[str, ...]
    rows: Callable[..., DataFrame]
    made: Callable[[DataFrame, dt.datetime | None], DataFrame]
    monthly: bool = False  # made of the partials of each month, and kept by month


KEPT = {
    "dim_users": Kept(USERS, ("orders", "clickstream"), user_rows, dim_users),
    "dim_products": Kept(PRODUCTS, ("orders",), product_rows, dim_products),
    "dim_devices": Kept(DEVICES, ("orders",), lambda orders: orders, dim_devices),
    "agg_product_performance": Kept(SALES, ("orders",), sale_rows, agg_product_performance, monthly=True),
    "agg_order_values": Kept(ORDER_VALUES, ("orders",), order_value_rows, agg_order_values, monthly=True),
    "agg_active_users": Kept(ACTIVE, ("orders", "clickstream"), active_rows, agg_active_users, monthly=True),
}
