"""Upserts, change feeds and the warehouse load.

``merge_upsert`` is a full outer join on the key, for frames and small tables. Warehouse facts are merged by the same rules
(``FACTS``) into snapshot tables, of which only the touched partitions are read and written (``jobs.load_fact``).
"""

from __future__ import annotations

import dataclasses
import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillstream.functions import exprs as x
from tillstream.operators.rows import deduplicate


def merge_upsert(target: DataFrame, source: DataFrame, key: str, update: Sequence[str],
                 when: Callable[[Callable[[str], Column], Callable[[str], Column]], Column] | None = None,
                 on_update: dict[str, Column] | None = None, on_insert: dict[str, Column] | None = None) -> DataFrame:
    """Matched rows take the ``update`` columns from the source (where ``when(src, tgt)`` holds), the rest is inserted.

    ``on_update`` / ``on_insert`` set columns to fixed values such as the load time. Columns the source lacks stay null
    on insert. The source must hold one row per key.
    """
    on_update, on_insert = on_update or {}, on_insert or {}
    t = target.select(F.struct(*target.columns).alias("t"), F.col(key).alias("_tk"))
    s = source.select(F.struct(*source.columns).alias("s"), F.col(key).alias("_sk"))
    both = t.join(s, F.col("_tk") == F.col("_sk"), "full_outer")

    def src(c):
        return F.col(f"s.{c}") if c in source.columns else F.lit(None)

    def tgt(c):
        return F.col(f"t.{c}")

    inserted = F.col("_tk").isNull()
    updated = F.col("_tk").isNotNull() & F.col("_sk").isNotNull()
    if when is not None:
        updated = updated & F.coalesce(when(src, tgt), F.lit(False))
    out = []
    for f in target.schema.fields:
        c = f.name
        col = F.when(inserted, on_insert.get(c, src(c)).cast(f.dataType))
        if c in on_update or c in update:
            col = col.when(updated, on_update.get(c, src(c)).cast(f.dataType))
        out.append(col.otherwise(tgt(c)).alias(c))
    return both.select(*out)


def merge_insert_only(target: DataFrame, source: DataFrame, key: str,
                      on_insert: dict[str, Column] | None = None) -> DataFrame:
    """Append the source rows whose key is new."""
    new = source.join(target.select(key), key, "left_anti").withColumns(on_insert or {})
    return target.unionByName(new.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in target.schema.fields]))


@dataclasses.dataclass(frozen=True)
class Rule:
    """How a fact is loaded: the source's latest row of each key updates some columns when the status changes."""
    key: str
    order: str
    update: tuple[str, ...] = ()
    status: str = ""

    def decided(self, source: DataFrame) -> DataFrame:
        """One row a key: the latest; of equally late ones that of the greatest event id, then row hash."""
        ties = [c for c in ("event_id",) if c in source.columns and c != self.key]
        hashed = source.withColumn("_hash", F.xxhash64(*source.columns))
        return deduplicate(hashed, [self.key], self.order, [*ties, "_hash"]).drop("_hash")

    def changed(self, src: Callable[[str], Column], tgt: Callable[[str], Column]) -> Column:
        return src(self.status) != tgt(self.status)


FACTS = {"fact_orders": Rule("order_id", "order_timestamp", ("order_status", "order_total"), "order_status"),
         "fact_payments": Rule("payment_id", "payment_timestamp", ("payment_status", "failure_reason"), "payment_status"),
         "fact_clickstream": Rule("event_id", "view_timestamp")}


def _merge_fact(name: str, target: DataFrame, source: DataFrame, run_ts: dt.datetime) -> DataFrame:
    rule, now = FACTS[name], {"loaded_at": F.lit(run_ts)}
    source = rule.decided(source)
    if not rule.update:
        return merge_insert_only(target, source, rule.key, now)
    return merge_upsert(target, source, rule.key, rule.update, rule.changed, now, now)


def merge_fact_orders(target: DataFrame, source: DataFrame, run_ts: dt.datetime) -> DataFrame:
    return _merge_fact("fact_orders", target, source, run_ts)


def merge_fact_payments(target: DataFrame, source: DataFrame, run_ts: dt.datetime) -> DataFrame:
    return _merge_fact("fact_payments", target, source, run_ts)


def merge_fact_clickstream(target: DataFrame, source: DataFrame, run_ts: dt.datetime) -> DataFrame:
    return _merge_fact("fact_clickstream", target, source, run_ts)


def preferred_category(fact_orders: DataFrame) -> DataFrame:
    """The most frequent category per user; the alphabetically first one on a tie."""
    n = fact_orders.filter(F.col("primary_category").isNotNull()).groupBy("user_id", "primary_category").agg(
        F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy("user_id").orderBy(F.col("n").desc(), "primary_category")
    return n.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").select(
        "user_id", F.col("primary_category").alias("preferred_category"))


def user_metrics(fact_orders: DataFrame, as_of: dt.date) -> DataFrame:
    """Order history figures and scores per user."""
    m = fact_orders.groupBy("user_id").agg(
        F.countDistinct("order_id").alias("total_orders"), x.fixed_sum("order_total").alias("total_spend"),
        x.fixed_avg("order_total").alias("avg_order_value"), F.to_date(F.min("order_timestamp")).alias("first_order_date"),
        F.to_date(F.max("order_timestamp")).alias("last_order_date"), F.max("country").alias("country"),
        F.max("customer_segment").alias("customer_segment"), F.max("is_prime").alias("is_prime"))
    m = m.withColumn("days_since_last_order", F.date_diff(F.lit(as_of), "last_order_date"))
    m = m.join(preferred_category(fact_orders), "user_id", "left")
    return m.withColumns({
        "user_sk": x.surrogate_key("user_id"), "churn_risk_score": x.churn_risk_score("days_since_last_order"),
        "ltv_score": x.ltv_score("total_spend", "total_orders", "days_since_last_order"), "is_active": F.lit(True)})


DIM_USER_COLUMNS = ["user_sk", "user_id", "country", "customer_segment", "is_prime", "first_order_date",
                    "last_order_date", "total_orders", "total_spend", "avg_order_value", "preferred_category",
                    "days_since_last_order", "churn_risk_score", "ltv_score", "is_active"]


def merge_dim_users(target: DataFrame, fact_orders: DataFrame, run_ts: dt.datetime) -> DataFrame:
    """SCD type 1. The first order date and the creation time of a known user stay."""
    source = user_metrics(fact_orders, run_ts.date())
    update = [c for c in DIM_USER_COLUMNS if c not in ("user_sk", "user_id", "first_order_date", "is_active")]
    now = F.lit(run_ts)
    return merge_upsert(target, source, "user_id", update, None, {"updated_at": now},
                        {"created_at": now, "updated_at": now})


def merge_dim_products(target: DataFrame, products: DataFrame, run_ts: dt.datetime) -> DataFrame:
    """Names and prices of known products are replaced; the source is cut to one row per product id first."""
    source = products.withColumnRenamed("dim_product_sk", "product_sk") if "dim_product_sk" in products.columns else products
    source = deduplicate(source, ["product_id"], "avg_unit_price", ["product_name", "category", "brand"])
    now = F.lit(run_ts)
    return merge_upsert(target, source, "product_id",
                        ["product_name", "avg_unit_price", "min_unit_price", "max_unit_price"], None,
                        {"updated_at": now}, {"is_active": F.lit(True), "created_at": now, "updated_at": now})


def changes(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Change feed between two versions: the new (or deleted) row, ``change`` = insert / update / delete."""
    cols = [c for c in new.columns if c in old.columns]
    o = old.select(F.struct(*cols).alias("o"), F.col(key).alias("_ok"))
    n = new.select(F.struct(*cols).alias("n"), F.col(key).alias("_nk"))
    both = o.join(n, F.col("_ok") == F.col("_nk"), "full_outer")
    kind = (F.when(F.col("_ok").isNull(), "insert").when(F.col("_nk").isNull(), "delete")
            .when(~F.col("o").eqNullSafe(F.col("n")), "update"))
    return both.withColumn("change", kind).filter(F.col("change").isNotNull()).select(
        "change", *[F.when(F.col("_nk").isNull(), F.col(f"o.{c}")).otherwise(F.col(f"n.{c}")).alias(c) for c in cols])


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """Assertion query for a unique key: the keys that occur more than once."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
