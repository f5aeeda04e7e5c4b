"""Typed layouts of the streams, the lake tables and the warehouse tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def struct_of(ddl: str) -> T.StructType:
    """The layouts below are DDL text, so importing them needs no session."""
    return T.StructType.fromDDL(ddl)


ITEM_DDL = ("struct<product_id:string,product_name:string,category:string,brand:string,quantity:int,"
            "unit_price:double,discount_pct:double,final_price:double>")

_BASE = ("event_id string, event_type string, event_timestamp string, ingestion_timestamp string, "
         "schema_version string, platform string, session_id string, user_id string, device_type string, "
         "device_os string, browser string, country string, city string, ip_address string, utm_source string, "
         "utm_medium string, utm_campaign string, is_authenticated boolean, customer_segment string, ")

# Wire layouts: timestamps are still text
WIRE = {
    "orders": (_BASE + "order_id string, order_status string, payment_method string, currency string, "
                  "subtotal double, tax_amount double, shipping_cost double, total_amount double, "
                  "discount_amount double, coupon_code string, items array<" + ITEM_DDL + ">, item_count int, "
                  "shipping_address struct<street:string,city:string,state:string,zip:string,country:string>, "
                  "estimated_delivery_days int, is_prime boolean, is_gift boolean"),
    "payments": (_BASE + "payment_id string, order_id string, payment_method string, payment_gateway string, "
                    "currency string, amount double, payment_status string, failure_reason string, "
                    "transaction_id string, gateway_response_code string, processing_time_ms int, "
                    "is_3ds_authenticated boolean, card_last_four string, installment_plan int"),
    "clickstream": (_BASE + "page_type string, page_url string, referrer_url string, product_id string, "
                       "product_name string, category string, search_query string, search_result_count int, "
                       "time_on_page_seconds int, scroll_depth_pct int, click_x int, click_y int, "
                       "is_bounce boolean, viewport_width int, load_time_ms int, ab_test_variant string"),
    "carts": (_BASE + "cart_id string, action string, product_id string, product_name string, "
                 "category string, brand string, unit_price double, quantity int, cart_total double, "
                 "cart_item_count int, is_wishlist_item boolean, recommendation_source string, "
                 "time_since_add_minutes int, abandonment_step string"),
}

# What the stream consumers add before landing a record
_ENRICHED = ", processing_id string, environment string, year int, month int, day int, hour int"
BRONZE = {
    "orders": (WIRE["orders"] + ", average_item_value double, day_of_week string, "
                  "is_weekend boolean" + _ENRICHED),
    "payments": (WIRE["payments"] + ", fraud_signals array<string>, "
                    "is_fraud_flagged boolean" + _ENRICHED),
    "clickstream": (WIRE["clickstream"] + _ENRICHED),
    "carts": (WIRE["carts"] + ", cart_value double" + _ENRICHED),
}

DEAD_LETTER = ("original_record string, reason string, failed_at timestamp, stream string, environment string, "
                  "batch_id long")

ALERTS = ("raised_at timestamp, source string, subject string, message string")
METRICS = ("measured_at timestamp, entity string, metric string, value double")

SILVER_ORDERS = (
    "event_id string, event_type string, event_timestamp timestamp, ingestion_timestamp timestamp, "
    "processing_id string, order_id string, user_id string, session_id string, device_type string, "
    "device_os string, browser string, country string, city string, currency string, payment_method string, "
    "order_status string, subtotal double, tax_amount double, shipping_cost double, total_amount double, "
    "discount_amount double, item_count int, items array<" + ITEM_DDL + ">, coupon_code string, is_prime boolean, "
    "is_gift boolean, customer_segment string, utm_source string, utm_medium string, year int, month int, "
    "day int, hour int")

# Warehouse tables. Columns that no job ever fills (fiscal year, season, price tier, ...) are left out.
WAREHOUSE = {
    "dim_time": ("date_key int, full_date date, year smallint, month tinyint, day tinyint, "
                    "week_of_year tinyint, day_name string, month_name string, quarter tinyint, is_weekend boolean"),
    "dim_users": ("user_sk string, user_id string, country string, customer_segment string, is_prime boolean, "
                     "first_order_date date, last_order_date date, total_orders bigint, total_spend decimal(14,2), "
                     "avg_order_value decimal(10,2), preferred_category string, days_since_last_order int, "
                     "churn_risk_score decimal(5,4), ltv_score decimal(10,2), is_active boolean, "
                     "created_at timestamp, updated_at timestamp"),
    "dim_products": ("product_sk string, product_id string, product_name string, category string, brand string, "
                        "avg_unit_price decimal(10,2), min_unit_price decimal(10,2), max_unit_price decimal(10,2), "
                        "is_active boolean, created_at timestamp, updated_at timestamp"),
    "dim_devices": ("device_sk string, device_type string, device_os string, browser string, "
                       "device_class string, is_mobile boolean, updated_at timestamp"),
    "fact_orders": ("order_sk string, order_id string, event_id string, user_sk string, device_sk string, "
                       "date_key int, user_id string, session_id string, country string, device_type string, "
                       "currency string, payment_method string, order_status string, order_timestamp timestamp, "
                       "item_count int, order_total decimal(12,2), subtotal decimal(12,2), tax_amount decimal(10,2), "
                       "shipping_cost decimal(10,2), discount_amount decimal(10,2), "
                       "effective_discount_pct decimal(8,4), order_value_tier string, primary_category string, "
                       "distinct_products int, customer_segment string, utm_source string, utm_medium string, "
                       "is_prime boolean, is_gift boolean, is_weekend boolean, order_hour_bucket string, "
                       "loaded_at timestamp"),
    "fact_payments": ("payment_sk string, payment_id string, order_id string, user_id string, session_id string, "
                         "date_key int, payment_timestamp timestamp, payment_method string, payment_gateway string, "
                         "payment_status string, amount decimal(12,2), currency string, country string, "
                         "failure_reason string, processing_time_ms int, is_3ds_authenticated boolean, "
                         "gateway_response_code string, installment_plan tinyint, loaded_at timestamp"),
    "fact_clickstream": ("click_sk string, event_id string, session_id string, user_id string, date_key int, "
                            "view_timestamp timestamp, page_type string, product_id string, category string, "
                            "search_query string, time_on_page_seconds int, scroll_depth_pct int, load_time_ms int, "
                            "is_bounce boolean, device_type string, country string, utm_source string, "
                            "utm_medium string, customer_segment string, ab_test_variant string, "
                            "viewport_width smallint, loaded_at timestamp"),
    "rpt_funnel": ("report_date date, country string, device_type string, sessions bigint, page_views bigint, "
                      "cart_sessions bigint, order_sessions bigint, cart_rate decimal(8,4), "
                      "conversion_rate decimal(8,4), cart_to_order_rate decimal(8,4), revenue decimal(14,2)"),
}

NULL_TOKENS = ["NULL", "null", ""]


def lenient_cast(col: Column, source: T.DataType, target: T.DataType) -> Column:
    """A cast that gives null on bad input; a no-op when the type is right already."""
    if source == target:
        return col
    if isinstance(target, T.TimestampType):
        if isinstance(source, T.StringType):
            return F.try_to_timestamp(col)
        return col.cast(target)
    return col.try_cast(target)


def cast_columns(df: DataFrame, targets: dict[str, T.DataType]) -> DataFrame:
    """Cast the named columns that exist; untouched columns stay as they are."""
    have = {f.name: f.dataType for f in df.schema.fields}
    return df.withColumns({n: lenient_cast(F.col(n), have[n], t) for n, t in targets.items()
                           if n in have and have[n] != t})


def conform(df: DataFrame, layout: str, null_tokens: bool = False) -> DataFrame:
    """Project a frame onto a table layout: order, types, nulls for absent columns."""
    have = {f.name: f.dataType for f in df.schema.fields}
    out = []
    for f in struct_of(layout).fields:
        if f.name not in have:
            out.append(F.lit(None).cast(f.dataType).alias(f.name))
            continue
        col = F.col(f.name)
        if null_tokens and isinstance(have[f.name], T.StringType):
            col = F.when(~col.isin(NULL_TOKENS), col)
        out.append(lenient_cast(col, have[f.name], f.dataType).alias(f.name))
    return df.select(*out)
