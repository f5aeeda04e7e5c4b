"""The data rules of the derived entities, in DuckDB SQL, for checking the Spark results.

``with_entities(body)`` prepends them as CTEs; DuckDB evaluates only those the body uses.
"""

from __future__ import annotations

import re


def r(expr: str, digits: int) -> str:
    """Half-up rounding through a decimal."""
    return f"CAST(ROUND(CAST({expr} AS DECIMAL(28,8)), {digits}) AS DOUBLE)"


def units(expr: str) -> str:
    return f"CAST(ROUND(({expr}) * 100) AS BIGINT)"


def msum(expr: str) -> str:
    """Exact sum of a two-digit amount."""
    return f"(CAST(SUM({units(expr)}) AS DOUBLE) / 100)"


def mavg(expr: str, digits: int = 2) -> str:
    return r(f"{msum(expr)} / NULLIF(COUNT({expr}), 0)", digits)


def iavg(expr: str, digits: int) -> str:
    return r(f"CAST(SUM({expr}) AS DOUBLE) / NULLIF(COUNT({expr}), 0)", digits)


def pct(num: str, den: str, digits: int = 2) -> str:
    return r(f"({num}) * 100 / NULLIF(CAST({den} AS DOUBLE), 0)", digits)


def ratio(num: str, den: str, digits: int) -> str:
    return r(f"({num}) / NULLIF(CAST({den} AS DOUBLE), 0)", digits)


def isum(expr: str) -> str:
    return f"CAST(SUM({expr}) AS BIGINT)"


def elt(values: str, index: str) -> str:
    return f"(string_split('{values}', ','))[CAST({index} AS BIGINT) + 1]"


DONE = "order_status IN ('confirmed', 'shipped', 'delivered')"

_DEVICES = "mobile,desktop,tablet"
_OS = "iOS 17,Windows 11,iPadOS 17"
_BROWSERS = "Chrome,Safari,Firefox,Edge"
_SOURCES = "google,facebook,instagram,email,direct,organic,twitter,affiliate"
_MEDIUMS = "cpc,social,email,organic,referral,display"
_METHODS = "credit_card,debit_card,paypal,apple_pay,google_pay,bank_transfer,crypto"
_CATEGORIES = "Electronics,Fashion,Home,Sports,Beauty,Books,Toys,Food"
_SEGMENT = ("CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'new' WHEN 'BUILDING' THEN 'returning' "
            "WHEN 'FURNITURE' THEN 'vip' WHEN 'HOUSEHOLD' THEN 'churned' WHEN 'MACHINERY' THEN 'returning' END")


def bucket(hour: str) -> str:
    return (f"CASE WHEN {hour} BETWEEN 0 AND 5 THEN 'late_night' WHEN {hour} BETWEEN 6 AND 11 THEN 'morning' "
            f"WHEN {hour} BETWEEN 12 AND 17 THEN 'afternoon' WHEN {hour} BETWEEN 18 AND 21 THEN 'evening' ELSE 'night' END")


def _parts(ts: str = "event_timestamp") -> str:
    return (f"CAST(year({ts}) AS INT) AS year, CAST(month({ts}) AS INT) AS month, CAST(day({ts}) AS INT) AS day, "
            f"CAST(hour({ts}) AS INT) AS hour")


_CATALOG = "(SELECT greatest(count(*), 1) FROM part)"


def _product(p: str) -> str:
    return (f"'PRD-' || ({p}) AS product_id, 'Item ' || ({p}) AS product_name, "
            f"{elt(_CATEGORIES, f'({p}) % 8')} AS category, 'Brand ' || (({p}) % 25) AS brand, "
            f"round((5.0::DOUBLE + ({p}) * 2.99::DOUBLE) * 100) / 100 AS unit_price")


def device_key(t: str = "") -> str:
    return (f"md5(coalesce({t}device_type, '') || '|' || coalesce({t}device_os, '') || '|' || "
            f"coalesce({t}browser, ''))")


def date_key(ts: str) -> str:
    return f"CAST(strftime({ts}, '%Y%m%d') AS INT)"


def _silver_orders(raw: str, extra: str, join: str, has_items: str) -> str:
    return f"""
  SELECT s.*, {_parts()},
         CAST(CASE WHEN dayofweek(event_timestamp) = 0 THEN 1 ELSE dayofweek(event_timestamp) + 1 END AS INT)
           AS order_day_of_week,
         dayofweek(event_timestamp) IN (0, 6) AS is_weekend,
         {bucket('hour(event_timestamp)')} AS order_hour_bucket,
         CASE WHEN total_amount < 50 THEN 'low' WHEN total_amount BETWEEN 50 AND 200 THEN 'medium'
              WHEN total_amount BETWEEN 200 AND 500 THEN 'high' ELSE 'premium' END AS order_value_tier,
         CASE WHEN subtotal > 0 THEN {r('discount_amount * 100 / subtotal', 2)} ELSE 0.0 END AS effective_discount_pct,
         CASE WHEN {has_items} THEN 'HIGH' ELSE 'MEDIUM' END AS data_quality_score{extra}
  FROM (SELECT * REPLACE (coalesce(nullif(country, ''), 'UNKNOWN') AS country,
                          coalesce(nullif(device_type, ''), 'UNKNOWN') AS device_type,
                          coalesce(nullif(customer_segment, ''), 'UNKNOWN') AS customer_segment,
                          coalesce(nullif(payment_method, ''), 'UNKNOWN') AS payment_method)
        FROM {raw}
        WHERE event_id IS NOT NULL AND order_id IS NOT NULL AND user_id IS NOT NULL
          AND total_amount > 0 AND total_amount < 50000
        QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY event_timestamp DESC NULLS LAST,
                                   event_id DESC NULLS LAST, order_status DESC NULLS LAST) = 1) s {join}"""


ENTITIES: dict[str, str] = {}

ENTITIES["cust"] = f"""
  SELECT c_custkey, {_SEGMENT} AS customer_segment, n_name, r_name
  FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey"""

ENTITIES["raw_orders"] = f"""
  SELECT 'ORD-' || k AS order_id, 'EVT-O' || k AS event_id, 'order_placed' AS event_type, 'USR-' || u AS user_id,
         'SES-' || u || '-' || strftime(o_orderdate, '%Y%m%d') AS session_id,
         o_orderdate + to_hours(CAST(k % 24 + copy AS BIGINT)) AS event_timestamp,
         CASE WHEN k % 50 <> 0 THEN n_name END AS country, r_name AS city,
         {elt(_DEVICES, 'k % 3')} AS device_type, {elt(_OS, 'k % 3')} AS device_os,
         CASE WHEN k % 30 <> 0 THEN {elt(_BROWSERS, 'k % 4')} END AS browser,
         {elt(_METHODS, 'k % 7')} AS payment_method, 'USD' AS currency,
         {elt(_SOURCES, 'u % 8')} AS utm_source, {elt(_MEDIUMS, 'u % 6')} AS utm_medium, customer_segment, order_status,
         total_amount, subtotal, round((total_amount - subtotal) * 100) / 100 AS tax_amount,
         round((k % 5) * 4.99::DOUBLE * 100) / 100 AS shipping_cost,
         round(subtotal * 0.05::DOUBLE * (k % 6) * 100) / 100 AS discount_amount,
         u % 2 = 0 AS is_prime, k % 7 = 0 AS is_gift, CASE WHEN k % 4 = 0 THEN 'SAVE10' END AS coupon_code, copy
  FROM (SELECT *, round(total_amount / 1.08::DOUBLE * 100) / 100 AS subtotal
        FROM (SELECT o_orderkey AS k, o_custkey AS u, o_orderdate, copy,
                     round(o_totalprice * 12.5::DOUBLE) / 100 AS total_amount,
                     CASE WHEN copy = 1 OR o_orderstatus = 'F' THEN 'delivered'
                          WHEN o_orderstatus = 'O' THEN {elt('confirmed,shipped,processing', 'o_orderkey % 3')}
                          ELSE {elt('pending,cancelled', 'o_orderkey % 2')} END AS order_status
              FROM orders CROSS JOIN (VALUES (0), (1)) v(copy) WHERE copy = 0 OR o_orderkey % 20 = 0)) o
  LEFT JOIN cust ON u = c_custkey"""

ENTITIES["items"] = """
  SELECT 'ORD-' || l_orderkey AS order_id, 'PRD-' || p_partkey AS product_id, p_name AS product_name,
         p_type AS category, p_brand AS brand, CAST(l_quantity AS INT) AS quantity,
         round(l_extendedprice / l_quantity * 100) / 100 AS unit_price, round(l_discount * 100) AS discount_pct,
         round(round(l_extendedprice / l_quantity * 100) / 100 * (1 - l_discount) * 100) / 100 AS final_price,
         l_linenumber AS line, l_partkey AS part
  FROM lineitem JOIN part ON l_partkey = p_partkey"""

ENTITIES["rollup"] = """
  SELECT order_id AS rollup_order, CAST(count(*) AS INT) AS item_count, count(product_id) AS distinct_products,
         arg_min(category, line * 1099511627776 + part) AS primary_category
  FROM items GROUP BY order_id"""

ENTITIES["silver_orders"] = _silver_orders(
    "raw_orders", ", coalesce(item_count, 0) AS item_count, distinct_products, primary_category",
    "LEFT JOIN rollup ON s.order_id = rollup_order", "distinct_products IS NOT NULL")

ENTITIES["ev"] = f"""
  SELECT event_id AS e, user_id AS u, event_type AS kind, value, CAST(json_extract_string(props, '$.k') AS INT) AS kk,
         ts AS event_timestamp, 'EVT-' || event_id AS event_id, 'USR-' || user_id AS user_id,
         'SES-' || user_id || '-' || strftime(ts, '%Y%m%d') AS session_id,
         {elt(_DEVICES, '(user_id + day(ts)) % 3')} AS device_type, {elt(_OS, '(user_id + day(ts)) % 3')} AS device_os,
         CASE WHEN user_id % 30 <> 0 THEN {elt(_BROWSERS, 'user_id % 4')} END AS browser,
         CASE WHEN user_id % 50 <> 0 THEN n_name END AS country, r_name AS city,
         CASE WHEN user_id % 25 <> 24 THEN {elt(_SOURCES, 'user_id % 8')} END AS utm_source,
         {elt(_MEDIUMS, 'user_id % 6')} AS utm_medium, customer_segment
  FROM events LEFT JOIN cust ON user_id = c_custkey"""

_SESSION = ("e, event_id, event_timestamp, session_id, user_id, device_type, device_os, browser, country, city, "
            "utm_source, utm_medium, customer_segment")

ENTITIES["raw_clicks"] = f"""
  SELECT {_SESSION}, 'page_view' AS event_type, page_type,
         CASE WHEN page_type = 'product_detail' THEN product_id END AS product_id,
         CASE WHEN page_type = 'product_detail' THEN category END AS category,
         CASE WHEN page_type = 'search_results' THEN CASE WHEN e % 4 = 0 THEN ' ' || upper(term) || ' ' ELSE term END END
           AS search_query,
         CASE WHEN page_type = 'search_results' THEN CASE WHEN kk < 10 THEN 0 ELSE kk END END AS search_result_count,
         CAST(floor(value * 10) AS INT) AS time_on_page_seconds, kk AS scroll_depth_pct,
         CASE WHEN e % 40 <> 0 THEN e % 3 = 0 END AS is_bounce, CAST(e * 37 % 5000 AS INT) AS load_time_ms,
         CAST({elt('375,768,1280,1440,1920', 'e % 5')} AS INT) AS viewport_width,
         {elt('control,variant_a,variant_b', 'e % 3')} AS ab_test_variant
  FROM (SELECT *, {_product(f'e % {_CATALOG}')},
               {elt('home,category,product_detail,search_results,cart,checkout,order_confirmation,account,wishlist', 'e % 9')}
                 AS page_type,
               {elt('laptop,shoes,shirt,headphones,phone,camera,watch,bag,book,game', 'e % 10')} AS term
        FROM ev)"""

ENTITIES["silver_clickstream"] = f"""
  SELECT *, {_parts()},
         CASE WHEN time_on_page_seconds > 120 AND scroll_depth_pct > 70 AND NOT is_bounce THEN 'high'
              WHEN time_on_page_seconds > 30 AND scroll_depth_pct > 40 THEN 'medium' ELSE 'low' END AS engagement_level,
         CASE WHEN time_on_page_seconds > 60 AND scroll_depth_pct > 50 AND NOT is_bounce THEN 'high'
              WHEN time_on_page_seconds > 20 OR scroll_depth_pct > 25 THEN 'medium' ELSE 'low' END AS engagement_score,
         load_time_ms > 3000 AS is_slow_page, device_type = 'mobile' AS is_mobile,
         CASE WHEN page_type IN ('home', 'category') THEN 'browsing' WHEN page_type = 'product_detail' THEN 'product'
              WHEN page_type = 'search_results' THEN 'search' WHEN page_type IN ('cart', 'checkout') THEN 'purchase_funnel'
              WHEN page_type = 'order_confirmation' THEN 'post_purchase' ELSE 'account' END AS page_category,
         page_type = 'product_detail' AS is_product_page, page_type = 'checkout' AS is_checkout_page,
         page_type = 'search_results' AS is_search
  FROM (SELECT * REPLACE (CASE WHEN time_on_page_seconds BETWEEN 0 AND 3600 THEN time_on_page_seconds END
                            AS time_on_page_seconds)
        FROM raw_clicks WHERE event_id IS NOT NULL AND session_id IS NOT NULL
        QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY event_timestamp DESC) = 1)"""

ENTITIES["raw_carts"] = f"""
  SELECT {_SESSION}, 'cart_event' AS event_type, 'CRT-' || u AS cart_id,
         CASE WHEN kind = 'click' THEN 'item_added'
              ELSE {elt('item_removed,quantity_updated,cart_viewed,cart_abandoned,cart_saved', 'e % 5')} END AS action,
         {_product(f'e % {_CATALOG}')}, CAST(1 + e % 10 AS INT) AS quantity, value AS cart_total,
         CAST(1 + e % 12 AS INT) AS cart_item_count
  FROM ev WHERE kind IN ('click', 'view')"""

ENTITIES["silver_carts"] = f"""
  SELECT *, {_parts()}, {r('unit_price * quantity', 2)} AS item_total_value, {r('unit_price * quantity', 2)} AS line_value,
         action = 'cart_abandoned' AS is_abandonment, action = 'item_added' AS is_add, action = 'item_removed' AS is_remove
  FROM raw_carts WHERE event_id IS NOT NULL AND session_id IS NOT NULL AND product_id IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY event_timestamp DESC) = 1"""

ENTITIES["raw_payments"] = f"""
  SELECT * EXCLUDE (flagged), CASE WHEN e % 10 <> 0 THEN flagged END AS is_fraud_flagged
  FROM (SELECT *, amount > 5000 OR coalesce(failure_reason = 'fraud_detected', false)
                  OR (coalesce(NOT is_3ds_authenticated, false) AND amount > 500)
                  OR gateway_response_code IN ('59', '62', '63') AS flagged
        FROM (SELECT {_SESSION}, 'payment_processed' AS event_type, 'PAY-' || e AS payment_id,
                     CASE WHEN kind = 'purchase' OR e % 11 <> 0 THEN 'ORD-E' || e END AS order_id,
                     {elt(_METHODS, 'e % 7')} AS payment_method,
                     {elt('stripe,paypal,braintree,adyen,square', 'e % 5')} AS payment_gateway, 'USD' AS currency,
                     round(value * 20 * 100) / 100 AS amount,
                     CASE WHEN kind = 'purchase' THEN 'success'
                          ELSE {elt('failed,declined,pending,refunded', 'e % 4')} END AS payment_status,
                     CASE WHEN kind <> 'purchase' THEN
                       {elt('insufficient_funds,card_expired,fraud_detected,bank_decline,invalid_cvv,address_mismatch', 'e % 6')}
                     END AS failure_reason,
                     {elt('00,05,14,51,59,62,63', 'e % 7')} AS gateway_response_code,
                     CAST(e * 53 % 6000 AS INT) AS processing_time_ms,
                     CASE WHEN e % 45 <> 0 THEN e % 5 > 1 END AS is_3ds_authenticated,
                     CAST(1 + e % 3 AS INT) AS installment_plan
              FROM ev WHERE kind IN ('purchase', 'error')))"""

ENTITIES["silver_payments"] = f"""
  SELECT *, {_parts()}, payment_status = 'success' AS is_successful,
         payment_status IN ('failed', 'declined') AS is_failed,
         CASE WHEN amount < 50 THEN 'micro' WHEN amount < 200 THEN 'small' WHEN amount < 1000 THEN 'medium'
              ELSE 'large' END AS amount_tier,
         CASE WHEN processing_time_ms < 500 THEN 'fast' WHEN processing_time_ms < 1500 THEN 'normal' ELSE 'slow' END
           AS processing_tier,
         {bucket('hour(event_timestamp)')} AS payment_hour_bucket,
         is_fraud_flagged OR processing_time_ms > 5000 OR amount > 5000 AS is_high_risk,
         CASE WHEN user_id IS NOT NULL AND payment_gateway IS NOT NULL THEN 'HIGH' ELSE 'MEDIUM' END AS data_quality_score
  FROM raw_payments WHERE payment_id IS NOT NULL AND order_id IS NOT NULL AND amount > 0 AND amount < 100000
  QUALIFY row_number() OVER (PARTITION BY payment_id ORDER BY event_timestamp DESC) = 1"""

ENTITIES["raw_orders_ev"] = f"""
  SELECT {_SESSION}, 'order_placed' AS event_type, 'ORD-E' || e AS order_id,
         {elt('pending,confirmed,processing,shipped,delivered,cancelled,refunded', 'e % 7')} AS order_status,
         {elt(_METHODS, 'e % 7')} AS payment_method, 'USD' AS currency, value AS total_amount, subtotal,
         round((value - subtotal) * 100) / 100 AS tax_amount, round((e % 5) * 4.99::DOUBLE * 100) / 100 AS shipping_cost,
         round(subtotal * 0.05::DOUBLE * (e % 6) * 100) / 100 AS discount_amount,
         u % 2 = 0 AS is_prime, e % 7 = 0 AS is_gift, CAST(1 + e % 3 AS INT) AS item_count
  FROM (SELECT *, round(value / 1.08::DOUBLE * 100) / 100 AS subtotal FROM ev WHERE kind = 'purchase')"""

ENTITIES["silver_orders_ev"] = _silver_orders("raw_orders_ev", "", "", "item_count > 0")

ENTITIES["items_ev"] = f"""
  SELECT *, round(unit_price * (100 - discount_pct) / 100 * 100) / 100 AS final_price
  FROM (SELECT 'ORD-E' || e AS order_id, {_product(f'(e + j * 7) % {_CATALOG}')}, CAST(1 + (e + j) % 5 AS INT) AS quantity,
               ((e + j) % 6) * 5.0::DOUBLE AS discount_pct, j
        FROM ev CROSS JOIN (VALUES (0), (1), (2)) v(j) WHERE kind = 'purchase' AND j <= e % 3)"""


def _fact_orders(source: str, items: str) -> str:
    return f"""
  SELECT order_id, event_id, user_id, session_id, device_type, device_os, browser, country, currency, payment_method,
         order_status, item_count, total_amount AS order_total, subtotal, tax_amount, shipping_cost, discount_amount,
         effective_discount_pct, order_value_tier, primary_category, distinct_products, customer_segment, utm_source,
         utm_medium, is_prime, is_gift, is_weekend, order_hour_bucket, event_timestamp AS order_timestamp,
         md5(order_id) AS order_sk, md5(user_id) AS user_sk, {device_key()} AS device_sk,
         {date_key('event_timestamp')} AS date_key, year, month, day, hour
  FROM {source} {items}"""


ENTITIES["fact_orders"] = _fact_orders("silver_orders", "")
ENTITIES["fact_orders_ev"] = _fact_orders(
    "silver_orders_ev", "JOIN (SELECT order_id AS oid, arg_min(category, j) AS primary_category, "
                        "count(product_id) AS distinct_products FROM items_ev GROUP BY 1) ON order_id = oid")

ENTITIES["fact_clickstream"] = f"""
  SELECT event_id, session_id, user_id, page_type, product_id, category, search_query, time_on_page_seconds,
         scroll_depth_pct, load_time_ms, is_bounce, device_type, country, utm_source, utm_medium, customer_segment,
         ab_test_variant, viewport_width, event_timestamp AS view_timestamp, md5(event_id) AS click_sk,
         {date_key('event_timestamp')} AS date_key, year, month, day, hour
  FROM silver_clickstream"""

ENTITIES["fact_payments"] = f"""
  SELECT payment_id, order_id, user_id, session_id, payment_method, payment_gateway, payment_status, amount, currency,
         country, failure_reason, processing_time_ms, is_3ds_authenticated, gateway_response_code, installment_plan,
         event_timestamp AS payment_timestamp, md5(payment_id) AS payment_sk,
         {date_key('event_timestamp')} AS date_key, year, month, day, hour
  FROM silver_payments"""

ENTITIES["dim_products"] = f"""
  SELECT product_id, product_name, category, brand, {mavg('unit_price')} AS avg_unit_price,
         min(unit_price) AS min_unit_price, max(unit_price) AS max_unit_price, md5(product_id) AS dim_product_sk,
         true AS is_active
  FROM silver_orders JOIN (SELECT order_id AS oid, * EXCLUDE (order_id) FROM items) ON oid = order_id
  GROUP BY product_id, product_name, category, brand"""

ENTITIES["dim_devices"] = f"""
  SELECT DISTINCT device_type, device_os, browser, {device_key()} AS device_sk,
         CASE device_type WHEN 'mobile' THEN 'smartphone' WHEN 'tablet' THEN 'tablet' ELSE 'computer' END AS device_class,
         device_type = 'mobile' AS is_mobile
  FROM silver_orders"""


def calendar(start: str, end: str) -> str:
    return f"""
  SELECT {date_key('d')} AS date_key, strftime(d, '%Y-%m-%d') AS full_date, CAST(year(d) AS INT) AS year,
         CAST(month(d) AS INT) AS month, CAST(day(d) AS INT) AS day, CAST(weekofyear(d) AS INT) AS week_of_year,
         dayname(d) AS day_name, monthname(d) AS month_name, CAST(quarter(d) AS INT) AS quarter,
         dayofweek(d) IN (0, 6) AS is_weekend
  FROM (SELECT unnest(generate_series(TIMESTAMP '{start}', TIMESTAMP '{end}', INTERVAL 1 DAY)) AS d)"""


ENTITIES["dim_time"] = calendar("1995-01-01", "2027-12-31")


def with_entities(body: str, **extra: str) -> str:
    """``body`` with the entity CTEs it mentions (and ``extra`` ones, which may build on them) in front."""
    ctes = {**ENTITIES, **extra}
    wanted, todo = set(), [body]
    while todo:
        text = todo.pop()
        for name, sql in ctes.items():
            if name not in wanted and re.search(rf"\b{name}\b", text):
                wanted.add(name)
                todo.append(sql)
    chosen = [f"{n} AS ({sql})" for n, sql in ctes.items() if n in wanted]
    return "WITH " + ",\n".join(chosen) + "\n" + body
