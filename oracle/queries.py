"""Expected results of the registered queries as DuckDB SQL over the raw tables."""

from __future__ import annotations

from oracle.base import (DONE, date_key, elt, iavg, isum, mavg, msum, pct, r, ratio, units,
                         with_entities)

AS_OF = "TIMESTAMP '2024-01-30 23:59:59'"
ORDERS_AS_OF = "TIMESTAMP '2001-08-02'"
ITEM_REV = f"(CAST(SUM({units('final_price')} * quantity) AS DOUBLE) / 100)"

SQL: dict[str, str] = {}


def add(name: str, body: str, **extra: str) -> None:
    SQL[name] = with_entities(body, **extra)


def _i(expr: str) -> str:
    return f"CAST({expr} AS INT)"


def cnt_if(cond: str) -> str:
    return f"COUNT(*) FILTER (WHERE {cond})"


# ---- silver and gold -----------------------------------------------------------------------
add("silver_orders", "SELECT * EXCLUDE (copy) FROM silver_orders")
add("silver_orders_ev", "SELECT * EXCLUDE (e) FROM silver_orders_ev")
add("silver_payments", "SELECT * EXCLUDE (e) FROM silver_payments")
add("silver_clickstream", "SELECT * EXCLUDE (e) FROM silver_clickstream")
add("silver_carts", "SELECT * EXCLUDE (e) FROM silver_carts")
add("silver_variants", f"""
SELECT 'payments' AS variant, count(*) AS n, count(order_id) AS x FROM raw_payments WHERE amount > 0 AND amount < 100000
UNION ALL SELECT 'clickstream', count(*), {isum('least(time_on_page_seconds, 3600)')} FROM raw_clicks
UNION ALL SELECT 'carts', count(*), {cnt_if("action = 'cart_abandoned'")} FROM raw_carts""")
for name in ("fact_orders", "fact_orders_ev", "fact_payments", "fact_clickstream", "dim_products", "dim_devices"):
    add(name, f"SELECT * FROM {name}")
DIM_PRODUCTS_EV = f"""
  SELECT product_id, product_name, category, brand, {mavg('unit_price')} AS avg_unit_price,
         min(unit_price) AS min_unit_price, max(unit_price) AS max_unit_price, md5(product_id) AS dim_product_sk,
         true AS is_active
  FROM items_ev WHERE order_id IN (SELECT order_id FROM silver_orders_ev)
  GROUP BY product_id, product_name, category, brand"""
add("dim_products_ev", "SELECT * FROM dim_products_ev", dim_products_ev=DIM_PRODUCTS_EV)
add("dim_users", """
SELECT user_id, country, city, device_type, customer_segment, is_prime, md5(user_id) AS dim_user_sk, true AS is_active
FROM (SELECT user_id, country, city, device_type, customer_segment, event_timestamp, event_id, is_prime FROM silver_orders_ev
      UNION ALL SELECT user_id, country, city, device_type, customer_segment, event_timestamp, event_id, NULL
      FROM silver_clickstream)
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_timestamp DESC, event_id DESC, is_prime DESC NULLS LAST) = 1""")
SQL["dim_users_by_state"] = SQL["dim_users"]
add("dim_products_by_state", "SELECT * FROM dim_products_ev", dim_products_ev=DIM_PRODUCTS_EV)
add("product_performance_by_state", f"""
SELECT *, rank() OVER (PARTITION BY year, month, category ORDER BY total_revenue DESC) AS revenue_rank
FROM (SELECT product_id, product_name, category, brand, year, month, {isum('quantity')} AS units_sold,
             count(*) AS order_count, {r(ITEM_REV, 2)} AS total_revenue, {mavg('final_price')} AS avg_selling_price,
             {mavg('discount_pct')} AS avg_discount_pct
      FROM (SELECT order_id AS oid, year, month FROM silver_orders_ev WHERE {DONE}) JOIN items_ev ON oid = order_id
      GROUP BY ALL)""")
add("dim_time", """
SELECT * FROM dim_time WHERE full_date BETWEEN (SELECT strftime(min(o_orderdate), '%Y-%m-%d') FROM orders)
                                          AND (SELECT strftime(max(o_orderdate), '%Y-%m-%d') FROM orders)""")

add("daily_revenue", f"""
SELECT *, {ratio('gross_revenue', 'unique_customers', 2)} AS revenue_per_customer
FROM (SELECT year, month, day, country, device_type, payment_method, customer_segment, count(order_id) AS total_orders,
             count(DISTINCT user_id) AS unique_customers, {r(msum('total_amount'), 2)} AS gross_revenue,
             {r(msum('discount_amount'), 2)} AS total_discounts,
             {r(msum('total_amount') + ' - ' + msum('discount_amount'), 2)} AS net_revenue,
             {mavg('total_amount')} AS avg_order_value, {r(msum('shipping_cost'), 2)} AS total_shipping,
             {r(msum('tax_amount'), 2)} AS total_tax
      FROM silver_orders GROUP BY ALL)""")
add("product_performance", f"""
SELECT *, rank() OVER (PARTITION BY year, month, category ORDER BY total_revenue DESC) AS revenue_rank
FROM (SELECT product_id, product_name, category, brand, year, month, {isum('quantity')} AS units_sold,
             count(*) AS order_count, {r(ITEM_REV, 2)} AS total_revenue, {mavg('final_price')} AS avg_selling_price,
             {mavg('discount_pct')} AS avg_discount_pct
      FROM (SELECT order_id AS oid, year, month FROM silver_orders WHERE {DONE}) JOIN items ON oid = order_id
      GROUP BY ALL)""")

_FK = "year, month, day, country, device_type"


def _funnel(eq: str, orders: str = "silver_orders_ev") -> str:
    on = " AND ".join(f"v.{k} {eq} {{t}}.{k}" for k in _FK.split(", "))
    return f"""
  SELECT v.*, coalesce(cart_sessions, 0) AS cart_sessions, coalesce(order_sessions, 0) AS order_sessions, revenue,
         {ratio('coalesce(cart_sessions, 0)', 'sessions', 4)} AS cart_rate,
         {ratio('coalesce(order_sessions, 0)', 'sessions', 4)} AS conversion_rate,
         CASE WHEN cart_sessions > 0 THEN {ratio('coalesce(order_sessions, 0)', 'cart_sessions', 4)} ELSE 0.0 END
           AS cart_to_order_rate
  FROM (SELECT {_FK}, count(DISTINCT session_id) AS sessions, count(event_id) AS page_views FROM silver_clickstream
        GROUP BY ALL) v
  LEFT JOIN (SELECT {_FK}, count(DISTINCT session_id) AS cart_sessions FROM silver_carts WHERE action = 'item_added'
             GROUP BY ALL) c ON {on.format(t='c')}
  LEFT JOIN (SELECT {_FK}, count(DISTINCT session_id) AS order_sessions, {msum('total_amount')} AS revenue
             FROM {orders} GROUP BY ALL) o ON {on.format(t='o')}"""


add("funnel", "SELECT * FROM funnel_rows", funnel_rows=_funnel("="))
add("funnel_null_safe", "SELECT * FROM funnel_rows", funnel_rows=_funnel(
    "IS NOT DISTINCT FROM", "(SELECT * REPLACE (nullif(country, 'UNKNOWN') AS country) FROM silver_orders_ev)"))
add("rpt_funnel", """
SELECT * EXCLUDE (year, month, day), strftime(make_date(year, month, day), '%Y-%m-%d') AS report_date FROM funnel_rows""",
    funnel_rows=_funnel("="))
add("hourly_revenue", f"""
SELECT *, CAST(sum({units('revenue')}) OVER (PARTITION BY year, month, day, country ORDER BY hour ROWS UNBOUNDED PRECEDING)
               AS DOUBLE) / 100 AS revenue_cumulative
FROM (SELECT year, month, day, hour, country, count(order_id) AS orders, count(DISTINCT user_id) AS buyers,
             {r(msum('total_amount'), 2)} AS revenue, {mavg('total_amount')} AS aov
      FROM silver_orders WHERE {DONE} GROUP BY ALL)""")

# ---- lake queries --------------------------------------------------------------------------
_TOP = """
SELECT *, dense_rank() OVER (ORDER BY total_revenue DESC) AS revenue_rank
FROM (SELECT product_id, product_name, category, brand, {units} AS units_sold, count(DISTINCT order_id) AS order_count,
             {rev} AS total_revenue, {unit} AS avg_unit_price, {disc} AS avg_discount_pct
      FROM {source} GROUP BY ALL)
ORDER BY total_revenue DESC, product_id LIMIT 50"""
_TOP = _TOP.replace("{units}", isum("quantity")).replace("{rev}", r(ITEM_REV, 2)).replace(
    "{unit}", mavg("unit_price")).replace("{disc}", mavg("discount_pct"))
add("top_products", _TOP.replace("{source}", f"""(
  SELECT * FROM items_ev JOIN (SELECT order_id AS oid FROM silver_orders_ev WHERE {DONE}
    AND event_timestamp > {AS_OF} - INTERVAL 30 DAY AND event_timestamp <= {AS_OF}) ON oid = order_id)"""))
add("top_products_calendar", _TOP.replace("{source}", f"""(
  SELECT * FROM items JOIN (SELECT order_id AS oid FROM silver_orders WHERE {DONE} AND year = 2001 AND month >= 7)
  ON oid = order_id)"""))
_JAN = "year = 2024 AND month = 1"
add("conversion_by_channel", f"""
SELECT s.*, coalesce(total_orders, 0) AS orders, coalesce(rev, 0.0) AS revenue,
       {pct('coalesce(converting_sessions, 0)', 'total_sessions')} AS conversion_rate_pct,
       {ratio('coalesce(rev, 0)', 'total_orders', 2)} AS avg_order_value
FROM (SELECT utm_source, utm_medium, device_type, count(DISTINCT session_id) AS total_sessions,
             count(DISTINCT user_id) AS unique_users FROM silver_clickstream WHERE {_JAN} GROUP BY ALL) s
LEFT JOIN (SELECT utm_source, utm_medium, device_type, count(DISTINCT session_id) AS converting_sessions,
                  count(DISTINCT order_id) AS total_orders, {r(msum('total_amount'), 2)} AS rev
           FROM silver_orders_ev WHERE {_JAN} AND {DONE} GROUP BY ALL) o
  ON s.utm_source = o.utm_source AND s.utm_medium = o.utm_medium AND s.device_type = o.device_type""")
add("hourly_revenue_trend", f"""
SELECT *, CAST(sum({units('gross_revenue')}) OVER (PARTITION BY country ORDER BY hour ROWS UNBOUNDED PRECEDING) AS DOUBLE)
          / 100 AS cumulative_revenue
FROM (SELECT hour, country, count(order_id) AS orders, count(DISTINCT user_id) AS buyers,
             {r(msum('total_amount'), 2)} AS gross_revenue,
             {r(msum('total_amount - discount_amount'), 2)} AS net_revenue, {mavg('total_amount')} AS avg_order_value
      FROM silver_orders_ev WHERE {_JAN} AND day = 30 AND order_status <> 'cancelled' GROUP BY ALL)""")


def _cart_sessions(money: str) -> str:
    return f"""
  SELECT session_id, user_id, country, device_type, customer_segment, count(DISTINCT product_id) AS products_added,
         {r(money, 2)} AS potential_revenue, max(event_timestamp) AS last_activity
  FROM silver_carts WHERE action = 'item_added' GROUP BY ALL"""


def _abandoned(keys: str) -> str:
    k = f"{keys}, " if keys else ""
    return f"""
  SELECT {k}count(c.session_id) AS cart_sessions, count(conv) AS converted_sessions,
         count(c.session_id) - count(conv) AS abandoned_carts,
         {pct('count(c.session_id) - count(conv)', 'count(c.session_id)')} AS abandonment_rate_pct,
         {r(msum('CASE WHEN conv IS NULL THEN potential_revenue ELSE 0 END'), 2)} AS lost_revenue
  FROM cart_sess c LEFT JOIN (SELECT DISTINCT session_id AS conv FROM silver_orders_ev) ON c.session_id = conv
  {'GROUP BY ALL' if keys else ''}"""


_SUM = _cart_sessions(msum("cart_total"))
add("abandoned_carts", _abandoned("country, device_type, customer_segment"), cart_sess=_SUM)
add("abandoned_carts_last_total", _abandoned("country, device_type, customer_segment"),
    cart_sess=_cart_sessions("max(cart_total)"))
add("abandonment_by_country", _abandoned("country"), cart_sess=_SUM)
add("lost_revenue", f"SELECT abandoned_carts, lost_revenue FROM ({_abandoned('')})", cart_sess=_SUM)
add("abandoned_cart_list", "SELECT * FROM cart_sess WHERE session_id NOT IN (SELECT session_id FROM silver_orders_ev)",
    cart_sess=_SUM)
add("abandonment_trend", f"""
SELECT strftime(last_activity, '%Y-%m-%d') AS day, count(*) AS cart_sessions, count(conv) AS converted_sessions,
       {pct('count(*) - count(conv)', 'count(*)')} AS abandonment_rate_pct
FROM cart_sess LEFT JOIN (SELECT DISTINCT session_id AS conv FROM silver_orders_ev) ON session_id = conv GROUP BY 1""",
    cart_sess=_SUM)
_COHORT = f"""
  SELECT f.user_id, cohort_month, order_month,
         {_i('(year(order_month) - year(cohort_month)) * 12 + month(order_month) - month(cohort_month)')} AS n
  FROM (SELECT user_id, date_trunc('month', min(event_timestamp)) AS cohort_month FROM silver_orders WHERE {DONE} GROUP BY 1) f
  JOIN (SELECT DISTINCT user_id, date_trunc('month', event_timestamp) AS order_month FROM silver_orders WHERE {DONE}) m
    ON f.user_id = m.user_id"""
add("cohort_retention", f"""
SELECT strftime(cohort_month, '%Y-%m') AS cohort_label, n AS months_since_acquisition,
       count(DISTINCT user_id) AS active_customers, count(DISTINCT user_id) AS cohort_size, 100.0::DOUBLE AS retention_rate_pct
FROM cohorts WHERE n BETWEEN 0 AND 11 GROUP BY ALL""", cohorts=_COHORT)
add("cohort_retention_true", f"""
SELECT cohort_label, n AS months_since_acquisition, active AS active_customers, size AS cohort_size,
       {pct('active', 'size')} AS retention_rate_pct
FROM (SELECT strftime(cohort_month, '%Y-%m') AS cohort_label, n, count(DISTINCT user_id) AS active FROM cohorts
      WHERE n BETWEEN 0 AND 11 GROUP BY ALL)
JOIN (SELECT strftime(cohort_month, '%Y-%m') AS label, count(DISTINCT user_id) AS size FROM cohorts GROUP BY ALL)
  ON label = cohort_label""", cohorts=_COHORT)
_BOUNCES = "CAST(SUM(CASE WHEN is_bounce THEN 1 ELSE 0 END) AS BIGINT)"
add("active_users", f"""
SELECT date_trunc('minute', event_timestamp) AS minute_bucket, device_type, page_type,
       count(DISTINCT session_id) AS active_sessions, count(DISTINCT user_id) AS active_users,
       count(event_id) AS page_views, {iavg('time_on_page_seconds', 1)} AS avg_time_on_page, {_BOUNCES} AS bounces,
       {pct(_BOUNCES, 'count(event_id)')} AS bounce_rate_pct
FROM silver_clickstream GROUP BY ALL""")
add("aov_by_segment", f"""
SELECT customer_segment, country, count(DISTINCT user_id) AS customers, count(order_id) AS orders,
       {mavg('total_amount')} AS avg_order_value, {r('quantile_cont(total_amount, 0.25)', 2)} AS aov_p25,
       {r('quantile_cont(total_amount, 0.5)', 2)} AS aov_median, {r('quantile_cont(total_amount, 0.75)', 2)} AS aov_p75,
       {r('quantile_cont(total_amount, 0.95)', 2)} AS aov_p95, {r(msum('total_amount'), 2)} AS total_revenue,
       {iavg('item_count', 1)} AS avg_items_per_order
FROM silver_orders WHERE {DONE} GROUP BY ALL HAVING count(order_id) >= 10""")


def _status(s: str) -> str:
    return cnt_if(f"payment_status = '{s}'")


add("payment_success", f"""
SELECT payment_method, payment_gateway, country, failure_reason, count(payment_id) AS total_transactions,
       {_status('success')} AS successful, {_status('failed')} AS failed, {_status('declined')} AS declined,
       {iavg('processing_time_ms', 0)} AS avg_processing_ms, {mavg('amount')} AS avg_transaction_amount,
       {r(msum("CASE WHEN payment_status = 'success' THEN amount ELSE 0 END"), 2)} AS successful_volume,
       {cnt_if("failure_reason = 'fraud_detected'")} AS fraud_count,
       {pct(_status('success'), 'count(payment_id)')} AS success_rate_pct
FROM silver_payments WHERE {_JAN} GROUP BY ALL""")
add("search_performance", f"""
SELECT *, {pct('zero_result_searches', 'search_count')} AS zero_result_rate_pct,
       {pct('search_count', '(sum(search_count) OVER ())', 3)} AS search_share_pct
FROM (SELECT lower(trim(search_query)) AS query, count(event_id) AS search_count,
             count(DISTINCT session_id) AS searching_sessions, {iavg('search_result_count', 0)} AS avg_results,
             {cnt_if('search_result_count = 0')} AS zero_result_searches
      FROM silver_clickstream WHERE page_type = 'search_results' AND search_query IS NOT NULL AND {_JAN} GROUP BY 1)
WHERE search_count >= 5 ORDER BY search_count DESC, query LIMIT 100""")
add("dq_monitor", f"""
SELECT 'silver_orders' AS table_name, year, month, day, count(*) AS total_records,
       {cnt_if('order_id IS NULL')} AS null_order_ids, {cnt_if('user_id IS NULL')} AS null_user_ids,
       {cnt_if('total_amount <= 0')} AS invalid_amounts, {cnt_if('total_amount > 10000')} AS suspicious_amounts,
       {cnt_if("country IS NULL OR country = 'UNKNOWN'")} AS unknown_country, {mavg('total_amount')} AS avg_order_value,
       min(event_timestamp) AS earliest_event, max(event_timestamp) AS latest_event,
       count(DISTINCT order_id) AS distinct_orders, count(DISTINCT user_id) AS distinct_users
FROM silver_orders GROUP BY year, month, day""")

# ---- views and reports ---------------------------------------------------------------------


def _metrics(fact: str, today: str) -> str:
    days = f"date_diff('day', CAST(max(order_timestamp) AS DATE), CAST({today} AS DATE))"
    return f"""
  SELECT md5(user_id) AS user_sk, *, CAST(CASE WHEN days_since_last_order > 180 THEN 0.9 WHEN days_since_last_order > 90 THEN 0.65
              WHEN days_since_last_order > 45 THEN 0.35 WHEN days_since_last_order > 21 THEN 0.15 ELSE 0.05 END AS DOUBLE)
           AS churn_risk_score,
         {r('total_spend * 0.5::DOUBLE + total_orders * 10 + CASE WHEN days_since_last_order < 30 THEN 100 ELSE 0 END', 2)}
           AS ltv_score, true AS is_active
  FROM (SELECT user_id, count(DISTINCT order_id) AS total_orders, {r(msum('order_total'), 2)} AS total_spend,
               {mavg('order_total')} AS avg_order_value,
               strftime(min(order_timestamp), '%Y-%m-%d') AS first_order_date,
               strftime(max(order_timestamp), '%Y-%m-%d') AS last_order_date, max(country) AS country,
               max(customer_segment) AS customer_segment, bool_or(is_prime) AS is_prime,
               {_i(days)} AS days_since_last_order
        FROM {fact} GROUP BY user_id)
  LEFT JOIN (SELECT user_id AS uid, primary_category AS preferred_category
             FROM {fact} WHERE primary_category IS NOT NULL GROUP BY user_id, primary_category
             QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY count(*) DESC, primary_category) = 1) ON uid = user_id"""


_USERS = _metrics("fact_orders", ORDERS_AS_OF)
_UCOLS = ("user_sk, user_id, country, customer_segment, is_prime, first_order_date, last_order_date, total_orders, "
          "total_spend, avg_order_value, preferred_category, days_since_last_order, churn_risk_score, ltv_score, is_active")
add("orders_enriched", f"""
SELECT f.order_id, f.event_id, f.user_id, f.session_id, f.order_timestamp, f.order_status, f.payment_method, f.currency,
       f.item_count, f.order_total, f.subtotal, f.tax_amount, f.shipping_cost, f.discount_amount, f.effective_discount_pct,
       f.order_value_tier, f.primary_category, f.distinct_products, f.is_prime, f.is_gift, f.is_weekend,
       f.order_hour_bucket, f.utm_source, f.utm_medium, f.country, u.customer_segment,
       u.total_orders AS customer_total_orders, u.total_spend AS customer_total_spend, u.avg_order_value AS customer_aov,
       u.churn_risk_score, u.ltv_score, u.preferred_category, u.is_active AS customer_is_active, d.device_type, d.device_os,
       d.browser, d.device_class, d.is_mobile, t.full_date AS order_date, t.year, t.month, t.day, t.week_of_year,
       t.day_name, t.month_name, t.quarter, coalesce(f.{DONE}, false) AS is_completed
FROM fact_orders f LEFT JOIN users u USING (user_sk) LEFT JOIN dim_devices d ON f.device_sk = d.device_sk
LEFT JOIN dim_time t ON f.date_key = t.date_key""", users=_USERS)
_DAY = "strftime(order_timestamp, '%Y-%m-%d')"
add("revenue_by_day", f"""
SELECT *, {ratio('gross_revenue', 'unique_buyers', 2)} AS revenue_per_customer,
       {r('gross_revenue - lag(gross_revenue, 30) OVER (PARTITION BY country ORDER BY order_date, payment_method, order_value_tier)', 2)}
         AS revenue_delta_30d
FROM (SELECT {_DAY} AS order_date, year, month, monthname(order_timestamp) AS month_name,
             {_i('quarter(order_timestamp)')} AS quarter, country, payment_method, order_value_tier,
             count(order_id) AS total_orders, {cnt_if('is_weekend')} AS weekend_orders,
             count(DISTINCT user_id) AS unique_buyers, {isum('item_count')} AS total_units,
             {r(msum('order_total'), 2)} AS gross_revenue, {r(msum('order_total - discount_amount'), 2)} AS net_revenue,
             {r(msum('discount_amount'), 2)} AS total_discounts, {r(msum('shipping_cost'), 2)} AS total_shipping,
             {r(msum('tax_amount'), 2)} AS total_tax, {mavg('order_total')} AS aov,
             {r('median(order_total)', 2)} AS median_order_value
      FROM fact_orders WHERE {DONE} GROUP BY ALL)""")
_DAILY = f"SELECT country, CAST(order_timestamp AS DATE) AS d, {r(msum('order_total'), 2)} AS revenue FROM fact_orders WHERE {DONE} GROUP BY ALL"
add("revenue_delta_30d", f"""
SELECT a.country, strftime(a.d, '%Y-%m-%d') AS order_date, a.revenue, coalesce(b.revenue, 0) AS revenue_before,
       {r('a.revenue - coalesce(b.revenue, 0)', 2)} AS revenue_delta_30d
FROM daily a LEFT JOIN daily b ON b.d = a.d - 30 AND b.country IS NOT DISTINCT FROM a.country""", daily=_DAILY)


def _category_join(dims: str, price: str, ranks: str) -> str:
    micro = "CAST(ROUND(order_total * 1e6::DOUBLE / NULLIF(item_count, 0)) AS BIGINT)"
    return f"""
SELECT *, {ranks}
FROM (SELECT product_id, product_name, p.category, brand, {dims}, count(order_id) AS order_count,
             {isum('item_count')} AS units_sold, {r(msum('order_total'), 2)} AS total_revenue,
             {r(f'CAST(SUM({micro}) AS DOUBLE) / 1e6::DOUBLE / COUNT({micro})', 2)} AS {price},
             {mavg('effective_discount_pct')} AS avg_discount_pct
      FROM fact_orders_ev f JOIN dim_products_ev p ON f.primary_category = p.category WHERE {DONE} GROUP BY ALL)"""


add("product_sales", _category_join(
    "year, month, monthname(order_timestamp) AS month_name, CAST(quarter(order_timestamp) AS INT) AS quarter, country, device_type",
    "avg_item_price", "rank() OVER (PARTITION BY year, month, category ORDER BY total_revenue DESC) AS category_rank, "
    "rank() OVER (PARTITION BY year, month ORDER BY total_revenue DESC) AS overall_rank"), dim_products_ev=DIM_PRODUCTS_EV)
add("rpt_product_performance", _category_join(
    "year, month", "avg_selling_price", "rank() OVER (PARTITION BY year, month, category ORDER BY total_revenue DESC) AS revenue_rank"),
    dim_products_ev=DIM_PRODUCTS_EV)
add("rpt_daily_revenue", f"""
SELECT *, {ratio('gross_revenue', 'unique_customers', 2)} AS revenue_per_customer
FROM (SELECT {_DAY} AS report_date, country, device_type, payment_method, customer_segment, count(order_id) AS total_orders,
             count(DISTINCT user_id) AS unique_customers, {r(msum('order_total'), 2)} AS gross_revenue,
             {r(msum('order_total - discount_amount'), 2)} AS net_revenue, {r(msum('discount_amount'), 2)} AS total_discounts,
             {mavg('order_total')} AS avg_order_value, {r(msum('shipping_cost'), 2)} AS total_shipping,
             {r(msum('tax_amount'), 2)} AS total_tax
      FROM fact_orders WHERE {DONE} GROUP BY ALL)""")
add("conversion_funnel", f"""
SELECT s.*, {pct('bounces', 'total_sessions')} AS bounce_rate_pct, coalesce(cs, 0) AS converting_sessions,
       coalesce(n, 0) AS orders, coalesce(rev, 0.0) AS revenue, {pct('coalesce(cs, 0)', 'total_sessions')} AS conversion_rate_pct,
       {ratio('rev', 'n', 2)} AS aov
FROM (SELECT strftime(view_timestamp, '%Y-%m-%d') AS session_date, country, device_type, utm_source, customer_segment,
             count(DISTINCT session_id) AS total_sessions, count(DISTINCT user_id) AS unique_users,
             count(event_id) AS page_views, {cnt_if('is_bounce')} AS bounces,
             {iavg('time_on_page_seconds', 1)} AS avg_time_on_page FROM fact_clickstream GROUP BY ALL) s
LEFT JOIN (SELECT {_DAY} AS d, country, device_type, utm_source, customer_segment, count(DISTINCT session_id) AS cs,
                  count(order_id) AS n, {r(msum('order_total'), 2)} AS rev FROM fact_orders_ev WHERE {DONE} GROUP BY ALL) c
  ON s.session_date = c.d AND s.country = c.country AND s.device_type = c.device_type AND s.utm_source = c.utm_source
     AND s.customer_segment = c.customer_segment""")
add("payment_analytics", f"""
SELECT strftime(payment_timestamp, '%Y-%m-%d') AS payment_date, year, month, payment_method, payment_gateway,
       payment_status, failure_reason, country, count(payment_id) AS transactions, {r(msum('amount'), 2)} AS volume,
       {mavg('amount')} AS avg_amount, {iavg('processing_time_ms', 0)} AS avg_processing_ms,
       {cnt_if('is_3ds_authenticated')} AS authenticated_3ds, {_status('success')} AS successful,
       {cnt_if("payment_status IN ('failed', 'declined')")} AS failed,
       {pct(_status('success'), 'count(payment_id)')} AS success_rate_pct
FROM fact_payments GROUP BY ALL""")
add("user_segments", f"""
SELECT * EXCLUDE (user_sk, is_active, uid),
       CASE WHEN churn_risk_score >= 0.65 THEN 'High' WHEN churn_risk_score >= 0.35 THEN 'Medium' ELSE 'Low' END
         AS churn_risk_band,
       CASE WHEN ltv_score >= 1000 THEN 'Champion' WHEN ltv_score >= 500 THEN 'Loyal' WHEN ltv_score >= 200 THEN 'Potential'
            ELSE 'New' END AS ltv_band,
       {_i("date_diff('day', CAST(first_order_date AS DATE), CAST(last_order_date AS DATE))")} AS customer_lifespan_days
FROM users""", users=_USERS)
add("hourly_activity", f"""
SELECT *, CAST(sum({units('revenue')}) OVER (PARTITION BY country ORDER BY hour_bucket, device_type ROWS UNBOUNDED PRECEDING)
               AS DOUBLE) / 100 AS cumulative_revenue
FROM (SELECT date_trunc('hour', order_timestamp) AS hour_bucket, country, device_type, count(order_id) AS orders,
             count(DISTINCT user_id) AS buyers, {r(msum('order_total'), 2)} AS revenue, {mavg('order_total')} AS aov
      FROM fact_orders_ev WHERE {DONE} AND order_timestamp >= {AS_OF} - INTERVAL 7 DAY GROUP BY ALL)""")


def _health(name: str, ts: str) -> str:
    loaded = f"({ts} + INTERVAL 15 MINUTE)"
    return f"""SELECT '{name}' AS table_name, count(*) AS total_rows, max({loaded}) AS last_load,
       date_diff('minute', max({loaded}), {AS_OF}) AS minutes_since_load,
       {cnt_if(f'{loaded} >= {AS_OF} - INTERVAL 1 HOUR')} AS rows_last_hour"""


add("pipeline_health", f"""{_health('fact_orders', 'order_timestamp')} FROM fact_orders_ev
UNION ALL {_health('fact_payments', 'payment_timestamp')} FROM fact_payments
UNION ALL {_health('fact_clickstream', 'view_timestamp')} FROM fact_clickstream""")

# ---- merges --------------------------------------------------------------------------------
# the date key of a known order stays that of its first send
_FIRST = f"""
  SELECT order_id AS old_id, order_status AS old_status, {date_key('event_timestamp')} AS old_key FROM raw_orders
  WHERE copy = 0 AND total_amount > 0 AND total_amount < 50000 AND event_timestamp < TIMESTAMP '2001-06-01'"""
add("merge_orders", f"""
SELECT order_id, order_status, order_total, country, coalesce(old_key, date_key) AS date_key, primary_category,
       CASE WHEN old_id IS NULL OR old_status <> order_status THEN {ORDERS_AS_OF} ELSE TIMESTAMP '2001-06-01' END AS loaded_at
FROM fact_orders LEFT JOIN first_load ON old_id = order_id""", first_load=_FIRST)
add("fact_changes", """
SELECT CASE WHEN old_id IS NULL THEN 'insert' ELSE 'update' END AS change, order_id, order_status, order_total, country
FROM fact_orders LEFT JOIN first_load ON old_id = order_id WHERE old_id IS NULL OR old_status <> order_status""",
    first_load=_FIRST)
add("merge_payments", f"""
SELECT payment_id, payment_status, failure_reason, amount,
       CASE WHEN payment_timestamp < TIMESTAMP '2024-01-20' AND payment_status NOT IN ('failed', 'declined')
            THEN TIMESTAMP '2024-01-20' ELSE {AS_OF} END AS loaded_at
FROM fact_payments""")
add("merge_clickstream", f"""
SELECT event_id, session_id, page_type,
       CASE WHEN view_timestamp < TIMESTAMP '2024-01-20' THEN TIMESTAMP '2024-01-20' ELSE {AS_OF} END AS loaded_at
FROM fact_clickstream""")
add("merge_dim_users", f"""
SELECT {_UCOLS}, CASE WHEN early IS NULL THEN {ORDERS_AS_OF} ELSE TIMESTAMP '2000-01-01' END AS created_at,
       {ORDERS_AS_OF} AS updated_at
FROM users LEFT JOIN (SELECT DISTINCT user_id AS early FROM fact_orders WHERE order_timestamp < TIMESTAMP '2000-01-01')
  ON early = user_id""", users=_USERS)
add("merge_dim_products", f"""
SELECT dim_product_sk AS product_sk, * EXCLUDE (dim_product_sk, early),
       CASE WHEN early IS NULL THEN {ORDERS_AS_OF} ELSE TIMESTAMP '2000-01-01' END AS created_at, {ORDERS_AS_OF} AS updated_at
FROM dim_products LEFT JOIN (SELECT DISTINCT product_id AS early FROM items WHERE order_id IN
  (SELECT order_id FROM silver_orders WHERE event_timestamp < TIMESTAMP '2000-01-01')) ON early = product_id""")

# ---- dashboards ----------------------------------------------------------------------------
def _div0(a: str, b: str) -> str:
    return f"coalesce(({a}) / nullif(CAST({b} AS DOUBLE), 0), 0)"


add("kpi_summary", f"""
SELECT total_revenue, {r('total_revenue - discounts', 2)} AS net_revenue, total_orders,
       {r(_div0('total_revenue', 'total_orders'), 2)} AS aov, {r(_div0('cancelled * 100', 'all_orders'), 2)} AS cancel_rate_pct,
       unique_customers, new_customers, returning_customers, avg_ltv, high_churn_risk,
       {r(_div0('paid * 100', 'payments'), 2)} AS payment_success_pct, failed_payments, avg_processing_ms, gmv,
       total_sessions, {r(_div0('total_orders * 100', 'total_sessions'), 2)} AS conversion_rate_pct,
       {r(_div0('bounces * 100', 'views'), 2)} AS bounce_rate_pct, avg_time_on_page, units_sold
FROM (SELECT {msum(f'CASE WHEN {DONE} THEN order_total END')} AS total_revenue,
             {msum(f'CASE WHEN {DONE} THEN discount_amount END')} AS discounts, CAST({cnt_if(DONE)} AS DOUBLE) AS total_orders,
             {cnt_if("order_status = 'cancelled'")} AS cancelled, count(*) AS all_orders,
             CAST(count(DISTINCT user_id) AS DOUBLE) AS unique_customers, CAST(sum(item_count) AS DOUBLE) AS units_sold
      FROM fact_orders_ev),
     (SELECT CAST({cnt_if("customer_segment = 'new'")} AS DOUBLE) AS new_customers,
             CAST({cnt_if("customer_segment IN ('returning', 'vip')")} AS DOUBLE) AS returning_customers,
             {mavg('ltv_score')} AS avg_ltv, CAST({cnt_if('churn_risk_score >= 0.65')} AS DOUBLE) AS high_churn_risk FROM users),
     (SELECT {_status('success')} AS paid, count(*) AS payments,
             CAST({cnt_if("payment_status IN ('failed', 'declined')")} AS DOUBLE) AS failed_payments,
             {iavg('processing_time_ms', 2)} AS avg_processing_ms,
             {msum("CASE WHEN payment_status = 'success' THEN amount END")} AS gmv FROM fact_payments),
     (SELECT CAST(count(DISTINCT session_id) AS DOUBLE) AS total_sessions, {cnt_if('is_bounce')} AS bounces,
             count(*) AS views, {iavg('time_on_page_seconds', 2)} AS avg_time_on_page FROM fact_clickstream)""",
    users=_metrics("fact_orders_ev", AS_OF))


def _mom(measure: str, expr: str) -> str:
    return f"""
SELECT strftime(a.m, '%Y-%m') AS month, a.v AS {measure}, b.v AS prior_{measure},
       {r('coalesce((a.v - b.v) * 100 / nullif(b.v, 0), 0)', 2)} AS mom_pct
FROM monthly a LEFT JOIN monthly b ON a.m = b.m + INTERVAL 1 MONTH"""


for m, e in (("revenue", r(msum("order_total"), 2)), ("orders", "CAST(count(*) AS DOUBLE)")):
    add(f"{m}_mom", _mom(m, e),
        monthly=f"SELECT date_trunc('month', order_timestamp) AS m, {e} AS v FROM fact_orders WHERE {DONE} GROUP BY 1")
_DAYS = f"SELECT {_DAY} AS order_date, {r(msum('order_total'), 2)} AS revenue FROM fact_orders WHERE {DONE} GROUP BY 1"
add("revenue_7d_avg", f"""
SELECT * FROM (
  SELECT full_date AS order_date, revenue,
         {r(f"CAST(sum({units('revenue')}) OVER w AS DOUBLE) / 100 / nullif(count(revenue) OVER w, 0)", 2)} AS revenue_7d_avg
  FROM dim_time LEFT JOIN days ON order_date = full_date
  WINDOW w AS (ORDER BY full_date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW))
WHERE revenue_7d_avg IS NOT NULL""", days=_DAYS)
add("revenue_rag", """
SELECT *, CASE WHEN revenue >= 100000 THEN 'Green' WHEN revenue >= 80000 THEN 'Amber' ELSE 'Red' END AS status FROM days""",
    days=_DAYS)
_REV = r(msum("order_total"), 2)
add("top_category", f"""
SELECT primary_category, {_REV} AS revenue FROM fact_orders WHERE {DONE} GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 1""")
add("orders_by_status", "SELECT order_status, count(*) AS orders FROM fact_orders GROUP BY 1")
for name, col in (("country", "country"), ("payment_method", "payment_method"), ("segment", "customer_segment")):
    add(f"revenue_by_{name}", f"SELECT {col}, {_REV} AS revenue, count(*) AS orders FROM fact_orders WHERE {DONE} GROUP BY 1")
add("revenue_trend_top_countries", f"""
SELECT {_DAY} AS order_date, country, {_REV} AS revenue FROM fact_orders WHERE {DONE} AND country IN
  (SELECT country FROM fact_orders WHERE {DONE} GROUP BY 1 ORDER BY {_REV} DESC, 1 LIMIT 5) GROUP BY ALL""")
add("revenue_heatmap", "SELECT dayname(order_timestamp) AS day_name, " + ", ".join(
    f"coalesce({r(msum(f'CASE WHEN hour = {h} THEN order_total END'), 2)}, 0.0) AS h{h:02d}" for h in range(24))
    + f" FROM fact_orders WHERE {DONE} GROUP BY 1")
add("order_value_histogram", f"""
SELECT floor(order_total / 1000) * 1000 AS bucket, count(*) AS orders FROM fact_orders WHERE {DONE} GROUP BY 1""")
add("churn_histogram", "SELECT floor(churn_risk_score * 10) / 10 AS bucket, count(*) AS customers FROM users GROUP BY 1",
    users=_USERS)
add("live_order_feed", """
SELECT order_id, order_timestamp, user_id, country, order_status, order_total FROM fact_orders_ev
ORDER BY order_timestamp DESC, order_id LIMIT 50""")
add("sessions_by_page_type", "SELECT page_type, count(DISTINCT session_id) AS sessions FROM fact_clickstream GROUP BY 1")
add("sessions_by_device", "SELECT device_type, count(DISTINCT session_id) AS sessions FROM fact_clickstream GROUP BY 1")
add("events_per_minute", """
SELECT date_trunc('minute', view_timestamp) AS minute_bucket, count(*) AS events FROM fact_clickstream GROUP BY 1""")
add("last_hour", f"""
SELECT CAST(n AS DOUBLE) AS orders, coalesce(rev, 0) AS revenue, CAST(s AS DOUBLE) AS active_sessions
FROM (SELECT count(*) AS n, {_REV} AS rev FROM fact_orders_ev WHERE {DONE} AND order_timestamp >= {AS_OF} - INTERVAL 1 HOUR),
     (SELECT count(DISTINCT session_id) AS s FROM fact_clickstream WHERE view_timestamp >= {AS_OF} - INTERVAL 1 HOUR)""")
add("bounce_by_page", f"""
SELECT page_type, count(*) AS views, {cnt_if('is_bounce')} AS bounces, {pct(cnt_if('is_bounce'), 'count(*)')} AS bounce_rate_pct
FROM fact_clickstream GROUP BY 1""")
add("time_by_page", f"SELECT page_type, {iavg('time_on_page_seconds', 2)} AS avg_time_on_page FROM fact_clickstream GROUP BY 1")
add("page_flow", """
SELECT from_page, to_page, count(*) AS transitions
FROM (SELECT page_type AS from_page, lead(page_type) OVER w AS to_page, lead(1) OVER w AS more FROM fact_clickstream
      WINDOW w AS (PARTITION BY session_id ORDER BY view_timestamp, event_id))
WHERE more = 1 GROUP BY ALL""")
add("new_vs_returning", """
SELECT CASE WHEN customer_segment = 'new' THEN 'new' WHEN customer_segment IN ('returning', 'vip') THEN 'returning'
            ELSE 'other' END AS customer_type, count(DISTINCT user_id) AS customers FROM fact_orders GROUP BY 1""")
_SOLD = f"SELECT i.*, year, month, country FROM items i JOIN silver_orders s ON i.order_id = s.order_id WHERE {DONE}"
_SOLD_EV = f"SELECT i.* FROM items_ev i JOIN silver_orders_ev s ON i.order_id = s.order_id WHERE {DONE}"
for name, n, src in (("top_products_20", 20, _SOLD), ("top_products_10", 10, _SOLD_EV)):
    add(name, f"""
SELECT product_id, product_name, category, {r(ITEM_REV, 2)} AS revenue, {isum('quantity')} AS units
FROM sold GROUP BY ALL ORDER BY revenue DESC, product_id LIMIT {n}""", sold=src)
add("revenue_by_category", f"""
SELECT category, {r(ITEM_REV, 2)} AS revenue, {isum('quantity')} AS units FROM sold GROUP BY 1""", sold=_SOLD)
add("brand_performance", f"""
SELECT *, {ratio('revenue', 'orders', 2)} AS aov
FROM (SELECT brand, {r(ITEM_REV, 2)} AS revenue, {isum('quantity')} AS units, count(DISTINCT order_id) AS orders
      FROM sold GROUP BY 1)""", sold=_SOLD)
add("rank_over_time", """
SELECT product_id, year, month, revenue, revenue_rank
FROM (SELECT *, rank() OVER (PARTITION BY year, month ORDER BY revenue DESC) AS revenue_rank FROM monthly)
WHERE product_id IN (SELECT product_id FROM monthly GROUP BY 1 ORDER BY """ + r(msum("revenue"), 2) + """ DESC, 1 LIMIT 5)""",
    sold=_SOLD, monthly=f"SELECT product_id, year, month, {r(ITEM_REV, 2)} AS revenue FROM sold GROUP BY ALL")
add("category_mix", f"""
SELECT *, {pct('revenue', f"(CAST(sum({units('revenue')}) OVER (PARTITION BY country) AS DOUBLE) / 100)")} AS share_pct
FROM (SELECT country, category, {r(ITEM_REV, 2)} AS revenue FROM sold GROUP BY ALL)""", sold=_SOLD)
_STAGES = [("sessions", "silver_clickstream", "true"), ("cart_adds", "silver_carts", "action = 'item_added'"),
           ("orders", "silver_orders_ev", "true"), ("paid", "silver_payments", "payment_status = 'success'")]
add("funnel_stages", f"SELECT *, {pct('sessions', '(max(CASE WHEN stage_no = 1 THEN sessions END) OVER ())')} AS of_sessions_pct FROM ("
    + " UNION ALL ".join(f"SELECT {i} AS stage_no, '{s}' AS stage, count(DISTINCT session_id) AS sessions FROM {t} WHERE {w}"
                         for i, (s, t, w) in enumerate(_STAGES, 1)) + ")")


def _conversion(key: str, eq: str) -> str:
    return f"""
SELECT s.{key}, sessions, coalesce(n, 0) AS order_sessions, {pct('coalesce(n, 0)', 'sessions')} AS conversion_rate_pct
FROM (SELECT {key}, count(DISTINCT session_id) AS sessions FROM silver_clickstream GROUP BY 1) s
LEFT JOIN (SELECT {key}, count(DISTINCT session_id) AS n FROM silver_orders_ev WHERE {DONE} GROUP BY 1) o ON s.{key} {eq} o.{key}"""


add("conversion_by_device", _conversion("device_type", "="))
add("conversion_by_utm", _conversion("utm_source", "="))
add("conversion_by_utm_null_safe", _conversion("utm_source", "IS NOT DISTINCT FROM"))
add("sliced_revenue", f"""
SELECT country, device_type, {_REV} AS revenue, count(*) AS orders FROM fact_orders
WHERE {DONE} AND order_timestamp >= TIMESTAMP '1999-01-01' AND order_timestamp < TIMESTAMP '2001-01-01'
  AND device_type IN ('mobile', 'tablet') AND customer_segment = 'vip' GROUP BY ALL""")
add("visible_orders", f"""
SELECT country, {_REV} AS revenue, count(*) AS orders FROM fact_orders
WHERE {DONE} AND country IN (SELECT n_name FROM nation JOIN region ON n_regionkey = r_regionkey WHERE r_name = 'ASIA') GROUP BY 1""")

# ---- data quality and stream batches: expected from the defect rules, not from JSON --------
_JSON = "e % 97 <> 0"
_NO_KEY = "(e % 89 = 0)"
_NO_USER = "(e % 83 = 0)"
_BAD_CODE = "(e % 79 = 0)"
_BAD_TIME = "(e % 73 = 0)"
_BAD_TEXT = elt("not-a-time,2024,2024-01,10:30", "(e // 73) % 4")
_NEGATIVE = "(e % 71 = 0)"

# entity -> [(check, category, severity, fails when)], only checks that can fail on these records
_FAILS = {
    "orders": [("not_null.user_id", "completeness", "CRITICAL", _NO_USER),
               ("not_null.currency", "completeness", "HIGH", _NO_KEY),
               ("positive.total_amount", "validity", "CRITICAL", f"({_NEGATIVE} OR total_amount = 0)"),
               ("valid_enum.currency", "validity", "MEDIUM", f"({_NO_KEY} OR {_BAD_CODE})"),
               ("valid_timestamp.event_timestamp", "validity", "HIGH", _BAD_TIME),
               ("format.user_id", "consistency", "MEDIUM", _NO_USER)],
    "payments": [("not_null.order_id", "completeness", "CRITICAL", "(order_id IS NULL)"),
                 ("positive.amount", "validity", "CRITICAL", f"({_NEGATIVE} OR amount = 0)"),
                 ("valid_enum.payment_status", "validity", "HIGH", _BAD_CODE),
                 ("valid_timestamp.event_timestamp", "validity", "HIGH", _BAD_TIME)],
    "clickstream": [("valid_enum.page_type", "validity", "LOW", _NO_KEY),
                    ("valid_timestamp.event_timestamp", "validity", "HIGH", _BAD_TIME),
                    ("time_on_page_valid", "validity", "LOW", "(time_on_page_seconds > 3600)")],
}
_DQ = {"orders": ("raw_orders_ev", "order_id", 16), "payments": ("raw_payments", "coalesce(order_id, payment_id)", 8),
       "clickstream": ("raw_clicks", "event_id", 5)}


def _reports(entity: str) -> str:
    table, ident, total = _DQ[entity]
    fails = " + ".join(f"CAST({c} AS INT)" for _, _, _, c in _FAILS[entity])
    soft = " + ".join([f"CAST({c} AS INT)" for _, _, s, c in _FAILS[entity] if s in ("LOW", "MEDIUM")] or ["0"])
    critical = " OR ".join([c for _, _, s, c in _FAILS[entity] if s == "CRITICAL"] or ["false"])
    return f"""
  SELECT dq_record_id, {_i(total)} AS dq_total_checks, {_i(f'{total} - failed')} AS dq_passed, {_i('failed')} AS dq_failed,
         {_i('soft')} AS dq_warnings,
         CASE WHEN failed = 0 THEN 'PASS' WHEN critical THEN 'CRITICAL' ELSE 'FAIL' END AS dq_status,
         {r(f'({total} - failed) / {total}.0::DOUBLE', 4)} AS dq_score, critical, event_timestamp, e
  FROM (SELECT {ident} AS dq_record_id, {fails} AS failed, {soft} AS soft, {critical} AS critical, event_timestamp, e
        FROM {table} WHERE {_JSON})"""


for entity in _DQ:
    add(f"dq_{entity}", f"SELECT * EXCLUDE (critical, event_timestamp, e) FROM reports", reports=_reports(entity))


def _summary(entity: str) -> str:
    return f"""
  SELECT '{entity}' AS entity, count(*) AS total_records, {cnt_if("dq_status = 'PASS'")} AS passed_records,
         {cnt_if("dq_status <> 'PASS'")} AS failed_records, {cnt_if('critical')} AS critical_failures,
         {pct(cnt_if("dq_status = 'PASS'"), 'count(*)')} AS pass_rate_pct,
         {r("CAST(SUM(CAST(ROUND(dq_score * 10000) AS BIGINT)) AS DOUBLE) / 10000 / count(*)", 4)} AS avg_quality_score,
         {cnt_if("dq_status <> 'PASS'")} * 10 > count(*) AS alert
  FROM ({_reports(entity)})"""


_SUMMARIES = " UNION ALL ".join(_summary(e) for e in _DQ)
add("dq_summary", "SELECT * FROM summaries", summaries=_SUMMARIES)
add("dq_metrics", " UNION ALL ".join(
    f"SELECT {AS_OF} AS measured_at, entity, '{m}' AS metric, CAST({c} AS DOUBLE) AS value FROM summaries"
    for m, c in (("PassRate", "pass_rate_pct"), ("CriticalFailures", "critical_failures"), ("AvgQualityScore", "avg_quality_score"))),
    summaries=_SUMMARIES)
_FAILURES = " UNION ALL ".join(
    f"SELECT '{e}' AS entity, '{n}' AS check_name, '{c}' AS category, {cnt_if(w)} AS failures FROM {_DQ[e][0]} WHERE {_JSON}"
    for e in _DQ for n, c, _, w in _FAILS[e])
add("dq_alerts", f"""
SELECT {AS_OF} AS raised_at, 'dq' AS source, 'High DQ failure rate: ' || entity AS subject,
       'Failed records: ' || failed_records || '/' || total_records || ' (' || printf('%.1f', 100.0 - pass_rate_pct) || '%); worst checks: '
       || coalesce(checks, '') AS message
FROM summaries LEFT JOIN worst USING (entity) WHERE failed_records > 0.01 * total_records""", summaries=_SUMMARIES, failures=_FAILURES,
    ranked="SELECT *, row_number() OVER (PARTITION BY entity ORDER BY failures DESC, check_name) AS k FROM failures WHERE failures > 0",
    worst="SELECT entity, string_agg(check_name || '=' || failures, ', ' ORDER BY k) AS checks FROM ranked WHERE k <= 5 GROUP BY entity")
add("dq_check_failures", "SELECT entity, check_name, failures FROM failures WHERE failures > 0", failures=_FAILURES)
add("dq_category_failures", "SELECT entity, category, CAST(sum(failures) AS BIGINT) AS failures FROM failures "
    "WHERE failures > 0 GROUP BY ALL", failures=_FAILURES)
add("dq_top_failures", "SELECT entity, check_name, failures FROM failures WHERE entity = 'orders' AND failures > 0 "
    "ORDER BY failures DESC, check_name LIMIT 5", failures=_FAILURES)
add("dq_pass_rate_series", f"""
SELECT 'orders' AS entity, time_bucket(INTERVAL 5 MINUTE, event_timestamp + to_minutes(CAST(e % 7 AS BIGINT))) AS window_start,
       count(*) AS records, {pct(cnt_if("dq_status = 'PASS'"), 'count(*)')} AS pass_rate_pct, {cnt_if('critical')} AS critical_failures,
       {r("CAST(SUM(CAST(ROUND(dq_score * 10000) AS BIGINT)) AS DOUBLE) / 10000 / count(*)", 4)} AS avg_quality_score
FROM reports GROUP BY ALL""", reports=_reports("orders"))

_PARTS = ("CAST(year(t) AS INT) AS year, CAST(month(t) AS INT) AS month, CAST(day(t) AS INT) AS day, "
          "CAST(hour(t) AS INT) AS hour")
_ARRIVAL = "event_timestamp + to_minutes(CAST(e % 7 AS BIGINT))"

# stream -> (rows, [(fails when, reason)] in order of precedence), applied to one copy of a record
_RULES = {
    "orders": ("raw_orders_ev", [
        ("e % 97 = 0", "'JSON decode error'"),
        (_NO_KEY, "'Schema error: Missing required fields: currency'"),
        (f"({_NO_USER} AND country IS NULL)", "'Schema error: Null values in required fields: country, user_id'"),
        (_NO_USER, "'Schema error: Null values in required fields: user_id'"),
        ("(country IS NULL)", "'Schema error: Null values in required fields: country'"),
        (_NEGATIVE, "'Business rule: Invalid total_amount: -' || CAST(total_amount AS VARCHAR)"),
        ("(total_amount = 0)", "'Business rule: Invalid total_amount: 0.0'"),
        (_BAD_CODE, "'Business rule: Unsupported currency: XYZ'"),
        (_BAD_TIME, "'Business rule: Invalid event_timestamp: ' || " + _BAD_TEXT)]),
    "payments": ("raw_payments", [
        ("e % 97 = 0", "'JSON decode error'"),
        (_NO_KEY, "'Schema: Missing fields: currency'"),
        (f"({_NO_USER} AND order_id IS NULL)", "'Schema: Null required fields: order_id, user_id'"),
        (_NO_USER, "'Schema: Null required fields: user_id'"),
        ("(order_id IS NULL)", "'Schema: Null required fields: order_id'"),
        (_NEGATIVE, "'Validation: Invalid amount: -' || CAST(amount AS VARCHAR)"),
        ("(amount = 0)", "'Validation: Invalid amount: 0.0'"),
        (_BAD_CODE, "'Validation: Invalid status: XYZ'"),
        (_BAD_TIME, "'Validation: Invalid timestamp: ' || " + _BAD_TEXT)]),
    "clickstream": ("raw_clicks", [
        ("e % 97 = 0", "'JSON decode error'"), (_NO_KEY, "'Missing: page_type'"), (_BAD_TIME, "'Invalid timestamp'")]),
    "carts": ("raw_carts", [
        ("e % 97 = 0", "'JSON decode error'"), (_NO_KEY, "'Missing: cart_id'"), (_BAD_CODE, "'Invalid action: XYZ'"),
        (_NEGATIVE, "'Invalid unit_price: -' || CAST(unit_price AS VARCHAR)")]),
}


def _judged(stream: str, copies: bool) -> str:
    table, rules = _RULES[stream]
    reason = "CASE " + " ".join(f"WHEN {c} THEN {t}" for c, t in rules) + " END"
    twice = " CROSS JOIN (VALUES (0), (1)) v(again) WHERE again = 0 OR e % 67 = 0" if copies else ""
    return f"SELECT *, {reason} AS reason FROM {table}{twice}"


add("ingest_orders", f"""
SELECT event_id, order_id, user_id, total_amount, item_count, {r('subtotal / item_count', 2)} AS average_item_value,
       dayname(event_timestamp) AS day_of_week, dayofweek(event_timestamp) IN (0, 6) AS is_weekend,
       {_PARTS.replace('(t)', '(event_timestamp)')}, 'prod' AS environment
FROM judged WHERE reason IS NULL""", judged=_judged("orders", False))
_SIGNALS = """list_filter([CASE WHEN amount > 5000 THEN 'high_value_transaction' END,
    CASE WHEN failure_reason = 'fraud_detected' THEN 'gateway_fraud_flag' END,
    CASE WHEN is_3ds_authenticated IS NOT DISTINCT FROM false AND amount > 500 THEN 'no_3ds_high_value' END,
    CASE WHEN gateway_response_code IN ('59', '62', '63') THEN 'suspicious_response_code' END], lambda v: v IS NOT NULL)"""
add("ingest_payments", f"""
SELECT event_id, payment_id, amount, payment_status, len({_SIGNALS}) > 0 AS is_fraud_flagged,
       coalesce(array_to_string({_SIGNALS}, ','), '') AS fraud_signals, {_PARTS.replace('(t)', '(event_timestamp)')}
FROM judged WHERE reason IS NULL""", judged=_judged("payments", False))
add("fraud_signals", f"""
SELECT signal, count(*) AS payments FROM (SELECT unnest({_SIGNALS}) AS signal FROM judged WHERE reason IS NULL) GROUP BY 1""",
    judged=_judged("payments", False))
_STAMP = f"{_ARRIVAL} + to_seconds(again)"
add("ingest_clickstream", f"""
SELECT event_id, CASE WHEN e % 83 <> 0 THEN user_id END AS user_id, page_type, {_PARTS.replace('(t)', '(event_timestamp)')},
       {_STAMP} AS ingestion_timestamp
FROM judged WHERE reason IS NULL""", judged=_judged("clickstream", True))
_LAG = f"date_diff('microsecond', event_timestamp, {_STAMP}) / 1000000"
add("ingestion_lag", f"""
SELECT date_trunc('day', event_timestamp)::TIMESTAMP AS window_start, count(*) AS records, {r(f'quantile_cont({_LAG}, 0.5)', 6)} AS lag_p50,
       {r(f'quantile_cont({_LAG}, 0.95)', 6)} AS lag_p95, max({_LAG}) AS lag_max
FROM judged WHERE reason IS NULL GROUP BY 1""", judged=_judged("clickstream", True))


def _bucket(units: str) -> str:
    """64 buckets a doubling, one a value below 64; the numbers here are not negative."""
    return (f"CASE WHEN {units} < 64 THEN {units} ELSE 64 * (length(bin({units})) - 7) "
            f"+ ({units} >> CAST(greatest(length(bin({units})) - 7, 0) AS BIGINT)) END")


def _middle(code: str, one: float) -> str:
    wide = f"pow(2.0::DOUBLE, {code} // 64 - 1)"
    return f"CAST(CASE WHEN {code} < 64 THEN {code} ELSE ({code} % 64 + 64) * {wide} + ({wide} - 1) / 2 END AS DOUBLE) / {one!r}::DOUBLE"


def _quantiles(rows: str, keys: str, names: dict[str, float], one: float, count: str) -> str:
    """The bucket at place floor(p * (n - 1)) of the ordered rows."""
    found = ", ".join(f"{_middle(f'min(b) FILTER (WHERE i = floor({p}::DOUBLE * (n - 1)))', one)} AS {name}" for name, p in names.items())
    return f"""
SELECT {keys}, CAST(max(n) AS BIGINT) AS {count}, {found}
FROM (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY b) - 1 AS i, count(*) OVER (PARTITION BY {keys}) AS n
      FROM (SELECT *, {_bucket('u')} AS b FROM ({rows})))
GROUP BY {keys}"""


add("order_value_quantiles", _quantiles(
    f"SELECT *, CAST(round(total_amount * 100) AS BIGINT) AS u FROM silver_orders WHERE {DONE} AND total_amount IS NOT NULL",
    "year, month, customer_segment, country", {"aov_p25": 0.25, "aov_median": 0.5, "aov_p75": 0.75, "aov_p95": 0.95}, 100.0, "orders"))
add("ingestion_lag_merged", _quantiles(
    f"SELECT date_trunc('day', event_timestamp)::TIMESTAMP AS window_start, CAST(date_diff('microsecond', event_timestamp, {_STAMP}) AS BIGINT) AS u "
    "FROM judged WHERE reason IS NULL", "window_start", {"lag_p50": 0.5, "lag_p95": 0.95}, 1000000.0, "records"),
    judged=_judged("clickstream", True))
_T = f"(CASE WHEN {_BAD_TIME} THEN {_STAMP} ELSE event_timestamp END)"
add("ingest_carts", f"""
SELECT event_id, CASE WHEN e % 83 <> 0 THEN user_id END AS user_id, action, {r('unit_price * quantity', 2)} AS cart_value,
       {_PARTS.replace('(t)', _T)}, {_STAMP} AS ingestion_timestamp
FROM judged WHERE reason IS NULL""", judged=_judged("carts", True))
add("ingest_dead_letters", "SELECT stream, reason, count(*) AS records FROM (" + " UNION ALL ".join(
    f"SELECT '{s}' AS stream, reason FROM ({_judged(s, True)})" for s in _RULES) + ") WHERE reason IS NOT NULL GROUP BY ALL")


def _batch(s: str) -> str:
    dedup = s in ("orders", "payments")
    valid = cnt_if("reason IS NULL AND again = 0") if dedup else cnt_if("reason IS NULL")
    dups = cnt_if("reason IS NULL AND again = 1") if dedup else "0"
    fraud = cnt_if(f"reason IS NULL AND again = 0 AND len({_SIGNALS}) > 0") if s == "payments" else "0"
    gone = cnt_if("reason IS NULL AND action = 'cart_abandoned'") if s == "carts" else "0"
    return f"""SELECT '{s}' AS stream, CAST(0 AS BIGINT) AS batch_id, count(*) AS total_records, {valid} AS valid_records,
       count(reason) AS failed_records, CAST({dups} AS BIGINT) AS duplicate_records, CAST({fraud} AS BIGINT) AS fraud_flagged,
       CAST({gone} AS BIGINT) AS abandonments, {pct('count(reason)', 'count(*)')} AS failure_rate_pct
  FROM ({_judged(s, True)})"""


_BATCHES = " UNION ALL ".join(_batch(s) for s in _RULES)
add("batch_summary", "SELECT * FROM batches", batches=_BATCHES)
add("failure_alerts", f"""
SELECT {AS_OF} AS raised_at, stream AS source, 'High failure rate' AS subject,
       'Batch 0: ' || failed_records || '/' || total_records AS message
FROM batches WHERE stream IN ('orders', 'payments') AND total_records >= 10 AND failed_records > total_records * 0.1""",
    batches=_BATCHES)
_LETTERS = f"""
  SELECT CASE WHEN event_id % 13 <> 0 THEN {elt('S3 write failed: timeout,Schema error: Missing required fields: currency,'
         'ServiceUnavailableException: slow down,JSON decode error,ProvisionedThroughputExceededException: keys', 'event_id % 5')}
         ELSE 'unknown' END AS reason,
         CASE WHEN event_id % 17 <> 0 THEN {elt('orders,payments,clickstream,carts', 'event_id % 4')} ELSE 'unknown' END AS stream,
         event_id, ts,
         CASE WHEN event_id % 13 <> 0 AND event_id % 5 IN (0, 2, 4) THEN 'recoverable' ELSE 'permanent' END AS disposition
  FROM events WHERE event_type = 'error'"""
add("dlq_triage", "SELECT stream, disposition, count(*) AS records FROM letters GROUP BY ALL", letters=_LETTERS)
add("dlq_redrive", "SELECT 'EVT-' || event_id AS event_id, ts AS arrival_ts FROM letters "
    "WHERE disposition = 'recoverable' AND stream = 'orders'", letters=_LETTERS)
add("cart_abandonment", f"""
SELECT event_id, '{{' || CASE WHEN e % 83 <> 0 THEN '"user_id":"' || user_id || '",' ELSE '' END || '"session_id":"' || session_id
       || '","cart_id":"' || cart_id || '","cart_total":' || CAST(cart_total AS VARCHAR) || ',"abandoned_at":"'
       || CASE WHEN {_BAD_TIME} THEN {_BAD_TEXT} ELSE strftime(event_timestamp, '%Y-%m-%dT%H:%M:%S.%f') || 'Z' END || '"'
       || CASE WHEN country IS NOT NULL THEN ',"country":"' || country || '"' ELSE '' END || '}}' AS message
FROM judged WHERE reason IS NULL AND action = 'cart_abandoned'""", judged=_judged("carts", True))
