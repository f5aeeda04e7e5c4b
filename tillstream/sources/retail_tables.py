"""Entity frames derived from the star-schema and event tables of a data folder.

``orders``/``lineitem``/``part``/``customer`` give order events with a separate item table; ``events`` gives page views,
carts, payments and orders (these with an ``items`` array). Everything is row-local or an equi-join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstream.functions import domains as d
from tillstream.functions import exprs as x
from tillstream.operators import silver

# Fixed values of the derived records
DEVICES = ["mobile", "desktop", "tablet"]
DEVICE_OS = ["iOS 17", "Windows 11", "iPadOS 17"]
BROWSERS = ["Chrome", "Safari", "Firefox", "Edge"]
UTM_SOURCES = ["google", "facebook", "instagram", "email", "direct", "organic", "twitter", "affiliate"]
UTM_MEDIUMS = ["cpc", "social", "email", "organic", "referral", "display"]
SEARCH_TERMS = ["laptop", "shoes", "shirt", "headphones", "phone", "camera", "watch", "bag", "book", "game"]
CATEGORIES = ["Electronics", "Fashion", "Home", "Sports", "Beauty", "Books", "Toys", "Food"]
GATEWAYS = ["stripe", "paypal", "braintree", "adyen", "square"]
FAILURES = ["insufficient_funds", "card_expired", "fraud_detected", "bank_decline", "invalid_cvv", "address_mismatch"]
GATEWAY_CODES = ["00", "05", "14", "51", "59", "62", "63"]
AB_VARIANTS = ["control", "variant_a", "variant_b"]
VIEWPORTS = ["375", "768", "1280", "1440", "1920"]
SEGMENTS = {"AUTOMOBILE": "new", "BUILDING": "returning", "FURNITURE": "vip", "HOUSEHOLD": "churned",
            "MACHINERY": "returning"}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def pick(values: list[str], index: Column) -> Column:
    return F.elt((index + 1).cast("int"), *[F.lit(v) for v in values])


def _id(prefix: str, col: Column) -> Column:
    return F.concat(F.lit(prefix), col.cast("string"))


def _cents(col: Column) -> Column:
    """Rounded to two digits; for values that are not negative."""
    return F.floor(col * 100 + 0.5) / 100.0


def _session(user: Column, ts: str) -> Column:
    return F.concat(_id("SES-", user), F.lit("-"), x.date_key(ts).cast("string"))


def _segment(col: Column) -> Column:
    out = F  # F.when starts the chain, Column.when continues it
    for market, segment in SEGMENTS.items():
        out = out.when(col == market, segment)
    return out


def _with_customer(df: DataFrame, key: str, spark: SparkSession, folder: str) -> DataFrame:
    """Add segment, nation and region. Joined one table at a time, so Spark sees each file's true size: the two fixed
    tables are broadcast, the customer table only while it is small."""
    c = table(spark, folder, "customer").select("c_custkey", "c_nationkey", _segment(F.col("c_mktsegment"))
                                                .alias("customer_segment"))
    n = table(spark, folder, "nation").select("n_nationkey", "n_name", "n_regionkey")
    r = table(spark, folder, "region").select("r_regionkey", "r_name")
    return (df.join(c, df[key] == c.c_custkey, "left").join(n, F.col("c_nationkey") == n.n_nationkey, "left")
            .join(r, n.n_regionkey == r.r_regionkey, "left"))


# ---- orders from the star schema -----------------------------------------------------------

def raw_orders(spark: SparkSession, folder: str, resend: bool = True, with_customer: bool = True) -> DataFrame:
    """Order events. Every 20th order is sent again an hour later as delivered (``resend``)."""
    o = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
                                              F.col("o_orderdate").cast("timestamp").alias("o_date"))
    k, u = F.col("o_orderkey"), F.col("o_custkey")
    copies = F.when(k % 20 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    o = o.withColumn("copy", F.explode(copies) if resend else F.lit(0))
    status = (F.when(F.col("copy") == 1, "delivered").when(F.col("o_orderstatus") == "F", "delivered")
              .when(F.col("o_orderstatus") == "O", pick(["confirmed", "shipped", "processing"], k % 3))
              .otherwise(pick(["pending", "cancelled"], k % 2)))
    total = F.floor(F.col("o_totalprice") * 12.5 + 0.5) / 100.0
    o = o.withColumns({"order_status": status, "total_amount": total})
    o = o.withColumn("subtotal", _cents(F.col("total_amount") / 1.08))
    if with_customer:
        o = _with_customer(o, "o_custkey", spark, folder)
    else:
        o = o.withColumns({c: F.lit(None).cast("string") for c in ("n_name", "r_name", "customer_segment")})
    return o.select(
        _id("ORD-", k).alias("order_id"), _id("EVT-O", k).alias("event_id"),
        F.lit("order_placed").alias("event_type"), _id("USR-", u).alias("user_id"),
        _session(u, "o_date").alias("session_id"),
        (F.col("o_date") + F.make_dt_interval(hours=(k % 24 + F.col("copy")).cast("int"))).alias("event_timestamp"),
        F.when(k % 50 != 0, F.col("n_name")).alias("country"), F.col("r_name").alias("city"),
        pick(DEVICES, k % 3).alias("device_type"), pick(DEVICE_OS, k % 3).alias("device_os"),
        F.when(k % 30 != 0, pick(BROWSERS, k % 4)).alias("browser"),
        pick(d.PAYMENT_METHODS, k % 7).alias("payment_method"), F.lit("USD").alias("currency"),
        pick(UTM_SOURCES, u % 8).alias("utm_source"), pick(UTM_MEDIUMS, u % 6).alias("utm_medium"),
        "customer_segment", "order_status", "total_amount", "subtotal",
        _cents(F.col("total_amount") - F.col("subtotal")).alias("tax_amount"),
        _cents((k % 5) * 4.99).alias("shipping_cost"),
        _cents(F.col("subtotal") * 0.05 * (k % 6)).alias("discount_amount"),
        (u % 2 == 0).alias("is_prime"), (k % 7 == 0).alias("is_gift"),
        F.when(k % 4 == 0, F.lit("SAVE10")).alias("coupon_code"))


def item_rollup(spark: SparkSession, folder: str) -> DataFrame:
    """Per order: item count, product count, category of the first item (by line number, then part).

    Lines are aggregated with plain long counters before anything is joined, so an order with very many lines costs a
    few partial rows; the part table is looked up once per order, not once per line.
    """
    line_and_part = F.col("l_linenumber").cast("long") * F.lit(2 ** 40) + F.col("l_partkey")
    rolled = table(spark, folder, "lineitem").groupBy(_id("ORD-", F.col("l_orderkey")).alias("order_id")).agg(
        F.count(F.lit(1)).cast("int").alias("item_count"), F.count("l_partkey").alias("distinct_products"),
        F.min(line_and_part).alias("first"))
    rolled = rolled.withColumn("first_part", F.col("first") % F.lit(2 ** 40))
    p = table(spark, folder, "part").select("p_partkey", F.col("p_type").alias("primary_category"))
    return rolled.join(p, rolled.first_part == p.p_partkey, "left").select(
        "order_id", "item_count", "distinct_products", "primary_category")


LINE_SOURCE = ["l_orderkey", "l_partkey", "l_quantity", "l_extendedprice", "l_discount"]


def _line_values() -> list[Column]:
    unit = _cents(F.col("l_extendedprice") / F.col("l_quantity"))
    return [F.col("l_quantity").cast("int").alias("quantity"), unit.alias("unit_price"),
            F.floor(F.col("l_discount") * 100 + 0.5).cast("double").alias("discount_pct"),
            _cents(unit * (1 - F.col("l_discount"))).alias("final_price")]


def order_items(spark: SparkSession, folder: str) -> DataFrame:
    """One row per order item."""
    li = table(spark, folder, "lineitem").select(*LINE_SOURCE)
    p = table(spark, folder, "part").select("p_partkey", "p_name", "p_type", "p_brand")
    return li.join(p, li.l_partkey == p.p_partkey).select(
        _id("ORD-", F.col("l_orderkey")).alias("order_id"), _id("PRD-", F.col("p_partkey")).alias("product_id"),
        F.col("p_name").alias("product_name"), F.col("p_type").alias("category"), F.col("p_brand").alias("brand"),
        *_line_values())


def order_lines(spark: SparkSession, folder: str) -> DataFrame:
    """The order items with no more of the product than its id; ``products`` has the rest."""
    li = table(spark, folder, "lineitem").select(*LINE_SOURCE).filter(F.col("l_partkey").isNotNull())
    return li.select(_id("ORD-", F.col("l_orderkey")).alias("order_id"), _id("PRD-", F.col("l_partkey")).alias("product_id"),
                     *_line_values())


def products(spark: SparkSession, folder: str) -> DataFrame:
    """What ``order_items`` says of a product, one row per row of the part table."""
    return table(spark, folder, "part").filter(F.col("p_partkey").isNotNull()).select(
        _id("PRD-", F.col("p_partkey")).alias("product_id"), F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"), F.col("p_brand").alias("brand"))


def catalog_size(spark: SparkSession, folder: str) -> Column:
    """Number of products, so that the catalogue of the event entities grows with the part table."""
    return table(spark, folder, "part").agg(F.greatest(F.count(F.lit(1)), F.lit(1)).alias("n")).scalar()


# ---- everything that comes from the event table --------------------------------------------

def _events(spark: SparkSession, folder: str, *types: str) -> DataFrame:
    e = table(spark, folder, "events")
    if types:
        e = e.filter(F.col("event_type").isin(*types))
    e = e.select(F.col("event_id").alias("e"), F.col("user_id").alias("u"), F.col("event_type").alias("kind"),
                 "value", F.get_json_object("props", "$.k").cast("int").alias("kk"),
                 F.col("ts").cast("timestamp").alias("ts"))
    u, s = F.col("u"), F.col("u") + F.dayofmonth("ts")
    return _with_customer(e, "u", spark, folder).select(
        "e", "u", "kind", "value", "kk", F.col("ts").alias("event_timestamp"), _id("EVT-", F.col("e")).alias("event_id"),
        _id("USR-", u).alias("user_id"),
        _session(u, "ts").alias("session_id"),
        pick(DEVICES, s % 3).alias("device_type"), pick(DEVICE_OS, s % 3).alias("device_os"),
        F.when(u % 30 != 0, pick(BROWSERS, u % 4)).alias("browser"),
        F.when(u % 50 != 0, F.col("n_name")).alias("country"), F.col("r_name").alias("city"),
        F.when(u % 25 != 24, pick(UTM_SOURCES, u % 8)).alias("utm_source"),
        pick(UTM_MEDIUMS, u % 6).alias("utm_medium"), "customer_segment")


_SESSION = ["event_id", "event_timestamp", "session_id", "user_id", "device_type", "device_os", "browser", "country",
            "city", "utm_source", "utm_medium", "customer_segment"]


def _product(p: Column) -> dict[str, Column]:
    return {"product_id": _id("PRD-", p), "product_name": _id("Item ", p), "category": pick(CATEGORIES, p % 8),
            "brand": _id("Brand ", p % 25), "unit_price": _cents(F.lit(5.0) + p * 2.99)}


def raw_clickstream(spark: SparkSession, folder: str) -> DataFrame:
    e, kk = F.col("e"), F.col("kk")
    page = pick(d.PAGE_TYPES, e % 9)
    search = page == "search_results"
    term = pick(SEARCH_TERMS, e % 10)
    product = _product(e % catalog_size(spark, folder))
    return _events(spark, folder).select(
        "e", *_SESSION, F.lit("page_view").alias("event_type"), page.alias("page_type"),
        F.when(page == "product_detail", product["product_id"]).alias("product_id"),
        F.when(page == "product_detail", product["category"]).alias("category"),
        F.when(search, F.when(e % 4 == 0, F.concat(F.lit(" "), F.upper(term), F.lit(" "))).otherwise(term))
        .alias("search_query"),
        F.when(search, F.when(kk < 10, 0).otherwise(kk)).alias("search_result_count"),
        F.floor(F.col("value") * 10).cast("int").alias("time_on_page_seconds"), kk.alias("scroll_depth_pct"),
        F.when(e % 40 != 0, e % 3 == 0).alias("is_bounce"), (e * 37 % 5000).cast("int").alias("load_time_ms"),
        pick(VIEWPORTS, e % 5).cast("int").alias("viewport_width"), pick(AB_VARIANTS, e % 3).alias("ab_test_variant"))


def raw_carts(spark: SparkSession, folder: str) -> DataFrame:
    e = F.col("e")
    product = _product(e % catalog_size(spark, folder))
    return _events(spark, folder, "click", "view").select(
        "e", *_SESSION, F.lit("cart_event").alias("event_type"),
        F.concat(F.lit("CRT-"), F.col("u").cast("string")).alias("cart_id"),
        F.when(F.col("kind") == "click", "item_added").otherwise(pick(d.CART_ACTIONS[1:], e % 5)).alias("action"),
        *[c.alias(n) for n, c in product.items()], (1 + e % 10).cast("int").alias("quantity"),
        F.col("value").alias("cart_total"), (1 + e % 12).cast("int").alias("cart_item_count"))


def raw_payments(spark: SparkSession, folder: str) -> DataFrame:
    e, ok = F.col("e"), F.col("kind") == "purchase"
    amount = _cents(F.col("value") * 20)
    reason = F.when(~ok, pick(FAILURES, e % 6))
    code, strong = pick(GATEWAY_CODES, e % 7), F.when(e % 45 != 0, e % 5 > 1)
    flagged = ((amount > 5000) | F.coalesce(reason == "fraud_detected", F.lit(False))
               | (F.coalesce(~strong, F.lit(False)) & (amount > 500)) | code.isin(d.SUSPICIOUS_GATEWAY_CODES))
    return _events(spark, folder, "purchase", "error").select(
        "e", *_SESSION, F.lit("payment_processed").alias("event_type"), _id("PAY-", e).alias("payment_id"),
        F.when(ok | (e % 11 != 0), _id("ORD-E", e)).alias("order_id"),
        pick(d.PAYMENT_METHODS, e % 7).alias("payment_method"), pick(GATEWAYS, e % 5).alias("payment_gateway"),
        F.lit("USD").alias("currency"), amount.alias("amount"),
        F.when(ok, "success").otherwise(pick(d.PAYMENT_STATUSES[1:], e % 4)).alias("payment_status"),
        reason.alias("failure_reason"), code.alias("gateway_response_code"),
        (e * 53 % 6000).cast("int").alias("processing_time_ms"), strong.alias("is_3ds_authenticated"),
        F.when(e % 10 != 0, flagged).alias("is_fraud_flagged"), (1 + e % 3).cast("int").alias("installment_plan"))


def raw_orders_ev(spark: SparkSession, folder: str) -> DataFrame:
    """Orders of the purchase events, in the same sessions as the page views; one to three items each."""
    e = F.col("e")

    def item(j: Column) -> Column:
        p = _product((e + j * 7) % F.col("catalog"))
        disc = ((e + j) % 6) * 5.0
        return F.struct(
            *[p[n].alias(n) for n in ("product_id", "product_name", "category", "brand")],
            (1 + (e + j) % 5).cast("int").alias("quantity"), p["unit_price"].alias("unit_price"),
            disc.alias("discount_pct"), _cents(p["unit_price"] * (100 - disc) / 100).alias("final_price"))

    total = F.col("value")
    df = _events(spark, folder, "purchase").withColumns({"subtotal": _cents(total / 1.08),
                                                               "catalog": catalog_size(spark, folder)})
    return df.select(
        "e", *_SESSION, F.lit("order_placed").alias("event_type"), _id("ORD-E", e).alias("order_id"),
        pick(d.ORDER_STATUSES, e % 7).alias("order_status"), pick(d.PAYMENT_METHODS, e % 7).alias("payment_method"),
        F.lit("USD").alias("currency"), total.alias("total_amount"), "subtotal",
        _cents(total - F.col("subtotal")).alias("tax_amount"), _cents((e % 5) * 4.99).alias("shipping_cost"),
        _cents(F.col("subtotal") * 0.05 * (e % 6)).alias("discount_amount"),
        (F.col("u") % 2 == 0).alias("is_prime"), (e % 7 == 0).alias("is_gift"),
        (1 + e % 3).cast("int").alias("item_count"),
        F.transform(F.sequence(F.lit(0).cast("long"), e % 3), item).alias("items"))


# ---- silver over the above -----------------------------------------------------------------

def silver_orders(spark: SparkSession, folder: str, with_items: bool = True, with_customer: bool = True) -> DataFrame:
    rollup = item_rollup(spark, folder) if with_items else None
    return silver.transform_orders(raw_orders(spark, folder, with_customer=with_customer), rollup=rollup)


def silver_orders_ev(spark: SparkSession, folder: str) -> DataFrame:
    return silver.transform_orders(raw_orders_ev(spark, folder))


def silver_payments(spark: SparkSession, folder: str) -> DataFrame:
    return silver.transform_payments(raw_payments(spark, folder))


def silver_clickstream(spark: SparkSession, folder: str) -> DataFrame:
    return silver.transform_clickstream(raw_clickstream(spark, folder))


def silver_carts(spark: SparkSession, folder: str) -> DataFrame:
    return silver.transform_carts(raw_carts(spark, folder))
