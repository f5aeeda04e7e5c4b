import datetime as dt

from pyspark.sql import functions as F

from tillstream.operators import merge

T0, T1 = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)
FACT = "order_id string, event_id string, order_status string, order_total double, country string, order_timestamp timestamp, loaded_at timestamp"


def fact(spark, *rows):
    return spark.createDataFrame([(k, "e", s, t, c, T0, T0) for k, s, t, c in rows], FACT)


def state(df):
    return {r.order_id: (r.order_status, r.order_total, r.country, r.loaded_at) for r in df.collect()}


def test_merge_orders(spark):
    old = fact(spark, ("a", "pending", 1.0, "US"), ("b", "shipped", 2.0, "US"), ("c", None, 3.0, "US"))
    new = fact(spark, ("a", "shipped", 9.0, "DE"), ("b", "shipped", 8.0, "DE"), ("c", "shipped", 7.0, "DE"), ("d", "pending", 4.0, "FR"))
    once = merge.merge_fact_orders(old, new, T1)
    assert state(once) == {"a": ("shipped", 9.0, "US", T1), "b": ("shipped", 2.0, "US", T0), "c": (None, 3.0, "US", T0),
                           "d": ("pending", 4.0, "FR", T1)}
    assert state(merge.merge_fact_orders(once, new, T1)) == state(once)
    assert merge.duplicate_keys(once, "order_id").count() == 0
    feed = {r.order_id: r.change for r in merge.changes(old, once, "order_id").collect()}
    assert feed == {"a": "update", "d": "insert"}
    assert {r.change for r in merge.changes(once, old, "order_id").collect()} == {"update", "delete"}


def test_insert_only(spark):
    cols = "event_id string, view_timestamp timestamp, loaded_at timestamp"
    old = spark.createDataFrame([("a", T0, T0)], cols)
    new = spark.createDataFrame([("a", T1, T1), ("b", T1, T0), ("b", T0, T0)], cols)
    out = merge.merge_fact_clickstream(old, new, T1)
    assert sorted((r.event_id, r.view_timestamp, r.loaded_at) for r in out.collect()) == [("a", T0, T0), ("b", T1, T1)]


def test_products_keep_category_and_one_row_per_id(spark):
    cols = "product_sk string, product_id string, product_name string, category string, brand string, avg_unit_price double, min_unit_price double, max_unit_price double"
    old = spark.createDataFrame([("k", "p", "old", "Toys", "b", 1.0, 1.0, 1.0, True, T0, T0)],
                                cols + ", is_active boolean, created_at timestamp, updated_at timestamp")
    new = spark.createDataFrame([("k", "p", "new", "Food", "b", 2.0, 2.0, 2.0), ("k", "p", "newer", "Food", "b", 3.0, 3.0, 3.0)], cols)
    r = merge.merge_dim_products(old, new, T1).collect()
    assert [(x.product_name, x.category, x.avg_unit_price, x.created_at, x.updated_at) for x in r] == [("newer", "Toys", 3.0, T0, T1)]


def test_preferred_category_tie(spark):
    df = spark.createDataFrame([("u", "b"), ("u", "a"), ("v", "b"), ("v", "b"), ("v", "a"), ("w", None)], "user_id string, primary_category string")
    assert {r.user_id: r.preferred_category for r in merge.preferred_category(df).collect()} == {"u": "a", "v": "b"}


def test_source_without_a_target_column_inserts_null(spark):
    old = spark.createDataFrame([("a", 1, "x")], "k string, v int, only_old string")
    new = spark.createDataFrame([("b", 2)], "k string, v int")
    out = merge.merge_upsert(old, new, "k", ["v"], on_insert={"only_old": F.lit("new")})
    assert sorted(tuple(r) for r in out.collect()) == [("a", 1, "x"), ("b", 2, "new")]
    assert sorted(tuple(r) for r in merge.merge_upsert(old, new, "k", ["v"]).collect()) == [("a", 1, "x"), ("b", 2, None)]
