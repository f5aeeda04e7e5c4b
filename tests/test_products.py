import datetime as dt

import pytest

from tillstream import registry
from tillstream.operators import gold, merge
from tillstream.plans import dashboards, lake
from tillstream.sources import retail_tables as rt


@pytest.fixture(scope="module")
def shop(spark, tmp_path_factory):
    """Parts listed twice, under two names and without a key; lines of unknown parts and orders; missing prices."""
    at = str(tmp_path_factory.mktemp("shop"))
    parts = [(k, f"name {k}", f"type {k % 3}", f"brand {k % 2}") for k in range(1, 12)]
    parts += [parts[3], (5, "other name", "type 2", "brand 1"), (6, "name 6", "type 0", "another brand"), (None, "none", "t", "b")]
    orders = [(k, k % 7, "FOP"[k % 3], 100.0 + k, dt.datetime(1999 + k % 3, 6 + k % 3, 1 + k % 28)) for k in range(1, 121)]
    lines = [(k % 130 if k % 50 else None, k % 14 if k % 37 else None, 1.0 + k % 5, 10.0 * (k % 17) if k % 23 else None, (k % 10) / 100)
             for k in range(1, 1500)]
    for name, rows, schema in (
            ("part", parts, "p_partkey long, p_name string, p_type string, p_brand string"),
            ("orders", orders, "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp"),
            ("lineitem", lines, "l_orderkey long, l_partkey long, l_quantity double, l_extendedprice double, l_discount double")):
        spark.createDataFrame(rows, schema).write.parquet(f"{at}/{name}.parquet")
    return at


def wide(name, spark, at):
    """The same with all columns of the product on every item row."""
    sales, items = registry._sales(spark, at), rt.order_items(spark, at)
    if name == "dim_products":
        return gold.dim_products(sales, items)
    if name == "product_performance":
        return gold.agg_product_performance(sales, items)
    if name == "top_products_calendar":
        return lake.top_products(sales, registry.ORDERS_AS_OF, items, calendar_predicate=True)
    if name == "top_products_20":
        return dashboards.best_products(sales, items, 20)
    stamp = registry.F.lit(registry.USERS_LOADED)
    old = gold.dim_products(sales.filter(registry.F.col("event_timestamp") < stamp), items)
    old = old.withColumnRenamed("dim_product_sk", "product_sk").withColumns({"created_at": stamp, "updated_at": stamp})
    return merge.merge_dim_products(old, gold.dim_products(sales, items), registry.ORDERS_AS_OF)


def joined_columns(plan):
    if plan.nodeName() == "Join":
        out = plan.output()
        yield {out.apply(i).name() for i in range(out.size())}
    for i in range(plan.children().size()):
        yield from joined_columns(plan.children().apply(i))


@pytest.mark.parametrize("name", ["dim_products", "merge_dim_products", "product_performance", "top_products_calendar", "top_products_20"])
def test_products_are_joined_to_sums_with_equal_results(spark, shop, name):
    got = registry.QUERIES[name](spark, shop)
    joined = list(joined_columns(got._jdf.queryExecution().optimizedPlan()))
    named = {"product_name", "category", "brand", "p_name", "p_type", "p_brand"}
    assert joined and not any("order_id" in c and c & named for c in joined)
    want = wide(name, spark, shop)
    assert got.columns == want.columns and [t for _, t in got.dtypes] == [t for _, t in want.dtypes]
    rows = sorted(map(repr, got.collect()))
    assert rows and rows == sorted(map(repr, want.collect()))
