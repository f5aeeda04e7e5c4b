"""Aggregates kept as state: after every run they equal those made anew of all silver."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tillstream.functions.schemas import BRONZE, struct_of
from tillstream.operators import gold, rollups as ops, silver
from tillstream.plans import rollups
from tillstream.sources import lake, snapshots

RUN = dt.datetime(2024, 3, 1)
LAYOUT = "year int, month int, day int, k string, j int, v bigint, at timestamp, w string"
RULE = ops.Rollup(("k", "j"), ("v",), ("low",), ("high", "last"))


def partials(spark, rows):
    df = spark.createDataFrame(rows, LAYOUT)
    return RULE.partials(df.withColumns({"low": F.col("v"), "high": F.col("v"), "last": F.struct("at", "w")}))


def some(rng, days, n):
    keys = [("a", 1), ("a", None), (None, None), ("b", 2), ("c", 3)]
    return [(2024, 1, rng.choice(days), *rng.choice(keys), rng.choice([None, *range(-3, 4)]),
             rng.choice([None, dt.datetime(2024, 1, 1, rng.randrange(3))]), rng.choice([None, "x", "y"])) for _ in range(n)]


@pytest.mark.parametrize("seed", range(4))
def test_totals_take_deltas(spark, seed):
    rng = random.Random(seed)
    old = some(rng, [1, 2, 3], 25)
    changed = [2, 4]
    kept = [r for r in old if r[2] not in changed]
    new = kept + some(rng, changed, rng.choice([0, 3, 12]))
    before, after = (partials(spark, rows) for rows in (old, new))
    applied = RULE.applied(RULE.totals(before), before.where(F.col("day").isin(changed)), after.where(F.col("day").isin(changed)))
    got = RULE.repaired(applied, lambda: after)
    want = RULE.totals(after)
    assert got.columns == want.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_only_keys_that_lost_an_extreme_are_made_anew(spark):
    def of(*rows):
        return partials(spark, [(2024, 1, d, k, 1, v, None, None) for d, k, v in rows])

    old, new = of((1, "a", 5), (2, "a", 1), (1, "b", 5), (2, "b", 9), (2, "c", 1)), of((2, "a", 1), (2, "a", 2), (2, "b", 7))
    applied = RULE.applied(RULE.totals(old), old.where("day = 2"), new)
    assert {(r.k, r._lost, r.v) for r in applied.collect()} == {("a", False, 8), ("b", True, 12)}
    none = of()
    assert RULE.applied(none.drop("year", "month", "day"), none, none).isEmpty()


ITEM = dict(product_id="PRD-1", product_name="n", category="Toys", brand="b", quantity=2, unit_price=10.0, discount_pct=5.0, final_price=9.5)
STATUSES = ["delivered", "confirmed", "cancelled", "shipped"]


def order(n, day, price=10.0, **kw):
    items = [{**ITEM, "product_id": f"PRD-{p}", "category": ["Toys", "Books"][p % 2], "unit_price": price, "final_price": price - 0.5,
              "quantity": None if n % 5 == 0 else 1 + n % 3} for p in {n % 3, n % 4}]
    return {**dict(event_id=f"EVT-{n}-{day}", order_id=f"ORD-{n}", user_id=f"USR-{n % 4}", session_id="SES-1", total_amount=50.0 + n,
                   event_timestamp=f"2024-{1 + (day > 20):02d}-{day:02d}T{n % 24:02d}:00:00Z", subtotal=40.0, country=["US", "DE", None][n % 3],
                   device_type=["mobile", "desktop"][n % 2], device_os="x", browser=[None, "Chrome"][n % 2], payment_method="paypal",
                   customer_segment="new", order_status=STATUSES[n % 4], is_prime=n % 2 == 0, items=items), **kw}


def click(n, day):
    return dict(event_id=f"EVT-{n}-{day}", session_id="SES-1", user_id=f"USR-{n % 6}", page_type="home", country="FR",
                event_timestamp=f"2024-{1 + (day > 20):02d}-{day:02d}T{n % 24:02d}:00:00Z", time_on_page_seconds=1, scroll_depth_pct=1)


def write(spark, root, entity, records, days=None):
    schema = struct_of(BRONZE[entity])
    df = silver.TRANSFORMS[entity](spark.createDataFrame([[r.get(f.name) for f in schema.fields] for r in records], schema), RUN)
    lake.write_silver(df, root, entity, days)


def same_as_rebuilt(spark, root, *names):
    orders, clicks = (lake.read_silver(spark, root, e) for e in ("orders", "clickstream"))
    want = {"dim_users": gold.dim_users(orders, clicks), "dim_products": gold.dim_products(orders), "dim_devices": gold.dim_devices(orders),
            "agg_product_performance": gold.agg_product_performance(orders)}
    for name, df in ((n, want[n]) for n in names or want):
        got = lake.read_gold(spark, root, name).select(*df.columns)
        assert sorted(map(str, got.collect())) == sorted(map(str, df.collect())), name


def day(n):
    return dt.date(2024, 1 + (n > 20), n)


def test_daily_runs_equal_a_rebuild_and_read_changed_days_only(spark, tmp_path, monkeypatch):
    """A first load, a new day, a late record, a dearer product that is taken back, and a day that goes: five runs."""
    root, read, opened = f"{tmp_path}/lake", snapshots.read, []

    def noted(session, path, parts=None, *rest, **kw):
        if "/silver/" in path:
            opened.append(None if parts is None else {lake.day_of(p) for p in parts})
        return read(session, path, parts, *rest, **kw)

    monkeypatch.setattr(snapshots, "read", noted)
    held = {d: [order(n, d) for n in range(6 * i, 6 * i + 6)] for i, d in enumerate((1, 2, 25))}

    def run(changed=None):
        records = [r for d, rs in held.items() for r in rs if changed is None or d in changed]
        write(spark, root, "orders", records, None if changed is None else {day(d) for d in changed})
        opened.clear()
        for name in ops.KEPT:
            rollups.refresh(spark, root, name, RUN)
        assert all(days == (None if changed is None else {day(d) for d in changed}) for days in opened) and opened
        same_as_rebuilt(spark, root)

    write(spark, root, "clickstream", [click(n, d) for n in range(8) for d in (1, 25)])
    run()
    held[26] = [order(n, 26, 99.0) for n in range(40, 44)]
    run([26])
    held[2] = held[2] + [order(50, 2, 0.5), order(51, 2, order_status="delivered", user_id="USR-9")]
    run([2])
    held[26] = [order(n, 26, 3.0) for n in range(40, 43)]  # the dearest price and the last order go
    run([26])
    held[25], held[2] = [], held[2][:-1]
    run([2, 25])

    before = {n: snapshots.load(spark, f"{root}/gold/{n}").version for n in ops.KEPT}
    for name in ops.KEPT:
        rollups.refresh(spark, root, name, RUN)
    assert {n: snapshots.load(spark, f"{root}/gold/{n}").version for n in ops.KEPT} == before  # no news, no version


def test_a_run_cut_short_is_made_up_for(spark, tmp_path):
    """Two days change; the first run dies behind the partials, the second behind the totals. Then old versions expire."""
    root = f"{tmp_path}/lake"
    write(spark, root, "clickstream", [click(n, 1) for n in range(8)])
    write(spark, root, "orders", [order(n, d) for d in (1, 2, 3) for n in range(4 * d, 4 * d + 4)])
    names = "dim_products", "agg_product_performance"
    for name in names:
        rollups.refresh(spark, root, name, RUN)
    write(spark, root, "orders", [order(8, 2, 77.0)], {day(2)})
    rollups.partials(spark, root, "dim_products")
    write(spark, root, "orders", [order(12, 3, 1.0)], {day(3)})
    rollups.partials(spark, root, "dim_products")
    rollups.totals(spark, root, "dim_products")
    for name in names:
        rollups.refresh(spark, root, name, RUN)
    same_as_rebuilt(spark, root, *names)
    for n in (5, 6):
        write(spark, root, "orders", [order(n, 2, float(n))], {day(2)})
        rollups.partials(spark, root, "dim_products")
    assert lake.vacuum(spark, root, keep=1, grace_seconds=0) > 0
    for name in names:
        rollups.refresh(spark, root, name, RUN)
    same_as_rebuilt(spark, root, *names)
