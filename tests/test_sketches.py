import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from tillstream.operators import rollups, sketches
from tillstream.sources import retail_tables as rt
from tillstream.streaming import windows


def test_buckets_are_ordered_and_close(spark):
    rng = random.Random(2)
    numbers = sorted({*range(-300, 300), *(rng.randrange(1, 1 << 60) >> rng.randrange(60) for _ in range(800)), (1 << 62) - 1, -(1 << 50)})
    df = spark.createDataFrame([(n,) for n in numbers], "u long").withColumn("b", sketches.bucket(F.col("u")))
    rows = df.withColumn("m", sketches.middle(F.col("b"))).orderBy("u").collect()
    assert all(a.b <= b.b for a, b in zip(rows, rows[1:]))
    assert all(abs(r.m - r.u) <= abs(r.u) * sketches.RELATIVE_ERROR for r in rows)
    assert all(r.m == r.u for r in rows if abs(r.u) < 128)
    assert max(r.b for r in rows) < 64 * 58
    assert spark.sql("select cast(null as long) u").select(sketches.bucket(F.col("u"))).first()[0] is None


@pytest.mark.parametrize("seed", range(3))
def test_quantiles_of_merged_days(spark, seed):
    rng = random.Random(seed)
    rows = [(rng.randrange(4), rng.choice(["a", None]), rng.choice([None, 0, 1, 7, rng.randrange(-500, 10 ** rng.randrange(1, 9))]))
            for _ in range(500)] + [(1, "hot", 12_345)] * 300
    df = spark.createDataFrame(rows, "day int, k string, u long")
    days = sketches.histogram(df, ["day", "k"], F.col("u"))
    names = {"low": 0.0, "mid": 0.5, "high": 0.9, "top": 1.0}
    got = {r.k: r for r in sketches.quantiles(days.filter("day < 3"), ["k"], names, scale=0).collect()}
    for k in ("a", None, "hot"):
        mine = sorted(u for day, key, u in rows if key == k and day < 3 and u is not None)
        assert got[k].n == len(mine)
        for name, p in names.items():
            want = mine[math.floor(p * (len(mine) - 1))]
            assert abs(got[k][name] - want) <= abs(want) * sketches.RELATIVE_ERROR, (k, name)
    assert sketches.quantiles(days.filter("false"), ["k"], names).isEmpty()
    assert sketches.quantiles(days, [], names, scale=0).first().n == sum(u is not None for _, _, u in rows)


def test_distinct_of_all_days_and_months(spark, folder):
    """Days, and months made of days, against exact counts; many more users than registers in a further group."""
    rows = rollups.active_rows(rt.silver_orders_ev(spark, folder), rt.silver_clickstream(spark, folder))
    many = spark.range(60_000).select(F.lit(2024).alias("year"), F.lit(2).alias("month"), (F.col("id") % 9 + 1).cast("int").alias("day"),
                                      F.lit("many").alias("device_type"), F.expr("concat('U', id % 20000)").alias("user_id"),
                                      F.expr("concat('S', id)").alias("session_id"))
    rows = rows.unionByName(many)
    days = rollups.ACTIVE.partials(rows).cache()
    for by in (["year", "month", "day"], ["year", "month"]):
        got = rollups.ACTIVE.totals(days, tuple(by)).select(*by, "device_type", sketches.distinct("user_id").alias("u"),
                                                           sketches.distinct("session_id").alias("s"))
        want = rows.groupBy(*by, "device_type").agg(F.countDistinct("user_id").alias("u"), F.countDistinct("session_id").alias("s"))
        def by_key(df):
            return {tuple(r[c] for c in [*by, "device_type"]): (r.u, r.s) for r in df.collect()}
        found, exact = by_key(got), by_key(want)
        assert found.keys() == exact.keys()
        for key, pair in exact.items():
            for a, b in zip(found[key], pair):
                assert abs(a - b) <= max(1, 4 * sketches.DISTINCT_ERROR * b), (key, a, b)
    with pytest.raises(ValueError):
        rollups.ACTIVE.applied(days, days, days)


def test_histogram_totals_take_deltas(spark):
    """Bucket counts of a day that is made anew leave the total and come back changed."""
    layout = "year int, month int, day int, customer_segment string, country string, bucket int"
    def of(*rows):
        return rollups.ORDER_VALUES.partials(spark.createDataFrame([(2024, 1, d, "s", c, b) for d, c, b in rows], layout))
    old, new = of((1, "US", 5), (1, "US", 5), (2, None, 9)), of((1, "US", 5), (1, "US", 6), (2, None, 9))
    applied = rollups.ORDER_VALUES.applied(rollups.ORDER_VALUES.totals(old), old.where("day = 1"), new.where("day = 1"))
    assert {(r.country, r.bucket, r.rows_n) for r in applied.collect()} == {("US", 5, 1), ("US", 6, 1), (None, 9, 1)}


def test_lag_histogram_of_a_stream_merges_into_days(spark, tmp_path):
    at = dt.datetime(2024, 1, 6)
    rows = [(at + dt.timedelta(minutes=7 * i), at + dt.timedelta(minutes=7 * i, milliseconds=i * i)) for i in range(300)]
    df = spark.createDataFrame(rows, "event_timestamp timestamp, ingestion_timestamp timestamp")
    df.repartition(3).write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(df.schema).parquet(f"{tmp_path}/in")
    got = []
    q = windows.lag_histogram(stream, watermark="2 days").writeStream.outputMode("update").option(
        "checkpointLocation", f"{tmp_path}/cp").trigger(availableNow=True).foreachBatch(lambda d, i: got.extend(d.collect())).start()
    q.awaitTermination(120)
    assert q.exception() is None
    stored = spark.createDataFrame(got, "window_start timestamp, bucket int, n long")
    assert stored.count() == windows.lag_histogram(df).count()
    assert sorted(windows.lag_quantiles(stored).collect()) == sorted(windows.lag_quantiles(windows.lag_histogram(df)).collect())
    exact = sorted((b - a).total_seconds() for a, b in rows if a < at + dt.timedelta(days=1))
    day = windows.lag_quantiles(stored).orderBy("window_start").first()
    assert abs(day.lag_p95 - exact[math.floor(0.95 * (len(exact) - 1))]) <= 0.01 * day.lag_p95
