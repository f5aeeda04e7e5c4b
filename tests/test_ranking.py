import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tillstream.operators.ranking import exact_percentiles, with_rank
from tillstream.operators.rows import transitions


def values(seed, n=600):
    rnd = random.Random(seed)
    pool = [0.0, -3.5, 0.01, 5.0, 7.25, 1e6] + [round(rnd.lognormvariate(3, 2), 2) for _ in range(n // 3)]
    return [(rnd.choice(["a", "a", "a", "b", None]), rnd.choice(pool), rnd.randint(1, 4)) for _ in range(n)]


@pytest.mark.parametrize("seed", [1, 2])
def test_rank_equals_window_rank(spark, seed):
    df = spark.createDataFrame(values(seed), "k string, v double, w int")
    got = with_rank(df, ["k"], "v", "r").toPandas()
    want = got.copy()
    want["k"] = want["k"].fillna("?")
    expected = want.groupby("k")["v"].rank(method="min", ascending=False).astype(int)
    assert (want["r"] == expected).all()
    assert len(got) == 600


def test_rank_without_groups_and_with_nulls(spark):
    df = spark.createDataFrame([(3.0,), (None,), (9.0,), (3.0,)], "v double")
    assert sorted(r.r for r in with_rank(df, [], "v", "r").collect()) == [1, 2, 2, 4]


def test_weighted_rank_counts_the_rows_a_row_stands_for(spark):
    df = spark.createDataFrame(values(3), "k string, v double, w int")
    repeated = df.select("k", "v", F.explode(F.array_repeat("v", F.col("w"))).alias("x"))
    want = {(r.k, r.v): r.r for r in with_rank(repeated, ["k"], "v", "r").collect()}
    got = {(r.k, r.v): r.r for r in with_rank(df, ["k"], "v", "r", weight="w").collect()}
    assert got == want


def test_one_value_on_most_rows_is_one_row_of_the_window(spark):
    df = spark.range(20_000).select(F.lit("a").alias("k"), F.when(F.col("id") % 100 == 0, F.col("id") / 7).otherwise(0.0).alias("v"))
    got = with_rank(df, ["k"], "v", "r").groupBy("v").agg(F.min("r").alias("a"), F.max("r").alias("b")).collect()
    values = sorted((r.v for r in got if r.v), reverse=True)
    assert {r.v: (r.a, r.b) for r in got} == {0.0: (200, 200)} | {v: (n, n) for n, v in enumerate(values, 1)}


def test_percentiles_equal_brute_force(spark):
    rows = values(4)
    df = spark.createDataFrame(rows, "k string, v double, w int")
    ps = {"p0": 0.0, "p25": 0.25, "p50": 0.5, "p95": 0.95, "p100": 1.0}
    got = {r.k: r for r in exact_percentiles(df, ["k"], F.col("v"), ps).collect()}
    pdf = pd.DataFrame(rows, columns=["k", "v", "w"])
    for key in ("a", "b", None):
        vals = pdf[pdf.k.isna()]["v"] if key is None else pdf[pdf.k == key]["v"]
        for name, p in ps.items():
            assert got[key][name] == pytest.approx(np.percentile(vals, p * 100), abs=1e-9)


@pytest.mark.parametrize("minutes", [1, 60, 100000])
def test_transitions_do_not_depend_on_the_bucket(spark, minutes):
    rnd = random.Random(5)
    rows = [(rnd.choice(["s1", "s1", "s2"]), rnd.choice("xyz"), i, rnd.randint(0, 20000)) for i in range(400)]
    df = spark.createDataFrame(rows, "s string, page string, id int, t long").withColumn("ts", F.timestamp_seconds("t"))
    got = {(r.from_value, r.to_value): r.transitions for r in transitions(df, "s", "page", ["id"], "ts", minutes).collect()}
    want = {}
    for s in ("s1", "s2"):
        pages = [r[1] for r in sorted((r for r in rows if r[0] == s), key=lambda r: (r[3], r[2]))]
        for a, b in zip(pages, pages[1:]):
            want[a, b] = want.get((a, b), 0) + 1
    assert got == want
