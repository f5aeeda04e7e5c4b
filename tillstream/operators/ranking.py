"""Ranks and exact percentiles whose groups may be far larger than one task can hold.

A window over a whole group sends that group to one task. Here every value falls in a magnitude bucket (a fixed,
order-keeping function of the value, 64 per doubling), windows run per (group, bucket), and a small table of bucket
totals - at most a few thousand rows per group, whatever the data size - supplies the offsets.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillstream.functions.exprs import units
from tillstream.operators.rows import join_on


def magnitude_bucket(value: Column) -> Column:
    size = F.floor(F.log2(F.abs(value)) * 64).cast("int") + 100_000
    return F.when(value > 0, size).when(value < 0, -size).when(value == 0, 0)


def _offsets(rows: DataFrame, keys: Sequence[str], weight: Column, descending: bool) -> DataFrame:
    """(keys, bucket) -> total weight of the buckets before it, and of the whole group."""
    totals = rows.groupBy(*keys, "_bucket").agg(F.sum(weight).alias("_w"))
    order = F.col("_bucket").desc_nulls_last() if descending else F.col("_bucket").asc_nulls_last()
    group = Window.partitionBy(*keys) if keys else Window.partitionBy()
    before = group.orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return totals.select(*keys, "_bucket", F.coalesce(F.sum("_w").over(before), F.lit(0)).alias("_before"),
                         F.sum("_w").over(group).alias("_total"))


def with_rank(df: DataFrame, keys: Sequence[str], value: str, name: str, weight: str | None = None) -> DataFrame:
    """``rank()`` by ``value`` descending within ``keys``; a row may stand for ``weight`` equal rows."""
    w = F.col(weight) if weight else F.lit(1)
    # The totals read every column (adding zero): both branches then need the same columns, their input plans are equal,
    # and Spark reuses the input's shuffle instead of computing the joins and aggregates below it a second time.
    zero = F.hash(*[F.col(c) for c in df.columns]).bitwiseAND(F.lit(0))
    # Equal values are counted before any window, so one value on most rows costs a single row; the join that gives rows
    # their rank can be split where a value is that frequent.
    counts = (df.groupBy(*keys, value).agg(F.sum(w + zero).alias("_n"))
              .withColumn("_bucket", magnitude_bucket(F.col(value))))
    offsets = _offsets(counts, keys, F.col("_n"), descending=True)
    greater = (Window.partitionBy(*keys, "_bucket").orderBy(F.col(value).desc_nulls_last())
               .rowsBetween(Window.unboundedPreceding, -1))
    local = counts.withColumn("_local", F.coalesce(F.sum("_n").over(greater), F.lit(0)))
    ranks = join_on(local, offsets, [*keys, "_bucket"], "inner", null_safe=True)
    ranks = ranks.select(*keys, value, (F.col("_before") + F.col("_local") + 1).cast("long").alias(name))
    return join_on(df, ranks, [*keys, value], "inner", null_safe=True)


def exact_percentiles(df: DataFrame, keys: Sequence[str], value: Column, names: dict[str, float],
                      scale: int = 2) -> DataFrame:
    """Interpolated percentiles of a fixed-point column per group, as ``percentile()`` gives them.

    Equal values are first counted, so a group costs its distinct values; then running counts locate the two
    neighbours of every wanted position.
    """
    one = 10 ** scale
    counts = (df.select(*keys, units(value, scale).alias("_v")).filter("_v is not null")
              .groupBy(*keys, "_v").agg(F.count(F.lit(1)).alias("_n"))
              .withColumn("_bucket", magnitude_bucket(F.col("_v"))))
    offsets = _offsets(counts, keys, F.col("_n"), descending=False)
    local = (Window.partitionBy(*keys, "_bucket").orderBy("_v")
             .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    rows = join_on(counts.withColumn("_local", F.sum("_n").over(local)), offsets, [*keys, "_bucket"], "inner",
                   null_safe=True).withColumn("_upto", F.col("_before") + F.col("_local"))
    aggs = []
    for i, p in enumerate(names.values()):
        pos = F.lit(p) * (F.col("_total") - 1)
        aggs += [F.min(F.when(F.col("_upto") > F.floor(pos), F.col("_v"))).alias(f"_lo{i}"),
                 F.min(F.when(F.col("_upto") > F.ceil(pos), F.col("_v"))).alias(f"_hi{i}")]
    found = rows.groupBy(*keys).agg(*aggs, F.max("_total").alias("_total"))
    cols = []
    for i, (name, p) in enumerate(names.items()):
        pos = F.lit(p) * (F.col("_total") - 1)
        cols.append(((F.col(f"_lo{i}") + (F.col(f"_hi{i}") - F.col(f"_lo{i}")) * (pos - F.floor(pos))) / float(one))
                    .alias(name))
    return found.select(*keys, *cols)
