"""Distinct counts and quantiles from small states that merge over any range of days or windows.

Quantiles: values are whole units (cents, microseconds) counted in buckets of whole-number arithmetic. Below 64 units every value has
its own bucket, above that each doubling is cut into 64, so a quantile is off by 1/128 of its value at most (``RELATIVE_ERROR``).
A group has some 3,700 buckets a sign at most, whatever its rows. Counts merge by addition, and by subtraction when a day is
made anew. Distinct counts: HyperLogLog sketches of 4,096 registers, a standard error of 1.04 / 64 = 1.6 %, which only merge.

Defined results: nulls are in no bucket and no sketch, null keys are keys, groups without values have no row, equal values share a bucket.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

STEP_BITS = 6
STEPS = 1 << STEP_BITS  # buckets in a doubling
RELATIVE_ERROR = 1 / (2 * STEPS)
REGISTERS_LOG2 = 12
DISTINCT_ERROR = 1.04 / 2 ** (REGISTERS_LOG2 / 2)


def bucket(units: Column) -> Column:
    """The bucket of a whole number; buckets are in the order of the numbers, negative ones mirror positive ones."""
    size = F.abs(units)
    shift = F.length(F.bin(size)).cast("int") - (STEP_BITS + 1)
    code = F.when(size < STEPS, size).otherwise(shift * STEPS + F.call_function("shiftright", size, F.greatest(shift, F.lit(0))))
    return (F.signum(units).cast("int") * code).cast("int")


def middle(code: Column) -> Column:
    """The number half way between the least and the greatest of a bucket, in units."""
    size = F.abs(code)
    wide = F.pow(F.lit(2.0), F.floor(size / STEPS) - 1)
    value = F.when(size < STEPS, size.cast("double")).otherwise((size % STEPS + STEPS) * wide + (wide - 1) / 2)
    return F.signum(code) * value


def histogram(df: DataFrame, keys: Sequence[str | Column], units: Column) -> DataFrame:
    """(keys, bucket, n). Works on a stream as well; the state is a counter a bucket."""
    return df.filter(units.isNotNull()).groupBy(*keys, bucket(units).alias("bucket")).agg(F.count(F.lit(1)).alias("n"))


def quantiles(buckets: DataFrame, keys: Sequence[str], names: dict[str, float], scale: int = 2, n: str = "n") -> DataFrame:
    """(keys, n, quantiles): the value at place floor(p * (n - 1)) of each group, to within the relative error.

    The rows may come from any number of days or windows; they are merged first, so a window sees a group's buckets only.
    """
    merged = buckets.groupBy(*keys, "bucket").agg(F.sum(n).alias("_n")).filter("_n > 0")
    group = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))
    rows = merged.withColumns({"_upto": F.sum("_n").over(group.orderBy("bucket")), "_total": F.sum("_n").over(group)})
    found = rows.groupBy(*keys).agg(F.max("_total").alias("n"), *[
        F.min(F.when(F.col("_upto") > F.floor(F.lit(p) * (F.col("_total") - 1)), F.col("bucket"))).alias(name)
        for name, p in names.items()])
    return found.withColumns({name: middle(F.col(name)) / F.lit(float(10 ** scale)) for name in names})


def distinct_state(column: str | Column) -> Column:
    return F.hll_sketch_agg(column, REGISTERS_LOG2)


def merged_state(column: str) -> Column:
    return F.hll_union_agg(column)


def distinct(column: str) -> Column:
    """The number of different values a state has seen, about."""
    return F.hll_sketch_estimate(column)
