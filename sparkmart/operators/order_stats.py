"""Exact ranks and quantiles per group, without holding a group in one task.

Spark's exact percentile keeps every distinct value of a group in one buffer,
and a ranking window sends a whole group to one task.  Here the values of a
group are cut into buckets by their four leading digits:

1. bucket sizes per group are counted with map-side combining; a group has a
   bounded number of buckets, so running totals over them are cheap,
2. only rows of buckets that matter are looked at again, reduced to distinct
   values and counts,
3. a bucket with more than twice ``_PART`` distinct values is cut into parts of
   about equal size, at cut points from a quantile sketch that tasks merge, and
   so are parts, until none is larger; values are placed by a window inside
   (group, bucket, part).

The results are exact whatever the distribution; buckets and parts only spread the work.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkmart.session import stored

_DIGITS = 4
_PART = 10_000
_CUTS = 64  # parts that a bucket or part is cut into at once
_ACCURACY = 10_000  # of the sketch: a share is off by one in so many at most
_END = 1 << 62


def _bucket(value: Column) -> Column:
    """A non-decreasing integer function of a number: sign, exponent, leading digits. Null is first, then -inf; NaN is last."""
    number = value.cast("double")
    endless = F.isnan(number) | (F.abs(number) == float("inf"))
    size = F.when(endless, F.lit(1.0)).otherwise(F.abs(number))
    exponent = F.floor(F.log10(size))
    digits = F.floor(size / F.pow(F.lit(10.0), exponent - (_DIGITS - 1)))
    rank = ((exponent + 400) * 10**_DIGITS + digits).cast("bigint")
    finite = F.when(size == 0, F.lit(0)).otherwise(F.when(number < 0, -rank).otherwise(rank))
    ends = F.when(F.isnan(number), F.lit(_END + 1)).when(number < 0, F.lit(-_END)).otherwise(F.lit(_END))
    placed = F.when(number.isNull(), F.lit(-_END - 1)).when(endless, ends).otherwise(finite)
    return F.coalesce(placed, F.lit(0))  # never null, so that joins add no null test on the whole expression


def _keyed(df: DataFrame, group: list[str], value: str) -> DataFrame:
    """Group as a struct (in which nulls compare equal), value and bucket."""
    rows = df.select(F.struct(*group).alias("_group"), F.col(value).alias("_value"))
    return rows.withColumn("_bucket", _bucket(F.col("_value")))


def _bucket_offsets(rows: DataFrame, size: Column, descending: bool = False) -> DataFrame:
    """Rows per bucket, rows in the buckets in front of it, rows of the group."""
    in_group = Window.partitionBy("_group")
    order = F.col("_bucket").desc() if descending else F.col("_bucket").asc()
    in_front = F.sum("_rows").over(in_group.orderBy(order).rowsBetween(Window.unboundedPreceding, -1))
    sizes = rows.groupBy("_group", "_bucket").agg(size.alias("_rows"))
    return sizes.withColumn("_in_front", F.coalesce(in_front, F.lit(0))).withColumn("_total", F.sum("_rows").over(in_group))


def _parted(counts: DataFrame, part: list[str]) -> DataFrame:
    """Cut the parts that are too large, whatever the spread of their values, until the cuts make no difference."""
    number, largest = F.col("_value").cast("double"), None
    shares = [i / _CUTS for i in range(1, _CUTS)]
    while True:
        wide = stored(counts.groupBy(*part).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > 2 * _PART))
        now = wide.agg(F.max("_n")).first()[0]
        if now is None or now == largest:  # none, or values that are one as a double
            return counts
        largest = now
        cuts = counts.join(wide, part).groupBy(*part).agg(F.percentile_approx(number, shares, _ACCURACY).alias("_cuts"))
        below = F.size(F.filter("_cuts", lambda cut: cut <= number))
        counts = stored(
            counts.join(stored(cuts), part, "left")
            .withColumn("_part", F.col("_part") * _CUTS + F.when(F.col("_cuts").isNotNull(), below).otherwise(0)).drop("_cuts")
        )


def _place(counts: DataFrame, descending: bool = False) -> DataFrame:
    """Rows in front of each distinct value, from (group, bucket, value, count, in_front)."""
    bucket, part = ["_group", "_bucket"], ["_group", "_bucket", "_part"]
    in_order = lambda name: F.col(name).desc() if descending else F.col(name).asc()
    parted = _parted(stored(counts.withColumn("_part", F.lit(0).cast("bigint"))), part)
    over_parts = Window.partitionBy(*bucket).orderBy(in_order("_part")).rowsBetween(Window.unboundedPreceding, -1)
    sizes = parted.groupBy(*part).agg(F.sum("_count").alias("_rows"))
    passed = sizes.withColumn("_passed", F.coalesce(F.sum("_rows").over(over_parts), F.lit(0))).drop("_rows")
    in_part = Window.partitionBy(*part).orderBy(in_order("_value")).rowsBetween(Window.unboundedPreceding, -1)
    before = F.col("_in_front") + F.col("_passed") + F.coalesce(F.sum("_count").over(in_part), F.lit(0))
    return parted.join(passed, part).withColumn("_before", before).drop("_part", "_passed")


def rank_in_group(df: DataFrame, group: list[str], value: str, alias: str) -> DataFrame:
    """``RANK() OVER (PARTITION BY group ORDER BY value DESC)``; ties share a rank and leave gaps, nulls are last.

    The input is stored once, since it is read for the sizes, the values and the result.
    """
    rows = stored(df)
    counts = _keyed(rows, group, value).groupBy("_group", "_bucket", "_value").agg(F.count(F.lit(1)).alias("_count"))
    offsets = _bucket_offsets(counts, F.sum("_count"), descending=True).drop("_rows", "_total")
    ranks = _place(counts.join(offsets, ["_group", "_bucket"]), descending=True).select(
        F.col("_group").alias("_g"), F.col("_value").alias("_v"), (F.col("_before") + 1).alias(alias)
    )
    same = (F.struct(*group) == F.col("_g")) & F.col(value).eqNullSafe(F.col("_v"))
    return rows.join(ranks, same).drop("_g", "_v")


def quantiles(df: DataFrame, group: list[str], value: str, wanted: dict[str, float]) -> DataFrame:
    """``_group`` and one exact, linearly interpolated quantile per entry of ``wanted``.

    The buckets that hold the wanted positions (a few per group) are found in a
    first pass and stored, so that Spark knows their size when it joins them
    in the second. Null values do not count.
    """
    positions = {name: F.lit(share) * (F.col("_total") - 1) for name, share in wanted.items()}
    ends = {name: (F.floor(at), F.ceil(at)) for name, at in positions.items()}
    any_end = lambda start, size: reduce(
        lambda a, b: a | b, [(start <= at) & (at < start + size) for pair in ends.values() for at in pair]
    )
    rows = _keyed(df.filter(F.col(value).isNotNull()), group, value)
    offsets = _bucket_offsets(rows, F.count(F.lit(1)))
    buckets = stored(offsets.filter(any_end(F.col("_in_front"), F.col("_rows"))).drop("_rows"))
    distinct = ["_group", "_bucket", "_value"]
    carried = [F.max(c).alias(c) for c in ("_in_front", "_total")]
    counts = rows.join(buckets, ["_group", "_bucket"]).groupBy(*distinct).agg(F.count(F.lit(1)).alias("_count"), *carried)
    at_value = lambda at: (F.col("_before") <= at) & (at < F.col("_before") + F.col("_count"))
    found = [
        F.max(F.when(at_value(end), F.col("_value"))).cast("double").alias(f"_{side}_{name}")
        for name, pair in ends.items()
        for side, end in zip(("low", "high"), pair)
    ]
    per_group = _place(counts).groupBy("_group").agg(F.max("_total").alias("_total"), *found)
    low, high = (lambda name: F.col(f"_low_{name}")), (lambda name: F.col(f"_high_{name}"))
    between = lambda name, at: F.when(low(name) == high(name), low(name)).otherwise(
        low(name) + (high(name) - low(name)) * (at - F.floor(at))
    )
    return per_group.select("_group", *[between(name, at).alias(name) for name, at in positions.items()])
