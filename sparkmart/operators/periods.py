"""Periods held in a table: which days lie in how many of them.

Days and periods meet in bins of days, by equality. What a period covers of a bin is one of a bounded number of stretches, so periods are
summed up to (bin, first day, last day, number) before they meet any day: neither many periods of one time nor one that is very long
makes a large group. Days are reduced to distinct ones in the same way.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BIN_DAYS = 32


def _number(day: Column) -> Column:
    return F.unix_date(day.cast("date"))


def _bin(number: Column) -> Column:
    return F.floor(number / BIN_DAYS).cast("int")


def stretches(periods: DataFrame, start: str, end: str) -> DataFrame:
    """(_bin, _low, _high, _periods): the periods cut at the bounds of bins, equal stretches counted. Both ends belong to a period."""
    first, last = _number(F.col(start)), _number(F.col(end))
    real = periods.select(first.alias("_first"), last.alias("_last")).filter("_first <= _last")  # neither null nor turned round
    whole = real.groupBy("_first", "_last").agg(F.count(F.lit(1)).alias("_n"))
    cut = whole.select("*", F.explode(F.sequence(_bin(F.col("_first")), _bin(F.col("_last")))).alias("_bin"))
    low = F.greatest("_first", F.col("_bin") * BIN_DAYS)
    high = F.least("_last", F.col("_bin") * BIN_DAYS + BIN_DAYS - 1)
    return cut.groupBy("_bin", low.alias("_low"), high.alias("_high")).agg(F.sum("_n").alias("_periods"))


def with_periods(df: DataFrame, day: str, periods: DataFrame, start: str, end: str, alias: str = "nb_periodes") -> DataFrame:
    """``df`` with the number of periods that its ``day`` lies in; a null day lies in none."""
    days = df.select(_number(F.col(day)).alias("_day")).filter("_day IS NOT NULL").distinct().withColumn("_bin", _bin(F.col("_day")))
    met = days.join(stretches(periods, start, end), "_bin").filter("_low <= _day AND _day <= _high")
    found = met.groupBy("_day").agg(F.sum("_periods").alias("_found"))
    return df.join(found, _number(F.col(day)) == F.col("_day"), "left").select(*df.columns, F.coalesce("_found", F.lit(0)).cast("bigint").alias(alias))
