"""Keep-one-row-per-key operators.

``row_number() = 1`` is planned as a window group limit on both sides of the
shuffle: every task sends at most one row per key, so a key that holds a large
part of the table is reduced before it meets the others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def keep_last(df: DataFrame, keys: list[str | Column], order_by: list[Column]) -> DataFrame:
    """The last row of each key in ``order_by`` (ascending columns; nulls come first).

    Null keys form one group, like any other value.
    """
    newest_first = [c.desc_nulls_last() for c in order_by]
    window = Window.partitionBy(*keys).orderBy(*newest_first)
    return df.withColumn("_n", F.row_number().over(window)).filter("_n = 1").drop("_n")


def distinct_values(df: DataFrame, column: str, exclude: list[str] | None = None) -> DataFrame:
    """Distinct values of a column without nulls and the excluded ones."""
    values = df.select(column).filter(F.col(column).isNotNull())
    if exclude:
        values = values.filter(~F.col(column).isin(exclude))
    return values.distinct()


def value_distribution(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("nb"))
