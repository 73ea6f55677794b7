"""Lookups against a table.

No join carries a broadcast hint: Spark broadcasts the lookup side when its
measured size is below the threshold, at planning time or after a shuffle, and
otherwise sorts and merges, splitting partitions swollen by a hot key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def standardize(
    df: DataFrame, column: str, mapping: DataFrame, key: str, target: str, normalized: Column, default: str
) -> DataFrame:
    """Replace ``column`` by ``mapping[normalized]``, or ``default`` when absent. ``key`` is unique in ``mapping``."""
    table = mapping.select(F.col(key).alias("_key"), F.col(target).alias("_target"))
    joined = df.withColumn("_lookup", normalized).join(table, F.col("_lookup") == F.col("_key"), "left")
    return joined.withColumn(column, F.coalesce("_target", F.lit(default))).drop("_lookup", "_key", "_target")


def resolve_key(df: DataFrame, on: str, dim: DataFrame, natural: str, surrogate: str, alias: str) -> DataFrame:
    """Add the surrogate key of each row, dropping rows whose natural key is unknown."""
    keys = dim.select(F.col(natural).alias("_nk"), F.col(surrogate).alias(alias))
    return df.join(keys, F.col(on) == F.col("_nk"), "inner").drop("_nk")


def resolve_key_or(
    df: DataFrame, on: str, dim: DataFrame, natural: str, surrogate: str, alias: str, default: int
) -> DataFrame:
    """Add the surrogate key of each row, ``default`` where the natural key is unknown."""
    keys = dim.select(F.col(natural).alias("_nk"), F.col(surrogate).alias("_sk"))
    joined = df.join(keys, F.col(on) == F.col("_nk"), "left")
    return joined.withColumn(alias, F.coalesce("_sk", F.lit(default))).drop("_nk", "_sk")


def unmatched(df: DataFrame, on: str, dim: DataFrame, key: str) -> DataFrame:
    """Rows whose key has no partner in the dimension."""
    return df.join(dim.select(F.col(key).alias("_k")), F.col(on) == F.col("_k"), "left_anti")


def require_unique(dim: DataFrame, key: str) -> None:
    """Raise when a lookup key occurs twice, which would multiply the rows of a join."""
    twice = dim.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    if not twice.isEmpty():
        raise ValueError(f"duplicate values in lookup key '{key}'")
