"""Value standardisation with fixed tables."""

from __future__ import annotations

from collections import defaultdict

from pyspark.sql import Column
from pyspark.sql import functions as F


def map_values(value: Column, table: dict[str, str]) -> Column:
    """Look ``value`` up in a fixed table; null when absent.

    One ``IN`` per target value instead of a join: the table is part of the
    code, so its size is known, and Spark tests long lists with a hash set.
    """
    if not table:
        return F.lit(None).cast("string")
    by_target = defaultdict(list)
    for variant, target in table.items():
        by_target[target].append(variant)
    chain = F
    for target, variants in by_target.items():
        chain = chain.when(value.isin(variants), F.lit(target))
    return chain.otherwise(F.lit(None).cast("string"))


def standard_value(value: Column, table: dict[str, str], default: str) -> Column:
    return F.coalesce(map_values(value, table), F.lit(default))
