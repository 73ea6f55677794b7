"""Places in a sorted order, without a task that sees all rows."""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkmart.llm.common import store

_PART_BITS = 33  # monotonically_increasing_id holds the partition above these bits and the row below


def numbered(df: DataFrame, name: str, order: list[Column]) -> DataFrame:
    """``df`` as a stored table with ``name`` = 0, 1, ... in the given order; rows that tie are numbered in any order.

    Rows are dealt out by ranges of the order, sorted and written with partition and row. A row's place is the number of rows in the
    partitions before its own, plus its row: one count a partition is all that the driver sees. ``df`` is read twice,
    to sample the ranges and to deal the rows out, so it had better be a stored table.
    """
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    written = store(ranged.withColumn("_written_at", F.monotonically_increasing_id()))
    part = F.shiftright("_written_at", _PART_BITS)
    counts = {r["_part"]: r["count"] for r in written.groupBy(part.alias("_part")).count().collect()}
    before = list(accumulate((counts.get(p, 0) for p in range(max(counts, default=0) + 1)), initial=0))
    row = F.col("_written_at").bitwiseAND((1 << _PART_BITS) - 1)
    return written.withColumn(name, F.get(F.lit(before).cast("array<bigint>"), part.cast("int")) + row).drop("_written_at")
