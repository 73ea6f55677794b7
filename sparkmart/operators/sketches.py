"""Mergeable sketches: distinct counts and quantiles of parts that are united later without the rows.

A sketch is a bounded binary column. It is made by a grouped aggregate that combines inside each task, so a hot group costs one sketch per task;
``united`` merges stored sketches, for any coarser grouping, by reading them alone.

Nulls do not count. A group without values has null estimates for quantiles and 0 for distinct counts. Quantile sketches are randomised: two
builds differ, each within ``rank_error``.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LG_K = 14
QUANTILE_K = 2000


def distinct_error(lg_k: int = LG_K) -> float:
    """Relative standard error of a united distinct count."""
    return 1.04 / (2**lg_k) ** 0.5


def rank_error(k: int = QUANTILE_K) -> float:
    """Share of the rows by which the rank of an estimated quantile is off, with a confidence of 99 %."""
    return 2.296 / k**0.9021


def distinct_sketch(value: Column, lg_k: int = LG_K) -> Column:
    return F.hll_sketch_agg(value, F.lit(lg_k))


def quantile_sketch(value: Column, k: int = QUANTILE_K) -> Column:
    return F.kll_sketch_agg_double(value.cast("double"), F.lit(k))


def estimated_distinct(sketch: Column) -> Column:
    return F.coalesce(F.hll_sketch_estimate(sketch), F.lit(0)).cast("bigint")


def estimated_quantile(sketch: Column, share: float) -> Column:
    filled = F.when(F.kll_sketch_get_n_double(sketch) > 0, sketch)  # an empty sketch has no quantile
    return F.kll_sketch_get_quantile_double(filled, F.lit(float(share)))


def united(
    sketches: DataFrame,
    by: Iterable[str],
    *,
    distinct: Iterable[str] = (),
    quantile: Iterable[str] = (),
    totals: Iterable[str] = (),
) -> DataFrame:
    """Stored sketches and counters, merged to one row for each group of ``by``."""
    merged = [F.hll_union_agg(name).alias(name) for name in distinct]
    merged += [F.kll_merge_agg_double(name).alias(name) for name in quantile]
    merged += [F.sum(name).alias(name) for name in totals]
    return sketches.groupBy(*by).agg(*merged)
