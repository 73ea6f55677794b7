"""Slowly changing dimensions, type 2."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkmart.fixed_values import END_OF_TIME
from sparkmart.functions.dates import as_of_date
from sparkmart.operators.keys import with_surrogate_key


def version_columns(start: Column) -> dict[str, Column]:
    """Validity of a first version: from ``start``, open-ended, current."""
    return {
        "date_debut": start,
        "date_fin": F.lit(date.fromisoformat(END_OF_TIME)),
        "est_actif": F.lit(True),
    }


def merge_versions(
    dimension: DataFrame, incoming: DataFrame, key: str, surrogate: str, tracked: list[str], as_of: date | None = None
) -> DataFrame:
    """Merge a new extract into a versioned dimension.

    A changed row closes its current version on ``as_of`` and opens a new one;
    a new key opens its first version; history, unchanged rows and keys absent
    from the extract stay as they are.  New versions continue the surrogate keys.
    ``incoming`` has the key and the tracked columns, one row per key; a null key is
    a key like others.  Untracked columns of a new version come from ``incoming``
    where it has them, else from the version that it closes.
    """
    today = as_of_date(as_of)
    others = [c for c in dimension.columns if c not in (surrogate, key, *tracked, "date_debut", "date_fin", "est_actif")]
    carried = [c for c in others if c not in incoming.columns]
    old = dimension.filter("est_actif").select(
        F.col(key).alias("_old_key"), *[F.col(c).alias(f"_old_{c}") for c in tracked], *carried
    )
    same = F.lit(True)
    for c in tracked:
        same = same & F.col(c).eqNullSafe(F.col(f"_old_{c}"))
    compared = incoming.join(old.withColumn("_known", F.lit(True)), F.col(key).eqNullSafe(F.col("_old_key")), "left")
    opened = compared.filter(F.col("_known").isNull() | ~same).select(key, *tracked, *others)

    last_key = dimension.agg(F.coalesce(F.max(surrogate), F.lit(0))).scalar()
    new_rows = with_surrogate_key(opened, surrogate, [key], first=last_key + 1)
    new_versions = new_rows.withColumns(version_columns(today))

    changed = new_versions.select(F.col(key).alias("_changed"))  # from the checkpoint, not compared again
    marked = dimension.join(changed, F.col(key).eqNullSafe(F.col("_changed")) & F.col("est_actif"), "left")
    closes = F.col("_changed").isNotNull()
    kept = marked.withColumns(
        {
            "date_fin": F.when(closes, today).otherwise(F.col("date_fin")),
            "est_actif": F.col("est_actif") & ~closes,
        }
    ).drop("_changed")
    return kept.select(dimension.columns).unionByName(new_versions.select(dimension.columns))
