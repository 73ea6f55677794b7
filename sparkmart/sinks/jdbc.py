"""JDBC sink: truncate and insert in batches, keeping table structure and grants."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BATCH_ROWS = 1000


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN is a value for Spark but a missing one for the target."""
    floats = [f.name for f in df.schema.fields if f.dataType.typeName() in ("double", "float")]
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in floats})


def write_options(url: str, table: str, *, connections: int = 8, batch_rows: int = BATCH_ROWS) -> dict[str, str]:
    """``connections`` bounds how many tasks write at once, whatever the size of the DataFrame."""
    return {
        "url": url,
        "dbtable": table,
        "truncate": "true",
        "cascadeTruncate": "true",
        "batchsize": str(batch_rows),
        "numPartitions": str(connections),
    }


def write_jdbc(df: DataFrame, url: str, table: str, properties: dict[str, str] | None = None, **options) -> None:
    """Full load of one table over JDBC; nothing is written for an empty DataFrame."""
    if df.isEmpty():
        return
    settings = {**write_options(url, table, **options), **(properties or {})}
    nan_to_null(df).write.format("jdbc").mode("overwrite").options(**settings).save()
