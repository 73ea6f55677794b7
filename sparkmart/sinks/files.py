"""File sinks."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmart.plans.bronze import PARTITIONS


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Replace a Parquet table. A partitioned one is rebalanced first: few files per partition, large ones split.

    The new table is written beside the old one, which stays if that fails; then the folders change places. Readers that must never
    miss a table, or several tables that must change together, need ``generations``.
    """
    spark, mark = df.sparkSession, uuid.uuid4().hex[:12]
    rows = df.hint("rebalance", *partition_by) if partition_by else df
    writer = rows.write.option("compression", "snappy")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    place = lambda suffix: spark._jvm.org.apache.hadoop.fs.Path(path.rstrip("/") + suffix)
    old, new, here = place(f".old-{mark}"), place(f".new-{mark}"), place("")
    fs = here.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    try:
        writer.parquet(new.toString())
        replaced = fs.exists(here)
        if replaced and not fs.rename(here, old):
            raise OSError(f"{path} could not be set aside")
        if not fs.rename(new, here):
            if replaced:
                fs.rename(old, here)
            raise OSError(f"{path} could not be replaced")
        fs.delete(old, True)
    finally:
        fs.delete(new, True)
    spark._jsparkSession.catalog().refreshByPath(path)


def write_bronze(bronze: DataFrame, root: str) -> None:
    """Write offers as JSON lines by source and month; partitions this load does not touch stay."""
    bronze.hint("rebalance", *PARTITIONS).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
        *PARTITIONS
    ).json(f"{root}/bronze")


def with_month_partition(fact: DataFrame) -> DataFrame:
    """Add ``annee_mois`` (YYYYMM), the partition column of the stored fact."""
    return fact.withColumn("annee_mois", F.expr("id_date div 100").cast("int"))
