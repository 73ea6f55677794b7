"""Bronze zone: offers as received, laid out by source and month of publication."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmart.functions.offers import month_partition, source_partition

PARTITIONS = ["source_part", "mois"]


def to_bronze(offers: DataFrame, source_file: str, ingested_at: datetime | None = None) -> DataFrame:
    """The offers unchanged, plus partition columns and the ingestion envelope."""
    return offers.withColumns(
        {
            "source_part": source_partition(F.col("source")),
            "mois": month_partition(F.col("date_publication")),
            "_source_file": F.lit(source_file),
            "_ingested_at": F.current_timestamp() if ingested_at is None else F.lit(ingested_at),
        }
    )


def bronze_manifest(bronze: DataFrame) -> DataFrame:
    """One row per partition: where it came from, when, and how many offers it holds."""
    return bronze.groupBy(*PARTITIONS).agg(
        F.count(F.lit(1)).alias("nb_offres"),
        F.max("_source_file").alias("source_fichier"),
        F.max("_ingested_at").alias("date_ingestion"),
    ).withColumn("partition", F.concat_ws("/", *PARTITIONS))


def bronze_stats(manifest: DataFrame) -> DataFrame:
    """Offers in total, by source and by month, as (niveau, cle, nb_offres)."""
    by = lambda level, key: manifest.groupBy(key.alias("cle")).agg(F.sum("nb_offres").alias("nb_offres")).select(
        F.lit(level).alias("niveau"), "cle", "nb_offres"
    )
    total = by("total", F.lit("total"))
    return total.unionByName(by("source", F.col("source_part"))).unionByName(by("mois", F.col("mois")))
