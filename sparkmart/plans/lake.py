"""The lake flow: source -> bronze -> silver -> gold -> insights."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from sparkmart.plans import approximate, bronze, gold, insights, silver
from sparkmart.session import stored
from sparkmart.settings import LakeSettings
from sparkmart.sinks.files import write_bronze, write_parquet
from sparkmart.sources import files
from sparkmart.sources.references import read_skills


def ingest_bronze(spark: SparkSession, source: str, root: str, *, json_lines: bool = False) -> DataFrame:
    """Write the partitions the source touches and record them in the manifest. Returns the statistics."""
    offers = bronze.to_bronze(files.read_offers(spark, source, json_lines=json_lines), source, datetime.now())
    write_bronze(offers, root)
    manifest = stored(bronze.bronze_manifest(offers))
    # Like the data, a partition that is loaded again is replaced.
    replaced = manifest.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*bronze.PARTITIONS)
    replaced.parquet(f"{root}/bronze_manifest")
    return bronze.bronze_stats(manifest)


def build_silver(
    spark: SparkSession,
    root: str,
    skills_path: str,
    *,
    months: list[str] | None = None,
    settings: LakeSettings = LakeSettings(),
) -> tuple[DataFrame, DataFrame]:
    """Write offers, then the skills read from the written offers: the parsing rules run once."""
    raw = files.read_bronze(spark, root, months)
    write_parquet(silver.clean_offers(raw, settings), f"{root}/silver/offres_clean")
    offers = files.read_table(spark, root, "silver", "offres_clean")
    write_parquet(silver.offer_skills(offers, read_skills(spark, skills_path)), f"{root}/silver/competences_extraites")
    return offers, files.read_table(spark, root, "silver", "competences_extraites")


def build_gold(spark: SparkSession, root: str, settings: LakeSettings = LakeSettings()) -> dict[str, DataFrame]:
    offers = files.read_table(spark, root, "silver", "offres_clean")
    skills = files.read_table(spark, root, "silver", "competences_extraites")
    marts = gold.build_gold(offers, skills, settings)
    for name, mart in marts.items():
        write_parquet(mart, f"{root}/gold/{name}")
    if settings.sketches:
        approximate.write_sketches(offers, skills, root, settings)
    return {name: files.read_table(spark, root, "gold", name) for name in marts}


def run_lake(
    spark: SparkSession,
    source: str,
    skills_path: str,
    root: str,
    *,
    json_lines: bool = False,
    settings: LakeSettings = LakeSettings(),
) -> dict:
    stats = ingest_bronze(spark, source, root, json_lines=json_lines)
    counts = {(r.niveau, r.cle): r.nb_offres for r in stats.collect()}
    offers, skills = build_silver(spark, root, skills_path, settings=settings)
    marts = build_gold(spark, root, settings)
    return {
        "bronze": counts,
        "silver": {"offres_clean": offers.count(), "competences_extraites": skills.count()},
        "gold": {name: mart.count() for name, mart in marts.items()},
        "insights": insights.build_insights(marts),
    }
