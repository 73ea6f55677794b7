"""Approximate figures of the lake for any span of months, from sketches that are stored month by month beside the marts.

The exact marts read all offers of a span again. Here a month is read once, when its sketches are written; a year, or any choice of months, is the
union of their sketches. Off unless ``LakeSettings.sketches`` asks for it.

``croquis_offres``: by month, profile, city and contract the offers, those with a salary, and sketches of offer ids and salaries.
``croquis_competences``: by month, profile, family and skill a sketch of offer ids. Both are partitioned by year and month, and a load
replaces the months it holds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sparkmart.fixed_values import NO_SKILL
from sparkmart.functions.numbers import percent, rounded
from sparkmart.operators import sketches
from sparkmart.settings import LakeSettings

MONTH = ["annee", "mois"]
TABLES = {
    "croquis_offres": "profil string, ville string, type_contrat string, nb_offres bigint, nb_offres_avec_salaire bigint, "
    "offres binary, salaires binary, annee string, mois string",
    "croquis_competences": "profil string, famille string, competence string, offres binary, annee string, mois string",
}
SHARES = {"salaire_median_mad": 0.5, "salaire_q1_mad": 0.25, "salaire_q3_mad": 0.75}


def offer_sketches(offers: DataFrame, settings: LakeSettings = LakeSettings()) -> DataFrame:
    known = F.col("salaire_connu")
    groups = [F.col("profil_normalise").alias("profil"), F.col("ville_std").alias("ville"), F.col("type_contrat_std").alias("type_contrat")]
    return offers.groupBy(*groups, *MONTH).agg(
        F.count(F.lit(1)).alias("nb_offres"),
        F.count_if(known).alias("nb_offres_avec_salaire"),
        sketches.distinct_sketch(F.col("id_offre"), settings.sketch_lg_k).alias("offres"),
        sketches.quantile_sketch(F.when(known, F.col("salaire_median_mad")), settings.sketch_k).alias("salaires"),
    )


def skill_sketches(skills: DataFrame, settings: LakeSettings = LakeSettings()) -> DataFrame:
    found = skills.filter(F.col("competence") != NO_SKILL)
    ids = sketches.distinct_sketch(F.col("id_offre"), settings.sketch_lg_k).alias("offres")
    return found.groupBy("profil", "famille", "competence", *MONTH).agg(ids)


def write_sketches(offers: DataFrame, skills: DataFrame, root: str, settings: LakeSettings = LakeSettings()) -> None:
    """Replace the months that ``offers`` and ``skills`` hold; the others stay."""
    built = {"croquis_offres": offer_sketches(offers, settings), "croquis_competences": skill_sketches(skills, settings)}
    for name, table in built.items():
        by_month = table.hint("rebalance", *MONTH).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        by_month.partitionBy(*MONTH).parquet(f"{root}/gold/{name}")


def read_sketches(spark: SparkSession, root: str, name: str) -> DataFrame:
    """With the types given, as Spark would read a month of ``03`` as the number 3."""
    return spark.read.schema(TABLES[name]).parquet(f"{root}/gold/{name}")


def in_span(table: DataFrame, first: str | None = None, last: str | None = None) -> DataFrame:
    """The months from ``first`` to ``last``, both as YYYY-MM and both included. Offers without a month are in the open span alone."""
    month = F.concat_ws("-", *MONTH)
    dated = F.col("annee").isNotNull() & F.col("mois").isNotNull()
    test: Column = F.lit(True)
    if first is not None:
        test = test & dated & (month >= first)
    if last is not None:
        test = test & dated & (month <= last)
    return table.filter(test)


def approximate_top_skills(skill_table: DataFrame, offer_table: DataFrame) -> DataFrame:
    """The columns of ``gold.top_skills``, from the sketches of the months given."""
    all_offers = sketches.united(offer_table, [], distinct=["offres"]).select(sketches.estimated_distinct(F.col("offres"))).scalar()
    counted = sketches.united(skill_table, ["profil", "famille", "competence"], distinct=["offres"]).select(
        "profil", "famille", "competence", sketches.estimated_distinct(F.col("offres")).alias("nb_offres_mentionnent")
    )
    rank = F.rank().over(Window.partitionBy("profil").orderBy(F.col("nb_offres_mentionnent").desc()))
    return counted.withColumns(
        {"pct_offres_total": percent(F.col("nb_offres_mentionnent"), all_offers, 2), "rang_dans_profil": rank}
    )


def approximate_salaries(offer_table: DataFrame, by: list[str]) -> DataFrame:
    """Offers and salary quantiles by any of profil, ville, type_contrat, annee, mois. The two counts of offers are exact."""
    merged = sketches.united(
        offer_table, by, distinct=["offres"], quantile=["salaires"], totals=["nb_offres", "nb_offres_avec_salaire"]
    )
    quantiles = [rounded(sketches.estimated_quantile(F.col("salaires"), share), 0).alias(name) for name, share in SHARES.items()]
    distinct = sketches.estimated_distinct(F.col("offres")).alias("nb_offres_distinctes")
    return merged.select(*by, "nb_offres", "nb_offres_avec_salaire", distinct, *quantiles)
