"""Summaries of the gold marts. Every cut-off has a tie-break, so results repeat."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmart.functions.dates import month_label


def top_skills_overall(top_competences: DataFrame, n: int = 10) -> DataFrame:
    total = top_competences.groupBy("competence").agg(F.sum("nb_offres_mentionnent").alias("nb_offres_mentionnent"))
    return total.orderBy(F.col("nb_offres_mentionnent").desc(), "competence").limit(n)


def salary_by_profile(salaires_par_profil: DataFrame) -> DataFrame:
    """Unweighted mean of the group medians, highest first."""
    mean = salaires_par_profil.groupBy("profil").agg(F.avg("salaire_median_mad").alias("salaire_median_mad"))
    return mean.orderBy(F.col("salaire_median_mad").desc_nulls_last(), "profil")


def top_cities(offres_par_ville: DataFrame, n: int = 10) -> DataFrame:
    total = offres_par_ville.groupBy("ville").agg(
        F.sum("nb_offres").alias("nb_offres"), F.sum("nb_offres_remote").alias("nb_offres_remote")
    )
    return total.orderBy(F.col("nb_offres").desc(), F.col("ville").asc_nulls_last()).limit(n)


def top_employer_rows(entreprises_recruteurs: DataFrame, n: int = 10) -> DataFrame:
    order = [F.col("nb_offres_publiees").desc(), F.col("entreprise"), F.col("ville").asc_nulls_last()]
    return entreprises_recruteurs.orderBy(*order).limit(n)


def overall_trend(tendances_mensuelles: DataFrame) -> DataFrame:
    month = month_label(F.col("annee"), F.col("mois")).alias("date")
    return tendances_mensuelles.groupBy(month).agg(F.sum("nb_offres").alias("nb_offres")).orderBy("date")


def build_insights(gold: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return {
        "top_competences_global": top_skills_overall(gold["top_competences"]),
        "salaire_par_profil": salary_by_profile(gold["salaires_par_profil"]),
        "villes": top_cities(gold["offres_par_ville"]),
        "entreprises": top_employer_rows(gold["entreprises_recruteurs"]),
        "tendance_globale": overall_trend(gold["tendances_mensuelles"]),
    }
