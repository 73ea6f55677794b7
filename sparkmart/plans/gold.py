"""Gold zone: the five data marts over offers and skills.

None of them sorts its result: row order is not part of a stored table.
``in_report_order`` sorts for presentation.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkmart.fixed_values import NO_SKILL, REMOTE_WORDS
from sparkmart.functions.numbers import percent, rounded
from sparkmart.functions.text import like_any
from sparkmart.operators.order_stats import quantiles
from sparkmart.settings import LakeSettings

SALARY_QUANTILES = {"salaire_median_mad": 0.5, "salaire_q1_mad": 0.25, "salaire_q3_mad": 0.75}
REPORT_ORDER = {
    "top_competences": ["profil", "rang_dans_profil", "famille", "competence"],
    "salaires_par_profil": ["-nb_offres", "profil", "ville", "type_contrat"],
    "offres_par_ville": ["-nb_offres", "ville", "region_admin", "profil", "annee", "mois"],
    "entreprises_recruteurs": ["-nb_offres_publiees", "entreprise", "ville"],
    "tendances_mensuelles": ["profil", "annee", "mois"],
}


def _mean_known(value: str):
    """Mean of the known salaries, summed as decimals so that it does not depend on row order."""
    return rounded(F.avg(F.when(F.col("salaire_connu"), F.col(value).cast("decimal(18,4)"))), 0)


def top_skills(skills: DataFrame, offers: DataFrame) -> DataFrame:
    """Offers that mention a skill, by profile, as a share of all offers, ranked in the profile.

    Ranking is a plain window: a profile has at most one row per dictionary skill.
    """
    all_offers = offers.agg(F.countDistinct("id_offre")).scalar()
    counted = (
        skills.filter(F.col("competence") != NO_SKILL)
        .groupBy("profil", "famille", "competence")
        .agg(F.countDistinct("id_offre").alias("nb_offres_mentionnent"))
    )
    rank = F.rank().over(Window.partitionBy("profil").orderBy(F.col("nb_offres_mentionnent").desc()))
    return counted.withColumns(
        {
            "pct_offres_total": percent(F.col("nb_offres_mentionnent"), all_offers, 2),
            "rang_dans_profil": rank,
        }
    )


def salaries(offers: DataFrame) -> DataFrame:
    """Salary figures by profile, city and contract; the exact quantiles come from ``order_stats``."""
    known = F.col("salaire_connu")
    rows = offers.select(
        F.col("profil_normalise").alias("profil"),
        F.col("ville_std").alias("ville"),
        F.col("type_contrat_std").alias("type_contrat"),
        "salaire_connu", "salaire_median_mad", "salaire_min_mad", "salaire_max_mad",
    )
    group = ["profil", "ville", "type_contrat"]
    figures = rows.groupBy(*group).agg(
        F.count(F.lit(1)).alias("nb_offres"),
        F.count_if(known).alias("nb_offres_avec_salaire"),
        _mean_known("salaire_median_mad").alias("salaire_moyen_mad"),
        rounded(F.min(F.when(known, F.col("salaire_min_mad"))), 0).alias("salaire_min_observe"),
        rounded(F.max(F.when(known, F.col("salaire_max_mad"))), 0).alias("salaire_max_observe"),
    )
    exact = quantiles(rows.filter(known), group, "salaire_median_mad", SALARY_QUANTILES)
    joined = figures.join(exact, F.struct(*group) == F.col("_group"), "left")
    return joined.select(
        *group, "nb_offres", "nb_offres_avec_salaire",
        rounded(F.col("salaire_median_mad"), 0).alias("salaire_median_mad"),
        "salaire_moyen_mad",
        rounded(F.col("salaire_q1_mad"), 0).alias("salaire_q1_mad"),
        rounded(F.col("salaire_q3_mad"), 0).alias("salaire_q3_mad"),
        "salaire_min_observe", "salaire_max_observe",
    )


def offers_by_city(offers: DataFrame) -> DataFrame:
    """Offers and remote offers by city, profile and month."""
    remote = F.count_if(like_any(F.col("teletravail"), REMOTE_WORDS))
    return (
        offers.groupBy(
            F.col("ville_std").alias("ville"), "region_admin", F.col("profil_normalise").alias("profil"), "annee", "mois"
        )
        .agg(F.count(F.lit(1)).alias("nb_offres"), remote.alias("nb_offres_remote"))
        .withColumn("pct_remote", percent(F.col("nb_offres_remote"), F.col("nb_offres"), 1))
    )


def top_employers(offers: DataFrame, settings: LakeSettings = LakeSettings()) -> DataFrame:
    """Employers with most offers per city. The profile set is bounded by the profile rules."""
    profiles = F.array_sort(F.collect_set("profil_normalise"))
    return (
        offers.filter(F.col("entreprise").isNotNull() & (F.col("entreprise") != ""))
        .groupBy("entreprise", F.col("ville_std").alias("ville"))
        .agg(
            F.count(F.lit(1)).alias("nb_offres_publiees"),
            F.size(profiles).cast("bigint").alias("nb_profils_differents"),
            _mean_known("salaire_median_mad").alias("salaire_moyen_propose"),
            profiles.alias("profils_recrutes"),
            F.min("date_publication").alias("premiere_offre"),
            F.max("date_publication").alias("derniere_offre"),
        )
        .orderBy(F.col("nb_offres_publiees").desc(), F.col("entreprise"), F.col("ville").asc_nulls_last())
        .limit(settings.top_employers)
    )


def monthly_trend(offers: DataFrame) -> DataFrame:
    """Offers per profile and month next to the previous month that has any."""
    by_month = offers.groupBy("annee", "mois", F.col("profil_normalise").alias("profil")).agg(
        F.count(F.lit(1)).alias("nb_offres"), _mean_known("salaire_median_mad").alias("salaire_moyen_mois")
    )
    window = Window.partitionBy("profil").orderBy(F.col("annee").asc_nulls_last(), F.col("mois").asc_nulls_last())
    return by_month.withColumn("nb_offres_mois_precedent", F.lag("nb_offres").over(window))


def build_gold(offers: DataFrame, skills: DataFrame, settings: LakeSettings = LakeSettings()) -> dict[str, DataFrame]:
    return {
        "top_competences": top_skills(skills, offers),
        "salaires_par_profil": salaries(offers),
        "offres_par_ville": offers_by_city(offers),
        "entreprises_recruteurs": top_employers(offers, settings),
        "tendances_mensuelles": monthly_trend(offers),
    }


def in_report_order(name: str, mart: DataFrame) -> DataFrame:
    order = [F.desc_nulls_last(c[1:]) if c.startswith("-") else F.asc_nulls_last(c) for c in REPORT_ORDER[name]]
    return mart.orderBy(*order)
