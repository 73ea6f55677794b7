"""Silver zone: typed, normalised offers and the skills they mention."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkmart.fixed_values import UNKNOWN_FIELD
from sparkmart.functions import text
from sparkmart.functions.offers import experience_years, with_salary
from sparkmart.operators.skills import extract_skills_of_any, offer_text
from sparkmart.settings import LakeSettings


def profile_of(title: Column, settings: LakeSettings = LakeSettings()) -> Column:
    return text.last_match(title, settings.profile_rules, settings.other_profile)


def normalize_titles(df: DataFrame, settings: LakeSettings = LakeSettings()) -> DataFrame:
    title = text.strip(F.lower("titre_poste"))
    return df.withColumn("profil_source", title).withColumn(
        "profil_normalise", profile_of(F.col("profil_source"), settings)
    )


def normalize_salaries(df: DataFrame, settings: LakeSettings = LakeSettings()) -> DataFrame:
    return with_salary(df, "salaire_brut", settings)


def normalize_fields(df: DataFrame) -> DataFrame:
    """Experience, city, contract, region (a copy of the city until a lookup exists), year and month."""
    low, high = experience_years(F.col("experience_requise"))
    published = F.col("date_publication")
    return df.withColumns(
        {
            "experience_min_ans": low,
            "experience_max_ans": high,
            "ville_std": F.coalesce(text.strip(text.title_case(F.col("ville"))), F.lit(UNKNOWN_FIELD)),
            "type_contrat_std": F.coalesce(text.strip(F.upper("type_contrat")), F.lit(UNKNOWN_FIELD)),
            "annee": F.substring(published, 1, 4),
            "mois": F.substring(published, 6, 2),
        }
    ).withColumn("region_admin", F.col("ville_std"))


def clean_offers(raw: DataFrame, settings: LakeSettings = LakeSettings()) -> DataFrame:
    return raw.transform(normalize_titles, settings).transform(normalize_salaries, settings).transform(normalize_fields)


def offer_skills(offers: DataFrame, dictionary: DataFrame) -> DataFrame:
    """One row per offer and skill found in its skills and description fields."""
    keep = [
        F.col("id_offre"),
        F.col("profil_normalise").alias("profil"),
        F.col("ville_std").alias("ville"),
        F.col("date_publication").alias("date_pub"),
        F.col("annee"),
        F.col("mois"),
    ]
    rows = extract_skills_of_any(offers, offer_text("competences_brut", "description"), dictionary, keep)
    return rows.select("id_offre", "profil", "ville", "competence", "famille", "date_pub", "annee", "mois")
