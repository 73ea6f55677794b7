"""Cleaning rules for clients, and client segments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkmart import fixed_values as fv
from sparkmart.functions import dates, numbers, text
from sparkmart.functions.mapping import standard_value
from sparkmart.operators.dedup import keep_last
from sparkmart.plans.orders import standard_cities
from sparkmart.session import stored
from sparkmart.settings import WarehouseSettings
from sparkmart.sources.files import ORDINAL


def _recency(df: DataFrame) -> list[Column]:
    tie = [F.col(ORDINAL)] if ORDINAL in df.columns else []
    return [F.col("date_inscription"), *tie, F.col("id_client")]


def keep_latest_email(df: DataFrame) -> DataFrame:
    """One client per normalised e-mail, the latest registration; all clients without e-mail are one group."""
    keyed = df.withColumn("email_norm", text.normal_email(F.col("email"))).withColumn(
        "date_inscription", dates.iso_date(F.col("date_inscription"))
    )
    return keep_last(keyed, ["email_norm"], _recency(df)).drop(ORDINAL)


def merged_clients(df: DataFrame) -> DataFrame:
    """(id_client, id_survivant): each client id with an e-mail and the id that its e-mail keeps.

    One row per id, so that following it cannot multiply orders: an id that
    survives anywhere stays itself.  The survivors are stored so that the
    join back can split an e-mail with very many clients.
    """
    keyed = df.select("id_client", text.normal_email(F.col("email")).alias("_email")).filter("_email IS NOT NULL")
    survivors = stored(keep_latest_email(df).select("email_norm", F.col("id_client").alias("_kept")))
    pairs = keyed.join(survivors, F.col("_email") == F.col("email_norm"))
    itself = F.max(F.when(F.col("_kept") == F.col("id_client"), F.col("_kept")))
    return pairs.groupBy("id_client").agg(F.coalesce(itself, F.max("_kept")).alias("id_survivant"))


def standard_sexes(df: DataFrame, settings: WarehouseSettings = WarehouseSettings()) -> DataFrame:
    return df.withColumn("sexe", standard_value(text.strip(F.col("sexe")), settings.sexes, fv.UNKNOWN_SEX))


def valid_birth_dates(df: DataFrame, settings: WarehouseSettings = WarehouseSettings()) -> DataFrame:
    """Age on ``as_of``; outside the allowed ages both date and age become null, the row stays."""
    born = dates.iso_date(F.col("date_naissance"))
    age = numbers.age_on(F.col("date_naissance"), dates.as_of_date(settings.as_of))
    allowed = F.col("age").between(fv.AGE_MIN, fv.AGE_MAX)
    return (
        df.withColumn("date_naissance", born)
        .withColumn("age", age)
        .withColumn("date_naissance", F.when(allowed, F.col("date_naissance")))
        .withColumn("age", F.when(allowed, F.col("age")))
    )


def with_age_band(df: DataFrame) -> DataFrame:
    return df.withColumn("tranche_age", numbers.band(F.col("age"), fv.AGE_EDGES, fv.AGE_LABELS, fv.UNKNOWN_AGE))


def valid_emails(df: DataFrame) -> DataFrame:
    """A malformed e-mail (as written, blanks included) becomes null, the row stays."""
    return df.withColumns(
        {c: text.keep_if_matches(F.col(c), fv.EMAIL_PATTERN, F.col("email")) for c in ("email", "email_norm")}
    )


def with_full_name(df: DataFrame) -> DataFrame:
    return df.withColumn("nom_complet", text.full_name(F.col("prenom"), F.col("nom")))


def clean_clients(raw: DataFrame, cities: DataFrame, settings: WarehouseSettings = WarehouseSettings()) -> DataFrame:
    """All rules in order; de-duplication comes before e-mail validation."""
    return (
        keep_latest_email(raw)
        .transform(standard_sexes, settings)
        .transform(valid_birth_dates, settings)
        .transform(with_age_band)
        .transform(valid_emails)
        .transform(standard_cities, cities, "ville")
        .transform(with_full_name)
    )


def recent_delivered(orders: DataFrame, settings: WarehouseSettings = WarehouseSettings()) -> DataFrame:
    """Delivered orders of the trailing year before the last order. The bound is a scalar subquery."""
    last_day = orders.agg(F.max("date_commande")).scalar()
    return orders.filter(
        (F.col("date_commande") >= F.date_sub(last_day, settings.segment_days)) & (F.col("statut") == fv.DELIVERED)
    )


def client_segments(orders: DataFrame, settings: WarehouseSettings = WarehouseSettings()) -> DataFrame:
    """(id_client, segment_client, ca_12m) of clients with recent delivered orders."""
    revenue = recent_delivered(orders, settings).groupBy("id_client").agg(F.sum("montant_ttc").alias("ca"))
    segment = (
        F.when(F.col("ca") >= settings.gold_from, "Gold").when(F.col("ca") >= settings.silver_from, "Silver").otherwise("Bronze")
    )
    return revenue.select("id_client", segment.alias("segment_client"), F.round("ca", 2).cast("double").alias("ca_12m"))
