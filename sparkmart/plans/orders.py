"""Cleaning rules for sales orders.

Each rule is a function from DataFrame to DataFrame.  ``flag_orders`` applies
them all and marks the rows that a rule rejects instead of dropping them, so
the counts per rule can be read from the written table (``plans.rules``);
``clean_orders`` is the accepted part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkmart import fixed_values as fv
from sparkmart.functions import dates, numbers
from sparkmart.functions.mapping import standard_value
from sparkmart.functions.text import strip
from sparkmart.operators.dedup import keep_last
from sparkmart.operators.lookup import standardize
from sparkmart.settings import WarehouseSettings
from sparkmart.sources.files import ORDINAL

REJECTED = "_rejected_by"


def keep_last_order(df: DataFrame, order_by: list[Column] | None = None) -> DataFrame:
    """One row per order id: the last in the source."""
    return keep_last(df, ["id_commande"], order_by or [F.col(ORDINAL)])


def parse_dates(df: DataFrame) -> DataFrame:
    return df.withColumns({c: dates.mixed_date(F.col(c)) for c in ("date_commande", "date_livraison")})


def drop_undated(df: DataFrame) -> DataFrame:
    return df.filter(F.col("date_commande").isNotNull())


def city_key(column: str) -> Column:
    """What a city name is looked up by; a missing one is looked up as ``inconnu``."""
    return F.coalesce(F.lower(strip(F.col(column))), F.lit("inconnu"))


def standard_cities(df: DataFrame, cities: DataFrame, column: str = "ville_livraison") -> DataFrame:
    return standardize(df, column, cities, "variant", "city", city_key(column), fv.UNKNOWN_CITY)


def standard_statuses(df: DataFrame, settings: WarehouseSettings = WarehouseSettings()) -> DataFrame:
    """Exact spelling, upper and lower case included."""
    return df.withColumn("statut", standard_value(F.col("statut"), settings.statuses, fv.UNKNOWN_STATUS))


def parse_quantities(df: DataFrame) -> DataFrame:
    """Quantity as a double, still with its fraction: positivity is tested before truncation."""
    return df.withColumn("quantite", numbers.number(F.col("quantite")))


def positive_quantities(df: DataFrame) -> DataFrame:
    return parse_quantities(df).filter("quantite > 0").withColumn("quantite", numbers.whole(F.col("quantite")))


def positive_prices(df: DataFrame) -> DataFrame:
    price = numbers.number(F.col("prix_unitaire"))
    return df.filter(price > 0).withColumn("prix_unitaire", numbers.money(F.col("prix_unitaire")))


def fill_couriers(df: DataFrame) -> DataFrame:
    return df.withColumn("id_livreur", F.coalesce("id_livreur", F.lit(fv.MISSING_COURIER)))


def with_amounts(df: DataFrame, settings: WarehouseSettings = WarehouseSettings()) -> DataFrame:
    """Amount without tax, and with tax computed from the rounded amount."""
    return df.withColumn("montant_ht", numbers.amount_excl_tax(F.col("quantite"), F.col("prix_unitaire"))).withColumn(
        "montant_ttc", numbers.amount_incl_tax(F.col("montant_ht"), settings.vat_rate)
    )


def with_delay(df: DataFrame) -> DataFrame:
    delay = dates.days_between(F.col("date_commande"), F.col("date_livraison"))
    return df.withColumn("delai_livraison_jours", delay)


def flag_orders(
    raw: DataFrame,
    cities: DataFrame,
    settings: WarehouseSettings = WarehouseSettings(),
    order_by: list[Column] | None = None,
) -> DataFrame:
    """Cleaned orders, one per id, with ``_rejected_by`` naming the first rule a row fails.

    The counts of replaced values need what the row held before, so
    ``_statut_brut`` and ``_livreur_manquant`` are kept next to the results.
    """
    typed = (
        keep_last_order(raw, order_by)
        .withColumn("_statut_brut", F.col("statut"))
        .withColumn("_livreur_manquant", F.col("id_livreur").isNull())
        .transform(parse_dates)
        .transform(standard_statuses, settings)
        .transform(parse_quantities)
        .withColumn("_prix", numbers.number(F.col("prix_unitaire")))
    )
    positive = lambda column: F.coalesce(F.col(column) > 0, F.lit(False))
    rejected = (
        F.when(F.col("date_commande").isNull(), "date")
        .when(~positive("quantite"), "quantite")
        .when(~positive("_prix"), "prix")
    )
    measured = (
        typed.withColumn(REJECTED, rejected)
        .withColumn("quantite", numbers.whole(F.col("quantite")))
        .withColumn("prix_unitaire", numbers.money(F.col("prix_unitaire")))
        .transform(fill_couriers)
        .transform(with_amounts, settings)
        .withColumn("_delai_negatif", F.datediff("date_livraison", "date_commande") < 0)
        .transform(with_delay)
        .transform(standard_cities, cities)
    )
    return measured.drop("_prix", ORDINAL)


def accepted() -> Column:
    """Whether a flagged order stays."""
    return F.col(REJECTED).isNull()


def accepted_orders(flagged: DataFrame) -> DataFrame:
    visible = [c for c in flagged.columns if not c.startswith("_")]
    return flagged.filter(accepted()).select(*visible)


def clean_orders(
    raw: DataFrame,
    cities: DataFrame,
    settings: WarehouseSettings = WarehouseSettings(),
    order_by: list[Column] | None = None,
) -> DataFrame:
    return accepted_orders(flag_orders(raw, cities, settings, order_by))
