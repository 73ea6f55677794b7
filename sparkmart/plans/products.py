"""Cleaning rules for products."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmart.functions import dates, numbers, text
from sparkmart.functions.mapping import map_values
from sparkmart.operators.scd import version_columns
from sparkmart.settings import WarehouseSettings

TEXT_FIELDS = ("nom", "marque", "fournisseur", "origine_pays")


def standard_categories(df: DataFrame, settings: WarehouseSettings = WarehouseSettings()) -> DataFrame:
    """Known category spellings by table, others in title case."""
    category = F.col("categorie")
    return df.withColumns(
        {
            "categorie": F.coalesce(map_values(category, settings.categories), text.title_case(category)),
            "sous_categorie": text.title_case(text.strip(F.col("sous_categorie"))),
            "marque": text.strip(F.col("marque")),
            "fournisseur": text.strip(F.col("fournisseur")),
        }
    )


def default_prices(df: DataFrame, settings: WarehouseSettings = WarehouseSettings()) -> DataFrame:
    """A missing or unreadable price becomes the symbolic price."""
    price = F.when(numbers.number(F.col("prix_catalogue")).isNotNull(), numbers.money(F.col("prix_catalogue")))
    default = F.lit(Decimal(settings.default_price)).cast(numbers.MONEY)
    return df.withColumn("prix_catalogue", F.coalesce(price, default))


def products_without_price(raw: DataFrame) -> DataFrame:
    """Ids that ``default_prices`` changes."""
    return raw.filter(numbers.number(F.col("prix_catalogue")).isNull()).select("id_produit")


def tidy_text(df: DataFrame) -> DataFrame:
    return df.withColumns({c: text.squeeze(F.col(c)) for c in TEXT_FIELDS if c in df.columns})


def valid_creation_dates(df: DataFrame, settings: WarehouseSettings = WarehouseSettings()) -> DataFrame:
    created = dates.iso_date(F.col("date_creation"))
    return df.withColumn("date_creation", dates.default_date(created, settings.as_of))


def with_versions(df: DataFrame) -> DataFrame:
    """Typed ``actif`` and the columns of a first version, valid from the creation date."""
    return df.withColumn("actif", numbers.truthy(F.col("actif"))).withColumns(version_columns(F.col("date_creation")))


def clean_products(raw: DataFrame, settings: WarehouseSettings = WarehouseSettings()) -> DataFrame:
    """All rules. Dealt out first: the rules are the work, and a source of few megabytes is read by one task."""
    return (
        raw.repartition("id_produit")
        .transform(standard_categories, settings)
        .transform(default_prices, settings)
        .transform(tidy_text)
        .transform(valid_creation_dates, settings)
        .transform(with_versions)
    )
