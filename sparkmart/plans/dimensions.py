"""The five dimensions of the sales star."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkmart import fixed_values as fv
from sparkmart.functions import dates
from sparkmart.operators.dedup import distinct_values
from sparkmart.operators.keys import with_surrogate_key
from sparkmart.operators.scd import version_columns
from sparkmart.plans.clients import client_segments
from sparkmart.settings import WarehouseSettings

UNKNOWN_KEY = 1


def calendar(days: DataFrame, day: str) -> DataFrame:
    """Calendar rows for a DataFrame of distinct dates."""
    d = F.col(day)
    return days.select(
        *[column.alias(name) for name, column in dates.calendar_columns(d).items()],
        dates.fixed_holiday(d, fv.HOLIDAY_MONTH_DAYS, fv.HOLIDAY_YEARS).alias("est_ferie_maroc"),
        dates.in_periods(d, fv.RAMADAN_PERIODS).alias("periode_ramadan"),
    )


def days_between(bounds: DataFrame, first: Column, last: Column) -> DataFrame:
    """One row ``jour_complet`` per day of the range given by a one-row DataFrame."""
    return bounds.select(F.explode(F.sequence(first, last)).alias("jour_complet"))


def build_dim_calendar(spark: SparkSession, settings: WarehouseSettings = WarehouseSettings()) -> DataFrame:
    first, last = (F.lit(date.fromisoformat(d)) for d in (settings.calendar_start, settings.calendar_end))
    return calendar(days_between(spark.range(1), first, last), "jour_complet")


def product_members(products: DataFrame) -> DataFrame:
    """Members of the product dimension, without surrogate keys."""
    return products.select(
        F.col("id_produit").alias("id_produit_nk"),
        F.col("nom").alias("nom_produit"),
        "categorie", "sous_categorie", "marque", "fournisseur",
        F.col("prix_catalogue").cast("double").alias("prix_standard"),
        "origine_pays", "date_creation", "actif", "date_debut", "date_fin", "est_actif",
    )


def build_dim_product(products: DataFrame) -> DataFrame:
    return with_surrogate_key(product_members(products), "id_produit_sk", ["id_produit_nk"])


def client_members(clients: DataFrame, orders: DataFrame, settings: WarehouseSettings = WarehouseSettings()) -> DataFrame:
    """Clients with their segment, without surrogate keys; clients without recent delivered orders are ``Bronze``."""
    segments = client_segments(orders, settings).select(F.col("id_client").alias("_id"), "segment_client")
    joined = clients.join(segments, F.col("id_client") == F.col("_id"), "left")
    return joined.select(
        F.col("id_client").alias("id_client_nk"),
        "nom_complet", "tranche_age", "sexe", "ville", "canal_acquisition", "date_inscription",
        F.coalesce("segment_client", F.lit("Bronze")).alias("segment_client"),
    ).withColumns(version_columns(dates.as_of_date(settings.as_of)))


def build_dim_client(clients: DataFrame, orders: DataFrame, settings: WarehouseSettings = WarehouseSettings()) -> DataFrame:
    return with_surrogate_key(client_members(clients, orders, settings), "id_client_sk", ["id_client_nk", "date_inscription"])


#: Attributes whose change opens a new version. The creation date of a product without one is the day of the load, so it is none.
CLIENT_TRACKED = ["nom_complet", "tranche_age", "sexe", "ville", "canal_acquisition", "date_inscription", "segment_client"]
PRODUCT_TRACKED = ["nom_produit", "categorie", "sous_categorie", "marque", "fournisseur", "prix_standard", "origine_pays", "actif"]


def _with_unknown_member(dim: DataFrame, key: str, order_by: str, unknown: dict[str, str]) -> DataFrame:
    """Number the members from 2 and put the unknown member first, with key 1."""
    members = with_surrogate_key(dim, key, [order_by], first=UNKNOWN_KEY + 1)
    schema = dim.schema
    row = dim.sparkSession.range(1).select(
        F.lit(UNKNOWN_KEY).cast("bigint").alias(key),
        *[F.lit(unknown[c]).cast(schema[c].dataType).alias(c) for c in dim.columns],
    )
    return row.unionByName(members)


def build_dim_region(regions: DataFrame) -> DataFrame:
    dim = regions.select(
        F.col("nom_ville_standard").alias("ville"), "province", "region_admin", "zone_geo", F.lit(fv.COUNTRY).alias("pays")
    )
    unknown = {
        "ville": fv.UNKNOWN_CITY, "province": fv.UNKNOWN_MEMBER, "region_admin": fv.UNKNOWN_MEMBER,
        "zone_geo": fv.UNKNOWN_MEMBER, "pays": fv.COUNTRY,
    }
    return _with_unknown_member(dim, "id_region", "ville", unknown)


def _pick(code: Column, values: list[str], salt: int) -> Column:
    """A repeatable choice by a digest of the code."""
    number = F.conv(F.substring(F.md5(F.concat(F.lit(str(salt)), code).cast("binary")), 1, 8), 16, 10).cast("bigint")
    return F.get(F.array(*[F.lit(v) for v in values]), (number % len(values)).cast("int"))


def build_dim_courier(orders: DataFrame) -> DataFrame:
    """Couriers seen in the orders. Transport and zone have no source; they are picked by hash of the code."""
    code = F.col("id_livreur")
    codes = distinct_values(orders, "id_livreur", exclude=[fv.MISSING_COURIER])
    dim = codes.select(
        code.alias("id_livreur_nk"),
        F.concat(F.lit("Livreur "), code).alias("nom_livreur"),
        _pick(code, fv.COURIER_TRANSPORTS, 1).alias("type_transport"),
        _pick(code, fv.COURIER_ZONES, 2).alias("zone_couverture"),
    )
    unknown = {
        "id_livreur_nk": fv.MISSING_COURIER, "nom_livreur": "Livreur Inconnu",
        "type_transport": fv.UNKNOWN_MEMBER, "zone_couverture": fv.UNKNOWN_MEMBER,
    }
    return _with_unknown_member(dim, "id_livreur", "id_livreur_nk", unknown)
