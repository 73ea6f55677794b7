"""The sales fact."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmart.functions import dates
from sparkmart.operators.dedup import keep_last
from sparkmart.operators.lookup import resolve_key, resolve_key_or, unmatched
from sparkmart.plans.dimensions import UNKNOWN_KEY
from sparkmart.session import stored


def current_clients(clients: DataFrame) -> DataFrame:
    """One dimension row per client id: the last key, which is the latest registration or version.

    Stored, because Spark splits a hot key of a join only when both sides
    come straight from a shuffle; behind a window it would not.
    """
    narrow = clients.select("id_client_nk", "id_client_sk")
    return stored(keep_last(narrow, ["id_client_nk"], [F.col("id_client_sk")]))


def follow_survivors(orders: DataFrame, merged: DataFrame) -> DataFrame:
    """Give orders of a merged client id the id of the surviving client. ``merged`` is a stored table."""
    to = merged.select(F.col("id_client").alias("_id"), F.col("id_survivant").alias("_to"))
    return (
        orders.join(to, F.col("id_client") == F.col("_id"), "left")
        .withColumn("id_client", F.coalesce("_to", "id_client"))
        .drop("_id", "_to")
    )


def build_sales_fact(
    orders: DataFrame,
    clients: DataFrame,
    products: DataFrame,
    regions: DataFrame,
    couriers: DataFrame,
    loaded_at: datetime | None = None,
) -> DataFrame:
    """One row per order line with surrogate keys.

    Lines with an unknown product or client are dropped (inner joins); unknown
    city or courier go to member 1.  The date key comes from the order's own
    date, so the calendar is not joined here; ``unmatched_dates`` reports days
    it lacks.  Only the columns the fact needs enter the joins.
    """
    lines = orders.select(
        "id_produit", "id_client", "ville_livraison", "id_livreur",
        dates.date_key(F.col("date_commande")).alias("id_date"),
        F.col("quantite").try_cast("int").alias("quantite_vendue"),
        "montant_ht", "montant_ttc", "delai_livraison_jours",
        F.col("statut").alias("statut_commande"),
    )
    resolved = (
        resolve_key(lines, "id_produit", products.filter("est_actif"), "id_produit_nk", "id_produit_sk", "_produit")
        .transform(resolve_key, "id_client", current_clients(clients), "id_client_nk", "id_client_sk", "_client")
        .transform(resolve_key_or, "ville_livraison", regions, "ville", "id_region", "_region", UNKNOWN_KEY)
        .transform(resolve_key_or, "id_livreur", couriers, "id_livreur_nk", "id_livreur", "_livreur", UNKNOWN_KEY)
    )
    return resolved.select(
        "id_date",
        F.col("_produit").alias("id_produit"),
        F.col("_client").alias("id_client"),
        F.col("_region").alias("id_region"),
        F.col("_livreur").alias("id_livreur"),
        "quantite_vendue",
        "montant_ht",
        "montant_ttc",
        F.lit(0.0).alias("cout_livraison"),
        "delai_livraison_jours",
        F.lit(0.0).alias("remise_pct"),
        "statut_commande",
        (F.current_timestamp() if loaded_at is None else F.lit(loaded_at)).alias("date_chargement"),
    )


def unmatched_dates(orders: DataFrame, calendar: DataFrame) -> DataFrame:
    """Number of orders per day that the calendar does not hold."""
    per_day = orders.groupBy(dates.date_key(F.col("date_commande")).alias("id_date")).agg(F.count(F.lit(1)).alias("nb"))
    return unmatched(per_day, "id_date", calendar, "id_date")
