"""Reporting marts over the star."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmart.fixed_values import DELIVERED
from sparkmart.functions.numbers import percent, rounded
from sparkmart.operators.order_stats import rank_in_group
from sparkmart.settings import WarehouseSettings


def _delivered(fact: DataFrame) -> DataFrame:
    return fact.filter(F.col("statut_commande") == DELIVERED)


def monthly_revenue(fact: DataFrame, calendar: DataFrame) -> DataFrame:
    """Delivered revenue, orders and units by month. Days are summed before the calendar is joined."""
    per_day = _delivered(fact).groupBy("id_date").agg(
        F.sum("montant_ht").alias("ht"), F.sum("montant_ttc").alias("ttc"),
        F.count(F.lit(1)).alias("n"), F.sum("quantite_vendue").alias("q"),
    )
    return (
        per_day.join(calendar.select("id_date", "annee", "mois"), "id_date")
        .groupBy(F.col("annee").cast("int").alias("annee"), F.col("mois").cast("int").alias("mois"))
        .agg(
            F.sum("ht").cast("double").alias("ca_ht"),
            F.sum("ttc").cast("double").alias("ca_ttc"),
            F.sum("n").alias("nb_commandes"),
            F.sum("q").alias("quantite"),
        )
    )


def top_products(fact: DataFrame, products: DataFrame) -> DataFrame:
    """Delivered revenue and units per product with its rank in the category."""
    sold = _delivered(fact).groupBy("id_produit").agg(F.sum("montant_ttc").alias("ca"), F.sum("quantite_vendue").alias("quantite"))
    named = sold.join(products.select("id_produit_sk", "nom_produit", "categorie"), F.col("id_produit") == F.col("id_produit_sk"))
    ranked = rank_in_group(named.drop("id_produit_sk"), ["categorie"], "ca", "rang_categorie")
    return ranked.select(
        "id_produit", "nom_produit", "categorie", F.col("ca").cast("double").alias("ca_ttc"), "quantite", "rang_categorie"
    )


def courier_performance(fact: DataFrame, couriers: DataFrame, settings: WarehouseSettings = WarehouseSettings()) -> DataFrame:
    """Deliveries, mean delay and share of late deliveries per courier."""
    late = F.count_if(F.col("delai_livraison_jours") > settings.late_after_days)
    timed = F.count("delai_livraison_jours")
    per_courier = _delivered(fact).groupBy("id_livreur").agg(
        F.count(F.lit(1)).alias("nb_livraisons"),
        rounded(F.sum(F.col("delai_livraison_jours").cast("bigint")).cast("decimal(20,0)") / timed, 2).alias("delai_moyen"),
        percent(late, timed, 2).alias("pct_retard"),
    )
    return per_courier.join(couriers.select("id_livreur", "nom_livreur"), "id_livreur")

