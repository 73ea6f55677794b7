"""Referential integrity and control figures of the star."""

from __future__ import annotations

import logging
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkmart.fixed_values import DELIVERED
from sparkmart.operators.lookup import unmatched

log = logging.getLogger("sparkmart")


def orphan_count(fact: DataFrame, key: str, dim: DataFrame, dim_key: str) -> DataFrame:
    """Fact rows without a dimension member.

    The fact is reduced to its distinct keys with counts before the join, so a
    hot key is one row and the join is as small as the dimension.  A null key
    is an orphan too.
    """
    per_key = fact.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    return unmatched(per_key, key, dim, dim_key).agg(F.coalesce(F.sum("_n"), F.lit(0)).cast("double").alias("valeur"))


def integrity_checks(
    fact: Callable[[], DataFrame], calendar: Callable[[], DataFrame], products: Callable[[], DataFrame], clients: Callable[[], DataFrame]
) -> dict[str, Callable[[], DataFrame]]:
    """Each check as a function of its own, which makes (controle, valeur) from tables that it reads itself."""
    orphans = lambda name, key, dim, dim_key: lambda: orphan_count(fact(), key, dim(), dim_key).select(F.lit(name).alias("controle"), "valeur")
    count = F.count(F.lit(1)).cast("double")
    rows = lambda name, table: lambda: table().agg(count.alias("valeur")).select(F.lit(name).alias("controle"), "valeur")

    def figures() -> DataFrame:
        """Both figures of the fact from one scan."""
        delivered = F.sum(F.when(F.col("statut_commande") == DELIVERED, F.col("montant_ttc")))
        one = fact().agg(count.alias("nb"), F.round(delivered, 2).cast("double").alias("ca"))
        named = [F.struct(F.lit(name).alias("controle"), F.col(c).alias("valeur")) for name, c in (("nb_faits", "nb"), ("ca_total_ttc", "ca"))]
        return one.select(F.inline(F.array(*named)))

    return {
        "orphelins_date": orphans("orphelins_date", "id_date", calendar, "id_date"),
        "orphelins_produit": orphans("orphelins_produit", "id_produit", products, "id_produit_sk"),
        "orphelins_client": orphans("orphelins_client", "id_client", clients, "id_client_sk"),
        "nb_faits, ca_total_ttc": figures,
        "nb_clients": rows("nb_clients", clients),
        "nb_produits": rows("nb_produits", products),
    }


def _level(report: DataFrame) -> DataFrame:
    warns = F.col("controle").startswith("orphelins") & (F.col("valeur") > 0)
    return report.withColumn("niveau", F.when(warns, "warning").otherwise("info"))


def integrity_report(fact: DataFrame, calendar: DataFrame, products: DataFrame, clients: DataFrame) -> DataFrame:
    """(controle, valeur, niveau); an orphan count above 0 is a warning."""
    checks = integrity_checks(lambda: fact, lambda: calendar, lambda: products, lambda: clients)
    return _level(reduce(DataFrame.unionByName, [check() for check in checks.values()]))


def run_checks(spark: SparkSession, checks: dict[str, Callable[[], DataFrame]], threads: int = 4) -> DataFrame:
    """(controle, valeur, niveau, erreur) of checks that run side by side, each as a job of its own.

    A check that fails has no value, the level ``error`` and the first line of what went wrong; the others are not touched by it.
    """

    def run(item: tuple[str, Callable[[], DataFrame]]) -> list[tuple]:
        name, check = item
        try:
            return [(r["controle"], r["valeur"], r["niveau"], None) for r in _level(check()).collect()]
        except Exception as error:  # of this check alone
            log.error("%s: %s", name, error)
            return [(own, None, "error", str(error).strip().partition("\n")[0]) for own in name.split(", ")]

    with ThreadPoolExecutor(threads) as pool:
        found = [row for rows in pool.map(run, checks.items()) for row in rows]
    return spark.createDataFrame(found, "controle string, valeur double, niveau string, erreur string")
