"""The warehouse flow: sources -> staging -> star -> marts -> integrity.

Every stage that feeds more than one other is written and read back, so it is
computed once and survives the loss of an executor. The tables of a run become current together.
"""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkmart.operators.keys import with_surrogate_key
from sparkmart.operators.lookup import require_unique
from sparkmart.plans import clients, dimensions, fact, integrity, marts, orders, products, rules
from sparkmart.plans.history import merge_history, start_history
from sparkmart.settings import WarehouseSettings
from sparkmart.sinks import catalog
from sparkmart.sinks.files import with_month_partition
from sparkmart.sinks.generations import Generations, Load
from sparkmart.sources import files
from sparkmart.sources.references import city_variants


@dataclass(frozen=True)
class WarehouseSources:
    orders: str
    clients: str
    products: str
    regions: str
    products_json_lines: bool = False
    #: Line breaks inside quotes of the CSV sources; their files are then not split between tasks.
    multi_line: bool = False


def extract(spark: SparkSession, sources: WarehouseSources) -> dict[str, DataFrame]:
    return {
        "commandes": files.read_orders(spark, sources.orders, multi_line=sources.multi_line),
        "produits": files.read_products(spark, sources.products, json_lines=sources.products_json_lines),
        "clients": files.read_clients(spark, sources.clients, multi_line=sources.multi_line),
        "regions": files.read_regions(spark, sources.regions, multi_line=sources.multi_line),
    }


def transform(raw: dict[str, DataFrame], load: Load, settings: WarehouseSettings) -> dict[str, DataFrame]:
    """Staging tables, star and rule report, all written by ``load``, whose metrics hold what the writes have counted."""
    spark = raw["commandes"].sparkSession
    extracted = {name: _count(df) for name, df in raw.items() if name != "produits"}
    as_read = raw["produits"].agg(*[c.alias(n) for n, c in rules.product_raw_counts(settings.categories).items()]).first().asDict()
    extracted["produits"] = as_read["n"]
    load.metrics["extract"] = extracted

    cities = city_variants(raw["regions"], settings.city_variants)
    accepted = {"_acceptees": F.count_if(orders.accepted())}
    flagged = load.write(orders.flag_orders(raw["commandes"], cities, settings), "staging/commandes", metrics={**rules.order_counts(), **accepted})
    clean = orders.accepted_orders(flagged)
    clean_clients = load.write(clients.clean_clients(raw["clients"], cities, settings), "staging/clients", metrics=rules.client_counts())
    clean_products = load.write(products.clean_products(raw["produits"], settings), "staging/produits", metrics=rules.product_counts())

    star = {
        "dim_temps": load.write(dimensions.build_dim_calendar(spark, settings), "dwh/dim_temps"),
        "dim_produit": _history(
            load, "dwh/dim_produit", dimensions.product_members(clean_products), "id_produit_nk", "id_produit_sk",
            dimensions.PRODUCT_TRACKED, ["id_produit_nk"], settings,
        ),
        "dim_client": _history(
            load, "dwh/dim_client", dimensions.client_members(clean_clients, clean, settings), "id_client_nk", "id_client_sk",
            dimensions.CLIENT_TRACKED, ["id_client_nk", "date_inscription"], settings,
        ),
        "dim_region": load.write(dimensions.build_dim_region(raw["regions"]), "dwh/dim_region"),
        "dim_livreur": load.write(dimensions.build_dim_courier(clean), "dwh/dim_livreur"),
    }
    require_unique(star["dim_produit"].filter("est_actif"), "id_produit_nk")
    require_unique(star["dim_region"], "ville")

    lines = clean
    if settings.remap_merged_clients:
        merged = load.write(clients.merged_clients(raw["clients"]), "staging/clients_fusionnes")
        lines = fact.follow_survivors(clean, merged)
    sales = fact.build_sales_fact(lines, star["dim_client"], star["dim_produit"], star["dim_region"], star["dim_livreur"])
    revenue = {"ca_ttc_total": F.round(F.sum("montant_ttc"), 2).cast("double")}
    star["fait_ventes"] = load.write(with_month_partition(sales), "dwh/fait_ventes", ["annee_mois"], metrics=revenue)

    m = load.metrics
    report = rules.report_of(
        spark,
        {**m["staging/commandes"], "extraites": extracted["commandes"]},
        {**m["staging/clients"], "extraits": extracted["clients"]},
        {**as_read, **m["staging/produits"]},
        {"lignes": m["staging/commandes"]["_acceptees"], "faits": m["dwh/fait_ventes"]["rows"]},
    )
    cleaned = {"commandes_clean": clean, "clients_clean": clean_clients, "produits_clean": clean_products}
    return {**star, **cleaned, "regles": load.write(report, "reports/regles")}


def _count(df: DataFrame) -> int:
    """Rows of a source. Counted apart: what a write counts before a shuffle is counted again when a lost executor's tasks are repeated."""
    return df.count()


def _history(
    load: Load, table: str, members: DataFrame, key: str, surrogate: str, tracked: list[str], order: list[str], settings: WarehouseSettings
) -> DataFrame:
    """The dimension with the versions of earlier loads; the first load numbers all members."""
    if table in load.old:
        return merge_history(load, table, members, key, surrogate, tracked, settings.as_of, latest=[F.col(c) for c in order[1:]] or None)
    return start_history(load, table, with_surrogate_key(members, surrogate, order), key, surrogate, settings.dimension_buckets)


def _transform_metrics(load: Load) -> dict:
    """Rows of the tables that a transform has written, from the writes."""
    m = load.metrics
    rows = {name.partition("/")[2]: found["rows"] for name, found in m.items() if name.startswith("dwh/")}
    clean = {"commandes_clean": m["staging/commandes"]["_acceptees"], "clients_clean": m["staging/clients"]["rows"], "produits_clean": m["staging/produits"]["rows"]}
    return {**rows, **clean, "ca_ttc_total": m["dwh/fait_ventes"]["ca_ttc_total"]}


STAR = ["dim_temps", "dim_produit", "dim_client", "dim_region", "dim_livreur", "fait_ventes"]


def load(spark: SparkSession, store: Generations, settings: WarehouseSettings, database: str = "dwh") -> dict:
    """Point the catalog at the current star (no file is copied), refresh the marts and check the result."""
    catalog.ensure_databases(spark, ["staging", database, "reporting"])
    done = catalog.publish(spark, database, store, {name: f"dwh/{name}" for name in STAR})
    t = lambda name: lambda: spark.table(f"{database}.{name}")
    builders = {
        "mv_ca_mensuel": lambda: marts.monthly_revenue(t("fait_ventes")(), t("dim_temps")()),
        "mv_top_produits": lambda: marts.top_products(t("fait_ventes")(), t("dim_produit")()),
        "mv_performance_livreurs": lambda: marts.courier_performance(t("fait_ventes")(), t("dim_livreur")(), settings),
    }
    refreshed = catalog.refresh_marts(builders, spark, "reporting", f"{store.root}/reporting", settings.keep_versions)
    checks = integrity.integrity_checks(t("fait_ventes"), t("dim_temps"), t("dim_produit"), t("dim_client"))
    report = integrity.run_checks(spark, checks).collect()
    rows = {name: entry.rows for name, entry in store.entries().items() if name.startswith("dwh/")}
    return {"tables": done, "lignes": rows, "marts": refreshed, "integrity": {r.controle: r.valeur for r in report}}


def run_warehouse(
    spark: SparkSession,
    sources: WarehouseSources,
    out: str,
    *,
    phase: str = "all",
    dry_run: bool = False,
    settings: WarehouseSettings = WarehouseSettings(),
) -> dict:
    """Run the flow and return its metrics.

    ``phase`` stops after ``extract`` or ``transform``; ``dry_run`` keeps the written Parquet tables but loads nothing into the
    catalog. What a run has written becomes current with one switch at the end of ``transform`` (``Generations`` below ``out``): a
    run that fails before leaves all tables as they were. Clients and products keep their versions from run to run. A mart
    that could not be refreshed or a check that could not be made leaves the run ``partiel``.
    """
    if phase not in ("extract", "transform", "all"):
        raise ValueError(f"unknown phase: {phase}")
    start = time.monotonic()
    raw = extract(spark, sources)
    if phase == "extract":
        return {"extract": {name: _count(df) for name, df in raw.items()}, "statut": "partiel"}
    store = Generations(spark, out)
    with store.load() as writing:
        tables = transform(raw, writing, settings)
    metrics: dict = {"extract": writing.metrics["extract"], "transform": _transform_metrics(writing), "version": writing.version}
    metrics["rapport"] = rules.markdown(tables["regles"])
    whole = True
    if phase == "all" and not dry_run:
        metrics["load"] = load(spark, store, settings)
        whole = "failed" not in metrics["load"]["marts"].values() and None not in metrics["load"]["integrity"].values()
    store.prune(settings.keep_versions)
    if phase == "transform":
        return {**metrics, "statut": "partiel"}
    return {**metrics, "statut": "succès" if whole else "partiel", "duree_sec": round(time.monotonic() - start, 2)}
