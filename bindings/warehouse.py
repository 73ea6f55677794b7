"""Registered queries of the warehouse, with their SQL."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bindings import sources as src
from bindings.sources import SETTINGS, SQL_AS_OF, SQL_ORDERS, plain, sql_clients, sql_pick, sql_products, table
from sparkmart import fixed_values as fv
from sparkmart.operators import scd
from sparkmart.plans import clients, dimensions, fact, integrity, marts, orders, products, rules
from sparkmart.session import stored
from sparkmart.sources.references import city_variants


def _cities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return city_variants(src.regions(spark, sf_dir))


def _flagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orders.flag_orders(src.dirty_orders(spark, sf_dir), _cities(spark, sf_dir), SETTINGS)


def _clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orders.accepted_orders(_flagged(spark, sf_dir))


def _staged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned orders read back from the stored staging table, as in the flow."""
    return orders.accepted_orders(stored(_flagged(spark, sf_dir)))


def clean_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(_clean(spark, sf_dir))


def clean_clients(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = clients.clean_clients(src.clients_with_repeated_ids(spark, sf_dir), _cities(spark, sf_dir), SETTINGS)
    return cleaned.select(
        "id_client", "email", "email_norm", "date_naissance", F.round("age", 6).alias("age"), "tranche_age",
        "sexe", "ville", "nom_complet", "date_inscription", "canal_acquisition",
    )


def clean_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(products.clean_products(src.dirty_products(spark, sf_dir), SETTINGS))


def rule_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.order_rules(src.dirty_orders(spark, sf_dir), stored(_flagged(spark, sf_dir)))


def rule_report_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rules of all four families: orders, clients, products and fact."""
    star = _star(spark, sf_dir)
    raw_clients, raw_products = src.clients_with_repeated_ids(spark, sf_dir), src.dirty_products(spark, sf_dir)
    return (
        rules.order_rules(src.dirty_orders(spark, sf_dir), star["flagged"])
        .unionByName(rules.client_rules(raw_clients, star["cleaned_clients"]))
        .unionByName(rules.product_rules(raw_products, products.clean_products(raw_products, SETTINGS), SETTINGS.categories))
        .unionByName(rules.fact_rule(star["orders"], star["fact"]))
    )


# --- dimensions --------------------------------------------------------------


def _calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every day from the first to the last order date."""
    bounds = table(spark, sf_dir, "orders").agg(
        F.min(F.to_date("o_orderdate")).alias("first"), F.max(F.to_date("o_orderdate")).alias("last")
    )
    return dimensions.calendar(dimensions.days_between(bounds, F.col("first"), F.col("last")), "jour_complet")


def holidays_of_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calendar attributes of every event day, moved into the years that holidays and periods cover."""
    day = F.date_add(F.to_date("ts"), ((F.col("user_id") % 1800) - 900).cast("int"))
    days = table(spark, sf_dir, "events").select(day.alias("d")).distinct()
    return dimensions.calendar(days, "d").select("id_date", "est_ferie_maroc", "periode_ramadan", "libelle_jour")


def _dim_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dimensions.build_dim_product(products.clean_products(src.dirty_products(spark, sf_dir), SETTINGS))


def _clean_clients(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clients.clean_clients(src.clients_with_repeated_ids(spark, sf_dir), _cities(spark, sf_dir), SETTINGS)


def dim_client(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dimensions.build_dim_client(_clean_clients(spark, sf_dir), _staged(spark, sf_dir), SETTINGS)


def dim_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dimensions.build_dim_region(src.regions(spark, sf_dir))


def dim_courier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dimensions.build_dim_courier(_clean(spark, sf_dir))


def segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clients.client_segments(_staged(spark, sf_dir), SETTINGS)


# --- fact, integrity, marts --------------------------------------------------


def _star(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The star. As in the flow, cleaned orders and dimensions are stored before the fact reads them."""
    flagged = stored(_flagged(spark, sf_dir))
    cleaned = orders.accepted_orders(flagged)
    cleaned_clients = stored(_clean_clients(spark, sf_dir))
    dims = {
        "products": _dim_product(spark, sf_dir),
        "clients": dimensions.build_dim_client(cleaned_clients, cleaned, SETTINGS),
        "regions": dim_region(spark, sf_dir),
        "couriers": dimensions.build_dim_courier(cleaned),
    }
    star = {"calendar": _calendar(spark, sf_dir), "orders": cleaned, "flagged": flagged, "cleaned_clients": cleaned_clients, **{name: stored(dim) for name, dim in dims.items()}}
    star["fact"] = fact.build_sales_fact(cleaned, star["clients"], star["products"], star["regions"], star["couriers"])
    return star


def fact_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(_star(spark, sf_dir)["fact"].drop("date_chargement"))


def integrity_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The checks on a fact some of whose keys were changed after it was built, so that orphans exist."""
    star = _star(spark, sf_dir)
    far = lambda key, rule: F.when(F.col("quantite_vendue") % 10 == rule, -F.col(key)).otherwise(F.col(key))
    sales = stored(star["fact"].withColumns({key: far(key, i) for i, key in enumerate(("id_date", "id_produit", "id_client"), 1)}))
    return integrity.integrity_report(sales, star["calendar"], star["products"], star["clients"])


def unmatched_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order days that a calendar of working days does not hold."""
    working_days = _calendar(spark, sf_dir).filter("NOT est_weekend")
    return fact.unmatched_dates(_clean(spark, sf_dir), working_days)


def mart_monthly_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    star = _star(spark, sf_dir)
    return marts.monthly_revenue(star["fact"], star["calendar"])


def mart_top_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    star = _star(spark, sf_dir)
    return marts.top_products(star["fact"], star["products"])


def mart_courier_perf(spark: SparkSession, sf_dir: str) -> DataFrame:
    star = _star(spark, sf_dir)
    return marts.courier_performance(star["fact"], star["couriers"], SETTINGS)


def scd2_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merge an extract with new, changed, unchanged and missing suppliers into their dimension."""
    s = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("nk"), F.col("s_name").alias("nom"), F.col("s_nationkey").alias("pays"), "s_acctbal"
    )
    first = s.filter("s_acctbal > 0").withColumns(
        {"sk": F.col("nk") + 1, **scd.version_columns(F.lit(date(2020, 1, 1)))}
    ).select("sk", "nk", "nom", "pays", "date_debut", "date_fin", "est_actif")
    extract = s.filter("s_acctbal < 8000").withColumn("pays", F.when(F.col("s_acctbal") < 5000, F.col("pays")))
    return scd.merge_versions(first, extract.drop("s_acctbal"), "nk", "sk", ["nom", "pays"], date(2024, 6, 30))


QUERIES = {
    "clean_orders": clean_orders,
    "clean_clients": clean_clients,
    "clean_products": clean_products,
    "rule_report": rule_report,
    "rule_report_all": rule_report_all,
    "dim_calendar": _calendar,
    "holidays_of_events": holidays_of_events,
    "dim_product": lambda spark, sf_dir: plain(_dim_product(spark, sf_dir)),
    "dim_client": dim_client,
    "dim_region": dim_region,
    "dim_courier": dim_courier,
    "customer_segments": segments,
    "fact_sales": fact_sales,
    "unmatched_dates": unmatched_dates,
    "integrity_report": integrity_report,
    "mart_monthly_revenue": mart_monthly_revenue,
    "mart_top_products": mart_top_products,
    "mart_courier_perf": mart_courier_perf,
    "scd2_merge": scd2_merge,
}

# --- SQL ---------------------------------------------------------------------

SQL_SEGMENTS = """
segments AS (
  SELECT id_client, CASE WHEN sum(montant_ttc) >= 15000 THEN 'Gold' WHEN sum(montant_ttc) >= 5000 THEN 'Silver' ELSE 'Bronze' END AS segment_client,
    CAST(round(sum(montant_ttc), 2) AS DOUBLE) AS ca_12m
  FROM commandes
  WHERE statut = 'livré' AND date_commande >= (SELECT max(date_commande) FROM commandes) - 365
  GROUP BY id_client)"""

_ramadan = " OR ".join(f"d BETWEEN DATE '{a}' AND DATE '{b}'" for a, b in fv.RAMADAN_PERIODS)
_holiday = "strftime(d, '%m-%d') IN ({}) AND year(d) BETWEEN 2022 AND 2026".format(
    ", ".join(f"'{m}'" for m in fv.HOLIDAY_MONTH_DAYS)
)
SQL_CALENDAR_COLUMNS = f"""
  CAST(strftime(d, '%Y%m%d') AS INTEGER) AS id_date, CAST(day(d) AS SMALLINT) AS jour, CAST(month(d) AS SMALLINT) AS mois,
  CAST(quarter(d) AS SMALLINT) AS trimestre, CAST(year(d) AS SMALLINT) AS annee, CAST(weekofyear(d) AS SMALLINT) AS semaine,
  dayname(d) AS libelle_jour, monthname(d) AS libelle_mois, 'T' || quarter(d) || ' ' || year(d) AS libelle_trimestre,
  isodow(d) >= 6 AS est_weekend, {_holiday} AS est_ferie_maroc, ({_ramadan}) AS periode_ramadan"""
SQL_CALENDAR = f"""
calendrier AS (
  SELECT {SQL_CALENDAR_COLUMNS}
  FROM (SELECT CAST(unnest(generate_series(min(o_orderdate), max(o_orderdate), INTERVAL 1 DAY)) AS DATE) AS d FROM orders))"""

SQL_DIM_PRODUCT = """
dim_produit AS (
  SELECT row_number() OVER (ORDER BY id_produit) AS id_produit_sk, id_produit AS id_produit_nk, nom AS nom_produit, categorie,
    sous_categorie, marque, fournisseur, prix_catalogue AS prix_standard, origine_pays, date_creation, actif, date_debut, date_fin, est_actif
  FROM produits)"""
SQL_DIM_CLIENT = f"""
dim_client AS (
  SELECT row_number() OVER (ORDER BY id_client, date_inscription NULLS FIRST) AS id_client_sk, id_client AS id_client_nk,
    nom_complet, tranche_age, sexe, ville, canal_acquisition, date_inscription,
    coalesce(segment_client, 'Bronze') AS segment_client, {SQL_AS_OF} AS date_debut, DATE '9999-12-31' AS date_fin, TRUE AS est_actif
  FROM clients_banded LEFT JOIN segments USING (id_client))"""
SQL_DIM_REGION = """
dim_region AS (
  SELECT CAST(1 AS BIGINT) AS id_region, 'Non renseignée' AS ville, 'Inconnu' AS province, 'Inconnu' AS region_admin,
    'Inconnu' AS zone_geo, 'Maroc' AS pays
  UNION ALL
  SELECT 1 + row_number() OVER (ORDER BY 'Cité ' || n_nationkey), 'Cité ' || n_nationkey, n_name, r_name, lower(r_name), 'Maroc'
  FROM nation JOIN region ON n_regionkey = r_regionkey)"""
_courier = lambda values, salt: sql_pick(f"CAST('0x' || substr(md5('{salt}' || id_livreur), 1, 8) AS BIGINT) % {len(values)}", values)
SQL_DIM_COURIER = f"""
dim_livreur AS (
  SELECT CAST(1 AS BIGINT) AS id_livreur, '-1' AS id_livreur_nk, 'Livreur Inconnu' AS nom_livreur, 'Inconnu' AS type_transport, 'Inconnu' AS zone_couverture
  UNION ALL
  SELECT 1 + row_number() OVER (ORDER BY id_livreur), id_livreur, 'Livreur ' || id_livreur,
    {_courier(fv.COURIER_TRANSPORTS, 1)}, {_courier(fv.COURIER_ZONES, 2)}
  FROM (SELECT DISTINCT id_livreur FROM commandes WHERE id_livreur <> '-1'))"""
SQL_STAR = ",".join(
    [
        SQL_ORDERS, sql_products(), sql_clients(), SQL_SEGMENTS, SQL_CALENDAR,
        SQL_DIM_PRODUCT, SQL_DIM_CLIENT, SQL_DIM_REGION, SQL_DIM_COURIER,
        """
fait AS (
  SELECT CAST(strftime(date_commande, '%Y%m%d') AS INTEGER) AS id_date, p.id_produit_sk AS id_produit, c.id_client_sk AS id_client,
    coalesce(r.id_region, 1) AS id_region, coalesce(l.id_livreur, 1) AS id_livreur, CAST(quantite AS INTEGER) AS quantite_vendue,
    montant_ht, montant_ttc, CAST(0 AS DOUBLE) AS cout_livraison, delai_livraison_jours, CAST(0 AS DOUBLE) AS remise_pct,
    statut AS statut_commande
  FROM commandes o
  JOIN dim_produit p ON o.id_produit = p.id_produit_nk
  JOIN (SELECT id_client_nk, max(id_client_sk) AS id_client_sk FROM dim_client GROUP BY id_client_nk) c ON o.id_client = c.id_client_nk
  LEFT JOIN dim_region r ON o.ville_livraison = r.ville
  LEFT JOIN dim_livreur l ON o.id_livreur = l.id_livreur_nk)""",
    ]
)

_orphans = """SELECT 'orphelins_{0}' AS controle, CAST(count(*) AS DOUBLE) AS valeur FROM fait_change
  WHERE {1} NOT IN (SELECT {2} FROM {3})"""

SQL_ORDER_RULES = """
n AS (SELECT (SELECT count(*) FROM lineitem JOIN orders ON l_orderkey = o_orderkey) AS extraites, count(*) AS uniques,
    count(*) FILTER (date_commande IS NOT NULL) AS datees,
    count(*) FILTER (date_commande IS NOT NULL AND quantite > 0) AS quantifiees,
    count(*) FILTER (date_commande IS NOT NULL AND quantite > 0 AND prix_unitaire > 0) AS tarifees,
    count(*) FILTER (date_commande IS NOT NULL AND ville_livraison = 'Non renseignée') AS villes,
    count(*) FILTER (date_commande IS NOT NULL AND l_returnflag <> 'A') AS statuts,
    count(*) FILTER (date_commande IS NOT NULL AND quantite > 0 AND prix_unitaire > 0 AND id_livreur = '-1') AS livreurs,
    count(*) FILTER (date_commande IS NOT NULL AND quantite > 0 AND prix_unitaire > 0 AND date_livraison < date_commande) AS delais
  FROM typed),
r AS (
  SELECT 'R1 doublons id_commande' AS regle, extraites AS avant, uniques AS apres, 0 AS remplacees FROM n
  UNION ALL SELECT 'R2 dates', uniques, datees, 0 FROM n
  UNION ALL SELECT 'R3 villes', datees, datees, villes FROM n
  UNION ALL SELECT 'R4 statuts', datees, datees, statuts FROM n
  UNION ALL SELECT 'R5 quantites invalides', datees, quantifiees, 0 FROM n
  UNION ALL SELECT 'R6 prix nuls', quantifiees, tarifees, 0 FROM n
  UNION ALL SELECT 'R7 livreurs manquants', tarifees, tarifees, livreurs FROM n
  UNION ALL SELECT 'R9 delais negatifs', tarifees, tarifees, delais FROM n)"""
_rule_rows = lambda rows, entity: f"""SELECT regle, '{entity}' AS entite, avant, apres, avant - apres AS supprimees,
  CAST(round(CAST((avant - apres) * 100 AS DECIMAL(18,6)) / avant, 2) AS DOUBLE) AS pct, CAST(remplacees AS BIGINT) AS remplacees FROM {rows}"""

SQL = {
    "clean_orders": f"""WITH {SQL_ORDERS}
SELECT * REPLACE (CAST(montant_ht AS DOUBLE) AS montant_ht, CAST(montant_ttc AS DOUBLE) AS montant_ttc) FROM commandes""",
    "clean_clients": f"""WITH {sql_clients()}
SELECT id_client, email, email_norm, date_naissance, round(age, 6) AS age, tranche_age, sexe, ville, nom_complet,
  date_inscription, canal_acquisition FROM clients_banded""",
    "clean_products": f"WITH {sql_products()} SELECT * FROM produits",
    "rule_report": f"WITH {SQL_ORDERS}, {SQL_ORDER_RULES} {_rule_rows('r', 'commandes')}",
    "rule_report_all": f"""WITH {SQL_STAR}, {SQL_ORDER_RULES},
m AS (SELECT (SELECT count(*) FROM customer) AS extraits, count(*) AS uniques, count(*) FILTER (sexe = 'inconnu') AS sexes,
    count(*) FILTER (age IS NULL) AS ages, count(*) FILTER (email IS NULL) AS emails, count(*) FILTER (ville = 'Non renseignée') AS villes FROM clients),
rc AS (
  SELECT 'R1 doublons email' AS regle, extraits AS avant, uniques AS apres, 0 AS remplacees FROM m
  UNION ALL SELECT 'R2 sexe inconnu', uniques, uniques, sexes FROM m UNION ALL SELECT 'R3 ages invalides', uniques, uniques, ages FROM m
  UNION ALL SELECT 'R5 emails invalides', uniques, uniques, emails FROM m UNION ALL SELECT 'R6 villes inconnues', uniques, uniques, villes FROM m),
rp AS (
  SELECT 'R1 categories' AS regle, count(*) AS avant, count(*) AS apres, count(*) FILTER (p_partkey % 5 IN (0, 1, 3)) AS remplacees FROM part
  UNION ALL SELECT 'R2 prix null', count(*), count(*), count(*) FILTER (p_partkey % 50 = 0 OR p_partkey % 51 = 0) FROM part
  UNION ALL SELECT 'R4 produits inactifs', count(*), count(*), count(*) FILTER (NOT ({src.ACTIVE_SQL})) FROM part),
rf AS (SELECT 'fait_ventes' AS regle, (SELECT count(*) FROM commandes) AS avant, (SELECT count(*) FROM fait) AS apres, 0 AS remplacees)
{_rule_rows('r', 'commandes')} UNION ALL {_rule_rows('rc', 'clients')} UNION ALL {_rule_rows('rp', 'produits')} UNION ALL {_rule_rows('rf', 'faits')}""",
    "dim_calendar": f"WITH {SQL_CALENDAR} SELECT * FROM calendrier",
    "holidays_of_events": f"""SELECT id_date, est_ferie_maroc, periode_ramadan, libelle_jour FROM (SELECT {SQL_CALENDAR_COLUMNS}
  FROM (SELECT DISTINCT CAST(ts AS DATE) + CAST((user_id % 1800) - 900 AS INTEGER) AS d FROM events))""",
    "dim_product": f"WITH {sql_products()}, {SQL_DIM_PRODUCT} SELECT * FROM dim_produit",
    "dim_client": f"WITH {SQL_ORDERS}, {sql_clients()}, {SQL_SEGMENTS}, {SQL_DIM_CLIENT} SELECT * FROM dim_client",
    "dim_region": f"WITH {SQL_DIM_REGION} SELECT * FROM dim_region",
    "dim_courier": f"WITH {SQL_ORDERS}, {SQL_DIM_COURIER} SELECT * FROM dim_livreur",
    "customer_segments": f"WITH {SQL_ORDERS}, {SQL_SEGMENTS} SELECT * FROM segments",
    "fact_sales": f"""WITH {SQL_STAR}
SELECT * REPLACE (CAST(montant_ht AS DOUBLE) AS montant_ht, CAST(montant_ttc AS DOUBLE) AS montant_ttc) FROM fait""",
    "unmatched_dates": f"""WITH {SQL_ORDERS}
SELECT CAST(strftime(date_commande, '%Y%m%d') AS INTEGER) AS id_date, count(*) AS nb FROM commandes
WHERE isodow(date_commande) >= 6 GROUP BY ALL""",
    "integrity_report": f"""WITH {SQL_STAR},
fait_change AS (SELECT * REPLACE (CASE WHEN quantite_vendue % 10 = 1 THEN -id_date ELSE id_date END AS id_date,
    CASE WHEN quantite_vendue % 10 = 2 THEN -id_produit ELSE id_produit END AS id_produit,
    CASE WHEN quantite_vendue % 10 = 3 THEN -id_client ELSE id_client END AS id_client) FROM fait),
checks AS (
  {_orphans.format('date', 'id_date', 'id_date', 'calendrier')}
  UNION ALL {_orphans.format('produit', 'id_produit', 'id_produit_sk', 'dim_produit')}
  UNION ALL {_orphans.format('client', 'id_client', 'id_client_sk', 'dim_client')}
  UNION ALL SELECT 'nb_faits', count(*) FROM fait
  UNION ALL SELECT 'nb_clients', count(*) FROM dim_client
  UNION ALL SELECT 'nb_produits', count(*) FROM dim_produit
  UNION ALL SELECT 'ca_total_ttc', CAST(sum(montant_ttc) AS DOUBLE) FROM fait WHERE statut_commande = 'livré')
SELECT controle, valeur, CASE WHEN controle LIKE 'orphelins%' AND valeur > 0 THEN 'warning' ELSE 'info' END AS niveau FROM checks""",
    "mart_monthly_revenue": f"""WITH {SQL_STAR}
SELECT CAST(annee AS INTEGER) AS annee, CAST(mois AS INTEGER) AS mois, CAST(sum(montant_ht) AS DOUBLE) AS ca_ht,
  CAST(sum(montant_ttc) AS DOUBLE) AS ca_ttc, count(*) AS nb_commandes, CAST(sum(quantite_vendue) AS BIGINT) AS quantite
FROM fait JOIN calendrier USING (id_date) WHERE statut_commande = 'livré' GROUP BY ALL""",
    "mart_top_products": f"""WITH {SQL_STAR}
SELECT f.id_produit, nom_produit, categorie, CAST(sum(montant_ttc) AS DOUBLE) AS ca_ttc,
  CAST(sum(quantite_vendue) AS BIGINT) AS quantite, rank() OVER (PARTITION BY categorie ORDER BY sum(montant_ttc) DESC) AS rang_categorie
FROM fait f JOIN dim_produit ON f.id_produit = id_produit_sk WHERE statut_commande = 'livré' GROUP BY f.id_produit, nom_produit, categorie""",
    "mart_courier_perf": f"""WITH {SQL_STAR}
SELECT id_livreur, nom_livreur, count(*) AS nb_livraisons,
  CAST(round(CAST(sum(delai_livraison_jours) AS DECIMAL(18,8)) / count(delai_livraison_jours), 2) AS DOUBLE) AS delai_moyen,
  CAST(round(CAST(count(*) FILTER (delai_livraison_jours > 3) * 100 AS DECIMAL(18,8)) / nullif(count(delai_livraison_jours), 0), 2) AS DOUBLE) AS pct_retard
FROM fait JOIN dim_livreur USING (id_livreur) WHERE statut_commande = 'livré' GROUP BY ALL""",
    "scd2_merge": f"""WITH s AS (SELECT s_suppkey AS nk, s_name AS nom, s_nationkey AS pays, s_acctbal FROM supplier),
first_ AS (SELECT * FROM s WHERE s_acctbal > 0),
extract_ AS (SELECT nk, nom, CASE WHEN s_acctbal < 5000 THEN pays END AS pays FROM s WHERE s_acctbal < 8000),
opened AS (SELECT e.* FROM extract_ e LEFT JOIN first_ f ON e.nk = f.nk
  WHERE f.nk IS NULL OR e.nom IS DISTINCT FROM f.nom OR e.pays IS DISTINCT FROM f.pays)
SELECT f.nk + 1 AS sk, f.nk, f.nom, f.pays, DATE '2020-01-01' AS date_debut,
  CASE WHEN o.nk IS NULL THEN DATE '9999-12-31' ELSE {SQL_AS_OF} END AS date_fin, o.nk IS NULL AS est_actif
FROM first_ f LEFT JOIN opened o ON f.nk = o.nk
UNION ALL
SELECT (SELECT max(nk) + 1 FROM first_) + row_number() OVER (ORDER BY nk), nk, nom, pays, {SQL_AS_OF}, DATE '9999-12-31', TRUE FROM opened""",
}
