"""Registered round trips through the sources and sinks: whole tables are written in a layout and read back through the readers."""

from __future__ import annotations

import json
import uuid
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bindings import lake
from bindings.sources import pick, sql_pick, table
from sparkmart import schemas
from sparkmart.operators import scd, sketches
from sparkmart.operators.keys import with_surrogate_key
from sparkmart.plans import approximate, gold, history, integrity, silver
from sparkmart.plans.lake import build_gold, build_silver, ingest_bronze
from sparkmart.session import ensure_checkpoint_dir, stored
from sparkmart.sinks import catalog
from sparkmart.sinks.files import with_month_partition, write_parquet
from sparkmart.sinks.generations import Generations
from sparkmart.sinks.jdbc import nan_to_null
from sparkmart.sources import files

STATUSES = ["livré", "N/A", "", "dit \"OK\"", "a, b", None]
STATUSES_READ = ["livré", None, None, "dit \"OK\"", "a, b", None]
DOCUMENT_ROWS = 1000


def _folder(spark: SparkSession) -> str:
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/roundtrip-{uuid.uuid4().hex}"


def _database(spark: SparkSession) -> str:
    """A database of this call, so that a second call starts from nothing."""
    name = f"roundtrip_{uuid.uuid4().hex}"
    catalog.ensure_databases(spark, [name], _folder(spark))
    return name


def _write_csv(df: DataFrame, path: str) -> str:
    """Header names with blanks around them, quotes doubled."""
    padded = df.toDF(*[f" {c} " for c in df.columns])
    padded.write.csv(path, header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False, emptyValue="")
    return path


# --- CSV and JSON sources ----------------------------------------------------


def csv_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = lambda c: F.col(c).cast("string")
    raw = table(spark, sf_dir, "lineitem").select(
        text("l_orderkey").alias("id_commande"), text("l_linenumber").alias("id_client"), text("l_partkey").alias("id_produit"),
        F.to_date("l_shipdate").cast("string").alias("date_commande"), text("l_suppkey").alias("quantite"),
        F.lit("nan").alias("prix_unitaire"), pick(F.col("l_partkey") % len(STATUSES), STATUSES).alias("statut"),
        F.lit("Rabat").alias("ville_livraison"), F.lit("NULL").alias("mode_paiement"),
        F.col("l_returnflag").alias("id_livreur"), F.lit(None).cast("string").alias("date_livraison"),
    )
    return files.read_orders(spark, _write_csv(raw, _folder(spark))).select(*schemas.ORDERS.names)


def csv_clients(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names hold line breaks and quotes; the columns of every other customer's file are in another order."""
    key = F.col("c_custkey").cast("string")
    filled = {name: F.lit(None).cast("string") for name in schemas.CLIENTS.names}
    filled |= {
        "id_client": key, "nom": F.concat(F.lit('dit "le\nGrand", '), key), "prenom": F.col("c_mktsegment"),
        "ville": F.when(F.col("c_nationkey") % 3 != 0, F.col("c_nationkey").cast("string")).otherwise("n/a"),
    }
    raw = table(spark, sf_dir, "customer").select(*[column.alias(name) for name, column in filled.items()])
    path, odd = _folder(spark), F.col("id_client").cast("bigint") % 2 == 1
    _write_csv(raw.filter(~odd), f"{path}/even")
    _write_csv(raw.filter(odd).select(*reversed(raw.columns)), f"{path}/odd")
    read = files.read_clients(spark, f"{path}/*", multi_line=True)
    return read.select("id_client", "nom", "prenom", "ville", "email")


def csv_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = table(spark, sf_dir, "nation").select(
        F.lower("n_name").alias("code_ville"), F.col("n_name").alias("nom_ville_standard"), F.lit("p").alias("province"),
        F.col("n_regionkey").cast("string").alias("region_admin"), F.lit("z").alias("zone_geo"),
        (F.col("n_nationkey") * 1000).cast("string").alias("population"),
        F.concat(F.lit("0"), F.col("n_nationkey").cast("string")).alias("code_postal"),
    )
    return files.read_regions(spark, _write_csv(raw, _folder(spark))).drop(files.ORDINAL)


def _products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as products; price and flag are numbers and booleans."""
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("id_produit"), F.col("p_name").alias("nom"), F.col("p_type").alias("categorie"),
        F.col("p_brand").alias("marque"), F.col("p_size").alias("prix_catalogue"), (F.col("p_size") > 25).alias("actif"),
    )


_PRODUCT = ["id_produit", "nom", "categorie", "marque", "prix_catalogue", "actif", "origine_pays"]


def json_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with a root key, each of a bounded number of products."""
    products, path = _products(spark, sf_dir), _folder(spark)
    lot = F.floor(F.col("id_produit").cast("bigint") / DOCUMENT_ROWS).alias("lot")
    documents = products.groupBy(lot).agg(F.collect_list(F.struct(*products.columns)).alias("produits"))
    documents.select("lot", F.to_json(F.struct("produits")).alias("value")).write.partitionBy("lot").text(path)
    return files.read_products(spark, f"{path}/lot=*").select(*_PRODUCT)


def json_lines_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _folder(spark)
    _products(spark, sf_dir).write.json(path)
    return files.read_products(spark, path, json_lines=True).select(*_PRODUCT)


# --- lake --------------------------------------------------------------------


def _twice_loaded(spark: SparkSession, sf_dir: str) -> tuple[str, DataFrame]:
    """A lake into which the same offers were loaded twice, and the statistics of the second load."""
    root = _folder(spark)
    lake.dirty_offers(spark, sf_dir).drop("doc_id").write.json(f"{root}/source")
    ingest_bronze(spark, f"{root}/source", root, json_lines=True)
    return root, ingest_bronze(spark, f"{root}/source", root, json_lines=True)


def bronze_reload(spark: SparkSession, sf_dir: str) -> DataFrame:
    root, _ = _twice_loaded(spark, sf_dir)
    return files.read_bronze(spark, root).select("id_offre", "source", "description", "date_publication", "nb_postes")


def bronze_reload_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _twice_loaded(spark, sf_dir)[1]


def bronze_reload_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    root, _ = _twice_loaded(spark, sf_dir)
    return spark.read.parquet(f"{root}/bronze_manifest").select("partition", "nb_offres")


def lake_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze, silver and gold written and read again, with the dictionary from its file."""
    root, _ = _twice_loaded(spark, sf_dir)
    families: dict[str, dict[str, list[str]]] = {}
    for alias, skill, family in lake.SKILLS:
        families.setdefault(family, {}).setdefault(skill, []).append(alias)
    dictionary = json.dumps({"familles": families})
    spark.createDataFrame([(dictionary,)], "value string").write.text(f"{root}/skills")
    build_silver(spark, root, f"{root}/skills")
    build_gold(spark, root)
    return files.read_table(spark, root, "gold", "top_competences")


# --- warehouse sinks ---------------------------------------------------------


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", F.date_format("l_shipdate", "yyyyMMdd").cast("int").alias("id_date")
    )


def json_one_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All parts as one document with braces, quotes and key names in its strings, which several tasks read."""
    products, path = _products(spark, sf_dir), _folder(spark)
    hard = products.withColumn("nom", F.concat("nom", F.lit(' }, {"produits": [ \\ '), "id_produit"))
    lines = hard.select(F.concat(F.lit(","), F.to_json(F.struct(*hard.columns))).alias("value"))
    ends = [spark.range(1).select(F.lit(text).alias("value")) for text in ('{"note": "}", "autres": [{"id_produit": "x"}], "produits": [{}', ']}')]
    # One file from one task: only to have the table as one document.
    ends[0].union(lines).union(ends[1]).coalesce(1).write.text(path)
    read = files.read_products(spark, path, split_above=0, range_bytes=64 * 1024)
    return read.filter("id_produit IS NOT NULL").select(*_PRODUCT)


# --- loads -------------------------------------------------------------------


def load_after_failure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two tables loaded together, then loads of which one fails in its last table: both keep their rows."""
    database = _database(spark)
    customers, orders = table(spark, sf_dir, "customer").select("c_custkey", "c_name"), table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    catalog.load_tables(spark, database, {"clients": customers, "commandes": orders})
    lost = orders.withColumn("o_custkey", F.when(F.col("o_custkey") < 0, 0).otherwise(F.raise_error(F.lit("lost")).cast("bigint")))
    try:
        catalog.load_tables(spark, database, {"clients": customers.withColumn("c_name", F.lit("new")), "commandes": lost})
    except Exception:  # as meant
        pass
    return spark.table(f"{database}.commandes").join(spark.table(f"{database}.clients"), F.col("o_custkey") == F.col("c_custkey")).select(
        "o_orderkey", "c_custkey", "c_name"
    )


def dimension_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers that have ordered, then all customers with some of their attributes changed, merged into the stored dimension."""
    store = Generations(spark, _folder(spark))
    known = table(spark, sf_dir, "orders").select("o_custkey").distinct()
    every = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment", "c_acctbal")
    first = every.join(known, F.col("c_custkey") == F.col("o_custkey"), "left_semi").drop("c_acctbal")
    versions = lambda rows, day: rows.withColumns(scd.version_columns(F.lit(day)))
    with store.load() as load:
        numbered = with_surrogate_key(versions(first, date(2024, 1, 1)), "sk", ["c_custkey"])
        history.start_history(load, "dim", numbered, "c_custkey", "sk", 16)
    changed = every.withColumn("c_mktsegment", F.when(F.col("c_acctbal") >= 0, F.col("c_mktsegment"))).drop("c_acctbal")
    with store.load() as load:
        history.merge_history(load, "dim", versions(changed, date(2024, 6, 30)), "c_custkey", "sk", ["c_name", "c_mktsegment"], date(2024, 6, 30))
    return store.read("dim")


def checks_alone(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Checks side by side, of which those of the products can't be made."""
    fact = table(spark, sf_dir, "orders").select(
        F.col("o_orderdate").alias("id_date"), F.lit(1).alias("id_produit"), (F.col("o_custkey") + F.col("o_orderkey") % 2).alias("id_client"),
        F.when(F.col("o_orderstatus") == "F", "livré").alias("statut_commande"), F.col("o_totalprice").cast("decimal(18,2)").alias("montant_ttc"),
    )
    days = table(spark, sf_dir, "lineitem").select(F.col("l_shipdate").alias("id_date"))
    clients = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id_client_sk"))
    gone = lambda: files.read_table(spark, _folder(spark), "dwh", "dim_produit")
    checks = integrity.integrity_checks(lambda: fact, lambda: days, gone, lambda: clients)
    return integrity.run_checks(spark, checks).select("controle", "valeur", "niveau")


def run_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What writes count on their way: rows, the largest price and lines by flag."""
    store = Generations(spark, _folder(spark))
    lines = table(spark, sf_dir, "lineitem")
    with store.load() as load:
        counts = {flag: F.count_if(F.col("l_returnflag") == flag) for flag in ("A", "N", "R")}
        load.write(with_month_partition(_lines(spark, sf_dir)), "fait", ["annee_mois"], metrics={"plus": F.max("l_quantity").cast("double")})
        load.write(lines.select("l_orderkey", "l_returnflag"), "lignes", metrics=counts)
    found = [(name, metric, float(value)) for name, own in load.metrics.items() for metric, value in own.items()]
    return spark.createDataFrame(found, "table string, mesure string, valeur double")


def month_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A fact written by month, then replaced by another one."""
    path, fact = _folder(spark), with_month_partition(_lines(spark, sf_dir))
    for rows in (fact.withColumn("l_quantity", F.lit(0.0)), fact):
        write_parquet(rows, path, ["annee_mois"])
    return spark.read.parquet(path)


def catalog_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Created, truncated, loaded again with the columns in another order, and kept when an empty result comes."""
    database, rows = _database(spark), table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal")
    catalog.load_table(rows, database, "dim_client")
    catalog.truncate_table(spark, database, "dim_client")
    catalog.load_table(rows.select("c_acctbal", "c_custkey", "c_name"), database, "dim_client")
    catalog.load_table(rows.filter("false"), database, "dim_client")
    return spark.table(f"{database}.dim_client")


def catalog_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A fact partitioned by month, loaded twice."""
    database, fact = _database(spark), with_month_partition(_lines(spark, sf_dir))
    for _ in range(2):
        catalog.load_table(fact, database, "fait_ventes", ["annee_mois"])
    return spark.table(f"{database}.fait_ventes")


def mart_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A mart refreshed twice, then kept when a third refresh fails."""
    database, path = _database(spark), _folder(spark)
    orders = table(spark, sf_dir, "orders")

    def counted(factor: int) -> DataFrame:
        return orders.groupBy("o_orderpriority").agg((F.count(F.lit(1)) * factor).alias("nb"))

    for build in (lambda: counted(2), lambda: counted(1), lambda: orders.select(F.col("o_orderkey").alias("o orderkey,"), "missing")):
        catalog.refresh_marts({"mv_priorites": build}, spark, database, path)
    return spark.table(f"{database}.mv_priorites")


def nulls_for_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    price = F.when(F.col("o_orderkey") % 7 == 0, float("nan")).otherwise(F.col("o_totalprice").cast("double"))
    return nan_to_null(table(spark, sf_dir, "orders").select("o_orderkey", price.alias("prix"), "o_orderstatus"))


# --- sketches beside the marts -------------------------------------------------


def sketch_skills(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Skill counts from the stored sketches of all months, against the exact ones: four standard errors at most."""
    offers, root = silver.clean_offers(lake.dirty_offers(spark, sf_dir)), _folder(spark)
    skills = stored(silver.offer_skills(offers, lake.dictionary(spark)))
    approximate.write_sketches(offers, skills, root)
    read = lambda name: approximate.read_sketches(spark, root, name)
    near = approximate.approximate_top_skills(read("croquis_competences"), read("croquis_offres")).withColumnRenamed("nb_offres_mentionnent", "_near")
    keys, exact = ["profil", "famille", "competence"], F.col("nb_offres_mentionnent")
    within = F.abs(F.col("_near") / exact - 1) <= 4 * sketches.distinct_error()
    both = gold.top_skills(skills, offers).select(*keys, exact).join(near.select(*keys, "_near"), keys, "full")
    return both.select(*keys, exact, F.coalesce(within, F.lit(False)).alias("dans_la_borne"))


SPAN = ("1993-05", "1996-08")


def sketch_salaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quantiles of a span from the sketches of its months: the share of values below each is off by twice the rank error at most."""
    day, root = F.col("o_orderdate"), _folder(spark)
    offers = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").cast("string").alias("id_offre"), F.col("o_orderpriority").alias("profil_normalise"),
        F.col("o_orderstatus").alias("ville_std"), F.lit("CDI").alias("type_contrat_std"),
        (F.col("o_orderstatus") != "P").alias("salaire_connu"), F.col("o_totalprice").cast("double").alias("salaire_median_mad"),
        F.date_format(day, "yyyy").alias("annee"), F.date_format(day, "MM").alias("mois"),
    )
    skills = offers.select("id_offre", F.col("profil_normalise").alias("profil"), F.col("ville_std").alias("famille"),
                           F.col("ville_std").alias("competence"), "annee", "mois")
    approximate.write_sketches(offers, skills, root)
    span = approximate.in_span(approximate.read_sketches(spark, root, "croquis_offres"), *SPAN)
    near = stored(approximate.approximate_salaries(span, ["profil"]).withColumnRenamed("profil", "_profil"))
    known = approximate.in_span(offers, *SPAN).filter("salaire_connu").withColumnRenamed("salaire_median_mad", "_value").join(near, F.col("profil_normalise") == F.col("_profil"))
    shares = [
        (F.count_if(F.col("_value") < F.col(name) + 1) / F.count(F.lit(1)) >= share - 2 * sketches.rank_error())
        & (F.count_if(F.col("_value") < F.col(name) - 1) / F.count(F.lit(1)) <= share + 2 * sketches.rank_error())
        for name, share in approximate.SHARES.items()
    ]  # the quantiles are rounded to units
    checked = known.groupBy("_profil").agg(reduce(lambda a, b: a & b, shares).alias("quantiles_dans_la_borne"))
    distinct = approximate.in_span(offers, *SPAN).groupBy("profil_normalise").agg(F.countDistinct("id_offre").alias("nb_offres_distinctes"))
    exact = F.col("d.nb_offres_distinctes")
    within = F.abs(F.col("n.nb_offres_distinctes") / exact - 1) <= 4 * sketches.distinct_error()
    return (
        near.alias("n").join(checked.alias("c"), "_profil").join(distinct.alias("d"), F.col("_profil") == F.col("profil_normalise"))
        .select(F.col("_profil").alias("profil"), "n.nb_offres", "n.nb_offres_avec_salaire", exact, within.alias("distinctes_dans_la_borne"),
                "quantiles_dans_la_borne")
    )


QUERIES = {
    "csv_orders": csv_orders,
    "csv_clients": csv_clients,
    "csv_regions": csv_regions,
    "json_products": json_products,
    "json_lines_products": json_lines_products,
    "bronze_reload": bronze_reload,
    "bronze_reload_stats": bronze_reload_stats,
    "bronze_reload_manifest": bronze_reload_manifest,
    "lake_zones": lake_zones,
    "json_one_document": json_one_document,
    "load_after_failure": load_after_failure,
    "dimension_history": dimension_history,
    "checks_alone": checks_alone,
    "run_metrics": run_metrics,
    "month_partitions": month_partitions,
    "catalog_dimension": catalog_dimension,
    "catalog_fact": catalog_fact,
    "mart_refresh": mart_refresh,
    "nulls_for_sql": nulls_for_sql,
    "sketch_skills": sketch_skills,
    "sketch_salaries": sketch_salaries,
}

_SQL_PRODUCTS = """SELECT CAST(p_partkey AS VARCHAR) AS id_produit, p_name AS nom, p_type AS categorie, p_brand AS marque,
  CAST(p_size AS VARCHAR) AS prix_catalogue, CASE WHEN p_size > 25 THEN 'true' ELSE 'false' END AS actif,
  CAST(NULL AS VARCHAR) AS origine_pays FROM part"""
_SQL_FACT = """SELECT l_orderkey, l_linenumber, l_quantity, CAST(strftime(l_shipdate, '%Y%m%d') AS INTEGER) AS id_date,
  CAST(strftime(l_shipdate, '%Y%m') AS INTEGER) AS annee_mois FROM lineitem"""

SQL = {
    "csv_orders": f"""SELECT CAST(l_orderkey AS VARCHAR) AS id_commande, CAST(l_linenumber AS VARCHAR) AS id_client,
  CAST(l_partkey AS VARCHAR) AS id_produit, strftime(l_shipdate, '%Y-%m-%d') AS date_commande, CAST(l_suppkey AS VARCHAR) AS quantite,
  CAST(NULL AS VARCHAR) AS prix_unitaire, {sql_pick(f'l_partkey % {len(STATUSES)}', STATUSES_READ)} AS statut,
  'Rabat' AS ville_livraison, CAST(NULL AS VARCHAR) AS mode_paiement, l_returnflag AS id_livreur,
  CAST(NULL AS VARCHAR) AS date_livraison FROM lineitem""",
    "csv_clients": """SELECT CAST(c_custkey AS VARCHAR) AS id_client, 'dit "le' || chr(10) || 'Grand", ' || c_custkey AS nom,
  c_mktsegment AS prenom, CASE WHEN c_nationkey % 3 <> 0 THEN CAST(c_nationkey AS VARCHAR) END AS ville,
  CAST(NULL AS VARCHAR) AS email FROM customer""",
    "csv_regions": """SELECT lower(n_name) AS code_ville, n_name AS nom_ville_standard, 'p' AS province,
  CAST(n_regionkey AS VARCHAR) AS region_admin, 'z' AS zone_geo, CAST(n_nationkey * 1000 AS BIGINT) AS population,
  '0' || n_nationkey AS code_postal FROM nation""",
    "json_products": _SQL_PRODUCTS,
    "json_lines_products": _SQL_PRODUCTS,
    "bronze_reload": f"""SELECT 'OF-' || (doc_id % 5000) AS id_offre, CASE WHEN doc_id % 23 <> 0 THEN upper(source) || ' Web' END AS source,
  text AS description, {lake._PUBLISHED} AS date_publication, CAST(1 AS BIGINT) AS nb_postes FROM documents""",
    "bronze_reload_stats": lake.SQL["bronze_stats"],
    "bronze_reload_manifest": f"WITH {lake.SQL_MANIFEST} SELECT partition, nb_offres FROM manifest",
    "lake_zones": lake.SQL_TOP_SKILLS,
    "json_one_document": _SQL_PRODUCTS.replace("p_name AS nom", "p_name || ' }, {\"produits\": [ \\ ' || p_partkey AS nom"),
    "load_after_failure": "SELECT o_orderkey, c_custkey, c_name FROM orders JOIN customer ON o_custkey = c_custkey",
    "dimension_history": """WITH first_ AS (
  SELECT row_number() OVER (ORDER BY c_custkey) AS sk, * FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders)),
opened AS (SELECT c.c_custkey, c.c_name, CASE WHEN c.c_acctbal >= 0 THEN c.c_mktsegment END AS c_mktsegment FROM customer c
  LEFT JOIN first_ f ON c.c_custkey = f.c_custkey WHERE f.sk IS NULL OR c.c_acctbal < 0)
SELECT sk, f.c_custkey, f.c_name, f.c_mktsegment, DATE '2024-01-01' AS date_debut,
  CASE WHEN o.c_custkey IS NULL THEN DATE '9999-12-31' ELSE DATE '2024-06-30' END AS date_fin, o.c_custkey IS NULL AS est_actif
FROM first_ f LEFT JOIN opened o ON f.c_custkey = o.c_custkey
UNION ALL
SELECT (SELECT count(*) FROM first_) + row_number() OVER (ORDER BY c_custkey), c_custkey, c_name, c_mktsegment,
  DATE '2024-06-30', DATE '9999-12-31', TRUE FROM opened""",
    "checks_alone": """WITH f AS (SELECT o_orderdate, o_custkey + o_orderkey % 2 AS client, o_orderstatus, o_totalprice FROM orders),
c AS (
  SELECT 'orphelins_date' AS controle, CAST(count(*) AS DOUBLE) AS valeur FROM f WHERE o_orderdate NOT IN (SELECT l_shipdate FROM lineitem)
  UNION ALL SELECT 'orphelins_client', count(*) FROM f WHERE client NOT IN (SELECT c_custkey FROM customer)
  UNION ALL SELECT 'nb_faits', count(*) FROM f
  UNION ALL SELECT 'ca_total_ttc', CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) FROM f WHERE o_orderstatus = 'F'
  UNION ALL SELECT 'nb_clients', count(*) FROM customer)
SELECT controle, valeur, CASE WHEN controle LIKE 'orphelins%' AND valeur > 0 THEN 'warning' ELSE 'info' END AS niveau FROM c
UNION ALL SELECT 'orphelins_produit', CAST(NULL AS DOUBLE), 'error' UNION ALL SELECT 'nb_produits', CAST(NULL AS DOUBLE), 'error'""",
    "run_metrics": """WITH m AS (SELECT count(*) AS n, max(l_quantity) AS p, count(*) FILTER (l_returnflag = 'A') AS a,
    count(*) FILTER (l_returnflag = 'N') AS b, count(*) FILTER (l_returnflag = 'R') AS r FROM lineitem)
SELECT 'fait' AS table, 'rows' AS mesure, CAST(n AS DOUBLE) AS valeur FROM m UNION ALL SELECT 'fait', 'plus', p FROM m
UNION ALL SELECT 'lignes', 'rows', n FROM m UNION ALL SELECT 'lignes', 'A', a FROM m UNION ALL SELECT 'lignes', 'N', b FROM m
UNION ALL SELECT 'lignes', 'R', r FROM m""",
    "month_partitions": _SQL_FACT,
    "catalog_dimension": "SELECT c_custkey, c_name, c_acctbal FROM customer",
    "catalog_fact": _SQL_FACT,
    "mart_refresh": "SELECT o_orderpriority, count(*) AS nb FROM orders GROUP BY o_orderpriority",
    "nulls_for_sql": "SELECT o_orderkey, CASE WHEN o_orderkey % 7 <> 0 THEN CAST(o_totalprice AS DOUBLE) END AS prix, o_orderstatus FROM orders",
    "sketch_skills": f"SELECT profil, famille, competence, nb_offres_mentionnent, TRUE AS dans_la_borne FROM ({lake.SQL_TOP_SKILLS})",
    "sketch_salaries": f"""SELECT o_orderpriority AS profil, count(*) AS nb_offres, count(*) FILTER (o_orderstatus <> 'P') AS nb_offres_avec_salaire,
  count(DISTINCT o_custkey) AS nb_offres_distinctes, TRUE AS distinctes_dans_la_borne, TRUE AS quantiles_dans_la_borne
FROM orders WHERE strftime(o_orderdate, '%Y-%m') BETWEEN '{SPAN[0]}' AND '{SPAN[1]}' GROUP BY 1""",
}
