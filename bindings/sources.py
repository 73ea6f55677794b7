"""Warehouse and lake sources derived from the test tables.

The dirty text columns are made by Spark from whole tables, so the rules have
something to repair; the matching SQL states the expected clean values.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkmart.settings import WarehouseSettings
from sparkmart.sources.files import ORDINAL

SETTINGS = WarehouseSettings(as_of=date(2024, 6, 30))
SQL_AS_OF = "DATE '2024-06-30'"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles, the types the SQL side returns."""
    decimals = [f.name for f in df.schema.fields if isinstance(f.dataType, T.DecimalType)]
    return df.withColumns({c: F.col(c).cast("double") for c in decimals})


def pick(index: Column, values: list[str | None]) -> Column:
    """values[index]."""
    return F.get(F.array(*[F.lit(v).cast("string") for v in values]), index.cast("int"))


def sql_pick(index: str, values: list[str | None]) -> str:
    """The same choice as a SQL CASE."""
    quoted = [("NULL" if v is None else "'" + v.replace("'", "''") + "'") for v in values]
    return f"CASE {index} " + " ".join(f"WHEN {i} THEN {q}" for i, q in enumerate(quoted)) + " END"


# --- regions -----------------------------------------------------------------

def regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every nation is a region with a city."""
    n, r = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return n.join(r, n.n_regionkey == r.r_regionkey).select(
        F.lower("n_name").alias("code_ville"),
        F.concat(F.lit("Cité "), F.col("n_nationkey").cast("string")).alias("nom_ville_standard"),
        F.col("n_name").alias("province"),
        F.col("r_name").alias("region_admin"),
        F.lower("r_name").alias("zone_geo"),
    )


def dirty_city(key: Column, shape: Column) -> Column:
    number = key.cast("string")
    return (
        F.when(shape == 0, F.concat(F.lit("NATION_"), number))
        .when(shape == 1, F.concat(F.lit("  CITÉ "), number, F.lit(" ")))
        .when(shape == 2, F.concat(F.lit("cite "), number))
    )


# --- orders ------------------------------------------------------------------

STATUS_OF_LINE = ["livre", "DONE", "OK", "??"]
#: Lines whose keys were changed: they name a client, a product or a city that does not exist.
LOST_CLIENT, LOST_PRODUCT, LOST_CITY = 23, 29, 31


def dirty_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as text with mixed dates, spelling variants, gaps, repeated ids and keys that name nothing."""
    lines, orders = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    text = lambda c: F.col(c).cast("string")
    shape = F.col("l_linenumber") % 3
    iso = F.to_date("o_orderdate").cast("string")
    ordered = (
        F.when(F.col("l_partkey") % 53 == 0, "bad")
        .when(shape == 0, iso)
        .when(shape == 1, F.concat_ws("/", F.substring(iso, 9, 2), F.substring(iso, 6, 2), F.substring(iso, 1, 4)))
        .otherwise(F.date_format("o_orderdate", "MMM dd yyyy"))
    )
    status = (
        F.when(F.col("l_returnflag") == "R", "retourne")
        .when(F.col("l_returnflag") == "A", "annulé")
        .otherwise(pick(F.col("l_linenumber") % 4, STATUS_OF_LINE))
    )
    lost = lambda rule, key: F.when(F.col("l_suppkey") % rule == 0, F.concat(F.lit("X"), text(key))).otherwise(text(key))
    city = F.when(F.col("l_suppkey") % LOST_CITY == 0, F.lit(99)).otherwise(F.col("o_custkey") % 25)
    price = F.when(F.col("l_partkey") % 97 == 0, "0").otherwise(text("l_extendedprice"))
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.concat_ws("-", text("l_orderkey"), text("l_linenumber")).alias("id_commande"),
        lost(LOST_CLIENT, "o_custkey").alias("id_client"),
        lost(LOST_PRODUCT, "l_partkey").alias("id_produit"),
        ordered.alias("date_commande"),
        (F.col("l_quantity") - 2).cast("int").cast("string").alias("quantite"),
        price.alias("prix_unitaire"),
        status.alias("statut"),
        F.when(F.col("l_suppkey") % 19 != 0, dirty_city(city, shape)).alias("ville_livraison"),
        F.lit("cash").alias("mode_paiement"),
        F.when(F.col("l_suppkey") % 14 != 0, F.concat(F.lit("L"), text("l_suppkey"))).alias("id_livreur"),
        F.when(F.col("l_linenumber") != 7, F.to_date("l_shipdate").cast("string")).alias("date_livraison"),
        F.struct("l_shipdate", "l_partkey", "l_suppkey").alias(ORDINAL),
    )


SQL_ORDERS = f"""
last_lines AS (
  SELECT * FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                             ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC) = 1),
typed AS (
  SELECT l_orderkey || '-' || l_linenumber AS id_commande, CASE WHEN l_suppkey % {LOST_CLIENT} = 0 THEN 'X' ELSE '' END || o_custkey AS id_client,
    CASE WHEN l_suppkey % {LOST_PRODUCT} = 0 THEN 'X' ELSE '' END || l_partkey AS id_produit,
    CASE WHEN l_partkey % 53 <> 0 THEN CAST(o_orderdate AS DATE) END AS date_commande,
    CAST(l_quantity AS BIGINT) - 2 AS quantite,
    CASE WHEN l_partkey % 97 = 0 THEN 0 ELSE CAST(l_extendedprice AS DECIMAL(18,2)) END AS prix_unitaire,
    CASE l_returnflag WHEN 'R' THEN 'retourné' WHEN 'A' THEN 'annulé'
      ELSE CASE l_linenumber % 4 WHEN 0 THEN 'livré' WHEN 1 THEN 'livré' WHEN 2 THEN 'en_cours' ELSE 'inconnu' END END AS statut,
    CASE WHEN l_suppkey % 19 <> 0 AND l_suppkey % {LOST_CITY} <> 0 THEN 'Cité ' || (o_custkey % 25) ELSE 'Non renseignée' END AS ville_livraison,
    'cash' AS mode_paiement,
    CASE WHEN l_suppkey % 14 <> 0 THEN 'L' || l_suppkey ELSE '-1' END AS id_livreur,
    CASE WHEN l_linenumber <> 7 THEN CAST(l_shipdate AS DATE) END AS date_livraison,
    l_returnflag, l_linenumber, l_suppkey
  FROM last_lines),
commandes AS (
  SELECT id_commande, id_client, id_produit, date_commande, quantite, CAST(prix_unitaire AS DOUBLE) AS prix_unitaire, statut,
    ville_livraison, mode_paiement, id_livreur, date_livraison,
    quantite * prix_unitaire AS montant_ht,
    round(quantite * prix_unitaire * CAST(1.20 AS DECIMAL(3,2)), 2) AS montant_ttc,
    CASE WHEN date_livraison >= date_commande THEN CAST(date_diff('day', date_commande, date_livraison) AS INTEGER) END AS delai_livraison_jours
  FROM typed WHERE date_commande IS NOT NULL AND quantite > 0 AND prix_unitaire > 0)"""

# --- clients -----------------------------------------------------------------

SEX_RAW = ["m", "F", "1", " Homme ", "female", "x", None]
REPEATED = 50  # one client in so many has the id of the one before
SEX_CLEAN = ["m", "f", "m", "m", "f", "inconnu", "inconnu"]


def dirty_clients(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as text; e-mails repeat and differ in case and blanks, some are malformed or missing."""
    key = F.col("c_custkey")
    number = key.cast("string")
    day = lambda start, offset: F.date_format(F.date_add(F.lit(date.fromisoformat(start)), offset.cast("int")), "yyyy-MM-dd")
    box = F.concat(F.lower("c_mktsegment"), (key % 500).cast("string"))
    email = (
        F.when(key % 20 == 7, F.lit(None))
        .when(key % 20 == 3, box)
        .when(key % 20 == 11, F.concat(F.lit(" "), box, F.lit("@x.ma ")))
        .when(key % 2 == 0, F.concat(F.upper(box), F.lit("@X.ma")))
        .otherwise(F.concat(box, F.lit("@x.ma")))
    )
    return table(spark, sf_dir, "customer").select(
        number.alias("id_client"),
        F.concat(F.lit(" el "), F.lower("c_mktsegment"), F.lit(" ")).alias("nom"),
        F.when(key % 9 != 0, F.concat(F.lit("d'ANGE-"), number)).alias("prenom"),
        email.alias("email"),
        F.when(key % 33 == 0, "bad").otherwise(day("1900-01-01", (key * 37) % 46000)).alias("date_naissance"),
        pick(key % 7, SEX_RAW).alias("sexe"),
        dirty_city(F.when(key % LOST_CITY == 0, 99).otherwise(F.col("c_nationkey")), key % 4).alias("ville"),
        F.lit("+212600000000").alias("telephone"),
        F.when(key % 17 != 0, day("2020-01-01", key % 1500)).alias("date_inscription"),
        F.col("c_mktsegment").alias("canal_acquisition"),
    )


def clients_with_repeated_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same, but some ids name two clients; orders of the id that is lost have no client."""
    key = F.col("id_client").cast("bigint")
    return dirty_clients(spark, sf_dir).withColumn("id_client", F.when(key % REPEATED == REPEATED - 1, key - 1).otherwise(key).cast("string"))


def sql_clients() -> str:
    age = f"date_diff('day', naissance, {SQL_AS_OF}) / 365.25"
    return f"""
raw_clients AS (
  SELECT CAST(CASE WHEN c_custkey % {REPEATED} = {REPEATED - 1} THEN c_custkey - 1 ELSE c_custkey END AS VARCHAR) AS id_client, c_custkey AS k, c_nationkey, c_mktsegment,
    lower(c_mktsegment) || (c_custkey % 500) AS box,
    CASE WHEN c_custkey % 17 <> 0 THEN DATE '2020-01-01' + CAST(c_custkey % 1500 AS INTEGER) END AS date_inscription,
    CASE WHEN c_custkey % 33 <> 0 THEN DATE '1900-01-01' + CAST((c_custkey * 37) % 46000 AS INTEGER) END AS naissance
  FROM customer),
last_clients AS (
  SELECT *, CASE WHEN k % 20 = 7 THEN NULL WHEN k % 20 = 3 THEN box ELSE box || '@x.ma' END AS norm FROM raw_clients
  QUALIFY row_number() OVER (PARTITION BY norm ORDER BY date_inscription DESC NULLS LAST, id_client DESC) = 1),
clients AS (
  SELECT id_client, k,
    CASE WHEN k % 20 IN (3, 7, 11) THEN NULL WHEN k % 2 = 0 THEN upper(box) || '@X.ma' ELSE box || '@x.ma' END AS email,
    CASE WHEN k % 20 NOT IN (3, 7, 11) THEN norm END AS email_norm,
    CASE WHEN {age} BETWEEN 16 AND 100 THEN naissance END AS date_naissance,
    CASE WHEN {age} BETWEEN 16 AND 100 THEN {age} END AS age,
    {sql_pick('k % 7', SEX_CLEAN)} AS sexe,
    CASE WHEN k % 4 < 3 AND k % {LOST_CITY} <> 0 THEN 'Cité ' || c_nationkey ELSE 'Non renseignée' END AS ville,
    CASE WHEN k % 9 <> 0 THEN 'D''Ange-' || k || ' ' ELSE '' END
      || 'El ' || upper(c_mktsegment[1]) || lower(c_mktsegment[2:]) AS nom_complet,
    date_inscription, c_mktsegment AS canal_acquisition
  FROM last_clients),
clients_banded AS (
  SELECT *, CASE WHEN age IS NULL THEN 'Inconnu' WHEN age < 18 THEN '<18' WHEN age < 25 THEN '18-24' WHEN age < 35 THEN '25-34'
    WHEN age < 45 THEN '35-44' WHEN age < 55 THEN '45-54' WHEN age < 65 THEN '55-64' ELSE '65+' END AS tranche_age
  FROM clients)"""


# --- products ----------------------------------------------------------------

CATEGORY_RAW = ["electronique", "MODE", "Alimentation", "jeux d'été", None]
CATEGORY_CLEAN = ["Electronique", "Mode", "Alimentation", "Jeux D'Été", None]
ACTIVE_RAW = ["true", "False", "oui", None, "true"]
ACTIVE_SQL = "CASE p_partkey % 5 WHEN 1 THEN FALSE WHEN 3 THEN FALSE ELSE TRUE END"


def dirty_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("p_partkey")
    created = F.date_format(F.date_add(F.lit(date(2010, 1, 1)), ((key * 7) % 6000).cast("int")), "yyyy-MM-dd")
    return table(spark, sf_dir, "part").select(
        key.cast("string").alias("id_produit"),
        F.concat(F.lit("  "), F.replace("p_name", F.lit(" "), F.lit("  \t ")), F.lit(" ")).alias("nom"),
        pick(key % 5, CATEGORY_RAW).alias("categorie"),
        F.concat(F.lit(" "), F.lower("p_type"), F.lit("-a1b ")).alias("sous_categorie"),
        F.concat(F.lit(" "), F.col("p_brand")).alias("marque"),
        F.concat(F.col("p_brand"), F.lit("   sarl ")).alias("fournisseur"),
        F.when(key % 50 == 0, None).when(key % 51 == 0, "n.c.")
        .otherwise(F.col("p_retailprice").cast("decimal(18,2)").cast("string")).alias("prix_catalogue"),
        F.lit("Maroc").alias("origine_pays"),
        F.when(key % 41 == 0, "bad").otherwise(created).alias("date_creation"),
        pick(key % 5, ACTIVE_RAW).alias("actif"),
    )


def sql_products() -> str:
    return f"""
raw_products AS (
  SELECT *, CASE WHEN p_partkey % 41 <> 0 THEN DATE '2010-01-01' + CAST((p_partkey * 7) % 6000 AS INTEGER) END AS cree
  FROM part),
produits AS (
  SELECT CAST(p_partkey AS VARCHAR) AS id_produit, p_name AS nom, {sql_pick('p_partkey % 5', CATEGORY_CLEAN)} AS categorie,
    upper(p_type[1]) || lower(p_type[2:]) || '-A1B' AS sous_categorie, p_brand AS marque, p_brand || ' sarl' AS fournisseur,
    CAST(CASE WHEN p_partkey % 50 = 0 OR p_partkey % 51 = 0 THEN 0.01 ELSE CAST(p_retailprice AS DECIMAL(18,2)) END AS DOUBLE) AS prix_catalogue,
    'Maroc' AS origine_pays,
    CASE WHEN cree IS NULL OR cree > {SQL_AS_OF} THEN {SQL_AS_OF} ELSE cree END AS date_creation,
    {ACTIVE_SQL} AS actif,
    CASE WHEN cree IS NULL OR cree > {SQL_AS_OF} THEN {SQL_AS_OF} ELSE cree END AS date_debut,
    DATE '9999-12-31' AS date_fin, TRUE AS est_actif
  FROM raw_products)"""
