"""Registered queries of single rules and operators, with their SQL."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bindings import sources as src
from bindings.sources import SETTINGS, SQL_AS_OF, pick, plain, sql_pick, table
from sparkmart import fixed_values as fv
from sparkmart.functions import dates, numbers, offers, text
from sparkmart.functions.mapping import standard_value
from sparkmart.operators import dedup
from sparkmart.operators.keys import with_surrogate_key
from sparkmart.operators.lookup import standardize
from sparkmart.operators.order_stats import quantiles, rank_in_group
from sparkmart.operators.periods import with_periods
from sparkmart.plans import clients, orders, products
from sparkmart.plans.silver import profile_of
from sparkmart.sources.references import city_variants


def dedup_keep_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = ["l_shipdate", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", *order)
    return dedup.keep_last(lines, ["l_orderkey"], [F.col(c) for c in order])


def dedup_latest_email(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = clients.keep_latest_email(src.clients_with_repeated_ids(spark, sf_dir))
    return kept.select("id_client", "email_norm", "date_inscription")


def distinct_couriers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Couriers of the lines; lines still open have none, written as the missing-courier code."""
    code = F.when(F.col("l_linestatus") == "O", fv.MISSING_COURIER).otherwise(F.col("l_suppkey").cast("string"))
    return dedup.distinct_values(table(spark, sf_dir, "lineitem").select(code.alias("id")), "id", exclude=[fv.MISSING_COURIER])


def surrogate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    keyed = with_surrogate_key(table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice"), "sk", ["o_orderkey"])
    return keyed


def parse_mixed_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ship dates written in five ways and read back; undated lines are dropped."""
    shape, day = F.col("l_linenumber") % 6, F.col("l_shipdate")
    written = (
        F.when(F.col("l_partkey") % 53 == 0, "31/02/2024")
        .when(shape == 0, F.date_format(day, "yyyy-MM-dd"))
        .when(shape == 1, F.date_format(day, "dd/MM/yyyy"))
        .when(shape == 2, F.date_format(day, "MMM dd yyyy"))
        .when(shape == 3, F.date_format(day, "d/M/yyyy"))
        .when(F.dayofmonth(day) > 12, F.date_format(day, "MM/dd/yyyy"))
        .otherwise(F.date_format(day, "yyyy-MM-dd HH:mm:ss"))
    )
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", written.alias("brut"))
    parsed = lines.withColumn("jour", dates.mixed_date(F.col("brut"))).filter("jour IS NOT NULL")
    return parsed.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "jour")


def strict_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Creation dates of products: strict parse, then missing and future dates replaced."""
    raw = src.dirty_products(spark, sf_dir)
    return raw.select(
        "id_produit",
        dates.iso_date(F.col("date_creation")).alias("lue"),
        dates.default_date(dates.iso_date(F.col("date_creation")), SETTINGS.as_of).alias("retenue"),
    )


def filter_invalid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Positive quantities and prices, missing couriers filled; quantities are fractional text."""
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
        F.when(F.col("l_partkey") % 31 == 0, "x").otherwise(((F.col("l_quantity") - 10) / 2).cast("string")).alias("quantite"),
        F.when(F.col("l_partkey") % 97 == 0, "0").otherwise(F.col("l_extendedprice").cast("string")).alias("prix_unitaire"),
        F.when(F.col("l_suppkey") % 14 != 0, F.col("l_suppkey").cast("string")).alias("id_livreur"),
    )
    return plain(lines.transform(orders.positive_quantities).transform(orders.positive_prices).transform(orders.fill_couriers))


def amounts_ht_ttc(spark: SparkSession, sf_dir: str) -> DataFrame:
    unit = (F.col("l_extendedprice").cast("decimal(18,2)") / F.col("l_quantity").cast("decimal(10,0)")).cast("decimal(18,6)")
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", F.col("l_quantity").cast("bigint").alias("quantite"),
        F.round(unit, 2).alias("prix_unitaire"),
    )
    return plain(orders.with_amounts(lines).drop("prix_unitaire"))


def delivery_delay(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines, placed = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    joined = lines.join(placed, F.col("l_orderkey") == F.col("o_orderkey")).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        F.to_date("o_orderdate").alias("date_commande"),
        F.when(F.col("l_linenumber") != 7, F.to_date("l_shipdate")).alias("date_livraison"),
    )
    return orders.with_delay(joined).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "delai_livraison_jours")


PRIORITIES = {"1-URGENT": "haute", "2-HIGH": "haute", "3-MEDIUM": "moyenne", "5-LOW": "basse"}


def standardize_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A fixed table, a table with trimmed keys, and a lookup DataFrame derived from the parts."""
    o = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        standard_value(F.col("o_orderpriority"), PRIORITIES, "inconnue").alias("priorite"),
        standard_value(text.strip(pick(F.col("o_orderkey") % 7, src.SEX_RAW)), fv.SEXES, fv.UNKNOWN_SEX).alias("sexe"),
        F.upper("o_orderstatus").alias("marque"),
    )
    brands = table(spark, sf_dir, "part").groupBy(F.substring("p_type", 1, 1).alias("lettre")).agg(
        F.min("p_brand").alias("premiere")
    )
    return standardize(o, "marque", brands, "lettre", "premiere", F.col("marque"), "aucune")


def days_in_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ship days, and how many times between order and delivery of urgent orders, some of them long, they lie in."""
    orders_ = table(spark, sf_dir, "orders").filter("o_orderpriority = '1-URGENT'")
    length = F.when(F.col("o_orderkey") % 50 == 0, 400).otherwise(F.col("o_custkey") % 9 - 1).cast("int")
    periods = orders_.select("o_orderdate", F.date_add(F.to_date("o_orderdate"), length).alias("fin"))
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.to_date("l_shipdate").alias("jour"))
    return with_periods(lines.select("jour").distinct(), "jour", periods, "o_orderdate", "fin")


def city_harmonise(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Supplier cities in four spellings against the variants of the regions."""
    key = F.col("s_suppkey")
    s = table(spark, sf_dir, "supplier").select("s_suppkey", src.dirty_city(F.when(key % 37 == 0, 99).otherwise(F.col("s_nationkey")), key % 4).alias("ville"))
    s = s.withColumn("ville", F.when(F.col("s_suppkey") % 10 == 9, " FEZ ").otherwise(F.col("ville")))
    return orders.standard_cities(s, city_variants(src.regions(spark, sf_dir)), "ville")


def age_band(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = src.dirty_clients(spark, sf_dir)
    banded = raw.transform(clients.valid_birth_dates, SETTINGS).transform(clients.with_age_band)
    return banded.select("id_client", "date_naissance", "tranche_age")


def email_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = src.dirty_clients(spark, sf_dir).withColumn("email_norm", text.normal_email(F.col("email")))
    return clients.valid_emails(raw).select("id_client", "email", "email_norm")


def title_case(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", text.title_case(F.col("text")).alias("titre"))


def full_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return src.dirty_clients(spark, sf_dir).select("id_client", text.full_name(F.col("prenom"), F.col("nom")).alias("nom_complet"))


def text_cleanup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", text.squeeze(F.col("text")).alias("propre"))


def category_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = products.standard_categories(src.dirty_products(spark, sf_dir))
    return cleaned.select("id_produit", "categorie", "sous_categorie", "marque", "fournisseur")


def price_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(products.default_prices(src.dirty_products(spark, sf_dir)).select("id_produit", "prix_catalogue"))


def products_without_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    return products.products_without_price(src.dirty_products(spark, sf_dir))


def boolean_coercion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return products.with_versions(src.dirty_products(spark, sf_dir).withColumn("date_creation", F.lit(date(2024, 1, 1)))).select(
        "id_produit", "actif", "date_debut", "date_fin", "est_actif"
    )


def value_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.value_distribution(age_band(spark, sf_dir), "tranche_age")


TITLES = [
    "Data Eng.", " DATA ENGINEER Junior", "Dev Data", "Développeur BI", "Analyste Data", "Data Scientist",
    "Développeur Full Stack React/Node.js", "Back End dev", "front-end", "DevOps Engineer", "Chef de Projet IT",
    "data engineer full stack", "Machine Learning SRE", None,
]
PROFILES = [
    "Data Engineer", "Data Engineer", "Autre IT", "Data Analyst", "Data Analyst", "Data Scientist",
    "Développeur Full Stack", "Développeur Backend", "Développeur Frontend", "DevOps / SRE", "Autre IT",
    "Développeur Full Stack", "DevOps / SRE", "Autre IT",
]


def title_to_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    title = text.strip(F.lower(pick(F.col("l_partkey") % len(TITLES), TITLES)))
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", title.alias("titre"))
    return lines.withColumn("profil", profile_of(F.col("titre"))).drop("titre")


def salary_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Salaries written in eight ways from two numbers of each order line."""
    low, gap = F.col("l_quantity").cast("int"), F.col("l_linenumber")
    num = lambda c: c.cast("string")
    written = F.element_at(
        F.array(
            F.concat(num(low * 1000), F.lit("-"), num((low + gap) * 1000), F.lit(" MAD")),
            F.concat(num(low), F.lit("K-"), num(low + gap), F.lit("K")),
            F.concat(num(low * 100), F.lit("-"), num((low + gap) * 100), F.lit(" EUR")),
            F.concat(num(low), F.lit(" 500 DH")),
            F.concat(num(low), F.lit(".5k")),
            F.lit("Selon profil"),
            F.concat(F.lit("de "), num((low + gap) * 1000), F.lit(" à "), num(low * 1000), F.lit(" dh, 13 mois")),
            F.lit(None).cast("string"),
        ),
        (F.col("l_partkey") % 8 + 1).cast("int"),
    )
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", written.alias("brut"))
    parsed = offers.with_salary(lines, "brut").drop("brut")
    money = ["salaire_min_mad", "salaire_max_mad", "salaire_median_mad"]
    return parsed.withColumns({c: numbers.rounded(F.col(c), 2) for c in money})


def experience_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("p_size")
    written = F.element_at(
        F.array(
            F.concat(n.cast("string"), F.lit("-"), (n + 2).cast("string"), F.lit(" ans")),
            F.concat(n.cast("string"), F.lit(" à "), (n + 2).cast("string"), F.lit(" ans")),
            F.concat(F.lit("min "), n.cast("string"), F.lit(" years")),
            F.lit("Débutant accepté"),
            F.concat(F.lit("Lead "), n.cast("string"), F.lit(" ans")),
            F.lit("à discuter"),
            F.lit(None).cast("string"),
        ),
        (F.col("p_partkey") % 7 + 1).cast("int"),
    )
    parts = table(spark, sf_dir, "part").select("p_partkey", written.alias("brut"))
    low, high = offers.experience_years(F.col("brut"))
    return parts.select("p_partkey", low.alias("experience_min_ans"), high.alias("experience_max_ans"))


def exact_quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quartiles of price by flag and status; one flag is null and one group holds a third of the rows."""
    flag = F.when(F.col("l_returnflag") != "A", F.col("l_returnflag")).alias("drapeau")
    lines = table(spark, sf_dir, "lineitem").select(flag, F.col("l_discount"), F.col("l_extendedprice").alias("prix"))
    found = quantiles(lines, ["drapeau"], "prix", {"q1": 0.25, "mediane": 0.5, "q3": 0.75, "p99": 0.99})
    return found.select("_group.drapeau", *[numbers.rounded(F.col(c), 4).alias(c) for c in ("q1", "mediane", "q3", "p99")])


def exact_ranks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rank of customers by number of orders in each priority; most customers tie."""
    counted = table(spark, sf_dir, "orders").groupBy("o_orderpriority", "o_custkey").agg(F.count(F.lit(1)).alias("nb"))
    return rank_in_group(counted, ["o_orderpriority"], "nb", "rang")


QUERIES = {
    "dedup_keep_last": dedup_keep_last,
    "dedup_latest_email": dedup_latest_email,
    "distinct_couriers": distinct_couriers,
    "surrogate_keys": surrogate_keys,
    "parse_mixed_dates": parse_mixed_dates,
    "strict_dates": strict_dates,
    "filter_invalid": filter_invalid,
    "amounts_ht_ttc": amounts_ht_ttc,
    "delivery_delay": delivery_delay,
    "standardize_map": standardize_map,
    "days_in_periods": days_in_periods,
    "city_harmonise": city_harmonise,
    "age_band": age_band,
    "email_validation": email_validation,
    "title_case": title_case,
    "full_names": full_names,
    "text_cleanup": text_cleanup,
    "category_normalise": category_normalise,
    "price_default": price_default,
    "products_without_price": products_without_price,
    "boolean_coercion": boolean_coercion,
    "value_distribution": value_distribution,
    "title_to_profile": title_to_profile,
    "salary_parse": salary_parse,
    "experience_parse": experience_parse,
    "exact_quantiles": exact_quantiles,
    "exact_ranks": exact_ranks,
}

# --- SQL ---------------------------------------------------------------------

_runs = r"[\p{Lu}\p{Ll}\p{Lt}]+|[^\p{Lu}\p{Ll}\p{Lt}]+"
_blank = r"[\s\x0b\x1c-\x1f\x85\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
_low, _gap = "CAST(l_quantity AS INTEGER)", "l_linenumber"

SQL = {
    "dedup_keep_last": """SELECT l_orderkey, l_shipdate, l_linenumber, l_partkey, l_suppkey, l_extendedprice FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate DESC, l_linenumber DESC, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC) = 1""",
    "dedup_latest_email": f"WITH {src.sql_clients()} SELECT id_client, norm AS email_norm, date_inscription FROM last_clients",
    "distinct_couriers": "SELECT DISTINCT CAST(l_suppkey AS VARCHAR) AS id FROM lineitem WHERE l_linestatus <> 'O'",
    "surrogate_keys": "SELECT row_number() OVER (ORDER BY o_orderkey) AS sk, o_orderkey, o_totalprice FROM orders",
    "parse_mixed_dates": """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(l_shipdate AS DATE) AS jour
FROM lineitem WHERE l_partkey % 53 <> 0""",
    "strict_dates": f"""WITH {src.sql_products()}
SELECT CAST(p_partkey AS VARCHAR) AS id_produit, cree AS lue,
  CASE WHEN cree IS NULL OR cree > {SQL_AS_OF} THEN {SQL_AS_OF} ELSE cree END AS retenue FROM raw_products""",
    "filter_invalid": """SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, CAST(trunc((l_quantity - 10) / 2) AS BIGINT) AS quantite,
  l_extendedprice AS prix_unitaire, CASE WHEN l_suppkey % 14 <> 0 THEN CAST(l_suppkey AS VARCHAR) ELSE '-1' END AS id_livreur
FROM lineitem WHERE l_partkey % 31 <> 0 AND l_quantity > 10 AND l_partkey % 97 <> 0""",
    "amounts_ht_ttc": """WITH u AS (SELECT l_orderkey, l_partkey, l_suppkey, CAST(l_quantity AS BIGINT) AS quantite,
    round(CAST(CAST(l_extendedprice AS DECIMAL(18,2)) / CAST(l_quantity AS DECIMAL(10,0)) AS DECIMAL(18,6)), 2) AS prix FROM lineitem)
SELECT l_orderkey, l_partkey, l_suppkey, quantite, CAST(quantite * prix AS DOUBLE) AS montant_ht,
  CAST(round(CAST(quantite * prix AS DECIMAL(18,2)) * CAST(1.20 AS DECIMAL(3,2)), 2) AS DOUBLE) AS montant_ttc FROM u""",
    "delivery_delay": """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
  CASE WHEN l_linenumber <> 7 AND l_shipdate >= o_orderdate THEN CAST(date_diff('day', o_orderdate, l_shipdate) AS INTEGER) END AS delai_livraison_jours
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "standardize_map": f"""WITH b AS (SELECT p_type[1] AS lettre, min(p_brand) AS premiere FROM part GROUP BY 1)
SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 'haute' WHEN '2-HIGH' THEN 'haute' WHEN '3-MEDIUM' THEN 'moyenne'
    WHEN '5-LOW' THEN 'basse' ELSE 'inconnue' END AS priorite,
  {sql_pick('o_orderkey % 7', src.SEX_CLEAN)} AS sexe, coalesce(premiere, 'aucune') AS marque
FROM orders LEFT JOIN b ON o_orderstatus = lettre""",
    "days_in_periods": """WITH p AS (
  SELECT CAST(o_orderdate AS DATE) AS a, CAST(o_orderdate AS DATE) + CAST(CASE WHEN o_orderkey % 50 = 0 THEN 400 ELSE o_custkey % 9 - 1 END AS INTEGER) AS b
  FROM orders WHERE o_orderpriority = '1-URGENT'),
d AS (SELECT DISTINCT CAST(l_shipdate AS DATE) AS jour FROM lineitem)
SELECT jour, (SELECT count(*) FROM p WHERE jour BETWEEN a AND b) AS nb_periodes FROM d""",
    "city_harmonise": f"""SELECT s_suppkey, CASE WHEN s_suppkey % 10 = 9 THEN 'Fès'
  WHEN s_suppkey % 4 < 3 AND s_suppkey % 37 <> 0 THEN 'Cité ' || s_nationkey ELSE 'Non renseignée' END AS ville FROM supplier""",
    "age_band": f"""WITH a AS (SELECT c_custkey, CASE WHEN c_custkey % 33 <> 0 THEN DATE '1900-01-01' + CAST((c_custkey * 37) % 46000 AS INTEGER) END AS d FROM customer),
b AS (SELECT c_custkey, d, date_diff('day', d, {SQL_AS_OF}) / 365.25 AS age FROM a)
SELECT CAST(c_custkey AS VARCHAR) AS id_client, CASE WHEN age BETWEEN 16 AND 100 THEN d END AS date_naissance,
  CASE WHEN age BETWEEN 16 AND 100 THEN CASE WHEN age < 18 THEN '<18' WHEN age < 25 THEN '18-24' WHEN age < 35 THEN '25-34'
    WHEN age < 45 THEN '35-44' WHEN age < 55 THEN '45-54' WHEN age < 65 THEN '55-64' ELSE '65+' END ELSE 'Inconnu' END AS tranche_age FROM b""",
    "email_validation": """WITH e AS (SELECT c_custkey AS k, lower(c_mktsegment) || (c_custkey % 500) AS box FROM customer)
SELECT CAST(k AS VARCHAR) AS id_client,
  CASE WHEN k % 20 IN (3, 7, 11) THEN NULL WHEN k % 2 = 0 THEN upper(box) || '@X.ma' ELSE box || '@x.ma' END AS email,
  CASE WHEN k % 20 NOT IN (3, 7, 11) THEN box || '@x.ma' END AS email_norm FROM e""",
    "title_case": rf"""SELECT doc_id, array_to_string(list_transform(
  regexp_extract_all(lower(text), '{_runs}'), lambda r: CASE WHEN r[1] = 'ß' THEN 'Ss' ELSE upper(r[1]) END || r[2:]), '') AS titre FROM documents""",
    "full_names": """SELECT CAST(c_custkey AS VARCHAR) AS id_client, CASE WHEN c_custkey % 9 <> 0 THEN 'D''Ange-' || c_custkey || ' ' ELSE '' END
  || 'El ' || upper(c_mktsegment[1]) || lower(c_mktsegment[2:]) AS nom_complet FROM customer""",
    "text_cleanup": rf"""SELECT doc_id, trim(regexp_replace(text, '{_blank}+', ' ', 'g')) AS propre FROM documents""",
    "category_normalise": f"WITH {src.sql_products()} SELECT id_produit, categorie, sous_categorie, marque, replace(fournisseur, ' ', '   ') AS fournisseur FROM produits",
    "price_default": f"WITH {src.sql_products()} SELECT id_produit, prix_catalogue FROM produits",
    "products_without_price": "SELECT CAST(p_partkey AS VARCHAR) AS id_produit FROM part WHERE p_partkey % 50 = 0 OR p_partkey % 51 = 0",
    "boolean_coercion": f"""SELECT CAST(p_partkey AS VARCHAR) AS id_produit, {src.ACTIVE_SQL} AS actif, DATE '2024-01-01' AS date_debut,
  DATE '9999-12-31' AS date_fin, TRUE AS est_actif FROM part""",
    "title_to_profile": f"SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, {sql_pick(f'l_partkey % {len(TITLES)}', PROFILES)} AS profil FROM lineitem",
    "salary_parse": f"""WITH a AS (SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, CAST(CASE l_partkey % 8
    WHEN 0 THEN {_low} * 1000 WHEN 1 THEN {_low} * 1000 WHEN 2 THEN {_low} * 1080 WHEN 3 THEN {_low} * 1000 + 500
    WHEN 4 THEN {_low} * 1000 + 500 WHEN 6 THEN {_low} * 1000 END AS DOUBLE) AS lo, CAST(CASE l_partkey % 8
    WHEN 0 THEN ({_low} + {_gap}) * 1000 WHEN 1 THEN ({_low} + {_gap}) * 1000 WHEN 2 THEN ({_low} + {_gap}) * 1080
    WHEN 3 THEN {_low} * 1000 + 500 WHEN 4 THEN {_low} * 1000 + 500 WHEN 6 THEN ({_low} + {_gap}) * 1000 END AS DOUBLE) AS hi FROM lineitem)
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, coalesce(lo >= 3000 AND hi <= 100000, FALSE) AS salaire_connu,
  CASE WHEN lo >= 3000 AND hi <= 100000 THEN lo END AS salaire_min_mad, CASE WHEN lo >= 3000 AND hi <= 100000 THEN hi END AS salaire_max_mad,
  CASE WHEN lo >= 3000 AND hi <= 100000 THEN (lo + hi) / 2 END AS salaire_median_mad FROM a""",
    "experience_parse": """SELECT p_partkey,
  CASE p_partkey % 7 WHEN 0 THEN p_size WHEN 1 THEN p_size WHEN 2 THEN p_size WHEN 3 THEN 0 WHEN 4 THEN 5 END AS experience_min_ans,
  CASE p_partkey % 7 WHEN 0 THEN p_size + 2 WHEN 1 THEN p_size + 2 WHEN 3 THEN 2 END AS experience_max_ans FROM part""",
    "exact_quantiles": """SELECT CASE WHEN l_returnflag <> 'A' THEN l_returnflag END AS drapeau,
  """ + ",\n  ".join(
        f"CAST(round(CAST(quantile_cont(l_extendedprice, {q}) AS DECIMAL(28,8)), 4) AS DOUBLE) AS {name}"
        for name, q in [("q1", 0.25), ("mediane", 0.5), ("q3", 0.75), ("p99", 0.99)]
    ) + "\nFROM lineitem GROUP BY 1",
    "exact_ranks": """SELECT o_orderpriority, o_custkey, count(*) AS nb,
  rank() OVER (PARTITION BY o_orderpriority ORDER BY count(*) DESC) AS rang FROM orders GROUP BY o_orderpriority, o_custkey""",
}
SQL["value_distribution"] = f"SELECT tranche_age, count(*) AS nb FROM ({SQL['age_band']}) GROUP BY 1"
