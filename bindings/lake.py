"""Registered queries of the lake, with their SQL."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bindings.scalars import PROFILES, TITLES
from bindings.sources import pick, sql_pick, table
from sparkmart.plans import bronze, gold, insights, silver
from sparkmart.operators.skills import extract_skills, extract_skills_by_join
from sparkmart.settings import LakeSettings

CITIES = ["casa", " CASABLANCA", "fès", "el-hajeb", None]
CITIES_CLEAN = ["Casa", "Casablanca", "Fès", "El-Hajeb", "Inconnu"]
CONTRACTS = ["CDI", "cdi ", "Freelance", None]
CONTRACTS_CLEAN = ["CDI", "CDI", "FREELANCE", "Inconnu"]

# (alias, skill, family); aliases overlap, repeat across skills' words, and hold blanks and signs.
SKILLS = [
    ("the", "article", "anglais"), ("a", "article", "anglais"), ("of the", "liaison", "anglais"), ("and", "liaison", "anglais"),
    ("le", "article_fr", "français"), ("la", "article_fr", "français"), ("un", "article_fr", "français"),
    ("der", "article_de", "allemand"), ("die", "article_de", "allemand"), ("é", "lettre", "français"),
    ("en", "lieu", "français"), ("co.uk", "adresse", "web"), ("e-mail", "adresse", "web"),
]


def _published(key: Column) -> Column:
    day = F.date_format(F.date_add(F.lit(date(2023, 1, 1)), (key % 700).cast("int")), "yyyy-MM-dd")
    return F.when(key % 29 == 0, None).when(key % 31 == 0, "bientôt").otherwise(day)


def dirty_offers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as job offers: every text is the description of one offer."""
    key = F.col("doc_id")
    thousands = (F.col("n_chars") % 17 + 2).cast("string")
    salary = F.element_at(
        F.array(F.concat(thousands, F.lit("K-20K")), F.concat(thousands, F.lit("000 MAD")), F.lit("Confidentiel")),
        (key % 3 + 1).cast("int"),
    )
    return table(spark, sf_dir, "documents").select(
        F.concat(F.lit("OF-"), (key % 5000).cast("string")).alias("id_offre"),
        F.when(key % 23 != 0, F.concat(F.upper("source"), F.lit(" Web"))).alias("source"),
        pick(key % len(TITLES), TITLES).alias("titre_poste"),
        F.col("text").alias("description"),
        F.lit(None).cast("string").alias("competences_brut"),
        F.col("source").alias("entreprise"),
        pick(key % 5, CITIES).alias("ville"),
        pick(key % 4, CONTRACTS).alias("type_contrat"),
        F.when(key % 2 == 0, "3 à 5 ans").otherwise("Junior").alias("experience_requise"),
        salary.alias("salaire_brut"),
        F.lit("Bac+5").alias("niveau_etudes"),
        F.col("lang").alias("secteur"),
        _published(key).alias("date_publication"),
        F.lit(None).cast("string").alias("date_expiration"),
        F.lit(1).cast("bigint").alias("nb_postes"),
        pick(key % 3, ["Hybride", "Full Remote", "Non"]).alias("teletravail"),
        F.array(F.lit("Français")).alias("langue_requise"),
        F.col("doc_id"),
    )


def _bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bronze.to_bronze(dirty_offers(spark, sf_dir), "documents", datetime(2024, 6, 30))


def bronze_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bronze.bronze_manifest(_bronze(spark, sf_dir)).select("partition", "source_part", "mois", "nb_offres", "source_fichier")


def bronze_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bronze.bronze_stats(bronze.bronze_manifest(_bronze(spark, sf_dir)))


SILVER = [
    "id_offre", "profil_normalise", "salaire_connu", "salaire_min_mad", "salaire_max_mad", "salaire_median_mad",
    "experience_min_ans", "experience_max_ans", "ville_std", "region_admin", "type_contrat_std", "annee", "mois",
]


def silver_offers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.clean_offers(dirty_offers(spark, sf_dir)).select("doc_id", *SILVER)


def dictionary(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(SKILLS, "alias string, competence string, famille string")


def skill_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    keep = [F.col("doc_id"), F.col("lang").alias("profil")]
    return extract_skills(docs, F.lower("text"), dictionary(spark), keep)


def skill_extract_by_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumnRenamed("lang", "profil")
    return extract_skills_by_join(docs, "doc_id", F.lower("text"), dictionary(spark), ["doc_id", "profil"])


def gold_top_skills(spark: SparkSession, sf_dir: str) -> DataFrame:
    offers = silver.clean_offers(dirty_offers(spark, sf_dir))
    return gold.top_skills(silver.offer_skills(offers, dictionary(spark)), offers)


def _line_offers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as clean offers: the price is the salary, known when the discount is above 2%."""
    known = F.col("l_discount") > 0.02
    price = lambda factor: F.when(known, F.col("l_extendedprice") * factor)
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_returnflag").alias("profil_normalise"),
        F.when(F.col("l_linestatus") != "O", F.col("l_linestatus")).alias("ville_std"),
        F.col("l_linenumber").cast("string").alias("type_contrat_std"),
        known.alias("salaire_connu"),
        price(1).alias("salaire_median_mad"),
        price(0.5).alias("salaire_min_mad"),
        price(2).alias("salaire_max_mad"),
    )


def gold_salaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.salaries(_line_offers(spark, sf_dir))


def _event_offers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        (F.col("user_id") % 7).cast("string").alias("ville_std"),
        (F.col("user_id") % 3).cast("string").alias("region_admin"),
        F.col("event_type").alias("profil_normalise"),
        F.date_format("ts", "yyyy").alias("annee"),
        F.date_format("ts", "MM").alias("mois"),
        F.concat(F.lit("mode "), pick(F.col("event_id") % 4, ["HYBRIDE", "Full Remote", "télétravail", "Non"])).alias("teletravail"),
    )


def gold_by_city(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.offers_by_city(_event_offers(spark, sf_dir))


def _order_offers(spark: SparkSession, sf_dir: str) -> DataFrame:
    o, c = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    return o.join(c, F.col("o_custkey") == F.col("c_custkey")).select(
        F.when(F.col("c_custkey") % 13 != 0, F.concat_ws("-", "c_mktsegment", (F.col("c_custkey") % 40).cast("string"))).alias("entreprise"),
        F.col("c_nationkey").cast("string").alias("ville_std"),
        F.col("o_orderpriority").alias("profil_normalise"),
        (F.col("o_orderstatus") != "P").alias("salaire_connu"),
        F.col("o_totalprice").alias("salaire_median_mad"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("date_publication"),
        F.date_format("o_orderdate", "yyyy").alias("annee"),
        F.date_format("o_orderdate", "MM").alias("mois"),
    )


def _employers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.top_employers(_order_offers(spark, sf_dir), LakeSettings())


def gold_top_employers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _employers(spark, sf_dir).withColumn("profils_recrutes", F.concat_ws("|", "profils_recrutes"))


def gold_monthly_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.monthly_trend(_order_offers(spark, sf_dir))


def insight_top_skills(spark: SparkSession, sf_dir: str) -> DataFrame:
    return insights.top_skills_overall(gold_top_skills(spark, sf_dir))


def insight_salary_by_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    by_profile = insights.salary_by_profile(gold_salaries(spark, sf_dir))
    return by_profile.withColumn("salaire_median_mad", F.round("salaire_median_mad", 6))


def insight_top_cities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return insights.top_cities(gold_by_city(spark, sf_dir), n=10)


def insight_top_employers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return insights.top_employer_rows(_employers(spark, sf_dir)).select("entreprise", "ville", "nb_offres_publiees")


def insight_overall_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return insights.overall_trend(gold_monthly_trend(spark, sf_dir))


QUERIES = {
    "bronze_partitions": bronze_partitions,
    "bronze_stats": bronze_stats,
    "silver_offers": silver_offers,
    "skill_extract": skill_extract,
    "skill_extract_by_join": skill_extract_by_join,
    "gold_top_skills": gold_top_skills,
    "gold_salaries": gold_salaries,
    "gold_by_city": gold_by_city,
    "gold_top_employers": gold_top_employers,
    "gold_monthly_trend": gold_monthly_trend,
    "insight_top_skills": insight_top_skills,
    "insight_salary_by_profile": insight_salary_by_profile,
    "insight_top_cities": insight_top_cities,
    "insight_top_employers": insight_top_employers,
    "insight_overall_trend": insight_overall_trend,
}

# --- SQL ---------------------------------------------------------------------

_PUBLISHED = """CASE WHEN doc_id % 29 = 0 THEN NULL WHEN doc_id % 31 = 0 THEN 'bientôt'
  ELSE strftime(DATE '2023-01-01' + CAST(doc_id % 700 AS INTEGER), '%Y-%m-%d') END"""
SQL_MANIFEST = f"""
manifest AS (
  SELECT source_part, mois, source_part || '/' || mois AS partition, count(*) AS nb_offres, 'documents' AS source_fichier FROM (
    SELECT CASE WHEN doc_id % 23 = 0 THEN 'inconnu' ELSE lower(source) || '_web' END AS source_part,
      CASE WHEN doc_id % 29 = 0 OR doc_id % 31 = 0 THEN 'date_inconnue'
        ELSE strftime(DATE '2023-01-01' + CAST(doc_id % 700 AS INTEGER), '%Y_%m') END AS mois FROM documents)
  GROUP BY ALL)"""

SQL_SILVER = f"""
silver AS (
  SELECT doc_id, 'OF-' || (doc_id % 5000) AS id_offre, {sql_pick(f'doc_id % {len(TITLES)}', PROFILES)} AS profil_normalise,
    known AS salaire_connu, CASE WHEN known THEN least(lo, hi) END AS salaire_min_mad, CASE WHEN known THEN greatest(lo, hi) END AS salaire_max_mad,
    CASE WHEN known THEN (lo + hi) / 2 END AS salaire_median_mad,
    CASE WHEN doc_id % 2 = 0 THEN 3 ELSE 0 END AS experience_min_ans, CASE WHEN doc_id % 2 = 0 THEN 5 ELSE 2 END AS experience_max_ans,
    {sql_pick('doc_id % 5', CITIES_CLEAN)} AS ville_std, {sql_pick('doc_id % 5', CITIES_CLEAN)} AS region_admin,
    {sql_pick('doc_id % 4', CONTRACTS_CLEAN)} AS type_contrat_std,
    pub[1:4] AS annee, pub[6:7] AS mois, text
  FROM (SELECT *, CASE WHEN doc_id % 3 = 2 THEN FALSE ELSE least(lo, hi) >= 3000 END AS known FROM (
    SELECT *, {_PUBLISHED} AS pub, CAST((n_chars % 17 + 2) * 1000 AS DOUBLE) AS lo,
      CAST(CASE WHEN doc_id % 3 = 0 THEN 20000 ELSE (n_chars % 17 + 2) * 1000 END AS DOUBLE) AS hi FROM documents)))"""

_W = r"[^\p{L}\p{N}_]"
_by_skill: dict[tuple[str, str], list[str]] = {}
for _alias, _skill, _family in SKILLS:
    _by_skill.setdefault((_skill, _family), []).append(_alias.replace(".", r"\."))
_VALUES = ", ".join(f"('{s}', '{f}', '(^|{_W})({'|'.join(a)})($|{_W})')" for (s, f), a in _by_skill.items())


def _sql_skills(rows: str) -> str:
    """Skill rows of a relation with columns ``row_key`` and ``text``."""
    return f"""
patterns(competence, famille, motif) AS (VALUES {_VALUES}),
hits AS (SELECT row_key, competence, famille FROM {rows}, patterns WHERE regexp_matches(lower(text), motif)),
skills AS (SELECT row_key, coalesce(competence, 'non_détecté') AS competence, coalesce(famille, 'inconnu') AS famille
  FROM {rows} LEFT JOIN hits USING (row_key))"""


SQL_SKILLS = f"""WITH d AS (SELECT doc_id AS row_key, text, lang AS profil FROM documents), {_sql_skills('d')}
SELECT row_key AS doc_id, profil, competence, famille FROM skills JOIN d USING (row_key)"""

SQL_TOP_SKILLS = f"""WITH {SQL_SILVER}, d AS (SELECT doc_id AS row_key, text FROM silver), {_sql_skills('d')}
SELECT profil_normalise AS profil, famille, competence, count(DISTINCT id_offre) AS nb_offres_mentionnent,
  CAST(round(CAST(count(DISTINCT id_offre) * 100 AS DECIMAL(18,6)) / (SELECT count(DISTINCT id_offre) FROM silver), 2) AS DOUBLE) AS pct_offres_total,
  CAST(rank() OVER (PARTITION BY profil_normalise ORDER BY count(DISTINCT id_offre) DESC) AS INTEGER) AS rang_dans_profil
FROM skills JOIN silver ON doc_id = row_key WHERE competence <> 'non_détecté' GROUP BY profil_normalise, famille, competence"""

_round0 = lambda e: f"CAST(round(CAST({e} AS DECIMAL(28,8)), 0) AS DOUBLE)"
SQL_SALARIES = f"""SELECT l_returnflag AS profil, CASE WHEN l_linestatus <> 'O' THEN l_linestatus END AS ville,
  CAST(l_linenumber AS VARCHAR) AS type_contrat, count(*) AS nb_offres, count(*) FILTER (l_discount > 0.02) AS nb_offres_avec_salaire,
  {_round0('median(l_extendedprice) FILTER (l_discount > 0.02)')} AS salaire_median_mad,
  {_round0('avg(CAST(l_extendedprice AS DECIMAL(18,4))) FILTER (l_discount > 0.02)')} AS salaire_moyen_mad,
  {_round0('quantile_cont(l_extendedprice, 0.25) FILTER (l_discount > 0.02)')} AS salaire_q1_mad,
  {_round0('quantile_cont(l_extendedprice, 0.75) FILTER (l_discount > 0.02)')} AS salaire_q3_mad,
  {_round0('min(l_extendedprice * 0.5) FILTER (l_discount > 0.02)')} AS salaire_min_observe,
  {_round0('max(l_extendedprice * 2) FILTER (l_discount > 0.02)')} AS salaire_max_observe
FROM lineitem GROUP BY 1, 2, 3"""

SQL_BY_CITY = """SELECT CAST(user_id % 7 AS VARCHAR) AS ville, CAST(user_id % 3 AS VARCHAR) AS region_admin, event_type AS profil,
  strftime(ts, '%Y') AS annee, strftime(ts, '%m') AS mois, count(*) AS nb_offres, count(*) FILTER (event_id % 4 < 3) AS nb_offres_remote,
  CAST(round(CAST(count(*) FILTER (event_id % 4 < 3) * 100 AS DECIMAL(18,6)) / count(*), 1) AS DOUBLE) AS pct_remote
FROM events GROUP BY ALL"""

SQL_EMPLOYERS = f"""SELECT c_mktsegment || '-' || (c_custkey % 40) AS entreprise, CAST(c_nationkey AS VARCHAR) AS ville, count(*) AS nb_offres_publiees,
  count(DISTINCT o_orderpriority) AS nb_profils_differents,
  {_round0("avg(CAST(o_totalprice AS DECIMAL(18,4))) FILTER (o_orderstatus <> 'P')")} AS salaire_moyen_propose,
  array_to_string(list(DISTINCT o_orderpriority ORDER BY o_orderpriority), '|') AS profils_recrutes,
  strftime(min(o_orderdate), '%Y-%m-%d') AS premiere_offre, strftime(max(o_orderdate), '%Y-%m-%d') AS derniere_offre
FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_custkey % 13 <> 0
GROUP BY 1, 2 ORDER BY nb_offres_publiees DESC, entreprise, ville LIMIT 100"""

SQL_TREND = f"""SELECT strftime(o_orderdate, '%Y') AS annee, strftime(o_orderdate, '%m') AS mois, o_orderpriority AS profil, count(*) AS nb_offres,
  {_round0("avg(CAST(o_totalprice AS DECIMAL(18,4))) FILTER (o_orderstatus <> 'P')")} AS salaire_moyen_mois,
  lag(count(*)) OVER (PARTITION BY o_orderpriority ORDER BY strftime(o_orderdate, '%Y'), strftime(o_orderdate, '%m')) AS nb_offres_mois_precedent
FROM orders GROUP BY 1, 2, 3"""

SQL = {
    "bronze_partitions": f"WITH {SQL_MANIFEST} SELECT partition, source_part, mois, nb_offres, source_fichier FROM manifest",
    "bronze_stats": f"""WITH {SQL_MANIFEST}
SELECT 'total' AS niveau, 'total' AS cle, CAST(sum(nb_offres) AS BIGINT) AS nb_offres FROM manifest
UNION ALL SELECT 'source', source_part, CAST(sum(nb_offres) AS BIGINT) FROM manifest GROUP BY source_part
UNION ALL SELECT 'mois', mois, CAST(sum(nb_offres) AS BIGINT) FROM manifest GROUP BY mois""",
    "silver_offers": f"WITH {SQL_SILVER} SELECT * EXCLUDE (text) FROM silver",
    "skill_extract": SQL_SKILLS,
    "skill_extract_by_join": SQL_SKILLS,
    "gold_top_skills": SQL_TOP_SKILLS,
    "gold_salaries": SQL_SALARIES,
    "gold_by_city": SQL_BY_CITY,
    "gold_top_employers": SQL_EMPLOYERS,
    "gold_monthly_trend": SQL_TREND,
    "insight_top_skills": f"""SELECT competence, CAST(sum(nb_offres_mentionnent) AS BIGINT) AS nb_offres_mentionnent FROM ({SQL_TOP_SKILLS})
GROUP BY competence ORDER BY 2 DESC, 1 LIMIT 10""",
    "insight_salary_by_profile": f"SELECT profil, round(avg(salaire_median_mad), 6) AS salaire_median_mad FROM ({SQL_SALARIES}) GROUP BY profil",
    "insight_top_cities": f"""SELECT ville, CAST(sum(nb_offres) AS BIGINT) AS nb_offres, CAST(sum(nb_offres_remote) AS BIGINT) AS nb_offres_remote
FROM ({SQL_BY_CITY}) GROUP BY ville ORDER BY nb_offres DESC, ville LIMIT 10""",
    "insight_top_employers": f"SELECT entreprise, ville, nb_offres_publiees FROM ({SQL_EMPLOYERS}) ORDER BY nb_offres_publiees DESC, entreprise, ville LIMIT 10",
    "insight_overall_trend": f"SELECT annee || '-' || mois AS date, CAST(sum(nb_offres) AS BIGINT) AS nb_offres FROM ({SQL_TREND}) GROUP BY ALL",
}
