"""Approximate figures against the exact ones."""

import json
import os

import pytest
from pyspark.sql import functions as F

from helpers import plan, rows
from sparkmart.operators import sketches
from sparkmart.plans import approximate, gold, lake
from sparkmart.settings import LakeSettings


@pytest.fixture(scope="module")
def offers(spark, tmp_path_factory):
    """120,000 offers of 40,000 ids in 24 months; one profile has nine rows of ten."""
    n = F.col("id")
    made = spark.range(120_000).select(
        (n % 40_000).cast("string").alias("id_offre"),
        F.when(n % 10 == 0, "rare").otherwise("hot").alias("profil_normalise"),
        F.lit("Casa").alias("ville_std"),
        F.when(n % 3 == 0, "CDI").alias("type_contrat_std"),
        (n % 7 > 0).alias("salaire_connu"),
        ((n * 7919 % 100_003) + 0.5).alias("salaire_median_mad"),
        F.when(n % 97 > 0, F.lpad((2020 + n % 2).cast("string"), 4, "0")).alias("annee"),
        F.when(n % 97 > 0, F.lpad((1 + n % 12).cast("string"), 2, "0")).alias("mois"),
    )
    skills = made.select(
        "id_offre", F.col("profil_normalise").alias("profil"), F.lit("langages").alias("famille"),
        F.when(F.col("id_offre") % 3 == 0, "python").otherwise("sql").alias("competence"), "annee", "mois",
    )
    root = str(tmp_path_factory.mktemp("sketches"))
    approximate.write_sketches(made, skills, root)
    return made, skills, root


def test_distinct_counts_are_within_their_error(spark, offers):
    made, skills, root = offers
    got = approximate.approximate_top_skills(
        approximate.read_sketches(spark, root, "croquis_competences"), approximate.read_sketches(spark, root, "croquis_offres")
    )
    exact = {(r.profil, r.competence): r for r in gold.top_skills(skills, made.withColumn("profil", F.col("profil_normalise"))).collect()}
    assert {(r.profil, r.competence) for r in got.collect()} == set(exact)
    for r in got.collect():
        wanted = exact[(r.profil, r.competence)]
        assert abs(r.nb_offres_mentionnent / wanted.nb_offres_mentionnent - 1) < 4 * sketches.distinct_error()
        assert r.rang_dans_profil == wanted.rang_dans_profil
        assert abs(r.pct_offres_total / wanted.pct_offres_total - 1) < 8 * sketches.distinct_error()


@pytest.mark.parametrize("span", [(None, None), ("2020-03", "2021-02"), ("2021-11", None), (None, "2020-01")])
def test_quantiles_are_within_their_rank_error(spark, offers, span):
    made, _, root = offers
    rows_in = approximate.in_span(made, *span).filter("salaire_connu")
    table = approximate.in_span(approximate.read_sketches(spark, root, "croquis_offres"), *span)
    for r in approximate.approximate_salaries(table, ["profil"]).collect():
        values = sorted(v.salaire_median_mad for v in rows_in.filter(F.col("profil_normalise") == r.profil).collect())
        assert r.nb_offres_avec_salaire == len(values)
        for name, share in approximate.SHARES.items():
            below = sum(v < r[name] for v in values) / len(values)
            assert abs(below - share) < 2 * sketches.rank_error() + 2 / len(values)


def test_a_load_replaces_its_months_alone(spark, offers, tmp_path):
    made, skills, _ = offers
    root = str(tmp_path)
    approximate.write_sketches(made, skills, root)
    march = (F.col("annee") == "2020") & (F.col("mois") == "03")
    approximate.write_sketches(made.filter(march).limit(5), skills.filter(march).limit(5), root)
    counts = lambda: rows(approximate.read_sketches(spark, root, "croquis_offres").groupBy("annee", "mois").agg(F.sum("nb_offres")))
    wanted = rows(made.groupBy("annee", "mois").count())
    assert counts() == [(a, m, 5 if (a, m) == ("2020", "03") else n) for a, m, n in wanted]
    assert (None, None) in [c[:2] for c in counts()]


def test_groups_without_values(spark, tmp_path):
    schema = "id_offre string, profil_normalise string, ville_std string, type_contrat_std string, salaire_connu boolean, salaire_median_mad double, annee string, mois string"
    unpaid = spark.createDataFrame([(None, None, None, None, False, None, "2024", "01"), ("1", None, None, None, None, 3.0, "2024", "02")], schema)
    made = approximate.approximate_salaries(approximate.offer_sketches(unpaid), ["profil"])
    assert rows(made) == [(None, 2, 0, 1, None, None, None)]
    assert rows(approximate.approximate_salaries(approximate.offer_sketches(unpaid.limit(0)), ["profil"])) == []


def test_a_span_is_read_from_the_sketches_of_its_months(spark, offers):
    _, _, root = offers
    table = approximate.in_span(approximate.read_sketches(spark, root, "croquis_offres"), "2021-02", "2021-03")
    shown = plan(approximate.approximate_salaries(table, ["profil"]))
    assert "PartitionFilters: [isnotnull" in shown and "PythonUDF" not in shown


def test_off_by_default_and_written_by_the_flow(spark, tmp_path):
    offer = {"id_offre": "1", "source": "LinkedIn", "titre_poste": "Data Engineer", "description": "python", "ville": "casa", "type_contrat": "CDI",
             "salaire_brut": "15K-20K", "date_publication": "2024-01-05"}
    (tmp_path / "offres.json").write_text(json.dumps({"offres": [offer]}), encoding="utf-8")
    (tmp_path / "skills.json").write_text(json.dumps({"familles": {"langages": {"python": ["python"]}}}), encoding="utf-8")
    run = lambda root, **k: lake.run_lake(spark, str(tmp_path / "offres.json"), str(tmp_path / "skills.json"), str(tmp_path / root), **k)
    run("plain")
    assert not os.path.exists(tmp_path / "plain/gold/croquis_offres")
    run("with", settings=LakeSettings(sketches=True))
    table = approximate.read_sketches(spark, str(tmp_path / "with"), "croquis_offres")
    assert rows(approximate.approximate_salaries(table, ["annee", "mois"])) == [("2024", "01", 1, 1, 1, 17500.0, 17500.0, 17500.0)]
