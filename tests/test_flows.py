import json
from datetime import date

import pytest
from pyspark.sql import functions as F

from helpers import plan, rows
from sparkmart.plans import clients, fact, gold, insights, lake, orders, products, silver, warehouse
from sparkmart.settings import WarehouseSettings
from sparkmart.sinks.generations import Generations
from sparkmart.sources import files
from sparkmart.sources.references import city_variants

SETTINGS = WarehouseSettings(as_of=date(2024, 12, 31))
ORDER_LINES = [
    "CMD1,C1,P1,05/03/2024,2,100.00,livre,TNG,cash,L001,2024-03-07",
    "CMD1,C1,P1,05/03/2024,3,100.00,livre,TNG,cash,L001,2024-03-07",
    "CMD2,C2,P1,2024-03-06,1,9000,DONE,casa,cash,,2024-03-12",
    "CMD3,C2,P2,Mar 08 2024,-1,10,OK,Fez,cash,L002,",
    "CMD4,C2,P2,2024-03-08,1,0,OK,Fez,cash,L002,",
    "CMD5,C2,P2,bad,1,10,OK,Fez,cash,L002,",
    "CMD6,C9,P2,2024-03-08,0.5,10,Livré,nowhere,cash,L002,2024-03-01",
    "CMD7,C3,P9,2024-03-08,1,10,KO,,cash,L003,",
    "CMD8,C4,P2,2022-01-01,1,10.005,LIVRE,fès,cash,L002,2022-01-02",
]
CLIENT_LINES = [
    "C1,el amrani,sara,Sara@x.ma,1990-05-01,f,tng,+2126,2023-01-01,organic",
    "C2,tazi,omar,omar@x.ma,1880-01-01,Homme,CASA,+2126,2023-02-01,referral",
    "C3,benali,rim, sara@x.ma ,2001-01-01,0,fes,+2126,2023-03-01,organic",
    "C4,kadiri,ali,invalide-4,bad,z,,+2126,,organic",
]
PRODUCT_ROWS = [
    {"id_produit": "P1", "nom": " a  b ", "categorie": "ELECTRONIQUE", "sous_categorie": "audio", "marque": "M ", "fournisseur": "F",
     "prix_catalogue": 100.0, "origine_pays": "Maroc", "date_creation": "2024-01-01", "actif": True},
    {"id_produit": "P2", "nom": "c", "categorie": "jeux d'hiver", "sous_categorie": "x", "marque": "M", "fournisseur": "F",
     "prix_catalogue": None, "origine_pays": "Maroc", "date_creation": "2030-01-01", "actif": False},
]
REGION_LINES = ["tanger,Tanger,T,Nord-Ouest,Nord,1,90000", "fes,Fès,F,Fès-Meknès,Centre,1,30000", "casablanca,Casablanca,C,CS,Centre,1,20000"]


@pytest.fixture(scope="module")
def sources(tmp_path_factory):
    d = tmp_path_factory.mktemp("sources")

    def csv(name, schema, lines):
        (d / name).write_text(",".join(schema.names) + "\n" + "\n".join(lines) + "\n", encoding="utf-8")
        return str(d / name)

    (d / "p.json").write_text(json.dumps({"produits": PRODUCT_ROWS}), encoding="utf-8")
    return warehouse.WarehouseSources(
        csv("o.csv", files.schemas.ORDERS, ORDER_LINES), csv("c.csv", files.schemas.CLIENTS, CLIENT_LINES),
        str(d / "p.json"), csv("r.csv", files.schemas.REGIONS, REGION_LINES),
    )


@pytest.fixture(scope="module")
def run(spark, sources, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("out"))
    return out, warehouse.run_warehouse(spark, sources, out, settings=SETTINGS)


def test_counts_and_status(run):
    _, metrics = run
    assert metrics["statut"] == "succès"
    assert metrics["extract"] == {"commandes": 9, "produits": 2, "clients": 4, "regions": 3}
    t = metrics["transform"]
    assert (t["commandes_clean"], t["clients_clean"], t["produits_clean"]) == (5, 3, 2)
    assert (t["dim_temps"], t["dim_region"], t["dim_livreur"], t["fait_ventes"]) == (2557, 4, 4, 2)
    assert t["ca_ttc_total"] == 10800.0 + 12.01


def test_clean_orders(spark, run):
    out, _ = run
    clean = {r.id_commande: r for r in orders.accepted_orders(Generations(spark, out).read("staging/commandes")).collect()}
    assert set(clean) == {"CMD1", "CMD2", "CMD6", "CMD7", "CMD8"}
    one = clean["CMD1"]
    assert (one.quantite, str(one.montant_ht), str(one.montant_ttc), one.delai_livraison_jours) == (3, "300.00", "360.00", 2)
    assert (one.ville_livraison, one.statut, one.date_commande) == ("Tanger", "livré", date(2024, 3, 5))
    assert clean["CMD2"].id_livreur == "-1"
    assert (clean["CMD6"].quantite, clean["CMD6"].ville_livraison, clean["CMD6"].delai_livraison_jours) == (0, "Non renseignée", None)
    assert str(clean["CMD8"].prix_unitaire) == "10.01"


def test_clean_clients(spark, run):
    out, _ = run
    got = {r.id_client: r for r in Generations(spark, out).read("staging/clients").collect()}
    assert set(got) == {"C2", "C3", "C4"}
    assert (got["C3"].email, got["C3"].sexe, got["C3"].nom_complet, got["C3"].ville) == (None, "f", "Rim Benali", "Fès")
    assert (got["C2"].date_naissance, got["C2"].tranche_age, got["C2"].email) == (None, "Inconnu", "omar@x.ma")
    assert (got["C4"].sexe, got["C4"].ville, got["C4"].email_norm) == ("inconnu", "Non renseignée", None)


def test_star(spark, run):
    out, _ = run
    dim = {r.id_client_nk: r for r in Generations(spark, out).read("dwh/dim_client").collect()}
    assert sorted(r.id_client_sk for r in dim.values()) == [1, 2, 3]
    assert dim["C2"].segment_client == "Silver" and dim["C3"].segment_client == "Bronze"
    product = {r.id_produit_nk: r for r in Generations(spark, out).read("dwh/dim_produit").collect()}
    assert (product["P1"].nom_produit, product["P1"].categorie) == ("a b", "Electronique")
    assert (product["P2"].categorie, product["P2"].prix_standard, product["P2"].date_creation) == ("Jeux D'Hiver", 0.01, date(2024, 12, 31))
    region = Generations(spark, out).read("dwh/dim_region").filter("id_region = 1").first()
    assert (region.ville, region.province) == ("Non renseignée", "Inconnu")
    courier = {r.id_livreur_nk: r.id_livreur for r in Generations(spark, out).read("dwh/dim_livreur").collect()}
    assert courier == {"-1": 1, "L001": 2, "L002": 3, "L003": 4}
    sales = Generations(spark, out).read("dwh/fait_ventes")
    assert {(r.id_date, r.id_client, r.id_livreur) for r in sales.collect()} == {
        (20240306, dim["C2"].id_client_sk, 1), (20220101, dim["C4"].id_client_sk, 3)
    }


def test_rule_report(spark, run):
    out, metrics = run
    report = {(r.entite, r.regle.split()[0]): (r.avant, r.apres, r.supprimees, r.pct, r.remplacees)
              for r in Generations(spark, out).read("reports/regles").collect()}
    assert report[("commandes", "R1")] == (9, 8, 1, 11.11, 0)
    assert report[("commandes", "R2")] == (8, 7, 1, 12.5, 0)
    assert report[("commandes", "R5")][:3] == (7, 6, 1) and report[("commandes", "R6")][:3] == (6, 5, 1)
    assert report[("commandes", "R3")][4] == 2 and report[("commandes", "R7")][4] == 1 and report[("commandes", "R9")][4] == 1
    assert report[("clients", "R1")][:3] == (4, 3, 1) and report[("clients", "R5")][4] == 2
    assert report[("produits", "R1")][4] == 2 and report[("produits", "R2")][4] == 1
    assert report[("faits", "fait_ventes")][:3] == (5, 2, 3)
    assert "| R1 doublons id_commande | commandes | 9 | 8 | 1 | 11.11 | 0 |" in metrics["rapport"]


def test_load_marts_and_integrity(spark, run):
    _, metrics = run
    load = metrics["load"]
    assert set(load["marts"].values()) == {"refreshed"}
    assert load["integrity"] == {
        "orphelins_date": 0.0, "orphelins_produit": 0.0, "orphelins_client": 0.0,
        "nb_faits": 2.0, "nb_clients": 3.0, "nb_produits": 2.0, "ca_total_ttc": 10812.01,
    }
    assert spark.table("reporting.mv_ca_mensuel").count() == 2
    assert {r.pct_retard for r in spark.table("reporting.mv_performance_livreurs").collect()} == {100.0, 0.0}


def test_second_run_replaces(spark, sources, run):
    out, _ = run
    again = warehouse.run_warehouse(spark, sources, out, settings=SETTINGS)
    assert set(again["load"]["tables"].values()) == {"truncate+insert"}
    assert again["load"]["integrity"]["nb_faits"] == 2.0


def test_phases(spark, sources, tmp_path):
    assert warehouse.run_warehouse(spark, sources, str(tmp_path), phase="extract")["statut"] == "partiel"
    assert not list(tmp_path.iterdir())
    dry = warehouse.run_warehouse(spark, sources, str(tmp_path), dry_run=True, settings=SETTINGS)
    assert dry["statut"] == "succès" and "load" not in dry
    with pytest.raises(ValueError):
        warehouse.run_warehouse(spark, sources, str(tmp_path), phase="x")


def test_orders_can_follow_merged_clients(spark, sources, tmp_path):
    settings = WarehouseSettings(as_of=SETTINGS.as_of, remap_merged_clients=True)
    done = warehouse.run_warehouse(spark, sources, str(tmp_path), phase="transform", settings=settings)
    assert done["transform"]["fait_ventes"] == 3


def test_merged_clients_are_unique(spark):
    data = [("1", "a@x.ma", "2024-01-01"), ("2", "A@x.ma", "2024-02-01"), ("1", "b@x.ma", "2024-01-01"), ("3", None, None), ("4", None, None)]
    df = spark.createDataFrame(data, "id_client string, email string, date_inscription string")
    assert rows(clients.merged_clients(df)) == [("1", "1"), ("2", "2")]


def test_segments_bounds(spark):
    data = [("a", date(2024, 1, 1), "livré", "15000.00"), ("b", date(2023, 1, 1), "livré", "4999.99"), ("c", date(2022, 12, 31), "livré", "9.00"),
            ("d", date(2024, 1, 1), "annulé", "9.00"), ("e", date(2024, 1, 1), "livré", "5000.00")]
    df = spark.createDataFrame(data, "id_client string, date_commande date, statut string, t string").withColumn("montant_ttc", F.col("t").cast("decimal(18,2)"))
    got = {r.id_client: r.segment_client for r in clients.client_segments(df).collect()}
    assert got == {"a": "Gold", "b": "Bronze", "e": "Silver"}
    assert clients.client_segments(df.filter("false")).collect() == []


def test_unmatched_dates(spark):
    days = spark.createDataFrame([(date(2024, 1, 1),), (date(2019, 1, 1),), (date(2019, 1, 1),)], "date_commande date")
    from sparkmart.plans.dimensions import build_dim_calendar

    assert rows(fact.unmatched_dates(days, build_dim_calendar(spark))) == [(20190101, 2)]


def test_products_without_price(spark):
    df = spark.createDataFrame([("a", "1"), ("b", None), ("c", "n.c.")], "id_produit string, prix_catalogue string")
    assert rows(products.products_without_price(df)) == [("b",), ("c",)]


OFFERS = [
    {"id_offre": "1", "source": "Re Krute", "titre_poste": "Data Eng.", "description": "Vous maîtrisez Python.", "competences_brut": "SQL, Agile",
     "entreprise": "E1", "ville": "casa", "type_contrat": "cdi", "experience_requise": "3-5 ans", "salaire_brut": "15K-20K",
     "date_publication": "2024-01-05", "teletravail": "Hybride", "nb_postes": 1, "langue_requise": ["Français"]},
    {"id_offre": "2", "source": "linkedin", "titre_poste": "DevOps", "description": "rien", "competences_brut": None, "entreprise": "E1",
     "ville": "CASA", "type_contrat": None, "experience_requise": None, "salaire_brut": "Confidentiel", "date_publication": "2024-03-05",
     "teletravail": "Non", "nb_postes": 1, "langue_requise": []},
    {"id_offre": "3", "source": "linkedin", "titre_poste": "Data Engineer", "description": "python", "competences_brut": "", "entreprise": "",
     "ville": None, "type_contrat": "CDI ", "experience_requise": "Senior", "salaire_brut": "10000 MAD", "date_publication": "2024-03-09",
     "teletravail": "Full remote", "nb_postes": 2, "langue_requise": []},
]


@pytest.fixture(scope="module")
def lake_run(spark, tmp_path_factory):
    d = tmp_path_factory.mktemp("lake")
    (d / "offres.json").write_text(json.dumps({"offres": OFFERS}), encoding="utf-8")
    (d / "skills.json").write_text(json.dumps({"familles": {"langages": {"python": ["python", "py"], "sql": ["sql"]}}}), encoding="utf-8")
    return str(d / "root"), lake.run_lake(spark, str(d / "offres.json"), str(d / "skills.json"), str(d / "root"))


def test_lake_counts(lake_run):
    _, done = lake_run
    assert done["bronze"][("total", "total")] == 3 and done["bronze"][("source", "linkedin")] == 2
    assert done["silver"] == {"offres_clean": 3, "competences_extraites": 4}
    assert done["gold"]["top_competences"] == 2 and done["gold"]["entreprises_recruteurs"] == 1


def test_silver_rows(spark, lake_run):
    root, _ = lake_run
    got = {r.id_offre: r for r in files.read_table(spark, root, "silver", "offres_clean").collect()}
    assert (got["1"].profil_normalise, got["1"].salaire_median_mad, got["1"].ville_std, got["1"].type_contrat_std) == (
        "Data Engineer", 17500.0, "Casa", "CDI"
    )
    assert (got["3"].ville_std, got["3"].region_admin, got["3"].type_contrat_std, got["3"].experience_max_ans) == ("Inconnu", "Inconnu", "CDI", None)
    assert (got["2"].salaire_connu, got["2"].type_contrat_std, got["2"].annee, got["2"].mois) == (False, "Inconnu", "2024", "03")
    skills = rows(files.read_table(spark, root, "silver", "competences_extraites").select("id_offre", "competence", "famille"))
    assert skills == [("1", "python", "langages"), ("1", "sql", "langages"), ("2", "non_détecté", "inconnu"), ("3", "python", "langages")]


def test_gold_rows(spark, lake_run):
    root, _ = lake_run
    read = lambda name: files.read_table(spark, root, "gold", name)
    top = {r.competence: r for r in read("top_competences").collect()}
    assert (top["python"].nb_offres_mentionnent, top["python"].pct_offres_total, top["python"].rang_dans_profil) == (2, 66.67, 1)
    assert top["sql"].rang_dans_profil == 2
    trend = {(r.profil, r.mois): (r.nb_offres, r.nb_offres_mois_precedent) for r in read("tendances_mensuelles").collect()}
    assert trend == {("Data Engineer", "01"): (1, None), ("Data Engineer", "03"): (1, 1), ("DevOps / SRE", "03"): (1, None)}
    employer = read("entreprises_recruteurs").first()
    assert (employer.nb_profils_differents, employer.profils_recrutes) == (2, ["Data Engineer", "DevOps / SRE"])
    paid = {(r.ville, r.profil): r.salaire_median_mad for r in read("salaires_par_profil").collect()}
    assert paid[("Casa", "Data Engineer")] == 17500.0 and paid[("Casa", "DevOps / SRE")] is None
    cities = {(r.ville, r.mois): r.pct_remote for r in read("offres_par_ville").collect()}
    assert cities == {("Casa", "01"): 100.0, ("Casa", "03"): 0.0, ("Inconnu", "03"): 100.0}
    counts = [r.nb_offres for r in gold.in_report_order("offres_par_ville", read("offres_par_ville")).collect()]
    assert counts == sorted(counts, reverse=True)


def test_insights(lake_run):
    _, done = lake_run
    found = done["insights"]
    assert [tuple(r) for r in found["top_competences_global"].collect()] == [("python", 2), ("sql", 1)]
    assert [(r.date, r.nb_offres) for r in found["tendance_globale"].collect()] == [("2024-01", 1), ("2024-03", 2)]
    assert [r.ville for r in found["villes"].collect()] == ["Casa", "Inconnu"]
    assert found["salaire_par_profil"].first().profil == "Data Engineer"


def test_silver_is_one_stage(spark, lake_run):
    root, _ = lake_run
    text = plan(silver.clean_offers(files.read_bronze(spark, root)))
    assert "Exchange" not in text and "Python" not in text


def test_empty_lake(spark, tmp_path):
    (tmp_path / "o.json").write_text(json.dumps({"offres": []}), encoding="utf-8")
    assert files.read_offers(spark, str(tmp_path / "o.json")).count() == 0
    assert insights.overall_trend(gold.monthly_trend(silver.clean_offers(files.read_offers(spark, str(tmp_path / "o.json"))))).collect() == []


def test_empty_orders(spark, sources):
    raw = files.read_orders(spark, sources.orders).filter("false")
    cities = city_variants(files.read_regions(spark, sources.regions))
    assert orders.clean_orders(raw, cities, SETTINGS).collect() == []
