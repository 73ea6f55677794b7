import json

import pytest
from pyspark.sql import functions as F

from helpers import rows
from sparkmart.plans.orders import keep_last_order
from sparkmart.sinks import catalog, jdbc
from sparkmart.sinks.files import write_bronze, write_parquet
from sparkmart.sources import files
from sparkmart.sources.references import read_skills
from sparkmart.plans import bronze
from sparkmart.plans.lake import ingest_bronze

HEADER = "id_commande , id_client,id_produit,date_commande,quantite,prix_unitaire,statut,ville_livraison,mode_paiement,id_livreur,date_livraison"


def write(path, text):
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_orders_csv_tokens_header_and_order(spark, tmp_path):
    path = write(
        tmp_path / "o.csv",
        HEADER + '\nC1,NULL,P1,2024-01-01,1,"1,5",livré,"a ""b""",cash,N/A,\nC1,c2,P2,2024-01-02,2,2,nan,Fès,cash,L1,n/a\n',
    )
    df = files.read_orders(spark, path)
    got = {r.id_produit: r for r in df.collect()}
    assert got["P1"].id_client is None and got["P1"].prix_unitaire == "1,5" and got["P1"].ville_livraison == 'a "b"'
    assert got["P1"].id_livreur is None and got["P1"].date_livraison is None and got["P2"].statut is None
    assert all(f.dataType.typeName() == "string" for f in df.schema.fields if f.name != files.ORDINAL)
    assert [r.id_produit for r in keep_last_order(df).collect()] == ["P2"]


def test_last_occurrence_follows_file_order_over_splits(spark, tmp_path):
    lines = [f"C{i % 50},x,P{i},2024-01-01,1,1,OK,Fes,cash,L1," for i in range(4000)]
    path = write(tmp_path / "o.csv", HEADER + "\n" + "\n".join(lines) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16384")
    try:
        df = files.read_orders(spark, path)
        assert df.rdd.getNumPartitions() > 4
        assert {r.id_commande: r.id_produit for r in keep_last_order(df).collect()} == {f"C{k}": f"P{3950 + k}" for k in range(50)}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_missing_and_empty_sources(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        files.read_orders(spark, str(tmp_path / "none.csv"))
    with pytest.raises(ValueError):
        files.read_clients(spark, write(tmp_path / "empty.csv", ""))
    with pytest.raises(ValueError):
        files.read_clients(spark, write(tmp_path / "columns.csv", "id_client,nom\n1,a\n"))


def test_products_json(spark, tmp_path):
    product = {"id_produit": "P1", "nom": "x", "prix_catalogue": 12.5, "actif": True, "date_creation": "2024-01-01"}
    path = write(tmp_path / "p.json", json.dumps({"produits": [product, {**product, "id_produit": "P2", "prix_catalogue": None, "actif": "False"}]}))
    got = {r.id_produit: (r.prix_catalogue, r.actif) for r in files.read_products(spark, path).collect()}
    assert got == {"P1": ("12.5", "true"), "P2": (None, "False")}
    lines = write(tmp_path / "p.jsonl", json.dumps(product) + "\n")
    assert files.read_products(spark, lines, json_lines=True).count() == 1
    with pytest.raises(KeyError):
        files.read_products(spark, write(tmp_path / "bad.json", json.dumps({"autres": []})))


def test_regions_csv(spark, tmp_path):
    path = write(tmp_path / "r.csv", "code_ville,nom_ville_standard,province,region_admin,zone_geo,population,code_postal\nfes,Fès,Fès,Fès-Meknès,Centre,1112072,030000\n")
    row = files.read_regions(spark, path).first()
    assert row.population == 1112072 and row.code_postal == "030000"


def test_skill_dictionary_file(spark, tmp_path):
    path = write(tmp_path / "s.json", json.dumps({"familles": {"bi": {"power_bi": ["Power BI", "pbi"]}}}))
    assert rows(read_skills(spark, path)) == [("pbi", "power_bi", "bi"), ("power bi", "power_bi", "bi")]


def offers(spark, data):
    df = spark.createDataFrame(data, "id_offre string, source string, date_publication string")
    missing = [f for f in files.schemas.OFFERS.fields if f.name not in df.columns]
    return df.withColumns({f.name: F.lit(None).cast(f.dataType) for f in missing}).select(files.schemas.OFFERS.names)


def test_bronze_overwrites_only_touched_partitions(spark, tmp_path):
    root = str(tmp_path)
    first = offers(spark, [("1", "Re Krute", "2024-01-05"), ("2", None, "2024-02-05"), ("3", "linkedin", "x")])
    write_bronze(bronze.to_bronze(first, "a"), root)
    write_bronze(bronze.to_bronze(offers(spark, [("4", "re krute", "2024-01-09")]), "b"), root)
    got = sorted(r.id_offre for r in files.read_bronze(spark, root).collect())
    assert got == ["2", "3", "4"]
    assert [r.id_offre for r in files.read_bronze(spark, root, months=["2024_02"]).collect()] == ["2"]
    raw = {r.id_offre: r.source for r in files.read_bronze(spark, root).collect()}
    assert raw == {"4": "re krute", "2": None, "3": "linkedin"}


def test_broken_json_is_an_error(spark, tmp_path):
    cut = write(tmp_path / "cut.json", '{"offres": [{"id_offre": "1"}, {"id_of')
    with pytest.raises(Exception, match="broken JSON"):
        files.read_offers(spark, cut).collect()
    lines = write(tmp_path / "lines.jsonl", '{"id_offre": "1"}\n{"id_offre": \n{"id_offre": "3", "nb_postes": "two"}\n')
    with pytest.raises(Exception, match="broken JSON"):
        files.read_offers(spark, lines, json_lines=True).count()
    partly = write(tmp_path / "partly.jsonl", '{"id_offre": "3", "nb_postes": "two"}\n')
    assert [(r.id_offre, r.nb_postes) for r in files.read_offers(spark, partly, json_lines=True).collect()] == [("3", None)]
    none = write(tmp_path / "none.json", '{"autres": []}')
    assert files.read_offers(spark, none).count() == 0


def test_manifest_of_a_second_load(spark, tmp_path):
    source = write(tmp_path / "o.json", json.dumps({"offres": [{"id_offre": str(i), "source": "a", "date_publication": "2024-01-02"} for i in range(2)]}))
    for _ in range(2):
        stats = {(r.niveau, r.cle): r.nb_offres for r in ingest_bronze(spark, source, str(tmp_path / "lake")).collect()}
        assert stats == {("total", "total"): 2, ("source", "a"): 2, ("mois", "2024_01"): 2}
    manifest = spark.read.parquet(str(tmp_path / "lake" / "bronze_manifest"))
    assert [(r.partition, r.nb_offres) for r in manifest.collect()] == [("a/2024_01", 2)]


def test_bronze_envelopes(spark, tmp_path):
    folder = tmp_path / "bronze" / "rekrute" / "2024_01"
    folder.mkdir(parents=True)
    write(folder / "offres_raw.json", json.dumps({"metadata": {"nb_offres": 1}, "offres": [{"id_offre": "1", "langue_requise": ["fr"]}]}))
    write(folder / "other.json", json.dumps({"offres": [{"id_offre": "2"}]}))
    assert [(r.id_offre, r.langue_requise) for r in files.read_bronze_envelopes(spark, str(tmp_path)).collect()] == [("1", ["fr"])]


def test_bronze_stats(spark):
    manifest = bronze.bronze_manifest(bronze.to_bronze(offers(spark, [("1", "A b", "2024-01-05"), ("2", "A b", "2024-02-05")]), "f"))
    assert rows(bronze.bronze_stats(manifest)) == sorted(
        [("total", "total", 2), ("source", "a_b", 2), ("mois", "2024_01", 1), ("mois", "2024_02", 1)], key=repr
    )


def test_partitioned_parquet_is_replaced(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(100).selectExpr("id", "id % 3 AS p")
    write_parquet(df, path, ["p"])
    write_parquet(df.filter("p = 1"), path, ["p"])
    assert spark.read.parquet(path).select("p").distinct().count() == 1


def test_catalog_load_keeps_structure(spark):
    catalog.ensure_databases(spark, ["t_dwh"])
    df = spark.createDataFrame([(1, "a")], "id int, v string")
    assert catalog.load_table(df, "t_dwh", "d") == "create+insert"
    assert catalog.load_table(spark.createDataFrame([("b", 2)], "v string, id int"), "t_dwh", "d") == "truncate+insert"
    assert rows(spark.table("t_dwh.d")) == [(2, "b")]
    assert catalog.load_table(df.filter("id > 5"), "t_dwh", "d") == "skipped"
    assert spark.table("t_dwh.d").count() == 1
    catalog.truncate_table(spark, "t_dwh", "d")
    assert catalog.table_exists(spark, "t_dwh", "d") and spark.table("t_dwh.d").count() == 0
    assert not catalog.table_exists(spark, "t_dwh", "none")


def test_refresh_swaps_and_survives_a_failure(spark, tmp_path):
    catalog.ensure_databases(spark, ["t_rep"])

    def broken():
        raise RuntimeError("no data")

    place = str(tmp_path)
    assert catalog.refresh_marts({"m": lambda: spark.range(3)}, spark, "t_rep", place) == {"m": "refreshed"}
    done = catalog.refresh_marts({"x": broken, "m": lambda: spark.table("t_rep.m").union(spark.range(1))}, spark, "t_rep", place)
    assert done == {"x": "failed", "m": "refreshed"}
    assert spark.table("t_rep.m").count() == 4


def test_jdbc_options_and_nan(spark):
    options = jdbc.write_options("jdbc:x", "dwh.t", connections=4)
    assert options["truncate"] == options["cascadeTruncate"] == "true"
    assert options["batchsize"] == "1000" and options["numPartitions"] == "4"
    df = spark.createDataFrame([(float("nan"),), (1.0,), (None,)], "v double")
    assert rows(jdbc.nan_to_null(df)) == sorted([(None,), (1.0,), (None,)], key=repr)
