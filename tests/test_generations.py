"""Loads that fail, loads of several tables, versions of a dimension, checks that fail alone."""

import os
from datetime import date

import pytest
from pyspark.sql import functions as F

from helpers import rows
from sparkmart.plans import integrity
from sparkmart.plans.history import merge_history, start_history
from sparkmart.operators.keys import with_surrogate_key
from sparkmart.operators.scd import merge_versions, version_columns
from sparkmart.sinks import catalog
from sparkmart.sinks.files import write_parquet
from sparkmart.sinks.generations import ConcurrentLoad, Generations


def failing(df, column="id"):
    """``df``, but its last row ends the job."""
    return df.withColumn(column, F.when(F.col(column) < 90, F.col(column)).otherwise(F.raise_error(F.lit("lost")).cast("bigint")))


def files_below(path):
    return sorted(os.path.join(d, f) for d, _, names in os.walk(path) for f in names)


def test_tables_change_together_or_not_at_all(spark, tmp_path):
    store = Generations(spark, str(tmp_path))
    assert store.versions() == [] and store.entries() == {}
    with store.load() as load:
        assert load.write(spark.range(100), "a").count() == 100
        load.write(spark.range(10).withColumn("p", F.col("id") % 3), "b/c", ["p"], metrics={"largest": F.max("id")})
        assert store.versions() == []  # nothing is current before the end
    assert load.version == 1 and load.metrics == {"a": {"rows": 100}, "b/c": {"rows": 10, "largest": 9}}
    before = files_below(tmp_path)
    with pytest.raises(Exception, match="lost"):
        with store.load() as load:
            load.write(spark.range(5), "a")
            load.write(failing(spark.range(100)), "b/c")
    assert load.version is None and files_below(tmp_path) == before
    assert store.read("a").count() == 100 and store.read("b/c").columns == ["id", "p"]
    with store.load() as load:
        load.write(spark.range(5), "a")
    assert (store.read("a").count(), store.read("b/c").count(), store.read("a", 1).count()) == (5, 10, 100)


def test_empty_results_and_old_versions(spark, tmp_path):
    store = Generations(spark, str(tmp_path))
    for n in (3, 4, 5):
        with store.load() as load:
            load.write(spark.range(n), "a")
    with store.load() as load:
        assert load.write(spark.range(0), "a", keep_if_empty=True).count() == 5
    assert load.done == {"a": "skipped"} and load.version is None
    assert store.take_back(1) == 4 and store.read("a").count() == 3
    removed = store.prune(2)
    assert store.versions() == [3, 4] and len(removed) == 1  # version 4 names the files of version 1
    assert (store.read("a").count(), store.read("a", 3).count()) == (3, 5)
    with pytest.raises(KeyError):
        store.read("a", 2)
    with pytest.raises(KeyError):
        store.read("none")
    with store.load() as load:
        load.write(spark.range(9).filter("id > 10"), "a")
    assert store.read("a").count() == 0 and store.read("a").columns == ["id"]


def test_two_loads_at_once(spark, tmp_path):
    store = Generations(spark, str(tmp_path))
    with pytest.raises(ConcurrentLoad):
        with store.load() as slow:
            slow.write(spark.range(1), "a")
            with store.load() as fast:
                fast.write(spark.range(2), "a")
    assert store.versions() == [1] and store.read("a").count() == 2
    assert len({os.path.dirname(f) for f in files_below(tmp_path / "a")}) == 1


def test_failed_loads_keep_rows(spark, tmp_path):
    catalog.ensure_databases(spark, ["t_gen"])
    whole, path = spark.range(100), str(tmp_path / "t")
    assert catalog.load_tables(spark, "t_gen", {"a": whole, "b": whole}) == {"a": "create+insert", "b": "create+insert"}
    write_parquet(whole, path)
    with pytest.raises(Exception, match="lost"):
        catalog.load_tables(spark, "t_gen", {"a": spark.range(7), "b": failing(whole)})
    with pytest.raises(Exception, match="lost"):
        write_parquet(failing(whole), path)
    assert spark.table("t_gen.a").count() == spark.table("t_gen.b").count() == spark.read.parquet(path).count() == 100
    assert os.listdir(tmp_path) == ["t"]
    write_parquet(spark.read.parquet(path).filter("id < 3"), path)  # a table made of itself
    assert spark.read.parquet(path).count() == 3


def test_a_real_table_gives_way(spark):
    catalog.ensure_databases(spark, ["t_real"])
    spark.sql("CREATE TABLE t_real.d (v STRING, id INT) USING parquet")
    spark.sql("INSERT INTO t_real.d VALUES ('old', 1)")
    assert catalog.load_table(spark.createDataFrame([(2, "new")], "id bigint, v string"), "t_real", "d") == "truncate+insert"
    assert rows(spark.table("t_real.d")) == [("new", 2)] and dict(spark.table("t_real.d").dtypes) == {"v": "string", "id": "int"}
    spark.sql("DROP VIEW t_real.d")
    catalog.repair(spark, "t_real")
    assert rows(spark.table("t_real.d")) == [("new", 2)]


def test_refreshes_are_kept_and_pruned(spark, tmp_path):
    catalog.ensure_databases(spark, ["t_ref"])
    tries = []

    def shaky():
        tries.append(1)
        return failing(spark.range(100)) if len(tries) % 2 else spark.range(100)

    def broken():
        return failing(spark.range(100))

    catalog.refresh_marts({"m": lambda: spark.range(1), "kept": lambda: spark.range(50)}, spark, "t_ref", str(tmp_path))
    for n in range(10):
        done = catalog.refresh_marts({"m": lambda: spark.range(n), "s": shaky, "kept": broken}, spark, "t_ref", str(tmp_path), keep=3)
        assert done == {"m": "refreshed", "s": "refreshed again", "kept": "failed"}
    assert (spark.table("t_ref.m").count(), spark.table("t_ref.s").count(), spark.table("t_ref.kept").count()) == (9, 100, 50)
    assert {name: len(os.listdir(tmp_path / name)) for name in ("m", "s", "kept")} == {"m": 3, "s": 3, "kept": 1}


def test_history_by_bucket(spark, tmp_path):
    store = Generations(spark, str(tmp_path))
    frame = lambda data: spark.createDataFrame(data, "nk string, a int, b string")
    first = [(f"k{i}", i, "x") for i in range(40)] + [(None, -1, "x")]
    today = [date(2024, 1, d) for d in (1, 2, 3)]
    dim = with_surrogate_key(frame(first).withColumns(version_columns(F.lit(today[0]))), "sk", ["nk"])
    with store.load() as load:
        start_history(load, "dim", dim, "nk", "sk", 8)
    plain = dim
    changes = [
        [("k3", 3, "x"), ("k5", 55, "x"), ("new", 1, "x"), ("k7", 7, "y")],  # unchanged, changed, new, untracked change
        [("k5", 55, "x"), ("k5", 56, "x"), (None, 0, "z"), ("k9", None, "x")],  # repeated: the last by a counts
    ]
    for day, data in zip(today[1:], changes):
        incoming = frame(data).withColumns(version_columns(F.lit(day)))
        old = store.entries()["dim"]
        with store.load() as load:
            merged = merge_history(load, "dim", incoming, "nk", "sk", ["a"], day, latest=[F.col("a")])
        one = frame([d for d in data if d != ("k5", 55, "x") or day == today[1]])
        plain = spark.createDataFrame(merge_versions(plain, one, "nk", "sk", ["a"], day).collect(), plain.schema)
        assert rows(merged.select(plain.columns)) == rows(plain)
        entry = store.entries()["dim"]
        assert entry.rows == plain.count() == merged.count()
        kept = set(old.folders) & set(entry.folders)
        assert len(kept) == len(old.folders) - entry.notes["rewritten"] and 0 < entry.notes["rewritten"] < 8
    with store.load() as load:  # nothing new: no file is written
        merge_history(load, "dim", frame([("k3", 3, "q")]).withColumns(version_columns(F.lit(today[2]))), "nk", "sk", ["a"], today[2])
    assert store.entries()["dim"].folders == entry.folders and store.entries()["dim"].notes["opened"] == 0
    store.prune(1)
    assert rows(store.read("dim")) == rows(plain.select(store.read("dim").columns))


def test_checks_fail_alone(spark):
    fact = spark.createDataFrame([(1, 1, 9, "livré", 2.5)], "id_date int, id_produit int, id_client int, statut_commande string, montant_ttc double")
    ids = lambda name: lambda: spark.range(1, 3).withColumnRenamed("id", name)
    checks = integrity.integrity_checks(lambda: fact, ids("id_date"), ids("none"), ids("id_client_sk"))
    got = {r.controle: (r.valeur, r.niveau, r.erreur is None) for r in integrity.run_checks(spark, checks).collect()}
    assert got == {
        "orphelins_date": (0.0, "info", True), "orphelins_produit": (None, "error", False), "orphelins_client": (1.0, "warning", True),
        "nb_faits": (1.0, "info", True), "ca_total_ttc": (2.5, "info", True), "nb_clients": (2.0, "info", True), "nb_produits": (2.0, "info", True),
    }
