"""JSON documents that several tasks read, against Python's parser."""

import json
import random
from functools import reduce
from operator import or_

import pytest
from pyspark.sql import functions as F

from bindings import storage
from sparkmart.sources import files
from sparkmart.sources.documents import document_records

HARD = ['}', '{', '"', '\\', '\\"', '},{', ']', '[', '"produits": [', 'é}', '\n', '\\\\', "a\"produits\":[{", "", "x" * 40, '\\"}']


@pytest.fixture
def small_ranges(spark):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200")
    yield
    spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def value(rng, deep=0):
    kind = rng.randrange(6 if deep < 2 else 3)
    if kind < 2:
        return "".join(rng.choice(HARD) for _ in range(rng.randrange(4)))
    if kind == 2:
        return rng.choice([1, -2.5, None, True])
    if kind == 3:
        return [value(rng, deep + 1) for _ in range(rng.randrange(3))]
    return {rng.choice(["a", "produits", 'k"}', "b"]) + str(i): value(rng, deep + 1) for i in range(rng.randrange(3))}


def document(rng):
    records = [{"id": i, "v": value(rng), "produits": [{"n": 1}] if rng.random() < 0.3 else []} for i in range(rng.randrange(12))]
    others = [("meta", {"a": {"b": {"c": [1, {"d": "}"}]}}, "produits": [[2], {"x": 1}]}), ("autres", [{"y": '"'}, {"produits": [{}]}]), ("n", 3), ("vide", [])]
    rng.shuffle(others)
    cut = rng.randrange(len(others) + 1)
    return dict([*others[:cut], ("produits", records), *others[cut:]])


@pytest.mark.parametrize("seed", range(2))
def test_records_match_the_parser(spark, tmp_path, small_ranges, seed):
    rng = random.Random(seed)
    whole = [document(rng) for _ in range(4)]
    for i, doc in enumerate(whole):
        text = json.dumps(doc, indent=rng.choice([None, 1]), ensure_ascii=rng.random() < 0.5, separators=rng.choice([None, (",", ":")]))
        (tmp_path / f"{i}.json").write_text(text + rng.choice(["", "\n", "  \n "]), encoding="utf-8-sig" if i == 3 else "utf-8")
    got = [json.loads(r.record) for r in document_records(spark, str(tmp_path), "produits", True).collect()]
    key = lambda r: json.dumps(r, sort_keys=True)
    assert sorted(map(key, got)) == sorted(key(r) for doc in whole for r in doc["produits"])


def test_one_document_is_many_tasks(spark, tmp_path, small_ranges):
    rows = [{"id_produit": f"P{i}", "nom": 'a }{ "b" \\', "prix_catalogue": i / 4, "actif": i % 2 == 0} for i in range(100)]
    (tmp_path / "p.json").write_text(json.dumps({"source": "x", "produits": rows}), encoding="utf-8")
    pieces = spark.read.option("lineSep", "}").text(str(tmp_path))
    assert pieces.rdd.getNumPartitions() > 20
    split = files.read_products(spark, str(tmp_path), split_above=0)
    one = files.read_products(spark, str(tmp_path), split_above=1 << 40)
    assert split.schema == one.schema
    assert sorted(map(tuple, split.collect()), key=repr) == sorted(map(tuple, one.collect()), key=repr)


@pytest.mark.parametrize("range_bytes, tasks", [(7, 2), (100, 3)])
def test_records_over_many_ranges_of_few_tasks(spark, tmp_path, range_bytes, tasks):
    rng, before = random.Random(range_bytes), spark.conf.get("spark.sql.files.maxPartitionBytes")
    whole = [document(rng) for _ in range(3)]
    for i, doc in enumerate(whole):
        (tmp_path / f"{i}.json").write_text(json.dumps(doc, ensure_ascii=False), encoding="utf-8")
    got = [json.loads(r.record) for r in document_records(spark, str(tmp_path), "produits", True, range_bytes=range_bytes, tasks=tasks).collect()]
    key = lambda r: json.dumps(r, sort_keys=True)
    assert sorted(map(key, got)) == sorted(key(r) for doc in whole for r in doc["produits"])
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == before


def test_tasks_do_not_grow_with_the_ranges(spark, tmp_path):
    """Each step once had a task and a file a range of 64 KB."""
    parts = spark.range(60000).select(
        F.col("id").alias("p_partkey"), F.lit("a bolt").alias("p_name"), F.lit("B").alias("p_brand"), F.lit("T").alias("p_type"),
        F.lit(1).alias("p_size"),
    )
    parts.write.parquet(f"{tmp_path}/part.parquet")
    spark.sparkContext.setJobGroup("one document", "")
    try:
        assert storage.json_one_document(spark, str(tmp_path)).count() == 60000
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    tracker = spark.sparkContext.statusTracker()
    stages = [tracker.getStageInfo(s) for job in tracker.getJobIdsForGroup("one document") for s in tracker.getJobInfo(job).stageIds]
    assert 0 < max(stage.numTasks for stage in stages if stage) <= 2 * spark.sparkContext.defaultParallelism


def test_other_arrays_are_not_parsed(spark, tmp_path):
    """A part of them alone may be no JSON."""
    text = '{"meta": {"k": {"produits": [1, 2], "z": 3}}, "autres": [{"a": {"b": 1}}], "produits": [{"id_produit": "1"}, {"id_produit": "2", "nom": "}"}]}'
    (tmp_path / "p.json").write_text(text)
    read = files.read_products(spark, str(tmp_path / "p.json"), split_above=0)
    assert sorted(r.id_produit for r in read.collect()) == ["1", "2"]


@pytest.mark.parametrize("text", ['{"produits": [{"id_produit": "1"}', '{"produits": [{"id_produit": "1"}]}}', '{"produits": [{"id_produit": "1}]}', '{"produits": [{"id_produit": 1 2}]}'])
def test_broken_documents(spark, tmp_path, text):
    (tmp_path / "p.json").write_text(text)
    with pytest.raises(Exception, match="broken JSON"):
        files.read_products(spark, str(tmp_path / "p.json"), split_above=0).collect()


def test_missing_and_empty_arrays(spark, tmp_path):
    (tmp_path / "p.json").write_text('{"autres": [{"id_produit": "1"}], "note": "\\"produits\\": ["}')
    with pytest.raises(KeyError):
        files.read_products(spark, str(tmp_path / "p.json"), split_above=0)
    assert files.read_offers(spark, str(tmp_path / "p.json"), split_above=0).count() == 0
    (tmp_path / "p.json").write_text('{"produits": [], "autres": [{"id_produit": "1"}]}')
    assert files.read_products(spark, str(tmp_path / "p.json"), split_above=0).count() == 0


def test_many_files_with_several_headers(spark, tmp_path):
    names = files.schemas.CLIENTS.names
    for i in range(60):
        order = names[i % 7 :] + names[: i % 7]
        head = ",".join(f' "{n}" ' if i % 2 else n for n in order)
        (tmp_path / f"{i}.csv").write_text(head + "\n" + ",".join(f"{n}{i}" for n in order) + "\n")
    df = files.read_clients(spark, str(tmp_path))
    assert df.count() == 60
    wrong = [F.col(n) != F.concat(F.lit(n), F.regexp_extract("_ord.f", r"(\d+)\.csv$", 1)) for n in names]
    assert df.filter(" OR ".join(f"{n} IS NULL" for n in names)).isEmpty()
    assert df.filter(reduce(or_, wrong)).isEmpty()
