"""The stages on edge cases and on the smallest tables."""

import corpus_pipeline
from sparkmart.llm.queries import QUERIES, SQL


def test_stages(spark, docs, items, tmp_path):
    folder = str(tmp_path)
    items.write.parquet(f"{folder}/benchmark.parquet")
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        found = stage(spark, kept, folder)
        assert found.columns == docs.columns
        found.write.parquet(f"{folder}/{name}")
        kept = spark.read.parquet(f"{folder}/{name}")
    ids = [r.doc_id for r in kept.collect()]
    assert ids.count(19) <= 1 and not {1, 3, 4, 5, 6, 7} & set(ids) and 11 in ids


def test_run(spark, sf_dir):
    found = corpus_pipeline.run(spark, sf_dir)
    assert found.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert 0 < found.count() < spark.read.parquet(f"{sf_dir}/documents.parquet").count()


def test_names():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))
    assert set(SQL) <= set(QUERIES)
