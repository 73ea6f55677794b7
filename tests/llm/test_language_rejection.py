"""Language rejection by the distances of training rows."""

import random

import pytest
from pyspark.sql import functions as F

from sparkmart.llm import language_id

SHORT = ["ok", "hi", "no.", "a"]


@pytest.fixture(scope="module")
def table(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def test_gibberish_is_rejected_and_short_texts_are_not(spark, table):
    rng = random.Random(3)
    some = lambda first, last, n: "".join(chr(rng.randint(first, last)) for _ in range(n))
    far = [some(0x61, 0x7A, 2000), some(0x4E00, 0x9FFF, 500), some(0x430, 0x44F, 300), " ".join(some(0x61, 0x7A, 6) for _ in range(200))]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate([*far, *SHORT])], "doc_id bigint, text string")
    learned = language_id.fit(table)
    found = {r._doc.text: r for r in language_id.identify(docs, learned, ["text"]).collect()}
    assert all(found[t].rejected for t in far)
    assert not any(found[t].rejected for t in SHORT)
    known = language_id.identify(table, learned, ["doc_id", "lang"]).filter("_doc.lang is not null")
    assert known.filter(F.col("rejected") & language_id.held_out(F.col("_doc.doc_id"))).count() == 0
    assert known.filter("not rejected").count() >= 0.98 * known.count()


def test_both_ends_give_trigrams():
    import pyarrow as pa

    texts = ["ok", "", "a", None, "ab cd", "!?", "ab", "ok"]
    raw = next(language_id.raw_vectors(pa.array(texts, pa.string())))
    assert [round(float(n)) for n in (raw**2).sum(axis=1)] == [2, 0, 1, 0, 4, 0, 2, 2]
    assert (raw[0] == raw[7]).all()
