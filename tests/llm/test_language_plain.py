"""Language ID against a plain version: dictionaries of trigrams, and one cosine after the other."""

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sparkmart.llm import language_id

ODD = ["", "a", "A b", "ünï cödé", "ÀÉ", "1 2 3", "der die das " * 3000, "x" * 50000, "\x00tab\tand\nline", "日本語の文", "end "]


def plain_vector(text):
    """Square roots of the counts by cell; letters A-Z are lowered, other bytes below 128 than letters are blanks."""
    data = [32, *re.sub(rb"[\x00-\x60\x7b-\x7f]", b" ", text.encode().lower()), 32]
    cells = Counter(
        ((a << 16 | b << 8 | c) * 2654435761 % 2**32) >> 20 for a, b, c in zip(data, data[1:], data[2:]) if b != 32
    )
    return {cell: math.sqrt(n) for cell, n in cells.items()}


def plain_prediction(text, idf, centres, names):
    weighted = {cell: n * idf[cell] for cell, n in plain_vector(text).items()}
    length = math.sqrt(sum(w * w for w in weighted.values())) or 1.0
    cosines = [sum(w * centre[cell] for cell, w in weighted.items()) / length for centre in centres]
    best = max(cosines)
    return {name for name, c in zip(names, cosines) if c > best - 1e-5}, min(max(best, 0.0), 1.0)


@pytest.fixture(scope="module")
def table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    return docs.unionByName(spark.createDataFrame([(10**9 + n, t, None) for n, t in enumerate([*ODD, None])], docs.schema))


def test_predictions_are_those_of_the_nearest_centroid(table):
    classifier = language_id.fit(table)
    centres, names, idf = classifier.centres.astype(float), list(classifier.names), classifier.idf.astype(float)
    assert max(Counter(names).values()) > 1, "several centroids for a language"
    found = language_id.identify(table, classifier, ["doc_id"]).select("_doc.doc_id", "lang_pred", "score")
    got = {r.doc_id: r for r in found.collect()}
    rows = table.collect()
    assert len(got) == len(rows)
    for r in rows:
        if r.text is None or not any(c.isalpha() for c in r.text):
            assert (got[r.doc_id].lang_pred, got[r.doc_id].score) == (language_id.UNKNOWN, 0.0)
            continue
        nearest, score = plain_prediction(r.text, idf, centres, names)
        assert got[r.doc_id].lang_pred in nearest and abs(got[r.doc_id].score - score) < 1e-4


def test_frequencies_and_centroids_come_from_the_training_rows(table):
    train = table.filter(~language_id.held_out(F.col("doc_id")) & F.col("lang").isNotNull() & F.col("text").isNotNull()).limit(60).collect()
    vectors = np.concatenate(list(language_id.raw_vectors(pa.array([r.text for r in train]))))
    plain = [plain_vector(r.text) for r in train]
    for row, wanted in zip(vectors, plain):
        assert set(np.flatnonzero(row)) == set(wanted) and np.allclose([row[c] for c in wanted], list(wanted.values()), atol=1e-4)
    classifier = language_id.Classifier(vectors, [r.lang for r in train])
    holders = Counter(cell for wanted in plain for cell in wanted)
    for cell in range(0, language_id.DIMENSIONS, 37):
        assert abs(classifier.idf[cell] - (math.log((1 + len(train)) / (1 + holders[cell])) + 1)) < 1e-4
    assert np.allclose(np.linalg.norm(classifier.centres, axis=1), 1, atol=1e-4)
    assert set(classifier.names) == {r.lang for r in train}
    assert max(Counter(classifier.names).values()) <= language_id.CENTROIDS
