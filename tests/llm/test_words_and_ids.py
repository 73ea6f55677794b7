"""Words that a weak hash takes for each other, and ids at both ends of BIGINT, against SQL."""

import numpy as np
import pyarrow as pa
import pytest

from conftest_llm import as_rows
from sparkmart.llm import decontaminate, exact_dedup, near_dedup, substring_dedup, suffix_dedup
from sparkmart.llm.words import BLANKS, cut
from test_llm_operators import by_sql

LONG = ["".join("ab"[(i.bit_count() + turn) % 2] for i in range(1024)) for turn in (0, 1)]
FEW = [f"p{i}" for i in range(13)]
MANY = [f"q{i}" for i in range(60)]


def texts(words):
    """Texts that are equal but for one word, which is one of two that a sum of powers can't tell apart."""
    return [" ".join(words[:6] + [long] + words[6:]) for long in LONG]


def test_words_have_hashes_of_their_own():
    words = ["x", "x\0", "x\0\0", "\0x", *LONG, "abcdefgh", "abcdefgha", "habcdefg", "abcdefghabcdefgh", "y" * 100000, "y" * 100001]
    found = cut(pa.array([" ".join(words), " ".join(reversed(words))]), BLANKS).hash
    assert len(set(found[: len(words)].tolist())) == len(words)
    assert np.array_equal(found[: len(words)], found[len(words) :][::-1])


@pytest.mark.parametrize(
    "run, sql, words",
    [
        (near_dedup.near_copies_report, near_dedup.SQL, FEW + ["end"]),
        (substring_dedup.substring_report, substring_dedup.SQL, FEW),
        (suffix_dedup.repeated_passages, suffix_dedup.SQL, MANY),
    ],
)
def test_long_words_and_outer_ids(spark, run, sql, words):
    one, two = texts(words)
    rows = [(-(1 << 63), one), ((1 << 63) - 1, one), (-5 * 10**18, two), (5 * 10**18, two), (1 << 62, one + " tail"), (0, "else " + two)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert as_rows(run(docs)) == by_sql(sql, docs)
    assert {r.doc_id for r in run(docs).collect()} <= {r[0] for r in rows}


def test_long_words_of_the_benchmark(spark):
    one, two = texts(FEW)
    docs = spark.createDataFrame([(-(1 << 63), one), ((1 << 63) - 1, two)], "doc_id bigint, text string")
    items = spark.createDataFrame([(1, one)], "item_id bigint, text string")
    assert as_rows(decontaminate.contamination_report(docs, items)) == by_sql(decontaminate.SQL, docs, items)


def test_rows_without_id_beside_the_least_id(spark):
    text = " ".join(MANY)
    rows = spark.createDataFrame([(None, text), (-(1 << 63), text + " a"), (7, text), (None, "other words")], "doc_id bigint, text string")
    near = {(r.doc_id, r.n_shingles): (r.component_id, r.kept) for r in near_dedup.near_copies_report(rows).collect()}
    assert near == {(None, 56): (None, True), (-(1 << 63), 57): (None, False), (7, 56): (None, False), (None, 1): (None, True)}
    assert near_dedup.drop_near_copies(rows).count() == 2
    assert {r.keep_id for r in exact_dedup.exact_dedup(rows).collect()} == {7, -(1 << 63), None}
    kept = {(r.doc_id, r.n_words): r.n_removed for r in substring_dedup.substring_dedup(rows).collect()}
    assert kept[None, 60] == 0 and kept[7, 60] == 60
