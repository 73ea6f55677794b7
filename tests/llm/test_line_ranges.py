"""Line deduplication over ranges: split ranges, the stream of a piece, bitmaps."""

from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from sparkmart.llm import line_dedup
from sparkmart.llm.common import store

HOT = "a line that nearly every document of this table has"
IDS = [-(1 << 63) + 1, -5, 0, (1 << 63) - 1]


@pytest.fixture(scope="module")
def skewed(spark):
    """3,000 documents: one line in nine of ten, lines of two to forty documents, own lines, one document of 500 equal lines."""
    rows = [
        (i, "\n".join([HOT.upper() if i % 2 else f"  {HOT} "] * (i % 10 > 0) + [f"shared by the documents of group {i % 200:040d}", f"own {i:060d}", "short", HOT]))
        for i in range(1, 3000)
    ]
    rows += [(i, f"{HOT}\nat the ends of the ids, and not short at all: {n // 2}") for n, i in enumerate(IDS)]
    rows += [(77777, "\n".join([HOT, ""] * 250)), (None, HOT), (5, HOT + "\nanother text of one id")]
    return spark.createDataFrame(rows, "doc_id bigint, text string").repartition(7)


def brute_force(rows):
    holders = defaultdict(set)
    key = lambda line: line.strip(" \t\n\x0b\x0c\r").lower()
    number = lambda i: line_dedup.NO_ID if i is None else i
    for i, text in rows:
        for line in text.split("\n"):
            if len(key(line)) >= 40:
                holders[key(line)].add(number(i))
    goes = lambda i, line: len(holders[key(line)]) >= 5 and number(i) != max(holders[key(line)])
    kept = [(i, [line for line in text.split("\n") if not goes(i, line)], len(text.split("\n"))) for i, text in rows]
    return sorted(((i, lines, n - len(lines)) for i, lines, n in kept), key=repr)


@pytest.mark.parametrize("rows_per_range", [3, 50, 700, 1 << 17])
def test_any_size_of_ranges_gives_the_same_rows(skewed, rows_per_range):
    found = line_dedup.line_dedup(skewed, rows_per_range=rows_per_range).collect()
    got = sorted(((r.doc_id, r._kept, r.n_dropped) for r in found), key=repr)
    assert got == brute_force([tuple(r) for r in skewed.collect()])


def test_a_hot_line_is_dealt_to_many_pieces(skewed):
    ranged = line_dedup.in_ranges(store(line_dedup.hashed_lines(skewed, 40)), 50)
    sizes = ranged.groupBy("_range", "_piece").count().agg(F.max("count")).first()[0]
    assert sizes < 600  # 500 equal lines of one document stay together, 2,700 documents of one line don't
    by_hash = ranged.groupBy("_h1").agg(F.count_distinct("_piece").alias("n")).agg(F.max("n")).first()[0]
    assert by_hash > 40


def test_the_stream_needs_no_shuffle_after_the_ranges(skewed):
    ranged = line_dedup.in_ranges(store(line_dedup.hashed_lines(skewed, 40)), 50)
    run = line_dedup.Window.partitionBy("_range", "_piece", "_h1", "_h2")
    streamed = ranged.withColumn("_nth", F.dense_rank().over(run.orderBy("_doc"))).withColumn("_docs", F.max("_nth").over(run))
    shown = streamed._jdf.queryExecution().executedPlan().toString()
    above = shown[: shown.index("rangepartitioning")]
    assert above.count("Exchange") == 1 and above.count("Sort [") == 1 and "PythonUDF" not in shown


def test_bitmaps_hold_the_lines_to_keep(skewed):
    bitmaps = line_dedup.keep_bitmaps(skewed.filter("doc_id in (77777, 1, 2, 3, 4)"))
    row = bitmaps.filter("_id = 4").first()
    kept = {w.word: w.bits for w in row.words}
    assert row.n_dropped == 2 and kept == {0: ((1 << 62) - 1) & ~0b10001}
