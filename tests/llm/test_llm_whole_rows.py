"""Rows that share an id but not a text are each judged on their own text."""

from sparkmart.llm import decontaminate, near_dedup

WORDS = [f"w{i}x" for i in range(400)]


def test_decontamination_of_equal_ids_in_several_blocks(spark, items):
    bad = " ".join(WORDS[30:60])
    good = " ".join(f"z{i}" for i in range(30))
    other = " ".join(f"y{i}" for i in range(30))
    rows = [(i, text) for i in (None, 7) for text in (bad, good, other, bad, None, "")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    for block_bytes in (256, 1 << 20):
        found = decontaminate.benchmark_matches(docs, items, docs.columns, block_bytes=block_bytes)
        got = sorted((repr(r._doc.doc_id), repr(r._doc.text), r.n_hit) for r in found.collect())
        assert got == sorted((repr(i), repr(text), 30 if text == bad else 0) for i, text in rows)
        found = decontaminate.benchmark_matches(docs, items, ["doc_id"], block_bytes=block_bytes)
        got = sorted((repr(r._doc.doc_id), r.n_words, r.n_hit) for r in found.collect())
        assert got == sorted((repr(i), len((text or "").split()), 30 if text == bad else 0) for i, text in rows)


def test_near_copies_of_repeated_ids(spark):
    text = lambda name: " ".join(f"{name}{i}" for i in range(120))
    near = lambda name: text(name) + " changed"
    rows = [
        (3, text("a")),
        (5, near("a")),  # a near copy of 3, under an id with a text of its own
        (5, text("b")),
        (6, text("c")),
        (6, text("a")),  # equal to 3
        (7, text("d")),
        (7, text("e")),
        (8, near("d")),
        (8, near("e")),
        (8, text("f")),
        (None, text("g")),
    ]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    gone = {(5, near("a")), (6, text("a")), (8, near("d")), (8, near("e"))}
    kept = {(r.doc_id, r.text) for r in near_dedup.drop_near_copies(docs).collect()}
    assert kept == set(rows) - gone
    found = sorted((r.doc_id or 0, r.component_id or 0, r.kept) for r in near_dedup.near_copies_report(docs).collect())
    assert found == [
        (0, 0, True), (3, 3, True), (5, 3, False), (5, 5, True), (6, 3, False), (6, 6, True),
        (7, 7, True), (7, 7, True), (8, 7, False), (8, 7, False), (8, 8, True),
    ]
