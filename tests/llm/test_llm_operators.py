"""Every operator on edge cases, against a plain version of its rule or its SQL."""

import hashlib
import re

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from conftest_llm import as_rows
from sparkmart.llm import bpe, decontaminate, exact_dedup, language_id, line_dedup, near_dedup, secrets, substring_dedup, suffix_dedup, token_counts
from sparkmart.llm.components import connected_components
from sparkmart.llm.queries import BYTE_BPE, PIECES


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def by_sql(sql, docs, items=None):
    con = duckdb.connect()
    con.register("documents", pa.Table.from_pylist([r.asDict() for r in docs.select("doc_id", "text").collect()], schema=pa.schema([("doc_id", pa.int64()), ("text", pa.string())])))
    if items is not None:
        con.register("benchmark", pa.Table.from_pylist([r.asDict() for r in items.collect()]))
    found = con.execute(sql)
    names = [c[0] for c in found.description]
    return sorted((tuple(dict(zip(names, row))[n] for n in sorted(names)) for row in found.fetchall()), key=repr)


def with_ids(docs):
    """Rows as the SQL has them: with an id, and each once."""
    return docs.filter("doc_id is not null").dropDuplicates(["doc_id"])


@pytest.mark.parametrize(
    "run, sql",
    [
        (near_dedup.near_copies_report, near_dedup.SQL),
        (exact_dedup.exact_dedup, exact_dedup.SQL),
        (line_dedup.line_dedup_digests, line_dedup.SQL),
        (substring_dedup.substring_report, substring_dedup.SQL),
        (suffix_dedup.repeated_passages, suffix_dedup.SQL),
    ],
)
def test_against_sql(docs, empty, run, sql):
    rows = with_ids(docs)
    assert as_rows(run(rows)) == by_sql(sql, rows)
    assert run(docs).count() >= len(by_sql(sql, rows)) - 1  # null ids and repeated rows do no harm
    assert run(empty).count() == 0


def test_decontamination(docs, items, empty):
    rows, named = with_ids(docs), items.filter("item_id is not null")
    assert as_rows(decontaminate.contamination_report(rows, named)) == by_sql(decontaminate.SQL, rows, named)
    one = as_rows(decontaminate.contamination_report(docs, items))
    assert one == as_rows(decontaminate.benchmark_matches(docs, items, ["doc_id"], block_bytes=64).selectExpr(
        "_doc.doc_id", "n_words", "n_hit", "cast(size(items) as bigint) n_items", "sha2(array_join(items, ','), 256) items_sha256",
        "n_hit > 0 and 20 * n_hit >= n_words contaminated"))
    clean = decontaminate.decontaminate(docs, items)
    assert clean.columns == docs.columns and 0 < clean.count() < docs.count()
    assert decontaminate.decontaminate(docs, items.limit(0)).count() == docs.count()
    assert decontaminate.contamination_report(empty, items).count() == 0


def test_token_counts(docs, empty):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    expected = sorted(((r.doc_id, len((r.text or "").encode()), len(model.encode(r.text or ""))) for r in docs.collect()), key=repr)
    for frequent in (3, 1 << 12):  # whatever the table holds
        found = token_counts.count_tokens(docs, PIECES, frequent)
        assert sorted((tuple(r) for r in found.collect()), key=repr) == expected
    assert token_counts.token_report(empty, PIECES).count() == 0


def test_bpe(docs, empty):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    expected = sorted(
        ((r.doc_id, library.encode(r.text or "", add_special_tokens=False).ids, r.text or "") for r in docs.collect()), key=repr
    )
    assert sorted((tuple(r) for r in bpe.encode_decode(docs, BYTE_BPE).collect()), key=repr) == expected
    assert bpe.encoding_digests(empty, BYTE_BPE).count() == 0


def plain_base(text):
    kinds = [
        ("assign", r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", lambda m: len(m[1]) >= 12),
        ("access", r"AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 18),
        ("hex", r"[0-9a-f]+", lambda m: len(m[0]) >= 16),
    ]
    spans = [
        (m.start(), k, f"{name}:{m.start()}:{m.end()}")
        for k, (name, pattern, good) in enumerate(kinds)
        for m in re.finditer(pattern, text, re.ASCII | (re.IGNORECASE if k == 0 else 0))
        if good(m)
    ]
    return ",".join(s[2] for s in sorted(spans))


def test_secrets(docs, empty):
    found = {(r.doc_id, r.base_sha256): r for r in secrets.secret_report(docs).collect()}
    for row in docs.collect():
        assert (row.doc_id, sha(plain_base(row.text or ""))) in found
    spans = [s for r in found.values() for s in r.spans.split(",") if s]
    assert any(s.startswith("propagated:") for s in spans)
    assert secrets.secret_report(empty).count() == 0
    assert secrets.lexed_spans("Note: the password is long; time: 12:30, a = b") == []


def test_language(docs, empty, spark, sf_dir):
    found = {(r.doc_id, r.lang_pred): r for r in language_id.language_report(docs).collect()}
    assert all((i, "und") in found for i in (4, 5, 6, 7))
    assert all(0 <= r.score <= 1 for r in found.values())
    assert language_id.keep_identified(docs).columns == docs.columns
    assert language_id.language_report(empty).count() == 0
    table = spark.read.parquet(f"{sf_dir}/documents.parquet")
    judged = language_id.language_report(table).join(table, "doc_id").filter("held_out").selectExpr("avg(cast(lang = lang_pred as int)) a", "sum(cast(rejected as int)) r")
    accuracy, rejected = judged.first()
    assert accuracy > 0.97 and rejected == 0


def test_filters_keep_columns(docs):
    exact = exact_dedup.drop_copies(docs)
    assert exact.columns == docs.columns
    assert sorted(r.doc_id for r in exact.filter("doc_id in (1, 2, 19)").collect()) == [2, 19]
    near = near_dedup.drop_near_copies(exact)
    assert near.columns == docs.columns
    assert [r.doc_id for r in near.filter("doc_id in (1, 2, 3)").collect()] == [2]


def test_short_blocks_name_exactly(spark):
    texts = ["", "a", "aaaaaaaa", "aaaaaaab", "aaaaaaaa", "baaaaaaa", "aaaaaaaaa", "aaaaaaaaa", "a" * 33, "a" * 33, "a" * 32 + "b"]
    rows = spark.createDataFrame(list(enumerate(texts)), "_row bigint, _text string")
    names = {r._row: (r._bytes, r._name) for r in exact_dedup.block_names(rows, block_bytes=4).collect()}
    for i, a in enumerate(texts):
        for j, b in enumerate(texts):
            assert (names[i] == names[j]) == (a == b)


def test_near_copies_in_one_large_group(spark, monkeypatch):
    """Members that are not linked with the least one of their bucket; blocks smaller than the bucket."""
    monkeypatch.setattr(near_dedup, "BLOCK", 7)
    rng = np.random.default_rng(1)
    base = [f"g{i}" for i in range(120)]
    rows = []
    for i in range(60):
        words = list(base)
        for at in rng.choice(120, size=int(rng.integers(0, 5)), replace=False):
            words[at] = f"n{i}"
        rows.append((i, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert as_rows(near_dedup.near_copies_report(docs)) == by_sql(near_dedup.SQL, docs)


def test_components(spark):
    links = [(i, i + 1) for i in range(1, 60)] + [(100, 101), (101, 102), (200, 200)]
    found = dict(tuple(r) for r in connected_components(spark.createDataFrame(links, "a bigint, b bigint")).collect())
    assert found == {**{i: 1 for i in range(1, 61)}, 100: 100, 101: 100, 102: 100}


def test_hot_anchors_change_nothing(docs, monkeypatch):
    from sparkmart.llm import repeats

    rows = with_ids(docs)
    expected = as_rows(substring_dedup.substring_report(rows))
    monkeypatch.setattr(repeats, "HOT", 1)
    assert as_rows(substring_dedup.substring_report(rows)) == expected
    assert as_rows(suffix_dedup.repeated_passages(rows)) == by_sql(suffix_dedup.SQL, rows)


def test_language_of_repeated_rows(spark):
    rows = [(1, "le chat dort sur le lit", "fr")] * 400 + [(i, f"the dog number {i} sleeps on the bed", "en") for i in range(2, 402)]
    table = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").filter(~language_id.held_out(F.col("doc_id")))
    learned = language_id.fit(table, sample=20)
    assert set(learned.names) == {"en", "fr"}
    found = language_id.identify(table, learned, ["lang"]).filter("lang_pred <> _doc.lang").count()
    assert found == 0
