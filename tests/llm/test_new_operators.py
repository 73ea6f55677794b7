"""Merkle manifest, toxicity and the audit of filters: edge cases against SQL or a plain version of the rule."""

import hashlib
import zlib
from itertools import permutations

import pytest
from pyspark.sql import functions as F

from conftest_llm import as_rows
from sparkmart.llm import filter_audit, merkle, toxicity

duckdb = pytest.importorskip("duckdb")
FULL = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def with_sources(docs):
    number = F.coalesce("doc_id", F.lit(0))
    return docs.withColumn("source", F.when(number % 3 != 0, F.concat(F.lit("s"), number % 3))).withColumn(
        "n_chars", F.when(number % 5 != 0, F.length("text")).cast("bigint")
    )


def by_sql(sql, **tables):
    con = duckdb.connect()
    for name, df in tables.items():
        con.register(name, df.toPandas().astype({c: "Int64" for c, kind in df.dtypes if kind in ("bigint", "int")}))
    result = con.execute(sql)
    names = [c[0] for c in result.description]
    order = [names.index(n) for n in sorted(names)]
    return sorted((tuple(None if v is None or v != v else v for v in (row[i] for i in order)) for row in result.fetchall()), key=repr)


# --- Merkle manifest ---------------------------------------------------------


def plain_manifest(rows, groups):
    """Roots and proofs as lists of levels; ``rows`` are (group, leaf) in order."""
    H = lambda *parts: hashlib.sha256("".join(parts).encode()).hexdigest()

    def tree(leaves):
        proofs, at, level = [[] for _ in leaves], list(range(len(leaves))), list(leaves)
        while len(level) > 1:
            for i, place in enumerate(at):
                proofs[i] += level[place ^ 1 : (place ^ 1) + 1]
                at[i] = place // 2
            level = [H(*level[i : i + 2]) for i in range(0, len(level), 2)]
        return level[0], proofs

    subs = {g: tree([leaf for group, leaf in rows if group == g]) for g in groups}
    root, above = tree([subs[g][0] for g in groups])
    return {g: (subs[g][0], root, [H(*p, *above[i]) for p in subs[g][1]]) for i, g in enumerate(groups)}


def test_manifest_matches_sql(spark, docs):
    docs = with_sources(docs)
    got = merkle.manifest_report(docs)
    assert as_rows(got) == by_sql(merkle.SQL, documents=docs.select("doc_id", "text", "lang", "source", "n_chars"))


@pytest.mark.parametrize("counts", [{"a": 1}, {"a": 1, "b": 1025}, {None: 3, "": 2, "é": 2049, "z": 7}])
def test_manifest_of_many_shapes(spark, counts):
    groups = sorted(counts, key=lambda g: (g is not None, (g or "").encode()))
    rows = [(i * 7 - 20, f"t{i}", g, None, i) for i, g in enumerate(g for g in groups for _ in range(counts[g]))]
    field = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    leaf = lambda r: hashlib.sha256("".join(map(field, (r[0], r[3], r[2], r[4], r[1]))).encode()).hexdigest()
    expected = plain_manifest([(r[2], leaf(r)) for r in rows], groups)
    got = {r.doc_id: r for r in merkle.manifest_report(spark.createDataFrame(rows, FULL)).collect()}
    place = dict.fromkeys(groups, 0)
    for row in rows:
        sub, root, proofs = expected[row[2]]
        found = got[row[0]]
        assert (found.leaf, found.subroot, found.root, found.proof_sha256) == (leaf(row), sub, root, proofs[place[row[2]]])
        tampered = zlib.crc32(str(row[0]).encode()) % 7 == 0
        assert found.verified == (not tampered) == (found.folded_root == root)
        place[row[2]] += 1


def test_manifest_of_nothing_and_lost_rows(spark, empty):
    assert merkle.manifest_report(with_sources(empty)).count() == 0
    rows = spark.createDataFrame([(i, f"t{i}", "en", "s", 1) for i in range(5)], FULL)
    proven = merkle.manifest(rows)
    later = rows.filter("doc_id <> 2").withColumn("text", F.when(F.col("doc_id") == 4, "else").otherwise(F.col("text")))
    assert [(r.doc_id, r.verified) for r in merkle.verified(later, proven).orderBy("doc_id").collect()] == [
        (0, True), (1, True), (2, False), (3, True), (4, False)
    ]


# --- audit of filters --------------------------------------------------------


def plain_audit(rows, labels):
    from collections import Counter

    split = lambda t: [w for w in t.translate({c: " " for c in (9, 10, 11, 12, 13)}).split(" ") if w]

    def fails(doc_id, text):
        words = split(text)
        found = "A" * (len(words) < 50) + "B" * (100 * len(set(words)) < 65 * len(words))
        found += "C" * (100 * sum("A" <= c <= "Z" for c in text) > 5 * len(text)) + "D" * any(c in "#$%&*|" for c in text)
        return found + "E" * (doc_id is not None and any(i is not None and i < doc_id and (t or "") == text for i, t, _ in rows))

    judged = [((s or ""), fails(i, t or ""), i in labels and labels[i][0] == 1, i in labels and labels[i][1] == 1) for i, t, s in rows]
    out, shapley = [], Counter()
    for part in {j[0] for j in judged}:
        own = [j for j in judged if j[0] == part]
        for order in map("".join, permutations("ABCDE")):
            for step, name in enumerate(order, 1):
                earlier = lambda j: any(f in j[1] for f in order[: step - 1])
                here = [j for j in own if name in j[1] and not earlier(j)]
                kept = sum(name not in j[1] and not earlier(j) for j in own)
                shapley[part, name] += len(here)
                out.append((part, order, step, kept, len(here), sum(name in j[1] and earlier(j) for j in own), sum(j[1] == name for j in own),
                            sum(j[2] for j in here), sum(j[3] for j in here), name))
    return sorted((*r[:-1], shapley[r[0], r[-1]]) for r in out)


COLUMNS = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def test_audit_matches_brute_force(spark, docs):
    docs = with_sources(docs)
    labels = [(1, 1, 0), (2, 1, 1), (3, 0, 1), (14, None, 1), (14, 1, None), (None, 1, 1), (99, 1, 1), (12, 1, 0)]
    labelled = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    got = sorted(tuple(r) for r in filter_audit.audit_report(docs, labelled).select(COLUMNS).collect())
    known = {1: (1, 0), 2: (1, 1), 3: (0, 1), 14: (1, 1), 12: (1, 0)}
    rows = [(r.doc_id, r.text, r.source) for r in docs.collect()]
    assert got == plain_audit(rows, known)
    assert len(got) == 600 * len({r[0] for r in got})


def test_audit_of_copies_and_ties(spark, empty):
    shout = "A# " * 60
    rows = [(5, shout, "x"), (5, shout, "x"), (7, shout, ""), (7, shout, None), (None, shout, "x"), (None, None, "x"), (3, None, "x"), (4, "", "x")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    none = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    got = sorted(tuple(r) for r in filter_audit.audit_report(docs, none).select(COLUMNS).collect())
    assert got == plain_audit(rows, {})
    assert filter_audit.audit_report(with_sources(empty), none).count() == 0


# --- toxicity ----------------------------------------------------------------

CLEAN = [f"the weather on day {i} was calm and the number {w} bus came late" for i, w in enumerate(["red", "blue", "long", "short"] * 60)]
TOXIC = [f"you are a filthy{e} pest on day {i} and everybody knows it" for i, e in enumerate(["", "est", "ish", "ly"] * 60)]


def labelled(spark, texts):
    """Documents and labels of (text, toxic); ids count up."""
    rows = [(i, t, x) for i, (t, x) in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, toxic int").cache()


def test_held_out_accuracy(spark):
    rows = labelled(spark, [pair for both in zip(((t, 0) for t in CLEAN), ((t, 1) for t in TOXIC)) for pair in both])
    got = toxicity.toxicity_report(rows.drop("toxic"), rows.select("doc_id", "toxic")).join(rows, "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)
    assert any(r.held_out for r in got) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got)
    assert all(r.predicted == r.toxic for r in got if r.held_out)


def test_labels_of_held_out_rows_are_not_learned(spark):
    rows = labelled(spark, [pair for both in zip(((t, 0) for t in CLEAN), ((t, 1) for t in TOXIC)) for pair in both])
    flipped = rows.select("doc_id", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")).alias("toxic"))
    scores = lambda labels: as_rows(toxicity.toxicity_report(rows.drop("toxic"), labels))
    assert scores(flipped) == scores(rows.select("doc_id", "toxic"))


def test_swaps_do_not_change_scores(spark):
    """Most toxic texts name a group here and few clean ones do; only the penalty keeps the mention out of the score."""
    texts = [(t + " muslim", 1) for t in TOXIC[:200]] + [(t, 1) for t in TOXIC[200:]] + [(t, 0) for t in CLEAN[:230]] + [(t + " muslim", 0) for t in CLEAN[230:]]
    rows = labelled(spark, texts)
    neutral = spark.createDataFrame([(None, "a muslim family moved in next door"), (None, "a christian family moved in next door")], "doc_id bigint, text string")
    gap = {}
    for fairness in (0.0, 1.0):
        model = toxicity.fit(rows.drop("toxic"), rows.select("doc_id", "toxic"), fairness=fairness)
        a, b = (r.score for r in toxicity.score(neutral, model, ["doc_id"]).collect())
        gap[fairness] = (abs(a - b), a)
    assert gap[1.0][0] < 0.02 and gap[1.0][0] < gap[0.0][0] / 2
    assert gap[1.0][1] < toxicity.TOXIC_FROM


def test_counterfactual_swaps_whole_words():
    terms = {"x": ["gay", "straight"], "y": ["Frau", "frauen"]}
    assert toxicity.counterfactual("Gay men, gayly; STRAIGHT", terms) == "straight men, gayly; gay"
    assert toxicity.counterfactual("nothing", terms).split()[0] == "nothing" and len(toxicity.counterfactual("nothing", terms).split()) == 2
    assert toxicity.counterfactual("", {}) == ""


def plain_scores(model, text):
    data = bytes(b + 32 if 65 <= b <= 90 else b for b in (text or "").encode())
    words = "".join(chr(b) if 97 <= b <= 122 or b >= 128 else " " for b in data).split(" ")
    found = {f" {w} "[i : i + n].encode("latin-1") for w in words if w for n in toxicity.LENGTHS for i in range(len(w) + 3 - n)}
    keys = {int.from_bytes(g, "big") for g in found}
    odds = model.offset + sum(w for f, w in zip(model.features, model.weights) if int(f) in keys)
    return 1 / (1 + 2.718281828459045 ** -odds)


def test_scores_match_the_plain_rule(spark, docs, monkeypatch):
    rows = labelled(spark, [pair for both in zip(((t, 0) for t in CLEAN), ((t, 1) for t in TOXIC)) for pair in both])
    model = toxicity.fit(rows.drop("toxic"), rows.select("doc_id", "toxic"))
    more = spark.createDataFrame([(t,) for t in [TOXIC[0] + " " + "y" * 3000 + " pest", "PEST", "filthy\npest!", "é filthÿ", None, ""]], "text string")
    for df in (docs.select("text"), more):
        got = toxicity.score(df, model, ["text"]).collect()
        assert [r.score for r in got] == pytest.approx([plain_scores(model, r._doc.text) for r in got], abs=1e-9)


def test_nothing_to_learn(spark, docs, empty):
    none = spark.createDataFrame([(1, None), (None, 1)], "doc_id bigint, toxic int")
    got = toxicity.toxicity_report(docs, none)
    assert got.count() == docs.count() and {r.score for r in got.collect()} == {0.5}
    one_kind = spark.createDataFrame([(i, 0) for i in range(20)], "doc_id bigint, toxic int")
    assert {r.predicted for r in toxicity.toxicity_report(docs, one_kind).collect()} == {0}
    assert toxicity.toxicity_report(empty, none).count() == 0
