import random
from collections import Counter, defaultdict
from datetime import date

import pytest
from pyspark.sql import functions as F

from helpers import plan, rows
from sparkmart.operators import dedup, keys, lookup, order_stats, scd, skills
from sparkmart.sources.references import city_variants, flatten_skills


def test_keep_last_breaks_ties_and_groups_nulls(spark):
    data = [("a", 1, 1), ("a", 2, 1), ("a", 2, 2), (None, 1, 1), (None, 5, 1), ("b", None, 9), ("b", 0, 1)]
    df = spark.createDataFrame(data, "k string, t int, u int")
    kept = dedup.keep_last(df, ["k"], [F.col("t"), F.col("u")])
    assert rows(kept) == sorted([("a", 2, 2), (None, 5, 1), ("b", 0, 1)], key=repr)
    again = dedup.keep_last(kept, ["k"], [F.col("t"), F.col("u")])
    assert rows(again) == rows(kept)


def test_keep_last_limits_rows_before_the_shuffle(spark):
    df = spark.range(1000).selectExpr("id % 3 AS k", "id AS t")
    text = plan(dedup.keep_last(df, ["k"], [F.col("t")]))
    before_shuffle = text[text.index("Exchange hashpartitioning") :]
    assert "WindowGroupLimit" in before_shuffle


def test_keep_last_hot_key(spark):
    df = spark.range(30000).selectExpr("if(id % 3 = 0, -1, id) AS k", "id AS t")
    kept = {r.k: r.t for r in dedup.keep_last(df, ["k"], [F.col("t")]).collect()}
    assert len(kept) == 20001 and kept[-1] == 29997


def test_surrogate_keys_are_dense_and_ordered(spark):
    df = spark.range(5000).selectExpr("cast(uuid() AS string) AS nk").cache()
    keyed = keys.with_surrogate_key(df, "sk", ["nk"], first=2).collect()
    in_order = sorted(keyed, key=lambda r: r.nk)
    assert [r.sk for r in in_order] == list(range(2, 5002))


def test_surrogate_keys_over_many_partitions(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        keyed = keys.with_surrogate_key(spark.range(1000).selectExpr("1000 - id AS nk"), "sk", ["nk"])
        assert keyed.rdd.getNumPartitions() == 4
        assert keyed.filter("sk <> nk").count() == 0
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_surrogate_keys_of_nothing(spark):
    assert keys.with_surrogate_key(spark.range(0), "sk", ["id"]).collect() == []


def test_surrogate_keys_need_no_single_task(spark):
    assert "SinglePartition" not in plan(keys.with_surrogate_key(spark.range(100), "sk", ["id"]))


def exact_quantile(values, share):
    ordered = sorted(values)
    at = share * (len(ordered) - 1)
    low = int(at)
    high = min(low + 1, len(ordered) - 1)
    return ordered[low] + (ordered[high] - ordered[low]) * (at - low)


@pytest.mark.parametrize("seed", [1, 2])
def test_quantiles_against_sorting(spark, seed):
    rng = random.Random(seed)
    data = [("hot", rng.choice([5.0, 5.0, rng.uniform(-100, 100), float(rng.randint(0, 3))])) for _ in range(3000)]
    data += [(None, rng.uniform(1e6, 1e6 + 1)) for _ in range(500)] + [("one", -7.5), ("two", 0.0), ("two", 1e-9)]
    data += [("nulls", None)]
    df = spark.createDataFrame(data, "g string, v double")
    wanted = {"q1": 0.25, "m": 0.5, "q3": 0.75, "lo": 0.0, "hi": 1.0}
    got = {r._group.g: r for r in order_stats.quantiles(df, ["g"], "v", wanted).collect()}
    groups = defaultdict(list)
    for g, v in data:
        if v is not None:
            groups[g].append(v)
    assert set(got) == set(groups)
    for g, values in groups.items():
        for name, share in wanted.items():
            assert got[g][name] == pytest.approx(exact_quantile(values, share), rel=1e-12)


def test_quantiles_of_many_groups(spark):
    df = spark.range(1000).selectExpr("id % 7 AS g", "cast(id AS double) AS v")
    got = {r._group.g: r.m for r in order_stats.quantiles(df, ["g"], "v", {"m": 0.5}).collect()}
    assert got == {g: exact_quantile([float(i) for i in range(1000) if i % 7 == g], 0.5) for g in range(7)}


def test_rank_with_ties(spark):
    rng = random.Random(3)
    data = [(rng.choice(["a", "b", None]), i, rng.choice([0, 0, 0, 1, 2, 10, 1000, 1001, -5])) for i in range(900)]
    df = spark.createDataFrame(data, "g string, i int, v int")
    got = {r.i: r.rk for r in order_stats.rank_in_group(df, ["g"], "v", "rk").collect()}
    by_group = defaultdict(list)
    for g, _, v in data:
        by_group[g].append(v)
    assert got == {i: 1 + sum(x > v for x in by_group[g]) for g, i, v in data}


def test_rank_of_nulls_and_endless_values(spark):
    values = [5.0, None, float("inf"), float("-inf"), None, float("nan"), 5.0, 0.0]
    df = spark.createDataFrame(list(enumerate(values)), "i int, v double").withColumn("g", F.lit("g"))
    got = {r.i: r.rk for r in order_stats.rank_in_group(df, ["g"], "v", "rk").collect()}
    assert got == {5: 1, 2: 2, 0: 3, 6: 3, 7: 5, 3: 6, 1: 7, 4: 7}
    median = order_stats.quantiles(df, ["g"], "v", {"m": 0.5, "hi": 0.8}).first()
    assert median.m == 5.0 and median.hi == float("inf")


def test_bucket_never_decreases(spark):
    values = sorted([0.0, 1e-300, 9.999e-5, 0.001, 0.99999, 1.0, 9.9999, 10.0, 999.9999999999999, 1000.0, 1e300] + [-x for x in (1e300, 1000.0, 999.99, 1.0, 1e-7)])
    df = spark.createDataFrame([(v,) for v in values], "v double")
    buckets = [r[0] for r in df.orderBy("v").select(order_stats._bucket(F.col("v"))).collect()]
    assert buckets == sorted(buckets)


def test_lookups(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "k string")
    dim = spark.createDataFrame([("a", 10)], "nk string, sk int")
    assert rows(lookup.resolve_key(df, "k", dim, "nk", "sk", "r")) == [("a", 10)]
    got = rows(lookup.resolve_key_or(df, "k", dim, "nk", "sk", "r", 1))
    assert got == sorted([("a", 10), ("b", 1), (None, 1)], key=repr)
    assert rows(lookup.unmatched(df, "k", dim, "nk")) == sorted([("b",), (None,)], key=repr)
    lookup.require_unique(dim, "nk")
    with pytest.raises(ValueError):
        lookup.require_unique(dim.union(dim), "nk")


def test_city_variants(spark):
    regions = spark.createDataFrame(
        [("fes", "Fès"), ("elhajeb", "El Hajeb"), ("kenitra", "Kénitra"), ("x1", "Doublon"), ("x2", "Doublon")],
        "code_ville string, nom_ville_standard string",
    )
    table = {r.variant: r.city for r in city_variants(regions).collect()}
    assert table["fès"] == table["fez"] == "Fès" and table["el hajeb"] == "El Hajeb" and table["casa"] == "Casablanca"
    assert city_variants(regions).groupBy("variant").count().filter("count > 1").isEmpty()


def test_city_lookup_is_not_a_shuffle_of_the_orders(spark, sf_dir):
    from bindings import sources as src
    from bindings.warehouse import _cities
    from sparkmart.plans.orders import standard_cities

    cities = standard_cities(src.dirty_orders(spark, sf_dir), _cities(spark, sf_dir))
    assert "SortMergeJoin" not in plan(cities)


DICTIONARY = [
    ("python", "python", "langages"), ("py", "python", "langages"), ("r", "r", "langages"), ("r-studio", "r", "langages"),
    ("node.js", "javascript", "langages"), ("js", "javascript", "langages"), ("power bi", "power_bi", "bi"), ("sql", "sql", "langages"),
]
TEXTS = {
    1: "Python, PY et r-studio", 2: "nodexjs erreur étér", 3: "NODE.JS / Power BI", 4: "", 5: None, 6: "powerbi power  bi mysql",
    7: "langage R.", 8: "(js)", 9: "sql_x x_sql sql2",
}
EXPECTED = {1: {"python", "r"}, 2: set(), 3: {"javascript", "power_bi"}, 4: set(), 5: set(), 6: set(), 7: {"r"}, 8: {"javascript"}, 9: set()}


def skill_input(spark):
    docs = spark.createDataFrame(list(TEXTS.items()), "i int, t string")
    return docs, spark.createDataFrame(DICTIONARY, "alias string, competence string, famille string")


def expected_skills():
    return sorted(((i, s) for i, found in EXPECTED.items() for s in (found or {"non_détecté"})), key=repr)


def test_skills_by_pattern(spark):
    docs, dictionary = skill_input(spark)
    got = skills.extract_skills(docs, skills.offer_text("t"), dictionary, [F.col("i")])
    assert rows(got.select("i", "competence")) == expected_skills()
    assert "Python" not in plan(got) and "Exchange" not in plan(got)


def test_skills_by_join_agree(spark):
    docs, dictionary = skill_input(spark)
    got = skills.extract_skills_by_join(docs, "i", skills.offer_text("t"), dictionary, ["i"])
    assert rows(got.select("i", "competence")) == expected_skills()


def test_one_family_a_skill_and_word_boundaries_on_both_paths(spark):
    """Aliases of four words and with signs at their end, a skill in two families."""
    rows_ = [
        ("ml", "ml", "short"), ("machine learning ops team", "ml", "long"), ("c++", "cpp", "langages"), ("c#", "csharp", "langages"),
        ("#tag", "tag", "web"),
    ]
    dictionary = spark.createDataFrame(rows_, "alias string, competence string, famille string")
    texts = {1: "ml, Machine Learning Ops team", 2: "ml", 3: "c++ and c#", 4: "c++x a#tag", 5: "#tag"}
    docs = spark.createDataFrame(list(texts.items()), "i int, t string")
    expected = [(1, "ml", "long"), (2, "ml", "short"), (4, "cpp", "langages"), (4, "tag", "web")]
    expected += [(i, "non_détecté", "inconnu") for i in (3, 5)]
    text = skills.offer_text("t")
    for got in (skills.extract_skills(docs, text, dictionary, [F.col("i")]), skills.extract_skills_by_join(docs, "i", text, dictionary, ["i"])):
        assert rows(got.select("i", "competence", "famille")) == sorted(expected, key=repr)


def test_large_dictionaries_on_both_paths(spark):
    big = spark.range(700).selectExpr("concat('w', id) alias", "concat('s', id) competence", "'f' famille")
    docs = spark.range(3).selectExpr("id AS i", "concat('w', id * 300, ' w', id * 300 + 9) AS t")
    expected = sorted(((i, f"s{i * 300 + k}") for i in range(3) for k in (0, 9)), key=repr)
    for got in (skills.extract_skills(docs, F.col("t"), big, [F.col("i")]), skills.extract_skills_by_join(docs, "i", F.col("t"), big, ["i"])):
        assert rows(got.select("i", "competence")) == expected


def test_skill_dictionary_later_alias_wins(spark):
    families = spark.createDataFrame(
        [({"a": {"one": ["X", "y"]}, "b": {"two": ["x", "z"]}},)], "familles map<string, map<string, array<string>>>"
    )
    got = {r.alias: (r.competence, r.famille) for r in flatten_skills(families).collect()}
    assert got == {"x": ("two", "b"), "y": ("one", "a"), "z": ("two", "b")}


def test_scd2_merge_twice(spark):
    first = spark.createDataFrame(
        [(1, "a", "x", date(2020, 1, 1), date(9999, 12, 31), True), (2, "b", None, date(2020, 1, 1), date(9999, 12, 31), True)],
        "sk bigint, nk string, v string, date_debut date, date_fin date, est_actif boolean",
    )
    second = spark.createDataFrame([("a", "x2"), ("b", None), ("c", "n")], "nk string, v string")
    merged = scd.merge_versions(first, second, "nk", "sk", ["v"], date(2024, 1, 1))
    got = {(r.sk, r.nk, r.v, r.est_actif) for r in merged.collect()}
    assert got == {(1, "a", "x", False), (2, "b", None, True), (3, "a", "x2", True), (4, "c", "n", True)}
    closed = merged.filter("NOT est_actif").first()
    assert closed.date_fin == date(2024, 1, 1)
    again = scd.merge_versions(merged, second, "nk", "sk", ["v"], date(2025, 1, 1))
    assert rows(again) == rows(merged)


def test_value_distribution(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,)], "c string")
    assert Counter(dict((r.c, r.nb) for r in dedup.value_distribution(df, "c").collect())) == Counter({"a": 2, None: 1})
    assert rows(dedup.distinct_values(df, "c", exclude=["z"])) == [("a",)]


def test_merge_twice_with_a_null_key_and_an_untracked_column(spark):
    start = scd.version_columns(F.lit("2024-01-01").cast("date"))
    first = spark.createDataFrame([(1, "a", 1, "x"), (2, None, 2, "y"), (3, "c", 3, "z")], "sk bigint, k string, t int, extra string")
    incoming = spark.createDataFrame([("a", 9), (None, 2), ("d", 4)], "k string, t int")
    merge = lambda dimension: scd.merge_versions(dimension, incoming, "k", "sk", ["t"], date(2024, 6, 1))
    once = merge(first.withColumns(start))
    rows = {(r.k, r.t, r.extra, r.est_actif) for r in once.collect()}
    assert rows == {("a", 1, "x", False), ("a", 9, "x", True), (None, 2, "y", True), ("c", 3, "z", True), ("d", 4, None, True)}
    assert sorted(map(str, merge(once).collect())) == sorted(map(str, once.collect()))


def test_dictionary_of_any_size_stays_out_of_the_plan(spark):
    """100,000 aliases of one to three words: few runs pass the filter, and no alias is in the plan."""
    big = spark.range(100_000).selectExpr("concat('w', id, if(id % 3 = 0, ' x', ''), if(id % 6 = 0, ' y', '')) alias", "concat('s', id) competence", "'f' famille")
    docs = spark.range(40).selectExpr("id AS i", "concat_ws(' ', transform(sequence(0, 200), k -> concat('v', k)), concat('w', id * 600, ' x y.'), concat('w', id * 600 + 3, ' y'), 'w1x') AS t")
    held, longest = skills._filter_of(big)
    assert longest == 5 and len(held) <= skills._MOST_BITS // 8
    runs = docs.select(F.size(skills.candidate_runs(F.col("t"), held, longest)).alias("n")).agg(F.sum("n")).first()[0]
    assert 40 <= runs < 100  # of some 40,000 runs
    got = skills.extract_skills_of_any(docs, F.col("t"), big, [F.col("i")])
    assert rows(got.select("i", "competence")) == sorted(((i, f"s{i * 600}") for i in range(40)), key=repr)
    assert "s600" not in plan(got) and "w600" not in plan(got)


def test_days_in_periods(spark):
    """Against counting: overlaps, one day, long, turned round, null and from before 1970; no nested loop."""
    from sparkmart.operators.periods import with_periods

    days = [date(1969, 12, 20), date(1970, 1, 1), date(2024, 2, 29), date(2024, 3, 1), date(2024, 3, 9), date(2030, 1, 1), None, date(2024, 3, 1)]
    spans = [(date(1969, 12, 1), date(2024, 3, 1)), (date(2024, 2, 29), date(2024, 2, 29)), (date(2024, 3, 9), date(2024, 3, 1))]
    spans += [(date(2024, 3, 1), date(2024, 3, 31))] * 3 + [(None, date(2024, 3, 1)), (date(2024, 3, 1), None)]
    df = spark.createDataFrame([(i, d) for i, d in enumerate(days)], "i int, d date")
    got = with_periods(df, "d", spark.createDataFrame(spans, "a date, b date"), "a", "b")
    expected = [(i, d, sum(a is not None and b is not None and d is not None and a <= d <= b for a, b in spans)) for i, d in enumerate(days)]
    assert rows(got) == sorted(expected, key=repr)
    assert "NestedLoop" not in plan(got) and "Cartesian" not in plan(got)
