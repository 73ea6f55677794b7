from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from helpers import one_column, plan
from sparkmart import fixed_values as fv
from sparkmart.functions import dates, numbers, offers, text
from sparkmart.functions.mapping import map_values, standard_value
from sparkmart.plans.silver import profile_of
from sparkmart.settings import LakeSettings

D = date


def evaluate(spark, values, expression, kind="string"):
    return [r[0] for r in one_column(spark, values, kind).select(expression(F.col("v"))).collect()]


@pytest.mark.parametrize(
    "value, expected",
    [
        ("2024-03-05", D(2024, 3, 5)), ("05/03/2024", D(2024, 3, 5)), ("Mar 05 2024", D(2024, 3, 5)),
        ("03/25/2024", D(2024, 3, 25)), ("2024-13-05", D(2024, 5, 13)), ("31/02/2024", None), ("bad", None),
        (None, None), ("", None), ("       ", None), ("5/3/2024", D(2024, 3, 5)), (" 2024-03-05 ", D(2024, 3, 5)),
        ("2024-03-05 10:00:00", D(2024, 3, 5)), ("05.03.2024", D(2024, 3, 5)), ("OCT 05 2024", D(2024, 10, 5)),
        ("Foo 05 2024", None), ("13/13/2024", None), ("12345", None), ("29/02/2023", None),
        ("2024-03-05 10:00:00.000", D(2024, 3, 5)), ("2024-03-05T10:00:00.123456", D(2024, 3, 5)), ("  2024-03-05 10:00:00", D(2024, 3, 5)),
        ("05/03/24", D(2024, 3, 5)), ("20240305", D(2024, 3, 5)), ("March 5 2024", D(2024, 3, 5)), ("05 March 2024", D(2024, 3, 5)),
        ("5 September 2024 10:30", D(2024, 9, 5)), ("2024-03-05 10:00:00 and more", None),
        ("2024-03-05 plus", None), ("05/03/2024 plus", None), ("05/03/2024 10:30", D(2024, 3, 5)),
    ],
)
def test_mixed_date(spark, value, expected):
    assert evaluate(spark, [value], dates.mixed_date) == [expected]


def test_iso_date_is_strict(spark):
    values = ["2024-03-05", "05/03/2024", "2024-3-5", "2024-02-30", "2024", None]
    assert evaluate(spark, values, dates.iso_date) == [D(2024, 3, 5), None, None, None, None, None]


def test_days_between_and_defaults(spark):
    df = spark.createDataFrame([(D(2024, 1, 1), D(2024, 1, 4)), (D(2024, 1, 4), D(2024, 1, 1)), (D(2024, 1, 4), None)], "a date, b date")
    assert [r[0] for r in df.select(dates.days_between(F.col("a"), F.col("b"))).collect()] == [3, None, None]
    as_of = D(2024, 6, 30)
    defaulted = evaluate(spark, [D(2024, 6, 30), D(2024, 7, 1), None], lambda c: dates.default_date(c, as_of), "date")
    assert defaulted == [as_of, as_of, as_of]


def test_calendar_columns(spark):
    row = one_column(spark, [D(2024, 12, 30)], "date").select(
        *[c.alias(n) for n, c in dates.calendar_columns(F.col("v")).items()]
    ).first()
    assert tuple(row) == (20241230, 30, 12, 4, 2024, 1, "Monday", "December", "T4 2024", False)


def test_holidays_and_periods(spark):
    days = [D(2022, 1, 1), D(2021, 1, 1), D(2024, 3, 10), D(2024, 4, 9), D(2024, 4, 10)]
    holiday = evaluate(spark, days, lambda c: dates.fixed_holiday(c, fv.HOLIDAY_MONTH_DAYS, fv.HOLIDAY_YEARS), "date")
    ramadan = evaluate(spark, days, lambda c: dates.in_periods(c, fv.RAMADAN_PERIODS), "date")
    assert holiday == [True, False, False, False, False]
    assert ramadan == [False, False, True, True, False]


def test_title_case_after_any_non_letter(spark):
    values = ["el-hajeb l'or", "x1y", "ÉCOLE été", "ßa", "", None]
    assert evaluate(spark, values, text.title_case) == ["El-Hajeb L'Or", "X1Y", "École Été", "Ssa", "", None]


def test_strip_and_squeeze(spark):
    assert evaluate(spark, ["  a \t　", None], text.strip) == ["a", None]
    assert evaluate(spark, ["  a   b\n\nc  "], text.squeeze) == ["a b c"]


def test_full_name(spark):
    df = spark.createDataFrame([("jean-luc ", " el amrani"), (None, "tazi"), ("sara", None), (None, None)], "p string, n string")
    names = [r[0] for r in df.select(text.full_name(F.col("p"), F.col("n"))).collect()]
    assert names == ["Jean-Luc El Amrani", "Tazi", "Sara", ""]


def test_number_rejects_what_is_not_a_plain_number(spark):
    values = ["12", " 2.7 ", "0.5", "-2", "1e3", ".5", "x", "12d", "NaN", "inf", "", None]
    assert evaluate(spark, values, numbers.number) == [12.0, 2.7, 0.5, -2.0, 1000.0, 0.5, None, None, None, None, None, None]
    assert evaluate(spark, [2.7, 0.5, 1e30], numbers.whole, "double") == [2, 0, None]


def test_amounts_are_exact(spark):
    df = spark.createDataFrame([(3, "0.335"), (7, "19999.99")], "q bigint, p string").withColumn("p", numbers.money(F.col("p")))
    excl = numbers.amount_excl_tax(F.col("q"), F.col("p"))
    got = df.select(excl.cast("string"), numbers.amount_incl_tax(excl, "0.20").cast("string")).collect()
    assert [tuple(r) for r in got] == [("1.02", "1.22"), ("139999.93", "167999.92")]


def test_age_bands(spark):
    band = lambda c: numbers.band(c, fv.AGE_EDGES, fv.AGE_LABELS, fv.UNKNOWN_AGE)
    ages = [16.0, 17.99, 18.0, 24.9, 25.0, 64.9, 65.0, 100.0, None, -1.0]
    assert evaluate(spark, ages, band, "double") == [
        "<18", "<18", "18-24", "18-24", "25-34", "55-64", "65+", "65+", "Inconnu", "Inconnu"
    ]


def test_truthy(spark):
    values = ["true", "True", "false", "False", "oui", "", None]
    assert evaluate(spark, values, numbers.truthy) == [True, True, False, False, True, False, False]


def test_percent(spark):
    df = spark.createDataFrame([(1, 3), (1, 0), (0, 5)], "a bigint, b bigint")
    assert [r[0] for r in df.select(numbers.percent(F.col("a"), F.col("b"), 1)).collect()] == [33.3, None, 0.0]


def test_status_and_sex_tables(spark):
    status = lambda c: standard_value(c, fv.ORDER_STATUSES, fv.UNKNOWN_STATUS)
    values = ["LIVRE", "Retourné", "KO", "OK", " livre", None]
    assert evaluate(spark, values, status) == ["livré", "inconnu", "annulé", "en_cours", "inconnu", "inconnu"]
    assert evaluate(spark, ["1", "0", "Homme", "x"], lambda c: map_values(c, fv.SEXES)) == ["m", "f", "m", None]


@pytest.mark.parametrize(
    "value, expected",
    [
        ("ok@x.ma", True), ("a.b+c@x-y.co.uk", True), ("sans-arobase", False), ("a@", False), ("a@b", False),
        (" a@x.ma", False), ("a@x.ma ", False), ("a@x.m", False),
    ],
)
def test_email_pattern(spark, value, expected):
    kept = evaluate(spark, [value], lambda c: text.keep_if_matches(c, fv.EMAIL_PATTERN, c))
    assert kept == [value if expected else None]


@pytest.mark.parametrize(
    "title, profile",
    [
        ("data eng.", "Data Engineer"), ("ingénieur data", "Data Engineer"), ("dev data", "Autre IT"),
        ("développeur bi", "Data Analyst"), ("analyste data", "Data Analyst"), ("data scientist", "Data Scientist"),
        ("développeur full stack react/node.js", "Développeur Full Stack"), ("back end", "Développeur Backend"),
        ("frontend", "Développeur Frontend"), ("sre", "DevOps / SRE"), ("chef de projet it", "Autre IT"),
        ("data engineer full stack", "Développeur Full Stack"), (None, "Autre IT"),
    ],
)
def test_profile_last_rule_wins(spark, title, profile):
    assert evaluate(spark, [title], profile_of) == [profile]


UNKNOWN_SALARY = (None, None, False)


def test_salary_of_given_texts(spark):
    expected = {
        "15000-20000 MAD": (15000.0, 20000.0, True), "15K-20K": (15000.0, 20000.0, True), "10000 MAD": (10000.0, 10000.0, True),
        "15.5k": (15500.0, 15500.0, True), "20000-15000": (15000.0, 20000.0, True), "12 000": (12000.0, 12000.0, True),
        "3000": (3000.0, 3000.0, True), "100000": (100000.0, 100000.0, True), "2999": UNKNOWN_SALARY, "100001": UNKNOWN_SALARY,
        "1000 MAD": UNKNOWN_SALARY, "Selon profil": UNKNOWN_SALARY, "Confidentiel": UNKNOWN_SALARY, "": UNKNOWN_SALARY, "k": UNKNOWN_SALARY,
    }
    found = offers.with_salary(one_column(spark, [*expected, None]), "v").collect()
    assert {r.v: (r.salaire_min_mad, r.salaire_max_mad, r.salaire_connu) for r in found} == {**expected, None: UNKNOWN_SALARY}


def test_salary_of_texts_made_from_numbers(spark):
    """The expected result follows from the numbers that a text was made of."""
    import random

    rng, made = random.Random(7), {}
    for _ in range(300):
        low, high = sorted(rng.randint(3, 100) for _ in range(2))
        result = (low * 1000.0, high * 1000.0, True)
        made[rng.choice(["{}000-{}000 MAD", "{}K-{}K", "{}k - {}k dh", "{} 000 - {}000"]).format(low, high)] = result
        made[f"{low + 200}000-{high + 200}000"] = UNKNOWN_SALARY
    found = offers.with_salary(one_column(spark, list(made)), "v").collect()
    assert {r.v: (r.salaire_min_mad, r.salaire_max_mad, r.salaire_connu) for r in found} == made


def test_salary_rate_is_a_parameter(spark):
    row = offers.with_salary(one_column(spark, ["1000 EUR"]), "v", LakeSettings(eur_to_mad=20.0)).first()
    assert (row.salaire_min_mad, row.salaire_median_mad) == (20000.0, 20000.0)


@pytest.mark.parametrize(
    "value, expected",
    [
        ("3-5 ans", (3, 5)), ("3 à 5 ans", (3, 5)), ("3 a 5", (3, 5)), ("min 3 ans", (3, None)), ("10 years", (10, None)),
        ("Débutant accepté", (0, 2)), ("Senior", (5, None)), ("lead 3-4 ans", (5, None)), ("stage 6 mois", (0, 2)),
        ("rien", (None, None)), (None, (None, None)),
    ],
)
def test_experience(spark, value, expected):
    low, high = offers.experience_years(F.col("v"))
    assert tuple(one_column(spark, [value]).select(low.alias("a"), high.alias("b")).first()) == expected


def test_partition_keys(spark):
    assert evaluate(spark, ["Re Krute", None], offers.source_partition) == ["re_krute", "inconnu"]
    months = ["2024-03-05", "2024-3", "2024-13-01", "", None, "x", "2024-3-05"]
    unknown = "date_inconnue"
    assert evaluate(spark, months, offers.month_partition) == ["2024_03", "2024_03", unknown, unknown, unknown, unknown, unknown]


def test_remote_words_ignore_case(spark):
    words = ["Full REMOTE", "Hybride", "TÉLÉTRAVAIL partiel", "Non", None]
    assert evaluate(spark, words, lambda c: F.coalesce(text.like_any(c, fv.REMOTE_WORDS), F.lit(False))) == [True, True, True, False, False]


def test_no_python_in_the_plans(spark):
    df = offers.with_salary(one_column(spark, ["15k"]), "v").withColumn("d", dates.mixed_date(F.col("v")))
    assert "Python" not in plan(df)


def test_month_names_by_position_are_read_as_by_the_formatter(spark):
    days = [date(2023, 12, 25) + timedelta(days=n) for n in range(0, 800, 3)]
    texts = [(d.strftime(layout), d) for d in days for layout in ("%b %d %Y", "%d %b %Y", "%b %d %Y 10:20", "%B %d %Y")]
    texts += [(text, None) for text in ("anF 05 2024", "Mar 32 2024", "32 Mar 2024", "Xyz 05 2024", "Mar x5 2024", "Mar 05 20x4", "Jan", "           ")]
    texts += [("MAR 05 2024", date(2024, 3, 5)), ("mar 05 2024", date(2024, 3, 5)), (" 5 Mar 2024", date(2024, 3, 5))]
    assert evaluate(spark, [text for text, _ in texts], dates.mixed_date) == [day for _, day in texts]
