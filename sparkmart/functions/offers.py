"""Expressions on job-offer fields: salary, experience, partition keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkmart import fixed_values as fv
from sparkmart.functions.text import contains_any
from sparkmart.settings import LakeSettings

_AMOUNT = r"([0-9]+(?:\.[0-9]+)?)"
_OUT_OF_RANGE = "9" * 19
_THOUSANDS_OR_CHAR = r"(?s)([0-9]+(?:\.[0-9]+)?k|.)"


def _without(text: Column, words: list[str]) -> Column:
    for word in words:
        text = F.replace(text, F.lit(word), F.lit(""))
    return text


def _thousands(token: Column) -> Column:
    units = (F.rtrim(token, F.lit("k")).try_cast("double") * 1000).try_cast("bigint").cast("string")
    return F.coalesce(units, F.lit(_OUT_OF_RANGE))


def _expand_thousands(text: Column) -> Column:
    """``15.5k`` -> ``15500``, truncated; only values that hold a ``k`` are taken apart."""
    tokens = F.regexp_extract_all(text, F.lit(_THOUSANDS_OR_CHAR), F.lit(1))
    spelled = F.transform(
        tokens,
        lambda t: F.when(F.endswith(t, F.lit("k")) & (F.length(t) > 1), _thousands(t)).otherwise(t),
    )
    return F.when(F.contains(text, F.lit("k")), F.array_join(spelled, "")).otherwise(text)


def with_salary(df: DataFrame, raw: str, settings: LakeSettings = LakeSettings()) -> DataFrame:
    """Add ``salaire_min_mad, salaire_max_mad, salaire_connu, salaire_median_mad``.

    The steps are separate columns so that each is evaluated once per row.
    """
    text = F.lower(F.col(raw))
    amounts = F.regexp_extract_all(F.col("_text"), F.lit(_AMOUNT), F.lit(1))
    amount = lambda i: F.get(F.col("_amounts"), i).try_cast("double") * F.col("_rate")
    return (
        df.withColumn("_text", F.when(~text.isin(fv.SALARY_UNKNOWN), _without(text, [" ", "\u202f"])))
        .withColumn("_rate", F.when(contains_any(F.col("_text"), fv.SALARY_EUR_MARKS), settings.eur_to_mad).otherwise(1.0))
        .withColumn("_text", _expand_thousands(_without(F.col("_text"), fv.SALARY_DROP)))
        .withColumn("_amounts", amounts)
        .withColumn("_low", F.least(amount(0), amount(1)))
        .withColumn("_high", F.greatest(amount(0), amount(1)))
        .withColumn(
            "salaire_connu",
            F.coalesce((F.col("_low") >= settings.salary_floor) & (F.col("_high") <= settings.salary_ceiling), F.lit(False)),
        )
        .withColumn("salaire_min_mad", F.when(F.col("salaire_connu"), F.col("_low")))
        .withColumn("salaire_max_mad", F.when(F.col("salaire_connu"), F.col("_high")))
        .withColumn("salaire_median_mad", (F.col("salaire_min_mad") + F.col("salaire_max_mad")) / 2)
        .drop("_text", "_rate", "_amounts", "_low", "_high")
    )


def experience_years(raw: Column) -> tuple[Column, Column]:
    """(minimum, maximum) years asked for; words for juniors and seniors come before numbers."""
    text = F.lower(raw)
    junior, senior = contains_any(text, fv.JUNIOR_WORDS), contains_any(text, fv.SENIOR_WORDS)
    group = lambda pattern, i: F.regexp_extract(text, pattern, i).try_cast("int")
    low, high = group(fv.YEARS_RANGE_PATTERN, 1), group(fv.YEARS_RANGE_PATTERN, 2)
    minimum = (
        F.when(junior, fv.JUNIOR_YEARS[0])
        .when(senior, fv.SENIOR_YEARS_FROM)
        .otherwise(F.coalesce(low, group(fv.YEARS_FROM_PATTERN, 1)))
    )
    maximum = F.when(junior, fv.JUNIOR_YEARS[1]).when(~senior, high)
    return minimum, maximum


def source_partition(source: Column) -> Column:
    """Lower-case source with blanks as underscores; ``inconnu`` when missing."""
    return F.coalesce(F.replace(F.lower(source), F.lit(" "), F.lit("_")), F.lit(fv.UNKNOWN_SOURCE))


def month_partition(published: Column) -> Column:
    """``yyyy_MM`` of an ISO date text, ``date_inconnue`` when it has none."""
    head = F.substring(published, 1, 7)
    year, month = F.split_part(head, F.lit("-"), F.lit(1)), F.split_part(head, F.lit("-"), F.lit(2))
    valid = head.rlike(r"^[0-9]{4}-(0?[1-9]|1[0-2])$")
    return F.when(valid, F.concat(year, F.lit("_"), F.lpad(month, 2, "0"))).otherwise(F.lit(fv.UNKNOWN_MONTH))

