"""Date expressions.

Bad input gives null, never an error.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

from sparkmart.functions.text import strip

# Optional sections: one formatter reads every layout. The second exchanges day and month.
_TIME = "[[ ]['T']H:mm[:ss][.SSSSSSSSS]]"
_DAY_FIRST = [
    "yyyy-M-d", "yyyy/M/d", "d/M/yyyy", "d-M-yyyy", "d.M.yyyy", "MMM d yyyy", "d MMM yyyy", "MMMM d yyyy", "d MMMM yyyy",
    "yyyyMMdd", "d/M/yy", "d-M-yy", "d.M.yy",
]
_LAYOUTS = "".join(
    f"[{layout}{_TIME}]" for layout in _DAY_FIRST
)
_EXCHANGED = "".join(f"[{layout}{_TIME}]" for layout in ["yyyy-d-M", "yyyy/d/M", "M/d/yyyy", "M-d-yyyy", "M.d.yyyy", "M/d/yy"])

_MONTHS = "JanFebMarAprMayJunJulAugSepOctNovDec"


def as_of_date(as_of: date | None) -> Column:
    return F.current_date() if as_of is None else F.lit(as_of)


def _month_number(name: Column) -> Column:
    """1 to 12 for an English name of three letters as it is usually written; else 0, which is no month."""
    place = F.instr(F.lit(_MONTHS), name)
    return F.when(place % 3 == 1, (place + 2) / 3).otherwise(0).cast("int").cast("string")


def mixed_date(value: Column) -> Column:
    """Parse ``2024-03-05``, ``05/03/2024``, ``05/03/24``, ``20240305``, ``Mar 05 2024`` and ``5 March 2024`` (``- / .`` between numbers).

    Day first; when that is no date, month first: ``03/25/2024`` is 25 March and
    ``2024-13-05`` is 13 May.  A time of day may follow.  Anything else is null.
    The usual layouts, and names of months in three letters, are cut by position and cast, which neither
    raises nor needs a pattern; everything else goes to a formatter.
    """
    at = lambda start, length: F.substring(value, start, length)
    dashed = lambda *parts: F.concat_ws("-", *parts)
    ten = F.length(value) == 10  # longer values need the formatter, which rejects trailing text
    by_position = lambda year_first, day_first: F.when(ten & (at(5, 1) == "-"), year_first).when(
        ten & (at(3, 1) == "/"), day_first
    )
    eleven = (F.length(value) == 11) & (at(7, 1) == " ")
    usual = (
        by_position(value, dashed(at(7, 4), at(4, 2), at(1, 2)))
        .when(eleven & (at(4, 1) == " "), dashed(at(8, 4), _month_number(at(1, 3)), at(5, 2)))
        .when(eleven & (at(3, 1) == " "), dashed(at(8, 4), _month_number(at(4, 3)), at(1, 2)))
    )
    exchanged = by_position(dashed(at(1, 4), at(9, 2), at(6, 2)), dashed(at(7, 4), at(1, 2), at(4, 2)))
    text = F.trim(value)
    parse = lambda layouts: F.try_to_timestamp(text, F.lit(layouts)).cast("date")
    read = F.coalesce(usual.try_cast("date"), exchanged.try_cast("date"), parse(_LAYOUTS), parse(_EXCHANGED))
    return F.when(text != "", read)


def iso_date(value: Column) -> Column:
    """Parse ``yyyy-MM-dd`` only; anything else is null."""
    text = strip(value)
    dashed = (F.length(text) == 10) & (F.substring(text, 5, 1) == "-") & (F.substring(text, 8, 1) == "-")
    return F.when(dashed, text.try_cast("date"))


def date_key(day: Column) -> Column:
    """``YYYYMMDD`` as an integer, by arithmetic rather than by formatting text."""
    return (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).cast("int")


def days_between(start: Column, end: Column) -> Column:
    """Whole days from ``start`` to ``end``; null when negative or when a side is missing."""
    days = F.datediff(end, start)
    return F.when(days >= 0, days)


def default_date(day: Column, as_of: date | None) -> Column:
    """A missing or future date becomes ``as_of``."""
    today = as_of_date(as_of)
    return F.when(day.isNull() | (day > today), today).otherwise(day)


def month_label(year: Column, month: Column) -> Column:
    return F.concat_ws("-", year.cast("string"), F.lpad(month.cast("string"), 2, "0"))


def calendar_columns(day: Column) -> dict[str, Column]:
    """Calendar attributes of a date (English names, ISO week)."""
    quarter, year = F.quarter(day), F.year(day)
    return {
        "id_date": date_key(day),
        "jour": F.dayofmonth(day).cast("smallint"),
        "mois": F.month(day).cast("smallint"),
        "trimestre": quarter.cast("smallint"),
        "annee": year.cast("smallint"),
        "semaine": F.weekofyear(day).cast("smallint"),
        "libelle_jour": F.date_format(day, "EEEE"),
        "libelle_mois": F.date_format(day, "MMMM"),
        "libelle_trimestre": F.concat(F.lit("T"), quarter.cast("string"), F.lit(" "), year.cast("string")),
        "est_weekend": F.weekday(day) >= 5,
    }


def fixed_holiday(day: Column, month_days: list[str], years: tuple[int, int]) -> Column:
    return F.year(day).between(*years) & F.date_format(day, "MM-dd").isin(month_days)


def in_periods(day: Column, periods: list[tuple[str, str]]) -> Column:
    """True when the date lies in one of the periods, both ends included."""
    inside = F.lit(False)
    for start, end in periods:
        inside = inside | day.between(F.lit(date.fromisoformat(start)), F.lit(date.fromisoformat(end)))
    return inside
