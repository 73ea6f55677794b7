"""Numeric coercion, money and bands.

Money is computed in DECIMAL: rounding and sums are then exact and do not
depend on the order in which tasks finish.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from sparkmart.functions.text import strip

_NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
MONEY = "decimal(18,2)"
MONEY_INPUT = "decimal(18,6)"


def number(value: Column) -> Column:
    """Text to double; anything that is not a plain number is null."""
    text = strip(value.cast("string"))
    return F.when(text.rlike(_NUMBER), text.try_cast("double"))


def whole(value: Column) -> Column:
    """Double to integer by truncation, null when out of range."""
    return value.try_cast("bigint")


def money(value: Column) -> Column:
    """Round an amount (text, double or decimal) half-up to two decimals."""
    return F.round(value.try_cast(MONEY_INPUT), 2).try_cast(MONEY)


def amount_excl_tax(quantity: Column, price: Column) -> Column:
    """Null where the amount does not fit; no value ends the job."""
    return F.round(quantity.try_cast("decimal(20,0)") * price.try_cast(MONEY_INPUT), 2).try_cast(MONEY)


def amount_incl_tax(excl_tax: Column, rate: str) -> Column:
    """Tax on the already rounded amount."""
    return F.round(excl_tax * F.lit(Decimal("1") + Decimal(rate)), 2).try_cast(MONEY)


def truthy(text: Column) -> Column:
    """``true/True/false/False`` as written; other text is true, a missing value is false."""
    return F.when(text.isin("true", "True"), True).when(text.isin("false", "False"), False).otherwise(
        text.isNotNull() & (text != "")
    )


def age_on(birth: Column, as_of: Column) -> Column:
    return F.datediff(as_of, birth) / F.lit(365.25)


def band(value: Column, edges: list[float], labels: list[str], default: str) -> Column:
    """Label of the left-closed interval that holds ``value``."""
    chain = F.when(value.isNull() | (value < edges[0]) | (value >= edges[-1]), F.lit(default))
    for upper, label in zip(edges[1:], labels):
        chain = chain.when(value < upper, F.lit(label))
    return chain.otherwise(F.lit(default))


def percent(part: Column, whole_: Column, digits: int) -> Column:
    """``part * 100 / whole``, null when the whole is 0, rounded as a decimal."""
    ratio = F.try_divide(part.cast("decimal(20,0)") * 100, whole_.cast("decimal(20,0)"))
    return F.round(ratio, digits).cast("double")


def rounded(value: Column, digits: int) -> Column:
    """Round a double by its decimal value."""
    return F.round(value.cast("decimal(28,8)"), digits).cast("double")
