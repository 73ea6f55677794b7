"""Text expressions. All of them are column expressions that stay in generated code."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: the characters that count as white space at the ends of a value
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# A run of letters that have case, or a run of anything else.
_CASED_RUNS = r"([\p{Lu}\p{Ll}\p{Lt}]+|[^\p{Lu}\p{Ll}\p{Lt}]+)"


def strip(value: Column) -> Column:
    """Remove Unicode white space at both ends (``trim`` alone removes only U+0020)."""
    return F.btrim(value, F.lit(WHITE_SPACE))


def title_case(value: Column) -> Column:
    """Capital after every character that is not a cased letter: ``l'or`` -> ``L'Or``."""
    runs = F.regexp_extract_all(F.lower(value), F.lit(_CASED_RUNS), F.lit(1))
    first = lambda run: F.replace(F.upper(F.substring(run, 1, 1)), F.lit("SS"), F.lit("Ss"))  # ß -> Ss
    capital = F.transform(runs, lambda run: F.concat(first(run), F.substring(run, 2, 1 << 30)))
    return F.array_join(capital, "")


def squeeze(value: Column) -> Column:
    """Strip and reduce inner white space to single blanks."""
    return F.regexp_replace(strip(value), r"(?U)\s+", " ")


def full_name(first: Column, last: Column) -> Column:
    """``First Last`` in title case; missing parts are left out."""
    part = lambda name: title_case(strip(F.coalesce(name, F.lit(""))))
    return strip(F.concat_ws(" ", part(first), part(last)))


def normal_email(email: Column) -> Column:
    return strip(F.lower(email))


def keep_if_matches(value: Column, pattern: str, tested: Column) -> Column:
    """``value`` where ``tested`` matches ``pattern``, else null."""
    return F.when(tested.rlike(pattern), value)


def contains_any(value: Column, words: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.contains(value, F.lit(word)) for word in words])


def like_any(value: Column, words: list[str]) -> Column:
    """Case-insensitive "contains one of the words"."""
    return reduce(lambda a, b: a | b, [value.ilike(f"%{word}%") for word in words])


def first_match(value: Column, rules: list[tuple[str, str]], default: str) -> Column:
    """Label of the first rule whose pattern is found in ``value``."""
    chain = F
    for pattern, label in rules:
        chain = chain.when(value.rlike(f"(?U){pattern}"), F.lit(label))
    return chain.otherwise(F.lit(default)) if rules else F.lit(default)


def last_match(value: Column, rules: list[tuple[str, str]], default: str) -> Column:
    """Label of the last matching rule: a ``CASE`` over the reversed rules, so it stops at the first hit."""
    return first_match(value, list(reversed(rules)), default)
