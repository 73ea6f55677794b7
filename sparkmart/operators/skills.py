"""Dictionary extraction: which named skills does a text mention?

``extract_skills`` tests one regular expression per skill, inside the scan
stage: no shuffle and no Python.  The dictionary becomes part of the plan and is
read by the driver; ``extract_skills_by_index`` leaves it a table and suits large ones.

Both follow one rule: an alias is found where its ends are word boundaries, and
a skill is given once per text, with the family of its longest alias there
(of equally long ones, the first in order).
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkmart.fixed_values import NO_FAMILY, NO_SKILL
from sparkmart.functions.text import contains_any
from sparkmart.session import stored

_WORD = r"[\p{L}\p{N}_]"
#: Aliases that become patterns of the plan.
MOST_PATTERNS = 500
_BITS_PER_ALIAS, _LEAST_BITS, _MOST_BITS = 32, 1 << 16, 1 << 23


def _is_word(char: str) -> bool:
    return char.isalnum() or char == "_"


def _bounded(alias: str) -> str:
    """The alias between word boundaries, spelled out so that they mean Unicode words on every JDK.

    The literal comes first and the left boundary is looked up behind it, so
    that most positions fail on one character.
    """
    literal = re.sub(r"([^\w\s])", r"\\\1", alias)
    left = f"(?<!{_WORD}{literal})" if _is_word(alias[0]) else f"(?<={_WORD}{literal})"
    right = f"(?!{_WORD})" if _is_word(alias[-1]) else f"(?={_WORD})"
    return f"{literal}{left}{right}"


def offer_text(*columns: str) -> Column:
    """The given fields, lower-case, with blanks between; missing fields are skipped."""
    return F.lower(F.concat_ws(" ", *columns))


def skill_array(text: Column, dictionary: DataFrame) -> Column:
    """Array of (competence, famille) found in ``text``."""
    aliases: dict[str, list[tuple[str, str]]] = {}
    rows = dictionary.select("alias", "competence", "famille").collect()
    for row in sorted(rows, key=lambda r: (-len(r.alias), r.alias)):
        aliases.setdefault(row.competence, []).append((row.alias, row.famille))
    hits = []
    for skill, named in aliases.items():
        names = [alias for alias, _ in named]
        # Plain containment is far cheaper than the pattern and rules out most texts.
        mentioned = contains_any(text, names) & text.rlike("|".join(map(_bounded, names)))
        if len({family for _, family in named}) == 1:
            family = F.lit(named[0][1])
        else:
            family = F.coalesce(*[F.when(text.rlike(_bounded(alias)), F.lit(of)) for alias, of in named])
        hits.append(F.when(mentioned, F.struct(F.lit(skill).alias("competence"), family.alias("famille"))))
    return F.array_compact(F.array(*hits))


def extract_skills(df: DataFrame, text: Column, dictionary: DataFrame, keep: list[Column]) -> DataFrame:
    """One row per (row, skill); rows that mention none give one row ``non_détecté``."""
    found = df.withColumn("_text", text).withColumn("_skills", skill_array(F.col("_text"), dictionary))
    exploded = found.select(*keep, F.explode_outer("_skills").alias("_skill"))
    return exploded.select(
        *[c for c in exploded.columns if c != "_skill"],
        F.coalesce("_skill.competence", F.lit(NO_SKILL)).alias("competence"),
        F.coalesce("_skill.famille", F.lit(NO_FAMILY)).alias("famille"),
    )


def _pieces(text: Column) -> Column:
    """Words and single other characters, in order."""
    return F.regexp_extract_all(text, F.lit(rf"({_WORD}+|[^\p{{L}}\p{{N}}_])"), F.lit(1))


def _bit(hashed: Column, bits: int) -> Column:
    return F.pmod(hashed, F.lit(bits))


def _entries(pieces: Column, alias: Column) -> Column:
    """What is looked up of an alias: its first piece, that with the number of its pieces, the whole of it."""
    first = F.get(pieces, F.lit(0))
    return F.array(F.xxhash64(first), F.xxhash64(first, F.size(pieces)), F.xxhash64(alias, F.lit("alias")))


def _filter_of(dictionary: DataFrame) -> tuple[bytes, int]:
    """A Bloom filter over the dictionary, and the pieces of its longest alias.

    It has ``_BITS_PER_ALIAS`` bits an alias, within bounds: beyond them it lets more runs through, and the join decides.
    """
    named = dictionary.select("alias", _pieces(F.col("alias")).alias("_pieces"))
    size = named.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("_pieces")).alias("longest")).first()
    bits = min(max(_LEAST_BITS, 1 << (_BITS_PER_ALIAS * size["n"]).bit_length()), _MOST_BITS)
    at = named.select(F.explode(_entries(F.col("_pieces"), F.col("alias"))).alias("h")).select(_bit(F.col("h"), bits).alias("bit"))
    whole = at.groupBy((F.col("bit") / 8).cast("int").alias("byte")).agg(F.bit_or(F.expr("shiftleft(1, cast(bit % 8 as int))")).alias("set"))
    held = bytearray(bits // 8)
    for row in whole.collect():  # one for each byte of the filter at most
        held[row["byte"]] = row["set"]
    return bytes(held), size["longest"] or 1


def candidate_runs(text: Column, held: bytes, longest: int) -> Column:
    """Distinct runs of pieces of ``text``, between word boundaries, that may be aliases: all that are and few others."""
    table, bits = F.lit(held), 8 * len(held)

    def maybe(hashed: Column) -> Column:
        at = _bit(hashed, bits)
        byte = F.conv(F.hex(F.substring(table, (at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("bigint")
        return F.getbit(byte, (at % 8).cast("int")) == 1

    pieces = _pieces(text)

    def runs(all_pieces: Column) -> Column:
        piece = lambda place: F.get(all_pieces, place)
        is_word = lambda place: F.coalesce(piece(place).rlike(f"^{_WORD}"), F.lit(False))
        starts = F.filter(F.sequence(F.lit(0), F.size(all_pieces) - 1), lambda at: maybe(F.xxhash64(piece(at))))

        def of_length(at: Column, length: Column) -> Column:
            end = at + length
            bounded = (is_word(at) | is_word(at - 1)) & (is_word(end - 1) | is_word(end))
            run = F.array_join(F.slice(all_pieces, at + 1, length), "")
            told = F.when(maybe(F.xxhash64(piece(at), length)) & (end <= F.size(all_pieces)) & bounded, run)
            return told

        found = F.flatten(F.transform(starts, lambda at: F.transform(F.sequence(F.lit(1), F.lit(longest)), lambda n: of_length(at, n))))
        return F.array_distinct(F.filter(F.array_compact(found), lambda run: maybe(F.xxhash64(run, F.lit("alias")))))

    none = F.array().cast("array<string>")
    cut = F.transform(F.array(pieces), lambda all_pieces: F.when(F.size(all_pieces) > 0, runs(all_pieces)).otherwise(none))
    return F.coalesce(F.get(cut, F.lit(0)), none)


def extract_skills_by_index(df: DataFrame, text: Column, dictionary: DataFrame, keep: list[Column]) -> DataFrame:
    """The result of ``extract_skills`` for dictionaries of any size.

    A text is cut into words and other characters. A Bloom filter, the only part of the dictionary in the plan, tells
    where an alias may begin, how many pieces it may have and whether a run may be one, all inside the scan; runs that pass are looked up by
    a join. Rows are stored with their runs, so their numbers stay the same.
    """
    known = stored(dictionary.select("alias", "competence", "famille"))
    held, longest = _filter_of(known)
    rows = df.withColumn("_text", text).select(*keep, candidate_runs(F.col("_text"), held, longest).alias("_runs"))
    rows = stored(rows.withColumn("_row", F.monotonically_increasing_id()))
    terms = rows.select("_row", F.explode("_runs").alias("alias")).join(known, "alias")
    family = F.min_by("famille", F.struct(-F.length("alias"), "alias")).alias("famille")
    skills = terms.groupBy("_row", "competence").agg(family)
    joined = rows.drop("_runs").join(skills, "_row", "left")
    return joined.select(
        *[c for c in rows.columns if c not in ("_runs", "_row")],
        F.coalesce("competence", F.lit(NO_SKILL)).alias("competence"),
        F.coalesce("famille", F.lit(NO_FAMILY)).alias("famille"),
    )


def extract_skills_by_join(df: DataFrame, row_id: str, text: Column, dictionary: DataFrame, keep: list[str]) -> DataFrame:
    """The same for columns by name; ``row_id`` names the rows and may be kept."""
    return extract_skills_by_index(df, text, dictionary, [F.col(c) for c in keep])


def extract_skills_of_any(df: DataFrame, text: Column, dictionary: DataFrame, keep: list[Column]) -> DataFrame:
    """``extract_skills`` for up to ``MOST_PATTERNS`` aliases, else by the index: the same rows."""
    small = dictionary.limit(MOST_PATTERNS + 1).count() <= MOST_PATTERNS
    return (extract_skills if small else extract_skills_by_index)(df, text, dictionary, keep)
