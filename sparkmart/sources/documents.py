"""Records of JSON documents of any size: one document is read by many tasks.

A document ``{..., root: [record, record, ...], ...}`` is read as text that is cut behind every ``}``, so that Spark splits
its file into byte ranges. What the brackets of a piece mean depends on what stands before it, which three prefix sums tell. Each
runs over the sums of the ranges of a file (a row a range) and inside each range, which is bounded:

1. Quotes that are not escaped: an odd number before a piece means that it begins inside a string.
2. Brackets outside strings, known then: how deep a piece begins. A ``}`` that leads back to depth 2 (the root object and its array) ends a record.
3. Ended records number the pieces of the next one, and the last array that was opened before a piece tells whether it is ``root``.

The depth that a range adds is summed up for both states that it can begin in, so sums 1 and 2 need one pass over the numbers of the
pieces. A second pass takes the text along, and sum 3 is added when its result is read. Records of one piece, which is every flat
one, never meet; pieces of others are put together by record.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sparkmart.session import stored

_RANGE = ["_file", "_start"]
_RANGE_BYTES = "spark.sql.files.maxPartitionBytes"


def _without_escapes(text: Column) -> Column:
    return F.when(F.contains(text, F.lit("\\")), F.regexp_replace(text, r"(?s)\\.", "")).otherwise(text)


def _outside(text: Column, inside_first: bool = False) -> Column:
    """What is left of a piece without its strings. Escapes are gone; ``inside_first``: it begins in a string."""
    if inside_first:
        text = F.regexp_replace(text, r'^[^"]*+"?+', "")
    return F.regexp_replace(text, r'"[^"]*+"?+', "")


def _count(text: Column, sign: str) -> Column:
    return F.octet_length(text) - F.octet_length(F.replace(text, F.lit(sign), F.lit("")))


def _opened(text: Column) -> Column:
    """Brackets opened less brackets closed. The ``}`` behind a piece is not part of it."""
    return _count(text, "{") + _count(text, "[") - _count(text, "]")


def _inside_range(value: Column, how=F.sum, last: int = -1) -> Column:
    """``how`` over ``value`` of the pieces of the range before this one; up to it with ``last`` 0."""
    return how(value).over(Window.partitionBy(*_RANGE).orderBy("_row").rowsBetween(Window.unboundedPreceding, last))


def _ahead(value: Column, how=F.sum) -> Column:
    """``how`` over ``value`` of the ranges of the file before this one."""
    return how(value).over(Window.partitionBy("_file").orderBy("_start").rowsBetween(Window.unboundedPreceding, -1))


def _or(value: Column, nothing: int = 0) -> Column:
    return F.coalesce(value, F.lit(nothing).cast("bigint"))


@contextmanager
def _ranges_of(spark: SparkSession, range_bytes: int | None) -> Iterator[None]:
    """Scans that run meanwhile read byte ranges of this length, if one is given."""
    if range_bytes is None:
        yield
        return
    before = spark.conf.get(_RANGE_BYTES)
    spark.conf.set(_RANGE_BYTES, str(range_bytes))
    try:
        yield
    finally:
        spark.conf.set(_RANGE_BYTES, before)


def _pieces(spark: SparkSession, path: str, options: dict[str, str]) -> DataFrame:
    """The text between closing braces, with its file, the start of its byte range and its place."""
    raw = spark.read.options(**options).option("lineSep", "}").text(path)
    return raw.select(
        F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_start"),
        F.col("_metadata.file_size").alias("_size"), F.monotonically_increasing_id().alias("_row"), F.col("value").alias("_text"),
    )


def _measured(pieces: DataFrame, root: str) -> DataFrame:
    """Numbers of each piece for both states that it can begin in, and where it opens the wanted array if it begins outside strings."""
    bare = _without_escapes(F.col("_text"))
    key = rf'(?s)"{re.escape(root)}"\s*:\s*\['
    found = F.regexp_substr("_text", F.lit(key))
    at = F.instr(F.col("_text"), found)
    rest = F.expr("substring(_text, _at + length(_found))")
    head = lambda text: F.substring_index(_outside(_without_escapes(text)), "{", 1)
    out = pieces.withColumns({"_found": found, "_at": F.coalesce(at, F.lit(0))})
    return out.withColumns(
        {
            "_bytes": F.octet_length("_text") + 1,
            "_quotes": _count(bare, '"'),
            "_deep0": _opened(_outside(bare)),
            "_deep1": _opened(_outside(bare, inside_first=True)),
            # Depth at which the key stands, relative to the begin of the piece, and whether its array is the one that a record follows in.
            "_key_deep": F.when(F.col("_at") > 0, _opened(_outside(_without_escapes(F.expr("substring(_text, 1, _at - 1)"))))),
            "_key_last": F.when(F.col("_at") > 0, ~F.contains(head(rest), F.lit("]"))),
            "_closes_array": F.contains(head(F.col("_text")), F.lit("]")),
        }
    )


def _depth(inside: Column, odd: Column) -> Column:
    """What a piece and the ``}`` behind it add to the depth. ``odd``: the piece ends in a string, or no ``}`` is behind it."""
    return (F.when(inside, F.col("_deep1")).otherwise(F.col("_deep0")) - (~odd).cast("int")).cast("bigint")


def _range_begins(pieces: DataFrame) -> DataFrame:
    """(_file, _start, _state, _deep_ahead, _open_end): quotes (odd or not) and depth ahead of a range, and the piece of it without a ``}``."""
    even = pieces.withColumn("_before", _or(_inside_range(F.col("_quotes"))))
    depth = lambda state: _depth((F.col("_before") + state) % 2 == 1, (F.col("_before") + F.col("_quotes") + state) % 2 == 1)
    ranges = even.groupBy(*_RANGE).agg(
        F.sum("_quotes").alias("_quotes"), F.sum(depth(0)).alias("_even"), F.sum(depth(1)).alias("_odd"),
        F.sum("_bytes").alias("_bytes"), F.max("_size").alias("_size"), F.max("_row").alias("_last"),
    )
    # The text behind the last brace has none behind it: then pieces and braces are one byte more than the file (less a byte order mark).
    file = Window.partitionBy("_file")
    spare, last = F.sum("_bytes").over(file) - F.col("_size"), F.max("_last").over(file)
    open_end = F.when(~spare.isin(0, -3) & (F.col("_last") == last), last)
    stated = ranges.withColumns({"_state": _or(_ahead(F.col("_quotes"))) % 2, "_open_end": open_end})
    added = F.when(F.col("_state") == 1, F.col("_odd")).otherwise(F.col("_even"))
    return stated.select(*_RANGE, "_state", _or(_ahead(added)).alias("_deep_ahead"), "_open_end")


def _placed(pieces: DataFrame, begins: DataFrame) -> DataFrame:
    """With the state and depth in which each piece begins, what its ``}`` does, and its record and array as far as its range tells."""
    whole = pieces.join(begins, _RANGE)
    whole = whole.withColumn("_inside", (F.col("_state") + _or(_inside_range(F.col("_quotes")))) % 2 == 1)
    whole = whole.withColumn("_odd", (F.col("_inside").cast("int") + F.col("_quotes")) % 2 == 1)
    closes = ~F.col("_odd") & ~F.coalesce(F.col("_row") == F.col("_open_end"), F.lit(False))
    whole = whole.withColumn("_closes", closes).withColumn("_deep", _depth(F.col("_inside"), ~F.col("_closes")))
    whole = whole.withColumn("_begin", F.col("_deep_ahead") + _or(_inside_range(F.col("_deep"))))
    whole = whole.withColumn("_end", F.col("_begin") + F.col("_deep"))
    outside = ~F.col("_inside")
    opens = outside & ((F.col("_begin") <= 1) | ((F.col("_begin") == 2) & F.col("_closes_array")))
    named = outside & F.coalesce(F.col("_begin") + F.col("_key_deep") == 1, F.lit(False))
    wanted = named & F.coalesce(F.col("_key_last"), F.lit(False))
    marked = whole.withColumns(
        {
            "_ends": F.col("_closes") & (F.col("_end") == 2), "_opens": opens, "_named": named,
            "_first": outside & (F.col("_begin") <= 2), "_mark": F.when(opens, F.col("_row") * 2 + wanted.cast("bigint")),
        }
    )
    counted = marked.withColumns(
        {"_ended": _or(_inside_range(F.col("_ends").cast("bigint"))), "_mark": _inside_range(F.col("_mark"), F.max, 0)}
    )
    behind_key = F.expr("substring(_text, _at + length(_found))")
    counted = counted.withColumn("_own", F.when(F.col("_opens"), behind_key).otherwise(F.col("_text")))
    part = F.when(F.col("_first"), F.concat(F.lit("{"), F.expr("substring(_own, instr(_own, '{') + 1)"))).otherwise(F.col("_own"))
    return counted.select(*_RANGE, "_row", "_odd", "_deep", "_end", "_ends", "_named", "_first", "_ended", "_mark", part.alias("_part"))


def document_records(
    spark: SparkSession, path: str, root: str, required: bool, *, range_bytes: int | None = None, tasks: int | None = None, **options: str
) -> DataFrame:
    """(record): the text of each object in the array ``root`` of the documents below ``path``.

    ``range_bytes``: length of the byte ranges (by default, what a task reads of a file); ``tasks``: number of tasks that read them (by default, one
    a range). Raises KeyError where no document has the key but it is ``required``, and ValueError where brackets or quotes of a document don't match.
    """
    measured = _measured(_pieces(spark, path, options), root)
    with _ranges_of(spark, range_bytes):
        pieces = stored(measured.coalesce(tasks) if tasks else measured)
    placed = stored(_placed(pieces, stored(_range_begins(pieces))))
    ranges = stored(
        placed.groupBy(*_RANGE).agg(
            F.sum("_deep").alias("_deep"), F.min("_end").alias("_least"), F.max("_row").alias("_last"), F.max_by("_odd", "_row").alias("_odd"),
            F.bool_or("_named").alias("_named"), F.sum(F.col("_ends").cast("bigint")).alias("_ends"), F.max("_mark").alias("_mark"),
        )
    )
    broken = (F.sum("_deep") != 0) | F.max_by("_odd", "_last") | (F.min("_least") < 0)
    found = ranges.groupBy("_file").agg(broken.alias("_broken"), F.bool_or("_named").alias("_named"))
    found = found.agg(F.bool_or("_broken").alias("broken"), F.bool_or("_named").alias("named")).first()
    if found["broken"]:
        raise ValueError(f"broken JSON in {path}")
    if required and not found["named"]:
        raise KeyError(f"key '{root}' missing in {path}")
    ahead = stored(ranges.select(*_RANGE, _or(_ahead(F.col("_ends"))).alias("_ended_ahead"), _or(_ahead(F.col("_mark"), F.max), -1).alias("_mark_ahead")))
    mark = F.greatest(F.col("_mark_ahead"), _or(F.col("_mark"), -1))
    parts = placed.join(ahead, _RANGE).withColumn("_wanted", (mark >= 0) & (mark % 2 == 1)).filter("_wanted")
    # What is made of a part must not be asked of others, should it be tested before the join: they need not be JSON.
    part = F.when(F.col("_wanted"), F.col("_part")).alias("_part")
    parts = parts.select("_file", (F.col("_ended_ahead") + F.col("_ended")).alias("_record"), "_row", "_first", "_ends", part)
    alone = parts.filter("_first AND _ends").select(F.concat("_part", F.lit("}")).alias("record"))
    more = parts.filter("NOT (_first AND _ends)").groupBy("_file", "_record").agg(
        F.array_sort(F.collect_list(F.struct("_row", "_part"))).alias("_parts"), F.bool_or("_ends").alias("_whole")
    )
    joined = more.filter("_whole").select(F.concat(F.array_join(F.col("_parts._part"), "}"), F.lit("}")).alias("record"))
    return alone.unionByName(joined)
