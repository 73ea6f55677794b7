"""What each of several filters removes, alone and in every order.

1. Filters on a text alone are bits of one number for each row, found in one pass over the texts.
2. Copies are found by a left-semi self-join on hash and length, exact text and smaller id. Its other side is the least id of each text, which
   is combined in the tasks first: a text that a third of all rows share is one row there, and the rows that look for it can
   be split by Spark. Only texts whose hash occurs twice travel.
3. The ids of the copies are united with the ids and bits of all rows; an aggregate by row gives each row's combination of
   bits, one by part and combination their counts: at most 2**5 a part.
4. A filter's effect depends on the set of filters before it, not on their order. So each part has a row for each filter
   and set of the others; orders only look these up.

Defined results: a null text counts as empty; empty texts are equal. A row with a null id is no copy, and none is a copy of it.
Rows that repeat an id are judged each by their own text and none is a copy of the other. Rows of ``labels`` that repeat an id count as one with the
larger labels; a null label is none. A null source and an empty one are the same part. An empty table has no part, so no rows. Other columns are
ignored, whatever their names.
"""

from __future__ import annotations

from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkmart.llm.common import store

#: Filters in order of their bits; the last is the one on copies.
FILTERS = "ABCDE"
COPY = 1 << FILTERS.index("E")
MIN_WORDS, DISTINCT_PERCENT, UPPER_PERCENT = 50, 65, 5
_CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def failures(text: Column) -> Column:
    """The bits of the filters A to D that ``text`` fails."""
    words = F.array_remove(F.split(F.translate(text, "\t\n\x0b\x0c\r", " " * 5), " "), "")
    rest = F.translate(text, _CAPITALS, "")
    failed = [
        F.size(words) < MIN_WORDS,
        F.size(F.array_distinct(words)) * 100 < F.size(words) * DISTINCT_PERCENT,
        (F.char_length(text) - F.char_length(rest)).cast("bigint") * 100 > F.char_length(text).cast("bigint") * UPPER_PERCENT,
        text.rlike("[#$%&*|]"),
    ]
    bits = F.lit(0)
    for i, condition in enumerate(failed):
        bits = bits + F.when(condition, 1 << i).otherwise(0)
    return bits


def copies(texts: DataFrame) -> DataFrame:
    """The rows of ``texts`` (_id, _hash, _length, _text and more) whose text a row with a smaller id has."""
    same = ["_hash", "_length"]
    twice = store(texts.groupBy(*same).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select(*same))
    suspects = texts.join(twice, same, "left_semi")
    first = store(suspects.filter("_id IS NOT NULL").groupBy(*same, "_text").agg(F.min("_id").alias("_first")))
    smaller = (F.col("d._text") == F.col("f._text")) & (F.col("f._first") < F.col("d._id"))
    for name in same:
        smaller = smaller & (F.col(f"d.{name}") == F.col(f"f.{name}"))
    return suspects.alias("d").join(first.alias("f"), smaller, "left_semi")


def combinations(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, bits, rows, good, toxic): how many rows of a part fail just these filters, and how many of them are labelled so."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        F.col("doc_id").alias("_id"), F.coalesce("source", F.lit("")).alias("part"),
        F.xxhash64(text).alias("_hash"), F.octet_length(text).alias("_length"), text.alias("_text"),
    )
    of_row = ["_id", "part", F.unhex(F.sha2(F.col("_text").cast("binary"), 256)).alias("_key")]
    united = rows.select(*of_row, F.lit(1).alias("_rows"), failures(F.col("_text")).alias("_bits")).unionByName(
        copies(rows).select(*of_row, F.lit(0).alias("_rows"), F.lit(COPY).alias("_bits"))
    )
    by_row = united.groupBy("_id", "part", "_key").agg(F.sum("_rows").alias("_rows"), F.bit_or("_bits").alias("bits"))
    label = lambda name: F.coalesce(F.max(F.col(name)) == 1, F.lit(False)).cast("int")
    known = labels.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(label("quality").alias("_good"), label("toxic").alias("_toxic"))
    labelled = by_row.join(known.withColumnRenamed("doc_id", "_id"), "_id", "left")
    total = lambda column: F.coalesce(F.sum(column), F.lit(0))
    return labelled.groupBy("part", "bits").agg(
        F.sum("_rows").alias("rows"), total(F.col("_rows") * F.col("_good")).alias("good"), total(F.col("_rows") * F.col("_toxic")).alias("toxic")
    )


def _settings() -> list[tuple[str, int, int, int]]:
    """(order, step, bit of the filter, bits of those before it)."""
    found = []
    for order in permutations(FILTERS):
        before = 0
        for step, name in enumerate(order, 1):
            bit = 1 << FILTERS.index(name)
            found.append(("".join(order), step, bit, before))
            before |= bit
    return found


def audit(counts: DataFrame) -> DataFrame:
    """The report from ``combinations``."""
    spark, n = counts.sparkSession, len(FILTERS)
    bits, bit, before = F.col("bits"), F.col("bit"), F.col("before")
    every = F.array(*[F.struct(F.lit(b).alias("bit"), F.lit(s).alias("before")) for b in (1 << i for i in range(n)) for s in range(1 << n) if not s & b])
    sized = counts.select("*", F.inline(every))
    fails, earlier = bits.bitwiseAND(bit) != 0, bits.bitwiseAND(before) != 0
    total = lambda condition, column="rows": F.coalesce(F.sum(F.when(condition, F.col(column))), F.lit(0)).cast("bigint")
    effects = store(
        sized.groupBy("part", "bit", "before").agg(
            total(~fails & ~earlier).alias("kept"), total(fails & ~earlier).alias("removed"), total(fails & earlier).alias("redundant"),
            total(bits == bit).alias("unique_fails"), total(fails & ~earlier, "good").alias("good_lost"), total(fails & ~earlier, "toxic").alias("toxic_lost"),
        )
    )
    # A set of k filters stands before a filter in k! (n - 1 - k)! of the orders.
    orders = F.get(F.lit([factorial(k) * factorial(n - 1 - k) for k in range(n)]), F.bit_count("before"))
    shapley = effects.groupBy("part", "bit").agg(F.sum(F.col("removed") * orders).cast("bigint").alias("shapley"))
    steps = spark.createDataFrame(_settings(), "filter_order string, step int, bit int, before int")
    return effects.join(shapley, ["part", "bit"]).join(steps, ["bit", "before"]).select(
        "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"
    )


def audit_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row for each part, order of the filters and step."""
    return audit(store(combinations(docs, labels)))


SQL = f"""
WITH RECURSIVE
known AS (SELECT doc_id, max(quality) AS quality, max(toxic) AS toxic FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
texts AS (SELECT d.doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t, coalesce(quality = 1, FALSE) AS good, coalesce(toxic = 1, FALSE) AS toxic,
    regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w, min(d.doc_id) OVER (PARTITION BY coalesce(text, '')) AS first_
  FROM documents d LEFT JOIN known k ON d.doc_id = k.doc_id),
judged AS (SELECT part, good, toxic,
    CASE WHEN len(w) < {MIN_WORDS} THEN 1 ELSE 0 END + CASE WHEN 100 * len(list_distinct(w)) < {DISTINCT_PERCENT} * len(w) THEN 2 ELSE 0 END
    + CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > {UPPER_PERCENT} * length(t) THEN 4 ELSE 0 END
    + CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END + CASE WHEN doc_id > first_ THEN 16 ELSE 0 END AS bits FROM texts),
counts AS (SELECT part, bits, count(*) AS n, count(*) FILTER (good) AS g, count(*) FILTER (toxic) AS x FROM judged GROUP BY part, bits),
steps AS (
  SELECT '' AS o, 0 AS step, 0 AS bit, 0 AS before
  UNION ALL
  SELECT o || f, step + 1, b, before | bit FROM steps, (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) v(f, b) WHERE ((before | bit) & b) = 0),
orders AS (SELECT full_.o AS filter_order, s.step, s.bit, s.before FROM steps s JOIN steps full_ ON full_.step = 5 AND starts_with(full_.o, s.o) AND s.step > 0),
effects AS (
  SELECT part, filter_order, step, bit, coalesce(sum(n) FILTER ((bits & (before | bit)) = 0), 0) AS kept,
    coalesce(sum(n) FILTER ((bits & before) = 0 AND (bits & bit) <> 0), 0) AS removed,
    coalesce(sum(n) FILTER ((bits & before) <> 0 AND (bits & bit) <> 0), 0) AS redundant, coalesce(sum(n) FILTER (bits = bit), 0) AS unique_fails,
    coalesce(sum(g) FILTER ((bits & before) = 0 AND (bits & bit) <> 0), 0) AS good_lost,
    coalesce(sum(x) FILTER ((bits & before) = 0 AND (bits & bit) <> 0), 0) AS toxic_lost
  FROM counts, orders GROUP BY part, filter_order, step, bit)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
  CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
  CAST(sum(removed) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley
FROM effects
"""
