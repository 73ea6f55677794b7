"""Lines that many documents share, as compressed bitmaps of the lines to keep per document.

1. Each line long enough to count gives (hash of its key, document, position). These rows, not the texts, are counted by range of the hash.
   Ranges are as many as give ``rows_per_range`` rows on average. One with more than twice that holds a hot hash, and its rows are dealt to
   several pieces by document, so that a line that a third of all documents hold spreads over as many tasks as its rows fill.
2. Rows are range-partitioned by range and piece, with a secondary sort by hash, document (largest first) and position. A window
   streams each piece in that order without another shuffle: the first row of a hash names the largest document, and
   a running number counts the documents.
3. A hash in a range of one piece is decided there. Those of several pieces give one total for each piece and hash, and the totals of a hash
   are put together: the largest of the first documents stays.
4. Each row in a document that isn't the first of a hash held by enough documents clears a bit: the bitmap of a document is the
   list of its 62-bit words that are not all ones. A document without one keeps all lines.

A key is told by 128 bits of hash, so two keys of 10^12 collide with a probability of about 10^-15.

Defined results: a null text is one empty line. Blank and short lines always stay. A null id is one document before all
others. Rows equal in id and text get equal results and count as one document; rows equal in id alone do too
when documents are counted, but each has its own bitmap. An empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkmart.llm.common import NO_ID, discard, sha256, store, text_key

_WORD = 62
_ALL = (1 << _WORD) - 1
#: Rows of about 40 bytes that a range holds on average; one of twice as many is split.
ROWS_PER_RANGE = 1 << 17
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Fixed value: what is stripped from both ends of a line.
_STRIPPED = " \t\n\x0b\x0c\r"


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    """The line without blanks at both ends, A-Z in lower case."""
    bare = F.btrim(line, F.lit(_STRIPPED))
    ascii_only = F.length(bare) == F.octet_length(bare)
    return F.when(ascii_only, F.lower(bare)).otherwise(F.translate(bare, _UPPER, _LOWER))


def hashed_lines(docs: DataFrame, min_chars: int) -> DataFrame:
    """(_h1, _h2, _doc, _text_key, _at) of the lines that count. ``_doc`` is the complement of the id: the largest id comes first."""
    lines = docs.select(
        F.bitwise_not(F.coalesce(F.col("doc_id").cast("bigint"), F.lit(NO_ID))).alias("_doc"),
        text_key(F.col("text")).alias("_text_key"),
        F.posexplode(lines_of(F.col("text"))).alias("_at", "_line"),
    ).filter(F.length("_line") >= min_chars)
    keyed = lines.withColumn("_key", line_key(F.col("_line"))).filter(F.length("_key") >= min_chars)
    return keyed.select(F.xxhash64("_key").alias("_h1"), F.xxhash64(F.lit(1), F.col("_key")).alias("_h2"), "_doc", "_text_key", "_at")


def in_ranges(hashed: DataFrame, rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """``hashed`` (stored) with ``_range``, ``_piece`` and ``_pieces``, range-partitioned by the first two and sorted inside."""
    bits = max(1, min(48, (hashed.count() // rows_per_range).bit_length()))
    ranged = hashed.withColumn("_range", F.shiftright("_h1", 64 - bits))
    sizes = ranged.groupBy("_range").agg(F.count(F.lit(1)).alias("_rows")).filter(F.col("_rows") > 2 * rows_per_range)
    split = store(sizes.select("_range", F.ceil(F.col("_rows") / rows_per_range).alias("_pieces")))
    pieces = F.coalesce("_pieces", F.lit(1).cast("bigint"))
    piece = F.when(F.col("_pieces").isNotNull(), F.pmod(F.xxhash64("_doc"), pieces)).otherwise(F.lit(0).cast("bigint"))
    dealt = ranged.join(split, "_range", "left").withColumn("_piece", piece).withColumn("_pieces", pieces)
    return dealt.repartitionByRange("_range", "_piece").sortWithinPartitions("_range", "_piece", "_h1", "_h2", "_doc", "_at")


def lost_lines(ranged: DataFrame, min_docs: int) -> DataFrame:
    """(_doc, _text_key, _at) of the lines that go, from the sorted stream of each piece."""
    run = Window.partitionBy("_range", "_piece", "_h1", "_h2")
    nth = F.dense_rank().over(run.orderBy("_doc"))  # 1: the first document of the run
    streamed = ranged.withColumn("_nth", nth).withColumn("_docs", F.max("_nth").over(run))
    whole = F.col("_pieces") == 1
    open_rows = store(
        streamed.filter(~whole | ((F.col("_nth") > 1) & (F.col("_docs") >= min_docs)))
        .select("_h1", "_h2", "_doc", "_text_key", "_at", "_nth", "_piece", "_docs", whole.alias("_whole"))
    )
    parts = open_rows.filter("not _whole")
    per_piece = parts.groupBy("_h1", "_h2", "_piece").agg(F.min("_doc").alias("_first"), F.max("_docs").alias("_docs"))
    totals = per_piece.groupBy("_h1", "_h2").agg(F.min("_first").alias("_first"), F.sum("_docs").alias("_all"))
    shared = store(totals.filter(F.col("_all") >= min_docs).drop("_all"))
    over_edges = parts.join(shared, ["_h1", "_h2"]).filter("_doc <> _first")
    columns = ["_doc", "_text_key", "_at"]
    return open_rows.filter("_whole").select(*columns).unionByName(over_edges.select(*columns))


def keep_bitmaps(
    docs: DataFrame, min_chars: int = 40, min_docs: int = 5, rows_per_range: int = ROWS_PER_RANGE
) -> DataFrame:
    """(_id, _text_key, words, n_dropped) of documents that lose lines; words holds (word, bits), a bit for each line that stays."""
    hashed = store(hashed_lines(docs, min_chars))
    lost = lost_lines(in_ranges(hashed, rows_per_range), min_docs).withColumn("_id", F.bitwise_not("_doc"))
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("_at") % _WORD)
    cleared = F.bit_or(bit)
    words = lost.groupBy("_id", "_text_key", F.expr(f"_at div {_WORD}").cast("int").alias("word")).agg(
        cleared.bitwiseXOR(F.lit(_ALL)).alias("bits"), F.bit_count(cleared).alias("_n")
    )
    bitmaps = store(
        words.groupBy("_id", "_text_key").agg(
            F.sort_array(F.collect_list(F.struct("word", "bits"))).alias("words"), F.sum("_n").alias("n_dropped")
        )
    )
    discard(hashed)
    return bitmaps


def kept_lines(joined: DataFrame) -> DataFrame:
    """``_kept`` from ``_lines`` and ``words``. The bits are spread to an array first, where a word is found by its number."""
    last = F.expr(f"cast((size(_lines) - 1) div {_WORD} as int)")
    by_word = F.map_from_entries("words")
    dense = F.transform(F.sequence(F.lit(0), last), lambda w: F.coalesce(F.try_element_at(by_word, w), F.lit(_ALL).cast("bigint")))
    spread = joined.withColumn("_dense", F.when(F.col("words").isNotNull(), dense))
    bit = f"shiftright(_dense[cast(i div {_WORD} as int)], cast(i % {_WORD} as int)) & 1"
    kept = F.expr(f"if(words is null, _lines, filter(_lines, (line, i) -> ({bit}) = 1))")
    return spread.withColumn("_kept", kept)


def line_dedup(docs: DataFrame, min_chars: int = 40, min_docs: int = 5, rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """``doc_id``, ``_lines``, ``_kept`` (lines that stay), ``n_dropped``, for every row of ``docs``."""
    bitmaps = keep_bitmaps(docs, min_chars, min_docs, rows_per_range).withColumnsRenamed({"_id": "_doc", "_text_key": "_text"})
    key = F.coalesce(F.col("doc_id").cast("bigint"), F.lit(NO_ID))
    rows = docs.select("doc_id", "text", key.alias("_id"), text_key(F.col("text")).alias("_text_key"))
    joined = rows.join(bitmaps, (F.col("_id") == F.col("_doc")) & (F.col("_text_key") == F.col("_text")), "left")
    dropped = F.coalesce("n_dropped", F.lit(0)).cast("bigint").alias("n_dropped")
    return kept_lines(joined.withColumn("_lines", lines_of(F.col("text")))).select("doc_id", "_lines", "_kept", dropped)


def line_dedup_digests(docs: DataFrame) -> DataFrame:
    """doc_id, n_lines, n_dropped, kept_sha256."""
    return line_dedup(docs.select("doc_id", "text")).select(
        "doc_id",
        F.size("_lines").cast("bigint").alias("n_lines"),
        "n_dropped",
        sha256(F.array_join("_kept", "\n")).alias("kept_sha256"),
    )


SQL = f"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS place
  FROM documents),
keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '{_UPPER}', '{_LOWER}') AS key FROM lines),
groups AS (
  SELECT key, max(doc_id) AS stays FROM keyed WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
judged AS (
  SELECT keyed.*, groups.key IS NOT NULL AND doc_id <> stays AS lost FROM keyed LEFT JOIN groups USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (lost) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT lost), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""
