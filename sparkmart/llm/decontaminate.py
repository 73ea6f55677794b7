"""Benchmark passages in training texts, by suffix arrays of the training shards.

The benchmark goes to the workers in blocks of bounded size, as a sorted vocabulary and its windows in word numbers. A shard is
one batch of documents. Its suffixes are sorted by their first words, and every benchmark suffix is looked up by binary search, which
gives all places where its window occurs. Places in a row, in text and item alike, join to the longest verbatim matches.

A suffix can match only if the first words of it, as many as the shortest window has, are all in the
vocabulary; others are left out of the array, which changes no result. Everything happens inside the shard, so a passage that a third of
all documents share is no hot group, and there is no shuffle but for a benchmark of several blocks.

Words are told by 64-bit hashes. The chance that a foreign word passes for one of V benchmark words is V / 2^64, and a match takes a window of them.

Defined results: null texts have no words. Items without words match nothing; items with null id give hits but are not listed,
equal items are listed each, repeated item rows once. Null and repeated document ids give a row for each input row. An empty
benchmark leaves all documents clean; empty tables give empty results. Other columns are carried as they are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkmart.llm.common import Shared, prepare, released, sha256
from sparkmart.llm.words import NOT_ALPHANUMERIC, cut

WINDOW = 13
#: Bytes of benchmark text that one pass over the documents takes.
BLOCK_BYTES = 8 << 20


class Windows:
    """The windows of a block of items, packed for binary search."""

    def __init__(self, ids: list, texts: list, window: int):
        words = cut(pa.array(texts, pa.string()), NOT_ALPHANUMERIC, fold=True)
        self.vocabulary, number = np.unique(words.hash, return_inverse=True)
        self.bits = max(8, 8 * -(-int(len(self.vocabulary) + 1).bit_length() // 8))
        self.window, self.ids = window, ids
        rows, self.item, self.at, self.length = [], [], [], []
        for i in range(len(texts)):
            own = number[words.first[i] : words.first[i + 1]] + 1
            size = min(window, len(own))
            for at in range(len(own) - size + 1 if size else 0):
                rows.append(np.concatenate([own[at : at + size], np.zeros(window - size, own.dtype)]))
                self.item.append(i), self.at.append(at), self.length.append(size)
        self.item, self.at, self.length = (np.array(x, dtype=np.int64) for x in (self.item, self.at, self.length))
        numbers = np.array(rows, dtype=np.int64).reshape(-1, window)
        past = np.arange(window) >= self.length[:, None]
        self.low = self.packed(numbers)
        self.high = self.packed(np.where(past, (1 << self.bits) - 1, numbers))
        self.shortest = int(self.length.min()) if len(rows) else 0

    def packed(self, numbers: np.ndarray) -> np.ndarray:
        """Rows of word numbers as byte strings that sort as the rows do."""
        wide = np.ascontiguousarray(numbers.astype(">u8")).view(np.uint8).reshape(len(numbers), self.window, 8)
        tight = np.ascontiguousarray(wide[:, :, 8 - self.bits // 8 :])
        size = self.window * self.bits // 8
        return tight.reshape(len(numbers), size).view(f"S{size}").ravel()

    def matches(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Words per text, and the matches as rows (text, start, item, start in the item, length)."""
        words = cut(texts, NOT_ALPHANUMERIC, fold=True)
        found = np.zeros((0, 5), dtype=np.int64)
        if not self.shortest:
            return np.diff(words.first), found
        place = np.searchsorted(self.vocabulary, words.hash)
        place[place == len(self.vocabulary)] = 0
        number = np.where(self.vocabulary[place] == words.hash, place + 1, 0)
        count, owner = len(number), words.owner
        foreign = np.concatenate([[0], np.cumsum(number == 0)])
        end = np.minimum(np.arange(count) + self.shortest, count)
        use = np.flatnonzero((foreign[end] == foreign[:-1]) & (np.arange(count) + self.shortest <= words.first[1:][owner]))
        if not len(use):
            return np.diff(words.first), found
        reach = use[:, None] + np.arange(self.window)
        inside = reach < words.first[1:][owner[use]][:, None]
        keys = self.packed(np.where(inside, number[np.minimum(reach, count - 1)], 0))
        order = np.argsort(keys, kind="stable")  # the suffix array of the shard
        keys, use = keys[order], use[order]
        low, high = np.searchsorted(keys, self.low, "left"), np.searchsorted(keys, self.high, "right")
        sizes = high - low
        which = np.repeat(np.arange(len(low)), sizes)
        at = use[np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes) + low[which]]
        return np.diff(words.first), self.joined(at, which, owner, words.first)

    def joined(self, at: np.ndarray, which: np.ndarray, owner: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Windows that follow each other in text and item, as one match."""
        text, item, start = owner[at], self.item[which], self.at[which]
        order = np.lexsort((at, at - start, item, text))
        at, which, text, item, start = at[order], which[order], text[order], item[order], start[order]
        new = np.ones(len(at), dtype=bool)
        new[1:] = (text[1:] != text[:-1]) | (item[1:] != item[:-1]) | (at[1:] - at[:-1] != 1) | (start[1:] - start[:-1] != 1)
        begin = np.flatnonzero(new)
        last = np.append(begin[1:], len(at))[: len(begin)] - 1
        length = at[last] - at[begin] + self.length[which[last]]
        return np.stack([text[begin], at[begin] - first[text[begin]], item[begin], start[begin], length], axis=1)


def _blocks(items: DataFrame, block_bytes: int) -> list[DataFrame]:
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    count = -(-size // block_bytes) or 1
    return [items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(count)) == i) for i in range(count)]


def _one_block(rows: DataFrame, windows: Windows) -> DataFrame:
    shared = Shared(rows.sparkSession, windows)
    match = pa.struct([("item", pa.string()), ("start", pa.int64()), ("item_start", pa.int64()), ("length", pa.int64())])

    @released
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = shared.value
        names = np.array([None if i is None else str(i) for i in block.ids] + [None], dtype=object)
        for batch in batches:
            n_words, found = block.matches(batch.column("_text"))
            found = found[np.argsort(found[:, 0], kind="stable")]
            columns = [pa.array(names[found[:, 2]], pa.string()), *[pa.array(found[:, k]) for k in (1, 3, 4)]]
            ends = np.searchsorted(found[:, 0], np.arange(len(batch) + 1)).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.StructArray.from_arrays(columns, fields=list(match)))
            yield pa.RecordBatch.from_arrays([batch.column("_doc"), pa.array(n_words.astype(np.int64)), lists], ["_doc", "n_words", "matches"])

    carried = rows.schema["_doc"].dataType.simpleString()
    return rows.mapInArrow(search, f"_doc {carried}, n_words bigint, matches array<struct<item:string,start:bigint,item_start:bigint,length:bigint>>")


def _covered(matches: Column) -> Column:
    """Words in any match."""
    spans = F.array_sort(F.transform(matches, lambda m: F.struct(m["start"].alias("a"), (m["start"] + m["length"]).alias("b"))))
    zero = F.struct(F.lit(0).cast("bigint").alias("end"), F.lit(0).cast("bigint").alias("n"))
    step = lambda s, x: F.struct(
        F.greatest(s["end"], x["b"]).alias("end"), (s["n"] + F.greatest(F.lit(0), x["b"] - F.greatest(s["end"], x["a"]))).alias("n")
    )
    return F.aggregate(spans, zero, step, lambda s: s["n"])


def benchmark_matches(docs: DataFrame, items: DataFrame, carry: list[str], window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``_doc`` (the columns ``carry`` as a struct), n_words, matches, n_hit and items, for each row of ``docs``."""
    prepare(docs.sparkSession)
    blocks, carried = _blocks(items, block_bytes), F.struct(*carry)
    if len(blocks) > 1:  # rows are put together again by what is carried and their text
        carried = F.struct(carried.alias("doc"), sha256(F.col("text")).alias("text"))
    rows = docs.select(carried.alias("_doc"), F.col("text").alias("_text"))
    found = []
    for block in blocks:
        content = block.select("item_id", "text").distinct().collect()  # at most one block, whose size was counted
        found.append(_one_block(rows, Windows([r.item_id for r in content], [r.text for r in content], window)))
    if len(found) == 1:
        all_found = found[0]
    else:  # each block gives a row per document; rows equal in text have equal matches
        united = found[0].withColumn("_block", F.lit(0))
        for i, more in enumerate(found[1:], 1):
            united = united.unionByName(more.withColumn("_block", F.lit(i)))
        once = united.groupBy("_doc", "n_words", "_block").agg(F.any_value("matches").alias("matches"), F.count(F.lit(1)).alias("_rows"))
        gathered = once.groupBy("_doc", "n_words").agg(F.flatten(F.collect_list("matches")).alias("matches"), F.max("_rows").alias("_rows"))
        repeated = gathered.withColumn("_", F.explode(F.sequence(F.lit(1).cast("bigint"), "_rows"))).drop("_", "_rows")
        all_found = repeated.withColumn("_doc", F.col("_doc.doc"))
    listed = F.array_sort(F.array_distinct(F.array_compact(F.transform("matches", lambda m: m["item"]))))
    return all_found.select("_doc", "n_words", "matches", _covered(F.col("matches")).alias("n_hit"), listed.alias("items"))


def contaminated() -> Column:
    """Hits are a twentieth of the words or more."""
    return (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))


def contamination_report(docs: DataFrame, items: DataFrame) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    return benchmark_matches(docs, items, ["doc_id"]).select(
        "_doc.doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        sha256(F.array_join("items", ",")).alias("items_sha256"),
        contaminated().alias("contaminated"),
    )


def decontaminate(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``docs`` without the contaminated rows, all columns."""
    return benchmark_matches(docs, items, docs.columns).filter(~contaminated()).select("_doc.*")


_FOLDED = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = rf"regexp_extract_all(coalesce({_FOLDED}, ''), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

SQL = f"""
WITH items AS (SELECT item_id, {_WORDS} AS words FROM benchmark),
docs AS (SELECT doc_id, {_WORDS} AS words FROM documents),
sizes AS (SELECT DISTINCT least({WINDOW}, len(words)) AS size FROM items WHERE len(words) > 0),
windows AS (
  SELECT DISTINCT item_id, size, array_to_string(words[place : place + size - 1], ' ') AS passage
  FROM (SELECT item_id, words, least({WINDOW}, len(words)) AS size,
               unnest(generate_series(1, len(words) - least({WINDOW}, len(words)) + 1)) AS place
        FROM items WHERE len(words) > 0)),
places AS (
  SELECT doc_id, size, place, array_to_string(words[place : place + size - 1], ' ') AS passage
  FROM (SELECT doc_id, words, size, unnest(generate_series(1, len(words) - size + 1)) AS place
        FROM docs, sizes WHERE len(words) >= size)),
hits AS (SELECT doc_id, place, size, item_id FROM places JOIN windows USING (size, passage)),
covered AS (
  SELECT doc_id, count(DISTINCT word) AS n_hit
  FROM (SELECT doc_id, unnest(generate_series(place, place + size - 1)) AS word FROM hits) GROUP BY doc_id),
found AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id)
SELECT doc_id, len(words) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit > 0 AND 20 * n_hit >= len(words), false) AS contaminated
FROM docs LEFT JOIN covered USING (doc_id) LEFT JOIN found USING (doc_id)
"""
