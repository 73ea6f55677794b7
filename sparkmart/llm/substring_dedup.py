"""Passages that an earlier document has, by compressed FM-indexes.

``repeats`` routes segments of documents to shards so that equal windows meet in one. Each shard builds an FM-index over its segments: suffixes
sorted by as many words as a window has, their preceding words as a wavelet matrix with packed bits and sampled ranks.
All windows are then streamed through it by backward search, word by word from their ends. A search stops when its interval has one
suffix, which is the window itself; its length then is the matching statistic. What reaches the whole window reports its
interval, over which the least and largest document are taken.

Documents are not streamed past the indexes of shards that can't have their windows: that would cost documents times shards.

Defined results: null texts have no words; fewer words than a window lose nothing. Windows that a document repeats within itself alone
stay. Rows that repeat an id are not earlier than each other; rows without id come before all others and are not earlier than
each other. An empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmart.llm.common import sha256
from sparkmart.llm.repeats import repeated_windows, without_repeats

WINDOW = 13
RUN = 5


class Bits:
    """A packed bit vector with the number of ones before each word of 64."""

    def __init__(self, bits: np.ndarray):
        padded = np.zeros((len(bits) // 64 + 1) * 64, dtype=np.uint8)
        padded[: len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view(np.uint64)
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words))]).astype(np.int32)

    def ones(self, at: np.ndarray) -> np.ndarray:
        """Ones before each position."""
        word, rest = at >> 6, (at & 63).astype(np.uint64)
        mask = (np.uint64(1) << rest) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & mask)


class FmIndex:
    """Symbols from 1 on; 0 ends a segment. Patterns of up to ``depth`` symbols can be searched."""

    def __init__(self, text: np.ndarray, depth: int):
        self.text = text
        self.suffixes = _sorted_suffixes(text, depth)
        last = text[self.suffixes - 1]
        sigma = int(text.max()) + 1
        self.before = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=sigma))])
        self.levels: list[tuple[Bits, int]] = []
        for shift in reversed(range(max(1, (sigma - 1).bit_length()))):
            bit = (last >> shift) & 1
            self.levels.append((Bits(bit), int(len(bit) - bit.sum())))
            last = np.concatenate([last[bit == 0], last[bit == 1]])

    def rank(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol precedes one of the suffixes before ``at``."""
        begin, end = np.zeros_like(at), at
        for k, (bits, zeros) in enumerate(self.levels):
            bit = (symbols >> (len(self.levels) - 1 - k)) & 1 == 1
            b, e = bits.ones(begin), bits.ones(end)
            begin, end = np.where(bit, zeros + b, begin - b), np.where(bit, zeros + e, end - e)
        return end - begin

    def windows(self, ends: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Backward search of the windows with the given last words: those with several places, and their intervals."""
        symbol = self.text[ends]
        low, high, alive = self.before[symbol], self.before[symbol + 1], np.arange(len(ends))
        for step in range(1, window):
            more = high - low > 1
            alive, low, high = alive[more], low[more], high[more]
            symbol = self.text[ends[alive] - step]
            low, high = (self.before[symbol] + self.rank(symbol, x) for x in (low, high))
        more = high - low > 1
        return alive[more], low[more], high[more]


def _sorted_suffixes(text: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes by their first symbols, at least ``depth`` of them, by doubling the length of what is ranked."""
    rank, length = text.astype(np.int64), 1
    while True:
        if length >= depth:
            return np.argsort(rank, kind="stable")
        behind = np.concatenate([rank[length:], rank[:length]])  # the text is taken as a circle
        key = rank * (int(rank.max()) + 1) + behind
        rank = np.unique(key, return_inverse=True)[1]
        length *= 2


def compare_by_fm_index(words: np.ndarray, first: np.ndarray, low: np.ndarray, high: np.ndarray, window: int, run: int):
    """Least and largest document of each window of a shard."""
    sizes = np.diff(first)
    segment = np.repeat(np.arange(len(sizes)), sizes)
    symbols = np.unique(words, return_inverse=True)[1] + 1
    text = np.zeros(len(words) + len(sizes), dtype=np.int64)
    place = np.arange(len(words)) + segment  # one sign behind each segment
    text[place] = symbols
    of = np.zeros(len(text), dtype=np.int64)
    of[place] = segment
    starts = np.flatnonzero(np.arange(len(words)) + window <= first[1:][segment])
    least, most = low[segment[starts]], high[segment[starts]]
    index = FmIndex(text, window)
    found, begin, end = index.windows(place[starts] + window - 1, window)
    if len(found):
        intervals, which = np.unique(np.stack([begin, end], axis=1), axis=0, return_inverse=True)
        sizes = intervals[:, 1] - intervals[:, 0]
        ahead = np.cumsum(sizes) - sizes
        inside = np.arange(sizes.sum()) - np.repeat(ahead, sizes) + np.repeat(intervals[:, 0], sizes)
        owner = of[index.suffixes[inside]]
        least[found] = np.minimum.reduceat(low[owner], ahead)[which.ravel()]
        most[found] = np.maximum.reduceat(high[owner], ahead)[which.ravel()]
    return least, most


def substring_dedup(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_removed and the kept words as a text, for each row of ``docs`` (doc_id, text)."""
    docs = docs.select("doc_id", "text")
    return without_repeats(docs, repeated_windows(docs, compare_by_fm_index, window, min(RUN, window)), window)


def substring_report(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256."""
    return substring_dedup(docs).select("doc_id", "n_words", "n_removed", sha256(F.col("kept")).alias("kept_sha256"))


SQL = rf"""
WITH docs AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
places AS (
  SELECT doc_id, place, array_to_string(words[place : place + {WINDOW - 1}], ' ') AS passage
  FROM (SELECT doc_id, words, unnest(generate_series(1, len(words) - {WINDOW - 1})) AS place FROM docs WHERE len(words) >= {WINDOW})),
firsts AS (SELECT passage, min(doc_id) AS first_doc FROM places GROUP BY passage HAVING count(DISTINCT doc_id) > 1),
lost AS (
  SELECT DISTINCT doc_id, unnest(generate_series(place, place + {WINDOW - 1})) AS place
  FROM places JOIN firsts USING (passage) WHERE first_doc < doc_id),
kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY place) AS kept, count(*) AS n
  FROM (SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS place FROM docs) ANTI JOIN lost USING (doc_id, place)
  GROUP BY doc_id)
SELECT docs.doc_id, len(words) AS n_words, len(words) - coalesce(n, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM docs LEFT JOIN kept USING (doc_id)
"""
