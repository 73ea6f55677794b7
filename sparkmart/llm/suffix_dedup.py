"""Passages that several documents have, by sparse suffix arrays.

Only suffixes at positions selected by content are retained: where a run of words has the least hash of its window (the anchors
of ``repeats``). A shard sorts its retained suffixes by their words and compares neighbours; the number of equal words between neighbours cuts the
sorted suffixes into classes for any length. A window with ``left`` words before its anchor is then told by its
suffix's class at the remaining length and the ``left`` words before it: matches extended to both sides.

``documents with passages`` of ``WINDOW`` words or more that another document has are reported, a row for each passage. In the smallest
document that has it the passage is the one that stays.

Defined results: null texts and texts shorter than a window have no passages. Passages that a document repeats within itself alone
are none. Rows that repeat an id are one document as to who has a passage first; each text is reported once. Rows without
id count as one such document, before all others. An empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmart.llm.common import prepare, real_id
from sparkmart.llm.repeats import repeated_windows, without_repeats
from sparkmart.llm.words import mix, runs, spread

WINDOW = 50
RUN = 10


def compare_by_suffixes(words: np.ndarray, first: np.ndarray, low: np.ndarray, high: np.ndarray, window: int, run: int):
    """Least and largest document of each window of a shard."""
    sizes = np.diff(first)
    segment = np.repeat(np.arange(len(sizes)), sizes)
    grams = runs(words, run)
    inside = np.arange(len(grams)) + run <= first[1:][segment[: len(grams)]]
    grams = np.where(inside, grams, np.uint64(0xFFFFFFFFFFFFFFFF))
    anchor = np.minimum.reduceat(grams, first[:-1])
    suffix = np.flatnonzero(inside & (grams == anchor[segment[: len(grams)]]))
    own = segment[suffix]
    behind, before = np.minimum(first[1:][own] - suffix, window), np.minimum(suffix - first[own], window - run)
    # Sort the retained suffixes and count the equal words of neighbours.
    places = np.arange(window)
    ahead = np.where(places < behind[:, None], words[np.minimum(suffix[:, None] + places, len(words) - 1)], np.uint64(0))
    order = np.argsort(np.ascontiguousarray(ahead.astype(">u8")).view(f"S{8 * window}").ravel(), kind="stable")
    suffix, own, behind, before, ahead = suffix[order], own[order], behind[order], before[order], ahead[order]
    differs = ahead[1:] != ahead[:-1]
    equal = np.where(differs.any(axis=1), differs.argmax(axis=1), window)
    equal = np.minimum(equal, np.minimum(behind[1:], behind[:-1]))
    # Extend to the left: a running hash of the words before the suffix.
    windows = np.cumsum(sizes - window + 1) - (sizes - window + 1)
    counts = sizes - window + 1
    least, most = np.repeat(low, counts), np.repeat(high, counts)
    left_hash = np.zeros(len(suffix), dtype=np.uint64)
    for left in range(window - run + 1):
        if left:
            left_hash = mix(left_hash + words[np.maximum(suffix - left, 0)])
        right = window - left
        group = np.concatenate([[0], np.cumsum(equal < right)]) if len(suffix) else np.zeros(0, np.int64)
        use = np.flatnonzero((before >= left) & (behind >= right))
        if not len(use):
            continue
        key = mix(left_hash[use] + spread(group[use]))
        turn = np.argsort(key, kind="stable")
        key, use = key[turn], use[turn]
        begin = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        size = np.diff(np.append(begin, len(key)))
        at = windows[own[use]] + suffix[use] - left - first[own[use]]
        least[at] = np.repeat(np.minimum.reduceat(low[own[use]], begin), size)
        most[at] = np.repeat(np.maximum.reduceat(high[own[use]], begin), size)
    return least, most


def _spans(found: DataFrame, window: int) -> DataFrame:
    """Windows joined to passages: (_id, start, n_words, first, removed)."""

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            for doc, *lists in zip(batch.column("_id").to_pylist(), *(batch.column(c) for c in ("starts", "firsts", "lasts"))):
                starts, firsts, lasts = (np.array(x.as_py(), dtype=np.int64) for x in lists)
                for removed, use in ((True, firsts < doc), (False, (firsts == doc) & (lasts > doc))):
                    order = np.flatnonzero(use)[np.argsort(starts[use], kind="stable")]
                    s, f = starts[order], firsts[order]
                    if not len(s):
                        continue
                    begin = np.flatnonzero(np.concatenate([[True], s[1:] - s[:-1] > window]))
                    last = np.append(begin[1:], len(s)) - 1
                    least = np.minimum.reduceat(f, begin)
                    rows += [(doc, int(a), int(b - a + window), int(c), removed) for a, b, c in zip(s[begin], s[last], least)]
            columns = list(zip(*rows)) if rows else [[]] * 5
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.bool_())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["_id", "start", "n_words", "first", "removed"])

    return found.mapInArrow(join, "_id bigint, start bigint, n_words bigint, first bigint, removed boolean")


def repeated_passages(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, start_word, n_words, first_doc_id, removed: a row for each passage of a document that another document has."""
    prepare(docs.sparkSession)
    found = repeated_windows(docs.select("doc_id", "text"), compare_by_suffixes, window, min(RUN, window), with_lasts=True)
    return _spans(found, window).select(
        real_id(F.col("_id"), docs).alias("doc_id"), F.col("start").alias("start_word"), "n_words", real_id(F.col("first"), docs).alias("first_doc_id"), "removed"
    )


def drop_passages(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_removed, kept: the texts without passages that a smaller document has."""
    docs = docs.select("doc_id", "text")
    return without_repeats(docs, repeated_windows(docs, compare_by_suffixes, window, min(RUN, window)), window)


SQL = rf"""
WITH docs AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
places AS (
  SELECT doc_id, place, array_to_string(words[place + 1 : place + {WINDOW}], ' ') AS passage
  FROM (SELECT doc_id, words, unnest(generate_series(0, len(words) - {WINDOW})) AS place FROM docs WHERE len(words) >= {WINDOW})),
shared AS (SELECT passage, min(doc_id) AS first_doc FROM places GROUP BY passage HAVING count(DISTINCT doc_id) > 1),
found AS (SELECT doc_id, place, first_doc, first_doc < doc_id AS removed FROM places JOIN shared USING (passage)),
marked AS (
  SELECT *, CASE WHEN place - lag(place) OVER (PARTITION BY doc_id, removed ORDER BY place) <= {WINDOW} THEN 0 ELSE 1 END AS opens FROM found),
numbered AS (SELECT *, sum(opens) OVER (PARTITION BY doc_id, removed ORDER BY place) AS span FROM marked)
SELECT doc_id, min(place) AS start_word, max(place) - min(place) + {WINDOW} AS n_words, min(first_doc) AS first_doc_id, removed
FROM numbered GROUP BY doc_id, removed, span
"""
