"""Windows of words that occur in several documents: finding the places worth comparing, and using the result.

A window is ``window`` successive words of one document. Its anchor is the least hash among its runs of ``run`` words, so equal windows
have equal anchors, and a window can be repeated only if its anchor is.

1. Each document gives its distinct anchors. Those in one document only are ruled out; counting combines before the shuffle.
2. Documents with other anchors are cut into segments: the words under successive windows with one repeated anchor. A segment
   travels as 48 bits of the hash of each word. Equal segments are reduced to one, with the least and the largest document that has them.
3. Segments with one anchor go to one shard, where an operator compares their windows. An anchor in more than
   ``HOT`` documents has its windows as segments of their own, dealt by their content, so no shard gets a large share of all documents.
4. The least and largest document of each window go back to the documents through joins on the segment.

The number of shards follows the number of words, so that a shard stays at about ``SHARD_WORDS``.

Two different words agree in 48 bits with a probability of 4 in 10^15. A window is taken for another only if all their different words do.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmart.llm.common import discard, node_id, prepare, store, text_key
from sparkmart.llm.words import BLANKS, Words, cut, inside_one, mix, runs, sliding_min, spread

SHARD_WORDS = 1 << 20
HOT = 4096  # segments of one anchor that still fit into a shard, at up to two windows of 50 words each
WIDTH = 6  # bytes of a word's hash that travel with a segment
_FAR = np.uint64(0xFFFFFFFFFFFFFFFF)

#: (words of all segments of a shard, first word of each, least and largest document of each, window, run)
#: to the least and largest document of each window, one window after the other.
Compare = Callable[[np.ndarray, np.ndarray, np.ndarray, np.ndarray, int, int], tuple[np.ndarray, np.ndarray]]


def _words(texts: pa.Array) -> Words:
    """Words with the part of their hash that travels."""
    words = cut(texts, BLANKS)
    words.hash &= np.uint64((1 << 8 * WIDTH) - 1)
    return words


def _window_runs(words: Words, window: int, run: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Successive windows with one anchor: first window, number of windows, anchor, text."""
    none = np.zeros(0, dtype=np.int64)
    count = len(words.hash) - window + 1
    if count <= 0:
        return none, none, none.astype(np.uint64), none
    grams = runs(words.hash, run)
    anchor = sliding_min(np.where(inside_one(words.first, run, len(grams)), grams, _FAR), window - run + 1)[:count]
    valid, owner = inside_one(words.first, window, count), words.owner[:count]
    head = valid.copy()
    head[1:] &= ~valid[:-1] | (anchor[1:] != anchor[:-1]) | (owner[1:] != owner[:-1])
    stop = ~valid | head
    start = np.flatnonzero(head)
    ends = np.append(np.flatnonzero(stop), count)
    return start, ends[np.searchsorted(ends, start, side="right")] - start, anchor[start], owner[start]


def _anchors(docs: DataFrame, window: int, run: int) -> DataFrame:
    """(_anchor, _id, _key), each once for each row of ``docs``."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, _, anchor, owner = _window_runs(_words(batch.column("text")), window, run)
            _, once = np.unique(mix(anchor + spread(owner)), return_index=True)
            owner = pa.array(owner[once])
            yield pa.RecordBatch.from_arrays(
                [pa.array(anchor[once].view(np.int64)), batch.column("_id").take(owner), batch.column("_key").take(owner)],
                ["_anchor", "_id", "_key"],
            )

    return docs.mapInArrow(find, "_anchor bigint, _id bigint, _key bigint")


def _expanded(start: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of all words of the given stretches, and their places inside the stretch."""
    place = np.arange(length.sum()) - np.repeat(np.cumsum(length) - length, length)
    return np.repeat(start, length) + place, place


def _segments(docs: DataFrame, window: int, run: int) -> DataFrame:
    """(_shard, _c1, _c2, _id, _key, _start, _words) from documents with their repeated anchors."""

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = _words(batch.column("text"))
            start, windows, anchor, owner = _window_runs(words, window, run)
            lists = batch.column("_anchors")
            sizes = np.diff(lists.offsets.to_numpy())
            flat = lists.flatten()
            known = flat.field("anchor").to_numpy().view(np.uint64) + spread(np.repeat(np.arange(len(batch)), sizes))
            order = np.argsort(known)
            known, hot = known[order], flat.field("hot").to_numpy(zero_copy_only=False)[order]
            wanted = anchor + spread(owner)
            at = np.minimum(np.searchsorted(known, wanted), max(0, len(known) - 1))
            use = known[at] == wanted if len(known) else np.zeros(len(wanted), dtype=bool)
            start, windows, anchor, owner, hot = start[use], windows[use], anchor[use], owner[use], hot[at[use]] if len(known) else use[use]
            # Windows of a hot anchor stand alone.
            single, _ = _expanded(start[hot], windows[hot])
            owners = np.concatenate([owner[~hot], np.repeat(owner[hot], windows[hot])])
            starts = np.concatenate([start[~hot], single])
            length = np.concatenate([windows[~hot] + window - 1, np.full(len(single), window)])
            where, place = _expanded(starts, length)
            content, first = words.hash[where], np.cumsum(length) - length
            turn = spread(place)
            sums = [np.add.reduceat(mix((content ^ np.uint64(k)) + turn), first) if len(first) else content for k in (0, 0x5BD1E995)]
            shard = np.concatenate([mix(anchor[~hot]), sums[0][(~hot).sum() :]])
            offsets = np.append(first, len(content)).astype(np.int32) * WIDTH
            tight = content.view(np.uint8).reshape(-1, 8)[:, :WIDTH].tobytes()
            packed = pa.Array.from_buffers(pa.binary(), len(first), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(tight)])
            row = pa.array(owners)
            longs = [pa.array(x.view(np.int64)) for x in (shard, *sums)]
            begin = pa.array((starts - words.first[owners]).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [*longs, batch.column("_id").take(row), batch.column("_key").take(row), begin, packed],
                ["_shard", "_c1", "_c2", "_id", "_key", "_start", "_words"],
            )

    return docs.mapInArrow(take, "_shard bigint, _c1 bigint, _c2 bigint, _id bigint, _key bigint, _start int, _words binary")


def repeated_windows(docs: DataFrame, compare: Compare, window: int, run: int, with_lasts: bool = False) -> DataFrame:
    """(_id, _key, starts, firsts) of documents (doc_id, text) with windows that other documents may have too.

    starts are the first words of all windows under a repeated anchor, firsts (and lasts, where asked for) the least
    (and the largest) document that has the window.
    """
    spark = prepare(docs.sparkSession)
    rows = docs.select(node_id(F.col("doc_id")).alias("_id"), text_key(F.col("text")).alias("_key"), "text")
    anchors = _anchors(rows, window, run)
    spans = anchors.groupBy("_anchor").agg(F.min("_id").alias("_low"), F.max("_id").alias("_high"), F.count(F.lit(1)).alias("_n"))
    repeated = store(spans.filter("_low < _high").select("_anchor", (F.col("_n") > HOT).alias("hot")))
    own = F.collect_list(F.struct(F.col("_anchor").alias("anchor"), "hot")).alias("_anchors")
    of_doc = store(anchors.join(repeated, "_anchor").groupBy("_id", "_key").agg(own))
    segments = store(_segments(rows.join(of_doc, ["_id", "_key"]), window, run))
    content = segments.groupBy("_c1", "_c2").agg(
        F.any_value("_shard").alias("_shard"), F.any_value("_words").alias("_words"), F.min("_id").alias("_low"), F.max("_id").alias("_high")
    )
    distinct = store(content)
    places = store(segments.select("_c1", "_c2", "_id", "_key", "_start"))
    discard(segments)
    total = distinct.agg(F.sum(F.octet_length("_words"))).first()[0] or 0
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // (WIDTH * SHARD_WORDS)))

    def shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if len(b)]
        if not held:
            return
        whole = pa.Table.from_batches(held).combine_chunks()
        tight = np.frombuffer(b"".join(whole.column("_words").to_pylist()), np.uint8).reshape(-1, WIDTH)
        words = np.zeros((len(tight), 8), dtype=np.uint8)
        words[:, :WIDTH] = tight
        first = np.concatenate([[0], np.cumsum([len(v) // WIDTH for v in whole.column("_words").to_pylist()])])
        low, high = (whole.column(c).to_numpy() for c in ("_low", "_high"))
        low, high = compare(words.view(np.uint64).ravel(), first, low, high, window, run)
        offsets = pa.array(np.concatenate([[0], np.cumsum(np.diff(first) - window + 1)]).astype(np.int32))
        lists = [pa.ListArray.from_arrays(offsets, pa.array(x, pa.int64())) for x in ((low, high) if with_lasts else (low,))]
        columns = [pa.array(whole.column(c).to_numpy()) for c in ("_c1", "_c2")]
        yield pa.RecordBatch.from_arrays([*columns, *lists], ["_c1", "_c2", *results])

    results = ["firsts", "lasts"] if with_lasts else ["firsts"]
    schema = "_c1 bigint, _c2 bigint, " + ", ".join(f"{name} array<bigint>" for name in results)
    judged = store(distinct.repartition(shards, "_shard").mapInArrow(shard, schema))
    discard(distinct)
    starts = F.transform("firsts", lambda _, i: F.col("_start") + i)
    lists = [F.flatten(F.collect_list(c)).alias(name) for c, name in ((starts, "starts"), *((name, name) for name in results))]
    found = places.distinct().join(judged, ["_c1", "_c2"])
    return found.groupBy("_id", "_key").agg(*lists)


def covered(starts: np.ndarray, window: int, count: int) -> np.ndarray:
    """Which of ``count`` words lie in a window that begins at one of ``starts``."""
    steps = np.zeros(count + 1, dtype=np.int64)
    np.add.at(steps, starts, 1)
    np.add.at(steps, starts + window, -1)
    return np.cumsum(steps[:-1]) > 0


def without_repeats(docs: DataFrame, found: DataFrame, window: int) -> DataFrame:
    """(doc_id, n_words, n_removed, kept): the words outside windows that a smaller document has, joined by blanks."""
    lost = found.select("_id", "_key", F.filter("starts", lambda s, i: F.get("firsts", i) < F.col("_id")).alias("_lost")).filter(F.size("_lost") > 0)
    rows = docs.select("doc_id", node_id(F.col("doc_id")).alias("_id"), text_key(F.col("text")).alias("_key"), "text")
    joined = rows.join(lost, ["_id", "_key"], "left").select("doc_id", "text", "_lost")

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = cut(batch.column("text"), BLANKS)
            sizes = np.diff(words.first)
            keep = np.ones(len(words.hash), dtype=bool)
            lists = batch.column("_lost")
            for i in np.flatnonzero(lists.is_valid().to_numpy(zero_copy_only=False)):
                keep[words.first[i] : words.first[i + 1]] = ~covered(np.array(lists[i].as_py(), dtype=np.int64), window, sizes[i])
            owner = words.owner
            stays = np.flatnonzero(keep)
            kept = np.bincount(owner[stays], minlength=len(sizes))
            length = words.end[stays] - words.start[stays] + 1
            where, place = _expanded(words.start[stays], length)
            blank = place == np.repeat(length, length) - 1
            data = np.where(blank, np.uint8(0x20), words.data[np.minimum(where, max(0, len(words.data) - 1))]) if len(stays) else words.data[:0]
            ends = np.concatenate([[0], np.cumsum(length)])[np.concatenate([[0], np.cumsum(kept)])]
            raw = data.tobytes()
            texts = [raw[a : max(a, b - 1)].decode() for a, b in zip(ends[:-1], ends[1:])]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes.astype(np.int64)), pa.array((sizes - kept).astype(np.int64)), pa.array(texts, pa.string())],
                ["doc_id", "n_words", "n_removed", "kept"],
            )

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return joined.mapInArrow(remove, f"doc_id {id_type}, n_words bigint, n_removed bigint, kept string")
