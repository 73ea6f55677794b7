"""Toxicity of a text by a classifier that is held to the same score when a group's name is swapped for another.

A text is the set of the byte n-grams of its words (lower case, a blank at both ends, ``LENGTHS`` bytes long). An n-gram fits into 64 bits, so none
is mistaken for another, and beginnings and parts of words count as well as words.

1. The sample: at most ``SAMPLE`` labelled rows, half of them toxic where there are as many, those with the least hash of their id, equal texts once.
2. ``FEATURES`` n-grams are chosen by their log odds in toxic and clean texts of the sample, over their deviation.
3. Every text of the sample gets a counterfactual: each name of a group in it becomes another of its kind (``IDENTITY_TERMS``); in a
   text that names none, one is added.
4. Logistic regression on the n-grams that a text has. The loss adds ``FAIRNESS`` times the mean square by which the swap changes the
   log odds, so that weights do not rest on the mere mention of a group, however often toxic texts of the sample mention it.

The classifier is fitted on the driver from bit vectors of fixed size, one pair a row of the sample. Scoring is one pass without a shuffle.

Defined results: a null text counts as empty, and an empty one has the score of a text without any of the chosen n-grams. Rows without an id or a label
are not learned from; of several labels of an id the largest counts, of several texts the one with the least hash. Without labels of both kinds
no n-gram is chosen, and all scores are the smoothed share of toxic labels. Each input row gives a row, repeated ones too; other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkmart.llm.common import Shared, prepare, store
from sparkmart.llm.words import cut, folding

SAMPLE = 4000
FEATURES = 1024
LENGTHS = range(4, 9)
LEAST_TEXTS = 4  # toxic or clean texts of the sample that an n-gram must be in
FAIRNESS = 1.0
RIDGE = 5e-5
TOXIC_FROM = 0.7
_STEPS = 600
_AT_ONCE = 64  # texts whose vectors are held at once
_PIECE = 1 << 20  # bytes whose n-grams are held at once

#: Names of groups by kind; a name is swapped for the next one of its kind.
IDENTITY_TERMS: dict[str, list[str]] = {
    "religion": ["christian", "muslim", "jewish", "hindu", "buddhist", "atheist", "christians", "muslims", "jews", "hindus", "buddhists", "atheists"],
    "origin": ["african", "asian", "european", "american", "arab", "mexican", "immigrant", "refugee", "africans", "asians", "arabs", "immigrants", "refugees"],
    "colour": ["black", "white", "brown"],
    "gender": ["woman", "man", "women", "men", "female", "male", "girl", "boy", "transgender", "nonbinary"],
    "orientation": ["gay", "straight", "lesbian", "bisexual", "heterosexual", "homosexual", "queer"],
    "body": ["disabled", "blind", "deaf", "autistic", "elderly"],
    "german": ["christen", "muslime", "juden", "frauen", "männer", "schwarze", "ausländer", "flüchtlinge", "behinderte"],
    "french": ["chrétiens", "musulmans", "juifs", "femmes", "hommes", "noirs", "étrangers", "réfugiés", "handicapés"],
    "spanish": ["cristianos", "musulmanes", "judíos", "mujeres", "hombres", "negros", "extranjeros", "refugiados", "discapacitados"],
}


def held_out(doc_id: Column) -> Column:
    """Rows whose label is never learned: a fixed third by the checksum of the id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def counterfactual(text: str, terms: dict[str, list[str]] = IDENTITY_TERMS) -> str:
    """The text with each name of a group swapped for the next of its kind; one that names none names one more."""
    following = {name: kind[(i + 1) % len(kind)] for kind in terms.values() for i, name in enumerate(kind)}
    if not following:
        return text
    names = "|".join(sorted(map(re.escape, following), key=len, reverse=True))
    swapped, count = re.subn(rf"(?<!\w)(?:{names})(?!\w)", lambda m: following[m[0].lower()], text, flags=re.IGNORECASE)
    if count:
        return swapped
    name = sorted(following)[zlib.crc32(text.encode("utf-8", "replace")) % len(following)]
    return f"{text} {name}"


def _letters() -> np.ndarray:
    """Lower-case letters and bytes above 127 stay, the rest becomes a blank."""
    fold = folding()
    stay = np.zeros(256, dtype=bool)
    stay[0x61:0x7B] = stay[0x80:] = True
    return np.where(stay[fold], fold, 0x20).astype(np.uint8)


def grams(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Number of the text and n-gram, for all n-grams, repeated ones too, piece by piece."""
    whole = cut(texts, np.zeros(256, dtype=bool))  # a text that is not empty is one word
    size = whole.end - whole.start
    data = np.full(len(whole.data) + 2 * len(size), 0x20, dtype=np.uint8)
    shift = 2 * np.arange(len(size)) + 1
    data[np.arange(len(whole.data)) + np.repeat(shift, size)] = _letters()[whole.data]
    ends = whole.end + shift + 1  # behind the blank after each text
    owner = whole.owner
    for low in range(0, len(data), _PIECE):
        part = data[low : low + _PIECE + max(LENGTHS)]
        blank = part == 0x20
        inner = np.cumsum(blank)  # blanks up to and including each byte
        key = part.astype(np.uint64)
        for length in range(2, max(LENGTHS) + 1):
            key = (key[:-1] << np.uint64(8)) | part[length - 1 :]
            if length in LENGTHS:
                count = min(len(key), _PIECE)
                inside = inner[length - 2 : length - 2 + count] - inner[:count]  # blanks strictly between the ends
                found = np.flatnonzero(inside == 0)
                if len(found):
                    yield owner[np.searchsorted(ends, found + low, side="right")], key[found]


def _cells(keys: np.ndarray) -> np.ndarray:
    return (keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(48)


class Model:
    def __init__(self, features: np.ndarray, weights: np.ndarray, offset: float):
        """``features`` ascend; ``offset`` is the log odds of a text without any of them."""
        self.features, self.weights, self.offset = features, weights, offset
        self.maybe = np.zeros(1 << 16, dtype=bool)
        self.maybe[_cells(features)] = True

    def present(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """Which features the texts have, for successive groups of texts."""
        for start in range(0, len(texts), _AT_ONCE):
            group = texts.slice(start, _AT_ONCE)
            has = np.zeros((len(group), len(self.features)), dtype=bool)
            if len(self.features):
                for owner, keys in grams(group):
                    near = np.flatnonzero(self.maybe[_cells(keys)])
                    place = np.minimum(np.searchsorted(self.features, keys[near]), len(self.features) - 1)
                    hit = self.features[place] == keys[near]
                    has[owner[near[hit]], place[hit]] = True
            yield has

    def scores(self, texts: pa.Array) -> np.ndarray:
        odds = [has @ self.weights + self.offset for has in self.present(pc.fill_null(texts, ""))]
        return 1 / (1 + np.exp(-np.clip(np.concatenate([np.zeros(0), *odds]), -50, 50)))


def _regression(has: np.ndarray, swapped: np.ndarray, toxic: np.ndarray, fairness: float) -> tuple[np.ndarray, float]:
    """Weights and offset by accelerated gradient steps; both classes weigh the same."""
    x, change = has.astype(np.float32), swapped.astype(np.float32) - has.astype(np.float32)
    share = np.where(toxic, 0.5 / max(1, toxic.sum()), 0.5 / max(1, (~toxic).sum())).astype(np.float32)
    # The step follows from the largest curvature, found by power iteration.
    v = np.ones(x.shape[1], np.float32)
    for _ in range(20):
        v = 0.25 * (x.T @ (share * (x @ v))) + 2 * fairness / len(x) * (change.T @ (change @ v)) + RIDGE * v
        curve = float(np.linalg.norm(v))
        v /= max(curve, 1e-12)
    rate = 1 / (1.5 * curve + 0.5)
    w = ahead = np.zeros(x.shape[1], np.float32)
    b = b_ahead = 0.0
    for i in range(_STEPS):
        error = share * (1 / (1 + np.exp(-np.clip(x @ ahead + b_ahead, -50, 50))) - toxic)
        slope = x.T @ error + 2 * fairness / len(x) * (change.T @ (change @ ahead)) + RIDGE * ahead
        new, new_b, pull = ahead - rate * slope, b_ahead - rate * float(error.sum()), i / (i + 3)
        ahead, b_ahead = new + pull * (new - w), new_b + pull * (new_b - b)
        w, b = new, new_b
    return w.astype(np.float64), b


def sample_of(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> tuple[DataFrame, dict[bool, int]]:
    """(text, toxic) to learn from, stored, and the number of rows by label that could be learned from."""
    wanted = F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id"))
    known = store(labels.filter(wanted).groupBy("doc_id").agg((F.max("toxic") == 1).alias("toxic")))
    place = F.xxhash64("doc_id") / 2.0**64 + 0.5  # from 0 to 1, in the order of the hashes
    counts = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    each = max(1, sample // 2)
    kinds = []
    for kind in (True, False):  # some four times the rows wanted lie below the place, so that a task sorts few more than are wanted
        near = known.filter((F.col("toxic") == kind) & (place <= (4.0 * each + 40) / max(1, counts.get(kind, 0))))
        kinds.append(near.orderBy(F.xxhash64("doc_id"), "doc_id").limit(each))
    chosen = store(kinds[0].unionByName(kinds[1]))
    least = F.min(F.struct(F.xxhash64("text").alias("h"), "text"))["text"].alias("text")
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(chosen, "doc_id").groupBy("doc_id", "toxic").agg(least)
    return store(texts.groupBy("text").agg(F.max("toxic").alias("toxic"))), counts


def _chosen_features(rows: DataFrame, features: int) -> np.ndarray:
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            toxic = batch.column("toxic").to_numpy(zero_copy_only=False)
            for start in range(0, batch.num_rows, _AT_ONCE):
                own, pairs = toxic[start : start + _AT_ONCE], []
                for owner, keys in grams(batch.column("text").slice(start, _AT_ONCE)):
                    pairs.append(_unique_pairs(keys, owner))
                if pairs:
                    keys, owner = (np.concatenate(x) for x in zip(*pairs))
                    keys, owner = _unique_pairs(keys, owner)
                    names, at = np.unique(keys, return_inverse=True)
                    bad = np.bincount(at, weights=own[owner].astype(float), minlength=len(names)).astype(np.int64)
                    all_ = np.bincount(at, minlength=len(names))
                    yield pa.RecordBatch.from_arrays([pa.array(names.view(np.int64)), pa.array(bad), pa.array(all_ - bad)], ["gram", "bad", "good"])

    found = rows.mapInArrow(counted, "gram bigint, bad bigint, good bigint").groupBy("gram").agg(F.sum("bad").alias("a"), F.sum("good").alias("b"))
    sizes = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    bad, good = sizes.get(True, 0), sizes.get(False, 0)
    if not bad or not good:
        return np.zeros(0, np.uint64)
    cells = [F.col("a") + 0.5, bad - F.col("a") + 0.5, F.col("b") + 0.5, good - F.col("b") + 0.5]
    odds = F.log(cells[0]) - F.log(cells[1]) - F.log(cells[2]) + F.log(cells[3])
    sure = odds / F.sqrt(1 / cells[0] + 1 / cells[1] + 1 / cells[2] + 1 / cells[3])
    enough = found.filter(F.greatest("a", "b") >= LEAST_TEXTS).select("gram", F.abs(sure).alias("sure"))
    best = enough.orderBy(F.desc("sure"), "gram").limit(features).collect()
    return np.sort(np.array([r["gram"] for r in best], dtype=np.int64).view(np.uint64))


def _unique_pairs(keys: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((keys, owner))
    keys, owner = keys[order], owner[order]
    new = np.ones(len(keys), dtype=bool)
    new[1:] = (keys[1:] != keys[:-1]) | (owner[1:] != owner[:-1])
    return keys[new], owner[new]


def fit(
    docs: DataFrame, labels: DataFrame, *, sample: int = SAMPLE, features: int = FEATURES, fairness: float = FAIRNESS,
    terms: dict[str, list[str]] = IDENTITY_TERMS,
) -> Model:
    """Learn from the labelled rows that are not held out."""
    prepare(docs.sparkSession)
    rows, counts = sample_of(docs, labels, sample)
    bad, good = counts.get(True, 0), counts.get(False, 0)
    chosen = _chosen_features(rows, features)
    if not len(chosen):
        return Model(chosen, np.zeros(0), float(np.log((bad + 1) / (good + 1))))
    finder = Shared(docs.sparkSession, Model(chosen, np.zeros(len(chosen)), 0.0))

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text")
            swapped = pa.array([counterfactual(t, terms) for t in texts.to_pylist()], texts.type)
            flat = [[row.tobytes() for has in finder.value.present(x) for row in np.packbits(has, axis=1)] for x in (texts, swapped)]
            yield pa.RecordBatch.from_arrays([batch.column("toxic"), *[pa.array(x, pa.binary()) for x in flat]], ["toxic", "own", "swapped"])

    found = sorted(rows.mapInArrow(vectors, "toxic boolean, own binary, swapped binary").collect(), key=lambda r: (r.toxic, bytes(r.own), bytes(r.swapped)))
    bits = lambda name: np.array([np.unpackbits(np.frombuffer(r[name], np.uint8), count=len(chosen)) for r in found], dtype=bool)
    weights, offset = _regression(bits("own"), bits("swapped"), np.array([r.toxic for r in found]), fairness)
    # Both classes weighed the same; the offset moves to the shares that they have.
    return Model(chosen, weights, offset + float(np.log((bad + 1) / (good + 1))))


def score(docs: DataFrame, model: Model, carry: list[str]) -> DataFrame:
    """The columns ``carry`` as the struct ``_doc`` and ``score``, for each row of ``docs``."""
    shared = Shared(prepare(docs.sparkSession), model)
    rows = docs.select(F.struct(*carry).alias("_doc"), F.col("text").alias("_text"))

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("_doc"), pa.array(shared.value.scores(batch.column("_text")))], ["_doc", "score"])

    return rows.mapInArrow(scored, f"_doc {rows.schema['_doc'].dataType.simpleString()}, score double")


def toxicity_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted, for every row of ``docs``."""
    return score(docs, fit(docs, labels), ["doc_id"]).select(
        "_doc.doc_id", held_out(F.col("_doc.doc_id")).alias("held_out"), "score", (F.col("score") >= TOXIC_FROM).cast("int").alias("predicted")
    )
