"""Language of a text by its nearest centroid.

A text is the vector of its byte trigrams (lower case, everything but letters as a blank, a blank at both ends), hashed to
``DIMENSIONS`` numbers, as the square root of the count times the inverse document frequency, scaled to length 1. Each language has up to ``CENTROIDS`` centroids,
found by clustering its training vectors by cosine. The language of the most similar centroid is the prediction, its cosine
the score. A text is rejected when it has no letter, or when its cosine is lower than texts of that language have: that far from all
centroids. As cosines grow with the length, the least cosine is learned for the effective number of trigrams (a word said
100 times counts as little more than one word): training rows and excerpts of them are
scored by centroids of the other half of the rows, and scores ``SPREADS`` deviations below the mean of their length are too low. For few
trigrams that is below 0, so no short text is rejected for its cosine; nor is any of a language with too few rows to tell.

The classifier is fitted on a bounded sample: at most ``SAMPLE`` training rows, shared out evenly between languages, those with the least
hash of their id, which are written once. Rows are counted by language first, so that a task ranks few more rows than are wanted of its language. If few ids
make up a language, fewer rows than wanted may be taken, at least one. Only their vectors, of fixed size, and
the scores of their excerpts reach the driver. Prediction is one pass without a shuffle.

Defined results: null and letterless texts are ``und`` with score 0. Rows with null id or null language are not learned from. With
nothing to learn, every row is ``und``. Ties go to the language first in order. Each input row gives a row, repeated ones too;
other columns are carried as they are.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkmart.llm.common import Shared, prepare, released, store
from sparkmart.llm.words import cut, folding

DIMENSIONS = 1 << 12
SAMPLE = 1200
CENTROIDS = 3
SPREADS = 4.0
ENOUGH = 8  # scores that a mean and a deviation are taken of
LEVELS = np.arange(15)  # of lengths, as powers of 2
_ROUNDS = 10
_AT_ONCE = 128  # texts whose vectors are held at once
UNKNOWN = "und"


def held_out(doc_id: Column) -> Column:
    """Rows that are kept from training: a fixed quarter by the checksum of the id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _letters() -> np.ndarray:
    """Lower-case letters and bytes above 127 stay, the rest becomes a blank."""
    fold = folding()
    stay = np.zeros(256, dtype=bool)
    stay[0x61:0x7B] = stay[0x80:] = True
    return np.where(stay[fold], fold, 0x20).astype(np.uint8)


def raw_vectors(texts: pa.Array) -> Iterator[np.ndarray]:
    """Square roots of the trigram counts, for successive groups of texts."""
    nothing = np.zeros(256, dtype=bool)
    letters = _letters()
    for start in range(0, len(texts), _AT_ONCE):
        group = texts.slice(start, _AT_ONCE)
        whole = cut(group, nothing)  # a text that is not empty is one word
        size = whole.end - whole.start
        data = np.full(len(whole.data) + 2 * len(size), 0x20, dtype=np.uint32)
        data[np.arange(len(whole.data)) + np.repeat(2 * np.arange(len(size)) + 1, size)] = letters[whole.data]
        code = ((data[:-2] << 16 | data[1:-1] << 8 | data[2:]) * np.uint32(2654435761)) >> np.uint32(20)
        wanted = data[1:-1] != 0x20  # around a letter, so all of one text
        cell = np.repeat(whole.owner, size + 2)[1:-1][wanted] * DIMENSIONS + code[wanted]
        yield np.sqrt(np.bincount(cell, minlength=len(group) * DIMENSIONS).reshape(len(group), DIMENSIONS)).astype(np.float32)


def _unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-12)


def _trigrams(raw: np.ndarray) -> np.ndarray:
    """Effective number of trigrams: their number if all differ, less where some repeat."""
    counts = np.square(raw)
    return counts.sum(axis=1) ** 2 / np.maximum(np.square(counts).sum(axis=1), 1)


def _clustered(rows: np.ndarray, k: int) -> np.ndarray:
    """Centroids by cosine; the first is the mean's nearest row, each next one the row least like those before."""
    chosen = [int(np.argmax(rows @ rows.mean(axis=0)))]
    while len(chosen) < min(k, len(rows)):
        chosen.append(int(np.argmin((rows @ rows[chosen].T).max(axis=1))))
    centres = rows[chosen]
    for _ in range(_ROUNDS):
        nearest = (rows @ centres.T).argmax(axis=1)
        means = [rows[nearest == i].mean(axis=0) if (nearest == i).any() else centres[i] for i in range(len(centres))]
        centres = _unit(np.array(means))
    return centres


def excerpts(text: str) -> list[str]:
    """The text, and whole words of it of about 1, 2, 4, 8 ... characters, each from another place."""
    found = [text]
    for level in LEVELS:
        size = 1 << int(level)
        if size >= len(text):
            break
        start = zlib.crc32(f"{level} {text[:1000]}".encode("utf-8", "replace")) % (len(text) - size + 1)
        while 0 < start < len(text) and text[start - 1].isalpha():
            start -= 1
        end = start + size
        while end < len(text) and text[end].isalpha() and end < start + size + 32:
            end += 1
        found.append(text[start:end])
    return found


def _least_scores(found: list[tuple[str, float, float]]) -> dict[str, np.ndarray]:
    """By language, for each of ``LEVELS``, the least score of a text, from (language, trigrams, score)."""
    least = {}
    for name in sorted({f[0] for f in found}):
        own = np.array([f[1:] for f in found if f[0] == name])
        level = np.rint(np.log2(own[:, 0])).astype(int)
        least[name] = np.zeros(len(LEVELS))
        for i in LEVELS:
            scores = own[level == i, 1]
            enough = len(scores) >= ENOUGH
            least[name][i] = max(0.0, scores.mean() - SPREADS * scores.std()) if enough else least[name][max(0, i - 1)]
    return least


class Classifier:
    def __init__(self, vectors: np.ndarray, languages: list[str]):
        self.idf = np.log((1 + len(vectors)) / (1 + (vectors > 0).sum(axis=0))).astype(np.float32) + 1
        rows, names = _unit(vectors * self.idf), np.array(languages, dtype=object)
        parts = {name: _clustered(rows[names == name], CENTROIDS) for name in sorted(set(languages))}
        self.centres = np.concatenate([*parts.values()]).astype(np.float32) if parts else np.zeros((0, DIMENSIONS), np.float32)
        self.names = np.array([name for name, own in parts.items() for _ in own], dtype=object)
        self.least: dict[str, np.ndarray] = {}

    def own_scores(self, texts: pa.Array, language: str) -> tuple[np.ndarray, np.ndarray]:
        """Trigrams of the texts and their scores for one language, which has a centroid."""
        centres, counts, scores = self.centres[self.names == language], [], []
        for raw in raw_vectors(texts):
            counts.append(_trigrams(raw))
            scores.append((_unit(raw * self.idf) @ centres.T).max(axis=1))
        return np.concatenate(counts), np.concatenate(scores)

    def _far(self, names: np.ndarray, raw: np.ndarray, scores: np.ndarray) -> np.ndarray:
        level = np.log2(np.maximum(_trigrams(raw), 1))
        far = np.zeros(len(names), dtype=bool)
        for name, least in self.least.items():
            far |= (names == name) & (scores < np.interp(level, LEVELS, least))
        return far

    def predict(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Languages, scores, and whether the score is too low."""
        names, scores, far = [], [], []
        for raw in raw_vectors(texts):
            if len(self.names):
                cosines = _unit(raw * self.idf) @ self.centres.T
                best = cosines.argmax(axis=1)
                names.append(self.names[best])
                scores.append(np.clip(cosines[np.arange(len(best)), best], 0, 1).astype(np.float64))
                far.append(self._far(names[-1], raw, scores[-1]))
            else:
                names.append(np.full(len(raw), UNKNOWN, dtype=object))
                scores.append(np.zeros(len(raw)))
                far.append(np.ones(len(raw), dtype=bool))
        return np.concatenate([np.zeros(0, object), *names]), np.concatenate([np.zeros(0), *scores]), np.concatenate([np.zeros(0, bool), *far])


def fit(docs: DataFrame, sample: int = SAMPLE) -> Classifier:
    """Learn from ``docs`` (doc_id, text, lang), but not from held-out rows."""
    prepare(docs.sparkSession)
    usable = F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & ~held_out(F.col("doc_id")) & F.col("text").rlike(r"\p{L}")
    rows = docs.select("doc_id", "text", "lang").filter(usable)
    place = F.xxhash64("doc_id") / 2.0**64 + 0.5  # from 0 to 1, in the order of the hashes
    sizes = store(rows.groupBy("lang").agg(F.count(F.lit(1)).alias("_rows"), F.min(place).alias("_least")))
    each = max(1, sample // max(1, sizes.count()))
    # Some four times the rows wanted lie below this place, whatever the number of tasks; the row with the least hash always does.
    below = F.greatest("_least", (4 * each + 40) / F.col("_rows"))
    near = rows.join(sizes, "lang").filter(place <= below).select(*rows.columns)
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id", "text")
    chosen = store(near.withColumn("_n", F.row_number().over(order)).filter(F.col("_n") <= each).select("lang", "text", (F.col("_n") % 2).alias("half")))

    @released
    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat = [row.tobytes() for rows in raw_vectors(batch.column("text")) for row in rows]
            yield pa.RecordBatch.from_arrays([batch.column("lang"), batch.column("half"), pa.array(flat, pa.binary())], ["lang", "half", "vector"])

    found = chosen.mapInArrow(vectors, "lang string, half int, vector binary").collect()
    found = sorted(found, key=lambda r: (r.lang, bytes(r.vector)))
    learned = _learned(found)
    halves = Shared(docs.sparkSession, [_learned([r for r in found if r.half != i]) for i in (0, 1)])

    @released
    def scores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                other = halves.value[row["half"]]
                if row["lang"] in other.names:
                    count, score = other.own_scores(pa.array(excerpts(row["text"]), pa.string()), row["lang"])
                    some = count > 0
                    columns = [pa.array([row["lang"]] * int(some.sum()), pa.string()), *[pa.array(x[some].astype(np.float64)) for x in (count, score)]]
                    yield pa.RecordBatch.from_arrays(columns, ["lang", "count", "score"])

    learned.least = _least_scores([tuple(r) for r in chosen.mapInArrow(scores, "lang string, count double, score double").collect()])
    return learned


def _learned(rows: list) -> Classifier:
    matrix = np.array([np.frombuffer(r.vector, np.float32) for r in rows]).reshape(-1, DIMENSIONS)
    return Classifier(matrix, [r.lang for r in rows])


def identify(docs: DataFrame, classifier: Classifier, carry: list[str]) -> DataFrame:
    """``_doc`` (the columns ``carry`` as a struct), lang_pred, score and rejected, for each row of ``docs``."""
    shared = Shared(prepare(docs.sparkSession), classifier)
    has_letter = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    rows = docs.select(F.struct(*carry).alias("_doc"), F.col("text").alias("_text"), has_letter.alias("_letter"))

    @released
    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, scores, far = shared.value.predict(batch.column("_text"))
            letter = batch.column("_letter").to_numpy(zero_copy_only=False)
            names, scores, far = np.where(letter, names, UNKNOWN), np.where(letter, scores, 0.0), far | (names == UNKNOWN) | ~letter
            columns = [batch.column("_doc"), pa.array(names, pa.string()), pa.array(scores), pa.array(far)]
            yield pa.RecordBatch.from_arrays(columns, ["_doc", "lang_pred", "score", "rejected"])

    carried = rows.schema["_doc"].dataType.simpleString()
    return rows.mapInArrow(predict, f"_doc {carried}, lang_pred string, score double, rejected boolean")


def language_report(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score, rejected."""
    return identify(docs, fit(docs), ["doc_id"]).select(
        "_doc.doc_id", held_out(F.col("_doc.doc_id")).alias("held_out"), "lang_pred", "score", "rejected"
    )


def keep_identified(docs: DataFrame) -> DataFrame:
    """``docs`` without the rejected rows, all columns."""
    return identify(docs, fit(docs), docs.columns).filter(~F.col("rejected")).select("_doc.*")
