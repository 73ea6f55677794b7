"""Near copies by MinHash with sequential Bayesian verification.

1. A text gives the set of its 5-word shingles as 64-bit hashes, a 128-bit digest of that set and ``BANDS * ROWS`` minima. Texts with
   equal sets are one class and go on as its least document, so copies are never paired.
2. Classes that agree in a band share a bucket. Each is paired with the least class of the bucket.
3. A pair's minima are compared in batches. After n of them with m equal, the similarity has the posterior
   Beta(m + 1, n - m + 1); the pair is dropped as soon as its chance to reach the threshold is below ``MISS``.
4. Survivors are verified on the full sets of both texts, and links give components.
5. What is left are pairs inside a bucket that do not hold its least class and lie in different components. Blocks of members of
   bounded size are compared by the same rule and verified at once, the likeliest first. A link joins two components, whose other pairs
   need nothing more, so a block gives fewer links than it has members, and no pairs leave it. Buckets that are one
   component by now, as most of a large group of near copies, are not looked at.

A pair at the threshold shares no band with a probability of (1 - s^ROWS)^BANDS, 2 in 10^13 at 0.85 and 7 in 10^10 at 0.8. There is
no cap on buckets, partners or candidates. Of each minimum 16 bits are kept: equal ones stay equal, and unlike ones that agree
by chance only let a pair live longer.

Defined results: a text with fewer words than a shingle is one shingle; without words it has none and is linked with nothing. Rows
that repeat an id with other texts are each judged by their own text, under the same id. A row without id is a document told by its
text, before all that have one, so its component is null. An empty table gives an empty result. Other
columns are carried along by ``drop_near_copies`` and not read otherwise.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkmart.llm.common import discard, prepare, released, store, text_key
from sparkmart.llm.components import connected_components
from sparkmart.llm.numbering import numbered
from sparkmart.llm.words import BLANKS, Words, cut, inside_one, mix, runs, spread

SHINGLE = 5
BANDS, ROWS = 40, 4
BATCH = 20
MISS = 1e-9
BLOCK = 2000  # members of a bucket compared with as many others at once


def shingles(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles as hashes, and how many each text has; they are grouped by text."""
    count, texts = len(words.hash), len(words.first) - 1
    hashes = runs(words.hash, SHINGLE)
    use = np.flatnonzero(inside_one(words.first, SHINGLE, len(hashes)))
    owner, hashes = words.owner[use], hashes[use]
    sizes = np.diff(words.first)
    short = np.flatnonzero((sizes > 0) & (sizes < SHINGLE))
    if len(short):
        whole = np.zeros(len(short), dtype=np.uint64)
        for k in range(SHINGLE - 1):
            more = sizes[short] > k
            whole[more] = mix(whole[more] * np.uint64(31) + words.hash[words.first[short[more]] + k])
        owner, hashes = np.concatenate([owner, short]), np.concatenate([hashes, mix(whole + sizes[short].astype(np.uint64))])
    _, once = np.unique(mix(hashes + spread(owner)), return_index=True)
    once = once[np.argsort(owner[once], kind="stable")]
    return hashes[once], np.bincount(owner[once], minlength=texts) if count else np.zeros(texts, dtype=np.int64)


def signatures(hashes: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Minima (texts x hashes, the low 16 bits), and two sums that are the digest of each set; texts without shingles have none."""
    some = np.flatnonzero(sizes)
    begin = (np.cumsum(sizes) - sizes)[some]
    seeds = spread(np.arange(2 * BANDS * ROWS))
    minima = np.zeros((len(sizes), BANDS * ROWS), dtype=np.uint16)
    sums = np.zeros((2, len(sizes)), dtype=np.uint64)
    if len(some):
        for j in range(BANDS * ROWS):
            values = ((hashes * (seeds[2 * j] | np.uint64(1)) + seeds[2 * j + 1]) >> np.uint64(32)).astype(np.uint32)
            minima[some, j] = np.minimum.reduceat(values, begin).astype(np.uint16)
        sums[0, some] = np.add.reduceat(mix(hashes), begin)
        sums[1, some] = np.add.reduceat(mix(hashes ^ seeds[0]), begin)
    return minima, sums[0], sums[1]


def least_matches(percent: int) -> list[int]:
    """For each number of batches seen, the fewest equal minima with which a pair still has a chance of ``MISS``."""
    t = percent / 100
    chance = lambda m, n: sum(comb(n + 1, i) * t**i * (1 - t) ** (n + 1 - i) for i in range(m + 1))
    return [next(m for m in range(n + 1) if chance(m, n) >= MISS) for n in range(BATCH, BANDS * ROWS + 1, BATCH)]


def survivors(left: np.ndarray, right: np.ndarray, least: list[int]) -> np.ndarray:
    """Numbers of the rows (of minima) that stay after all batches."""
    alive, equal = np.arange(len(right)), np.zeros(len(right), dtype=np.int64)
    for k, fewest in enumerate(least):
        at = slice(k * BATCH, (k + 1) * BATCH)
        ours = left[at] if left.ndim == 1 else left[alive, at]
        equal = equal + (ours == right[alive, at]).sum(axis=1)
        stay = equal >= fewest
        alive, equal = alive[stay], equal[stay]
    return alive


def _minima(column: pa.Array) -> np.ndarray:
    return np.array([np.frombuffer(v.as_py(), np.uint16) for v in column]).reshape(-1, BANDS * ROWS)


def sketches(docs: DataFrame) -> DataFrame:
    """(_id, _key, n_shingles, _s1, _s2, _minima) for each row of ``docs``."""

    @released
    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes, sizes = shingles(cut(batch.column("text"), BLANKS, fold=True))
            minima, s1, s2 = signatures(hashes, sizes)
            packed = pa.array([row.tobytes() for row in minima], pa.binary())
            sums = [pa.array(s.view(np.int64)) for s in (s1, s2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("_id"), batch.column("_key"), pa.array(sizes.astype(np.int64)), *sums, packed],
                ["_id", "_key", "n_shingles", "_s1", "_s2", "_minima"],
            )

    rows = docs.select(F.col("doc_id").cast("bigint").alias("_id"), text_key(F.col("text")).alias("_key"), "text")
    return rows.mapInArrow(sketch, "_id bigint, _key bigint, n_shingles bigint, _s1 bigint, _s2 bigint, _minima binary")


def _likely(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that survive the comparison of their minima."""
    least = least_matches(percent)

    @released
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.select(["a", "b"]).take(pa.array(survivors(_minima(batch.column("_l")), _minima(batch.column("_r")), least)))

    side = lambda end, name: classes.select(F.col("_class").alias(end), F.col("_minima").alias(name))
    both = pairs.join(side("a", "_l"), "a").join(side("b", "_r"), "b")
    return both.select("a", "b", "_l", "_r").mapInArrow(compare, "a bigint, b bigint")


def _verified(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """The pairs whose full sets reach the threshold."""

    @released
    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = []
            for side in ("_l", "_r"):
                hashes, sizes = shingles(cut(batch.column(side), BLANKS, fold=True))
                sets.append((hashes, np.repeat(np.arange(len(sizes)), sizes), sizes))
            # A shingle of both texts is there twice.
            joined = np.sort(np.concatenate([mix(h + spread(owner)) for h, owner, _ in sets]))
            twice = joined[1:][joined[1:] == joined[:-1]]
            own = mix(sets[0][0] + spread(sets[0][1]))
            shared = np.bincount(sets[0][1][np.isin(own, twice)], minlength=len(batch))
            union = sets[0][2] + sets[1][2] - shared
            linked = np.flatnonzero(100 * shared >= percent * union)
            yield batch.select(["a", "b"]).take(pa.array(linked))

    side = lambda end, name: texts.select(F.col("_class").alias(end), F.col("text").alias(name))
    both = pairs.join(side("a", "_l"), "a").join(side("b", "_r"), "b")
    return both.select("a", "b", "_l", "_r").mapInArrow(verify, "a bigint, b bigint")


class _Forest:
    """Components of a group's members, joined as links are found."""

    def __init__(self, labels: np.ndarray):
        self.label = labels.copy()

    def join(self, x: int, y: int) -> None:
        old, new = self.label[x], self.label[y]
        self.label[self.label == old] = new


def _links_of_group(ids, labels, own, minima, hashes, sizes, percent: int, least: list[int]) -> list[tuple[int, int]]:
    """Verified links that join components of the members; of pairs inside one component there are none."""
    first = np.concatenate([[0], np.cumsum(sizes)])
    sets = [np.sort(hashes[first[i] : first[i + 1]]) for i in range(len(ids))]
    forest, links = _Forest(labels), []
    one_block = len(set(own)) == 1
    for x in range(len(ids)):
        if not one_block and own[x] != own[0]:
            continue
        others = np.flatnonzero((forest.label != forest.label[x]) & ((ids > ids[x]) if one_block else (own != own[x])))
        likely = others[survivors(minima[x], minima[others], least)]
        closest = np.argsort(-(minima[likely] == minima[x]).sum(axis=1), kind="stable")
        for y in likely[closest]:
            if forest.label[x] == forest.label[y]:
                continue
            shared = int(np.isin(sets[x], sets[y], assume_unique=True).sum())
            if 100 * shared >= percent * (len(sets[x]) + len(sets[y]) - shared):
                links.append((min(int(ids[x]), int(ids[y])), max(int(ids[x]), int(ids[y]))))
                forest.join(x, y)
    return links


def _within_buckets(members: DataFrame, labels: DataFrame, classes: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """Links between members of a bucket, without its least class, that lie in different components."""
    least = least_matches(percent)
    placed = members.filter("_class <> _least").join(labels.withColumnRenamed("node", "_class"), "_class", "left")
    placed = store(placed.select("_bucket", "_class", F.coalesce("label", "_class").alias("_label")))
    same = [F.count(F.lit(1)).alias("_n"), F.bit_xor(F.xxhash64("_class")).alias("_x"), F.bit_xor(F.xxhash64(F.lit(1), "_class")).alias("_y")]
    open_ = placed.groupBy("_bucket").agg(F.min("_label").alias("_low"), F.max("_label").alias("_high"), *same)
    open_ = open_.filter("_low <> _high").dropDuplicates(["_n", "_x", "_y"])  # of buckets with the same members, one
    open_ = store(open_.select("_bucket", F.ceil(F.col("_n") / BLOCK).cast("int").alias("_blocks")))
    own = F.pmod(F.xxhash64("_class"), F.col("_blocks")).cast("int")
    dealt = placed.join(open_, "_bucket").withColumn("_own", own)
    dealt = dealt.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
    dealt = dealt.select("_bucket", "_class", "_label", "_own", F.least("_own", "_other").alias("_i"), F.greatest("_own", "_other").alias("_j"))
    rows = dealt.join(classes.select("_class", "_minima"), "_class").join(texts, "_class")

    def compare(group: pa.Table) -> pa.Table:
        ids, label, own = (group.column(c).to_numpy() for c in ("_class", "_label", "_own"))
        hashes, sizes = shingles(cut(group.column("text"), BLANKS, fold=True))
        links = _links_of_group(ids, label, own, _minima(group.column("_minima")), hashes, sizes, percent, least)
        return pa.table({side: pa.array([link[k] for link in links], pa.int64()) for k, side in enumerate("ab")})

    return rows.groupBy("_bucket", "_i", "_j").applyInArrow(compare, "a bigint, b bigint")


def near_components(docs: DataFrame, percent: int = 80) -> DataFrame:
    """(_id, _key, n_shingles, _lead, _lead_key) for each row of ``docs`` (doc_id, text): its id, and those of the least row of its component."""
    prepare(docs.sparkSession)
    found = store(sketches(docs.select("doc_id", "text")))
    digest = ["_s1", "_s2", "n_shingles"]
    one = F.min(F.struct("_id", "_key")).alias("_one")
    grouped = store(found.filter("n_shingles > 0").groupBy(*digest).agg(one, F.any_value("_minima").alias("_minima")))
    # Classes are numbered in order of their least rows, so the least class of a component has its least row.
    sets = numbered(grouped.select("_one.*", *digest, "_minima"), "_class", [F.col(c).asc_nulls_first() for c in ("_id", "_key")])
    discard(grouped)
    classes = sets.select("_class", F.col("_id").alias("_lead"), "_key", "_minima")
    bands = F.transform(
        F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda i: F.xxhash64(i, F.substring("_minima", i * (2 * ROWS) + 1, F.lit(2 * ROWS)))
    )
    in_bands = classes.select("_class", F.explode(bands).alias("_bucket"))
    buckets = store(
        in_bands.groupBy("_bucket").agg(F.min("_class").alias("_least"), F.max("_class").alias("_most")).filter("_least < _most").drop("_most")
    )
    members = store(in_bands.join(buckets, "_bucket").select("_bucket", "_class", "_least"))
    stars = store(members.filter("_class <> _least").select(F.col("_least").alias("a"), F.col("_class").alias("b")).distinct())
    # Few classes share a bucket: only their minima and texts are joined with pairs.
    paired = store(members.select("_class").distinct())
    wanted = store(classes.join(paired, "_class", "left_semi"))
    likely = store(_likely(stars, wanted, percent))
    texts = docs.select(F.col("doc_id").cast("bigint").alias("_id"), text_key(F.col("text")).alias("_text_key"), "text")
    leads = wanted.select("_class", "_lead", "_key")
    texts = texts.join(leads, (F.col("_text_key") == F.col("_key")) & F.col("_id").eqNullSafe(F.col("_lead")))
    texts = store(texts.dropDuplicates(["_class"]).select("_class", "text"))
    links = store(_verified(likely, texts, percent))
    labels = connected_components(links)
    more = store(_within_buckets(members, labels, wanted, texts, percent))
    if not more.isEmpty():
        labels = connected_components(links.union(more))
    # The row that leads a class's component: of classes without links, their own.
    leader = classes.select(F.col("_class").alias("label"), F.struct("_lead", F.col("_key").alias("_lead_key")).alias("_leads"))
    linked = labels.withColumnRenamed("node", "_class").join(leader, "label").drop("label")
    own = F.struct(F.col("_id").alias("_lead"), F.col("_key").alias("_lead_key"))
    led = sets.join(linked, "_class", "left").select(*digest, F.coalesce("_leads", own).alias("_leads"))
    rows = found.select("_id", "_key", *digest).join(led, digest, "left")
    return rows.withColumn("_leads", F.coalesce("_leads", own)).select("_id", "_key", "n_shingles", "_leads.*")


def _leads() -> Column:
    """Whether a row leads its component; of rows that repeat an id, all do under that id."""
    return F.col("_id").eqNullSafe(F.col("_lead")) & (F.col("_id").isNotNull() | (F.col("_key") == F.col("_lead_key")))


def near_copies_report(docs: DataFrame, percent: int = 85) -> DataFrame:
    """doc_id, n_shingles, component_id, kept."""
    return near_components(docs, percent).select(
        F.col("_id").alias("doc_id"), "n_shingles", F.col("_lead").alias("component_id"), _leads().alias("kept")
    )


def drop_near_copies(docs: DataFrame, percent: int = 80) -> DataFrame:
    """``docs`` with one document of each component, the one with the least id, all columns."""
    dropped = store(near_components(docs, percent).filter(~_leads()).select("_id", "_key").distinct())
    rows = docs.select(F.struct(*docs.columns).alias("_doc"), F.col("doc_id").cast("bigint").alias("_own"), text_key(F.col("text")).alias("_text_key"))
    lost = (F.col("_text_key") == F.col("_key")) & F.col("_own").eqNullSafe(F.col("_id"))
    return rows.join(dropped, lost, "left_anti").select("_doc.*")


_FOLDED = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

SQL = rf"""
WITH RECURSIVE docs AS (
  SELECT doc_id, regexp_extract_all(coalesce({_FOLDED}, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
places AS (
  SELECT doc_id, words, unnest(generate_series(1, greatest(1, len(words) - 4))) AS place FROM docs WHERE len(words) > 0),
shingles AS (SELECT DISTINCT doc_id, array_to_string(words[place : place + 4], ' ') AS shingle FROM places),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n
  FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (
  SELECT a, b FROM shared JOIN sizes x ON a = x.doc_id JOIN sizes y ON b = y.doc_id
  WHERE 100 * shared.n >= 85 * (x.n + y.n - shared.n)),
edges AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reached(start, node) AS (
  SELECT doc_id, doc_id FROM documents UNION SELECT start, b FROM reached JOIN edges ON node = a)
SELECT documents.doc_id, coalesce(n, 0) AS n_shingles, component_id, documents.doc_id = component_id AS kept
FROM documents
JOIN (SELECT start, min(node) AS component_id FROM reached GROUP BY start) ON start = documents.doc_id
LEFT JOIN sizes ON sizes.doc_id = documents.doc_id
"""
