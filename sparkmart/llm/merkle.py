"""Merkle manifest of a dataset, with a proof for every row, by pointer jumping.

A row is a leaf: the hash of its fields. Leaves of a group (a language) ascend by id; every two neighbours become a node, level by
level, until one is left, the group's subroot. Subroots, in order of the group, become the root in the same way.

1. Leaves are numbered in order by ranges (``numbering``). Up to ``LEVELS`` levels are built at once from a block of 2**LEVELS
   neighbours, so a block is bounded, and a tree of n leaves takes log(n) / LEVELS rounds.
2. Every node points at its parent and holds the segment of siblings on the way there: one step. A self-join replaces a pointer by the
   pointer of the node that it points at, and appends that node's segment, which doubles the distance. After log(depth) joins, each leaf
   points at its root and holds its whole proof. Of the nodes above the leaves, round k needs only the levels divisible by 2**k, so
   nearly all of the work is on the leaves. Rows whose pointer has reached the root take no part in later joins, so no key is the
   root; late rounds have few nodes on the other side, which Spark broadcasts if they measure small and else splits.

A proof is an array of steps: a byte for the side of the sibling (``_LEFT``, ``_RIGHT``, ``_ALONE``) and its digest. ``folded`` gives
the root that a leaf and a proof lead to.

Defined results: a null field is ``-``; null ids come first, rows of equal id are ordered by their leaf, so repeated rows are leaves of
their own, side by side. A null group is a group of its own, before all others. A lone leaf is its own subroot, with an empty proof.
An empty table gives an empty result. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkmart.llm.common import discard, store
from sparkmart.llm.numbering import numbered

COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]
LEVELS = 10
_LEFT, _RIGHT, _ALONE = b"\x00", b"\x01", b"\x02"
_TAMPER = 7


def _hash(text: Column) -> Column:
    return F.unhex(F.sha2(text.cast("binary"), 256))


def hex_text(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def leaf(fields: list[Column]) -> Column:
    """Digest of the fields, each with its length in bytes."""
    sized = [F.coalesce(F.concat(F.octet_length(f).cast("string"), F.lit(":"), f), F.lit("-")) for f in (f.cast("string") for f in fields)]
    return _hash(F.concat(*sized))


def folded(start: Column, proof: Column) -> Column:
    """The root that ``proof`` leads to from the leaf ``start``."""

    def up(node: Column, step: Column) -> Column:
        side, own, other = F.substring(step, 1, 1), hex_text(node), hex_text(F.substring(step, 2, 32))
        return _hash(F.when(side == F.lit(_LEFT), F.concat(other, own)).otherwise(F.concat(own, other)))

    return F.aggregate(proof, start, up)


def proof_digest(proof: Column) -> Column:
    """Digest of the siblings of a proof."""
    return hex_text(_hash(F.array_join(F.transform(proof, lambda step: hex_text(F.substring(step, 2, 32))), "")))


def _indices(array: Column, size: Column) -> Column:
    return F.when(size > 0, F.sequence(F.lit(0), (size - 1).cast("int"))).otherwise(F.array().cast("array<int>"))


def _parents(nodes: Column) -> Column:
    at = lambda i: F.coalesce(hex_text(F.get(nodes, i)), F.lit(""))
    return F.transform(_indices(nodes, F.ceil(F.size(nodes) / 2)), lambda i: _hash(F.concat(at(i * 2), at(i * 2 + 1))))


def _steps(nodes: Column, level: Column, first: Column) -> Column:
    """For each node its level, place and the step to its parent."""

    def step(node: Column, i: Column) -> Column:
        other = F.get(nodes, i.bitwiseXOR(F.lit(1)))
        side = F.when(other.isNull(), F.lit(_ALONE)).when(i % 2 == 1, F.lit(_LEFT)).otherwise(F.lit(_RIGHT))
        return F.struct(level.alias("level"), (first + i).alias("pos"), F.concat(side, F.coalesce(other, F.lit(b""))).alias("step"))

    return F.transform(nodes, step)


def _built(leaves: DataFrame, sizes: DataFrame, depth: int) -> tuple[DataFrame, DataFrame]:
    """Nodes below the roots (tree, depth, level, pos, step) and the roots (tree, hash), from leaves (tree, pos, hash)."""
    rows, nodes, roots = leaves.join(sizes, "tree"), [], []
    for start in range(0, depth, LEVELS):
        here = F.least(F.lit(LEVELS), F.col("depth") - start)
        block = rows.filter(F.col("depth") > start).groupBy("tree", "depth", F.shiftright("pos", LEVELS).alias("block")).agg(
            F.transform(F.array_sort(F.collect_list(F.struct("pos", "hash"))), lambda x: x["hash"]).alias("n0")
        )
        steps = []
        for i in range(LEVELS):
            block = block.withColumn(f"n{i + 1}", F.when(here > i, _parents(F.col(f"n{i}"))))
            level = F.when(here > i, _steps(F.col(f"n{i}"), F.lit(start + i), F.shiftleft(F.col("block"), LEVELS - i)))
            steps.append(F.coalesce(level, F.array().cast("array<struct<level:int,pos:bigint,step:binary>>")))
        tops = F.coalesce(*[F.when(here == i, F.get(f"n{i}", F.lit(0))) for i in range(1, LEVELS + 1)])
        built = store(block.select("tree", "depth", "block", tops.alias("top"), F.concat(*steps).alias("below")))
        nodes.append(built.select("tree", "depth", F.inline("below")))
        rows = built.select("tree", "depth", F.col("block").alias("pos"), F.col("top").alias("hash"))
        roots.append(rows.filter(F.col("depth") <= start + LEVELS).select("tree", "hash"))
    return reduce(DataFrame.unionByName, nodes), reduce(DataFrame.unionByName, roots)


def _jumped(nodes: DataFrame, depth: int) -> DataFrame:
    """(tree, pos, proof) of the leaves: pointers jump until they reach the root."""
    up = F.least(F.col("level") + 1, F.col("depth"))
    known = store(nodes.select("tree", "depth", "level", "pos", up.alias("up"), F.array("step").alias("proof")))
    done, distance = [], 1
    while distance < depth:
        leaves_done = F.expr("level = 0 AND up = depth")
        done.append(known.filter(leaves_done).select("tree", "pos", "proof"))
        rest = known.filter(~leaves_done)
        jumpers = rest.filter(F.col("level") % (2 * distance) == 0)
        targets = rest.filter(F.col("level") % (2 * distance) == distance).select(
            "tree", F.col("level").alias("up"), F.col("pos").alias("_to"), F.col("up").alias("_up"), F.col("proof").alias("_proof")
        )
        moving = jumpers.filter("up < depth").withColumn("_to", F.shiftright("pos", distance)).join(targets, ["tree", "up", "_to"])
        moved = moving.select("tree", "depth", "level", "pos", F.col("_up").alias("up"), F.concat("proof", "_proof").alias("proof"))
        known, distance = store(moved.unionByName(jumpers.filter("up = depth"))), 2 * distance
    return reduce(DataFrame.unionByName, [*done, known.filter("level = 0").select("tree", "pos", "proof")])


def forest(leaves: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Roots (tree, hash) and proofs (tree, pos, proof) of trees over the stored leaves (tree, pos, hash); pos counts from 0 in each tree."""
    last = F.max("pos")
    sizes = store(leaves.groupBy("tree").agg(F.when(last > 0, F.length(F.bin(last))).otherwise(0).alias("depth")))
    deepest = sizes.agg(F.max("depth")).first()[0] or 0
    lone = leaves.join(sizes.filter("depth = 0"), "tree").select("tree", "pos", "hash", F.array().cast("array<binary>").alias("proof"))
    roots, proofs = lone.select("tree", "hash"), lone.select("tree", "pos", "proof")
    if deepest:
        nodes, tops = _built(leaves, sizes, deepest)
        roots, proofs = roots.unionByName(tops), proofs.unionByName(_jumped(nodes, deepest))
    return store(roots), proofs


def manifest(
    docs: DataFrame, columns: list[str] = COLUMNS, group: str = "lang", order_by: str = "doc_id", carry: dict[str, Column] | None = None
) -> DataFrame:
    """For each row of ``docs``: ``order_by``, leaf, subroot, root (digests), proof (steps) and the expressions of ``carry``."""
    carried = carry or {}
    rows = store(docs.select(
        F.col(order_by).alias("_id"), F.col(group).alias("_group"), leaf([F.col(c) for c in columns]).alias("_leaf"),
        F.struct(*[column.alias(name) for name, column in carried.items()], F.lit(0).alias("_")).alias("_more"),
    ))
    placed = numbered(rows, "_place", [F.col(c).asc_nulls_first() for c in ("_group", "_id", "_leaf")])
    discard(rows)
    firsts = store(placed.groupBy("_group").agg(F.min("_place").alias("_first")))
    trees = store(numbered(firsts, "tree", [F.col("_group").asc_nulls_first()]).withColumnRenamed("_group", "_of"))
    leaves = store(
        placed.join(trees, F.col("_group").eqNullSafe(F.col("_of")))
        .select("tree", (F.col("_place") - F.col("_first")).alias("pos"), F.col("_leaf").alias("hash"), "_id", "_more")
    )
    subroots, proofs = forest(leaves.select("tree", "pos", "hash"))
    roots, above = forest(store(subroots.select(F.lit(0).cast("bigint").alias("tree"), F.col("tree").alias("pos"), "hash")))
    top = roots.first()  # one digest
    root = F.lit(bytes(top["hash"]) if top else None).cast("binary").alias("root")
    tops = store(
        subroots.join(above.select(F.col("pos").alias("tree"), F.col("proof").alias("_above")), "tree")
        .select("tree", F.col("hash").alias("subroot"), "_above", root)
    )
    whole = leaves.join(proofs, ["tree", "pos"]).join(tops, "tree")
    return whole.select(
        F.col("_id").alias(order_by), F.col("hash").alias("leaf"), "subroot", "root", F.concat("proof", "_above").alias("proof"),
        *[F.col(f"_more.{name}").alias(name) for name in carried],
    )


def manifest_report(docs: DataFrame) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root and verified; some rows are tampered with before they are verified."""
    hit = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % _TAMPER == 0, F.lit(False))
    changed = [F.col(c) + 1 if c == "n_chars" else F.col(c) for c in COLUMNS]
    proven = manifest(docs, carry={"_tampered": F.when(hit, leaf(changed))})
    start = F.coalesce("_tampered", "leaf")
    return proven.withColumn("_folded", folded(start, F.col("proof"))).select(
        "doc_id", hex_text(F.col("leaf")).alias("leaf"), hex_text(F.col("subroot")).alias("subroot"), hex_text(F.col("root")).alias("root"),
        proof_digest(F.col("proof")).alias("proof_sha256"), hex_text(F.col("_folded")).alias("folded_root"),
        (F.col("_folded") == F.col("root")).alias("verified"),
    )


def verified(docs: DataFrame, proven: DataFrame, columns: list[str] = COLUMNS, order_by: str = "doc_id") -> DataFrame:
    """``proven`` with ``verified``: whether the rows of that id in ``docs`` still lead to the root. A lost row is not verified.

    Ids should be unique in both; rows with a null id match each other.
    """
    now = docs.select(F.col(order_by).alias("_now"), leaf([F.col(c) for c in columns]).alias("_leaf"))
    joined = proven.join(now, F.col(order_by).eqNullSafe(F.col("_now")), "left")
    same = F.coalesce(folded(F.col("_leaf"), F.col("proof")) == F.col("root"), F.lit(False))
    return joined.select(*proven.columns, same.alias("verified"))


_HASHED = " || ".join(
    f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen(CAST({c} AS VARCHAR)) || ':' || {c} END" for c in COLUMNS
)
_TAMPERED = _HASHED.replace("CAST(n_chars AS VARCHAR)", "CAST(n_chars + 1 AS VARCHAR)").replace("':' || n_chars", "':' || (n_chars + 1)")
SQL = f"""
WITH RECURSIVE
bytes AS (SELECT i, list_reduce(list_concat([i], range(8)), lambda c, b: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v
  FROM range(256) t(i)),
crc AS (SELECT list(CAST(v AS BIGINT) ORDER BY i) AS l FROM bytes),
leaves AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM (
    SELECT doc_id, lang, sha256({_HASHED}) AS leaf,
      sha256({_TAMPERED}) AS changed,
      xor(list_reduce(list_concat([4294967295], [CAST(ascii(x) AS BIGINT) FOR x IN string_split(CAST(doc_id AS VARCHAR), '')]),
        lambda c, b: xor(c >> 8, l[CAST(xor(c, b) & 255 AS INTEGER) + 1])), 4294967295) % 7 = 0 AS hit
    FROM documents, crc)),
trees AS (SELECT lang, count(*) AS n, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree FROM leaves GROUP BY lang),
low AS (
  SELECT tree, 0 AS level, pos, leaf AS h, n FROM leaves l JOIN trees t ON l.lang IS NOT DISTINCT FROM t.lang
  UNION ALL
  SELECT tree, level + 1, pos // 2, sha256(string_agg(h, '' ORDER BY pos)), (n + 1) // 2 FROM low WHERE n > 1
  GROUP BY tree, level, pos // 2, n),
subroots AS (SELECT tree, h FROM low WHERE n = 1),
high AS (
  SELECT 0 AS level, tree AS pos, h, (SELECT count(*) FROM trees) AS n FROM subroots
  UNION ALL
  SELECT level + 1, pos // 2, sha256(string_agg(h, '' ORDER BY pos)), (n + 1) // 2 FROM high WHERE n > 1
  GROUP BY level, pos // 2, n),
nodes AS (SELECT tree, level, pos, h, n FROM low UNION ALL SELECT -1, level, pos, h, n FROM high),
walk AS (
  SELECT l.doc_id, l.pos AS leaf_at, t.tree AS leaf_tree, t.tree AS tree, 0 AS level, l.pos AS pos,
    CASE WHEN hit THEN changed ELSE leaf END AS f, '' AS proof, leaf, FALSE AS over
  FROM leaves l JOIN trees t ON l.lang IS NOT DISTINCT FROM t.lang
  UNION ALL
  SELECT w.doc_id, leaf_at, leaf_tree,
    CASE WHEN me.n > 1 THEN w.tree ELSE -1 END, CASE WHEN me.n > 1 THEN w.level + 1 ELSE 0 END,
    CASE WHEN me.n > 1 THEN w.pos // 2 ELSE w.tree END,
    CASE WHEN me.n = 1 THEN f WHEN o.h IS NULL THEN sha256(f) WHEN w.pos % 2 = 1 THEN sha256(o.h || f) ELSE sha256(f || o.h) END,
    CASE WHEN me.n > 1 THEN proof || coalesce(o.h, '') ELSE proof END, leaf, w.tree = -1 AND me.n = 1
  FROM walk w JOIN nodes me ON me.tree = w.tree AND me.level = w.level AND me.pos = w.pos
  LEFT JOIN nodes o ON o.tree = w.tree AND o.level = w.level AND o.pos = xor(w.pos, 1)
  WHERE NOT over)
SELECT doc_id, leaf, s.h AS subroot, r.h AS root, sha256(proof) AS proof_sha256, f AS folded_root, f = r.h AS verified
FROM walk w JOIN subroots s ON s.tree = w.leaf_tree, (SELECT h FROM high WHERE n = 1) r WHERE over
"""
