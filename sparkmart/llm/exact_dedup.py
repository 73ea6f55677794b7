"""Exact copies by deterministic block naming.

1. A text whose (length, 64-bit hash) no other row shares has no copy. Hashes only rule out; they never decide.
2. The other texts are cut into blocks of fixed size. The distinct blocks are sorted (by hash) and numbered; a block's number is its name.
3. Adjacent names of a text form pairs, the distinct pairs are sorted and numbered, and so on, until each text has
   one name. Texts of one length have the same name exactly when they are equal, so there are no collisions.

Naming sends each distinct block once and looks names up by joins that Spark can split, so a text that a third of
all rows share is no hot group. The number of rounds is the logarithm of the blocks of the longest copied text.

Defined results: null text counts as empty, and empty texts are equal. Null ids come before all others, so such a row stays
only where its whole group has none. Of rows equal in id and text (repeated rows), exactly one stays. Other columns
are carried along whatever their names. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmart.llm.common import sha256, store
from sparkmart.llm.numbering import numbered

BLOCK_BYTES = 4096


def _named(df: DataFrame, keys: list[str]) -> DataFrame:
    """``df`` with the place of its key among the sorted distinct keys as ``_name``, without the keys.

    Keys are sorted by their hash, so that range bounds are found on 8 bytes of each sampled key and not on whole
    blocks; places are unique whether hashes are or not.
    """
    distinct = df.select(*keys).distinct().withColumn("_order", F.xxhash64(*keys))
    return df.join(numbered(distinct, "_name", [F.col("_order")]).drop("_order"), keys).drop(*keys)


def block_names(texts: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(_row, _bytes, _name) from (_row, _text): equal (_bytes, _name) means equal texts."""
    raw = F.col("_text").cast("binary")
    blocks = F.transform(
        F.sequence(F.lit(0), F.greatest(F.ceil(F.col("_bytes") / block_bytes).cast("int") - 1, F.lit(0))),
        lambda i: F.substring(raw, i * block_bytes + 1, F.lit(block_bytes)),
    )
    sized = texts.withColumn("_bytes", F.octet_length("_text"))
    cut = sized.withColumn("_left", F.greatest(F.ceil(F.col("_bytes") / block_bytes), F.lit(1)).cast("int"))
    level = store(_named(cut.select("_row", "_bytes", "_left", F.posexplode(blocks).alias("_at", "_block")), ["_block"]))
    done = level.filter("_left = 1").select("_row", "_bytes", "_name")
    rounds = max((level.agg(F.max("_left")).first()[0] or 1) - 1, 0).bit_length()
    for _ in range(rounds):
        side = lambda odd: F.coalesce(F.max(F.when(F.col("_at") % 2 == odd, F.col("_name"))), F.lit(0))
        pairs = (
            level.filter("_left > 1")
            .groupBy("_row", "_bytes", "_left", F.expr("_at div 2").alias("_at"))
            .agg(side(0).alias("_first"), side(1).alias("_second"))
            .withColumn("_left", F.expr("cast((_left + 1) div 2 as int)"))
        )
        level = store(_named(store(pairs), ["_first", "_second"]))
        done = done.unionByName(level.filter("_left = 1").select("_row", "_bytes", "_name"))
    return done


def label_copies(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``_doc`` (the row as a struct), ``keep_id``, ``group_size`` and ``kept`` for each row of ``docs``."""
    text = F.coalesce(F.col(text_column), F.lit(""))
    rows = docs.select(
        F.struct(*docs.columns).alias("_doc"),
        F.xxhash64(text).alias("_hash"),
        F.octet_length(text).alias("_length"),
    )
    key = ["_hash", "_length"]
    suspects = store(rows.groupBy(*key).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select(*key))
    alone = rows.join(suspects, key, "left_anti").select(
        "_doc", F.col(f"_doc.{id_column}").alias("keep_id"), F.lit(1).cast("bigint").alias("group_size"), F.lit(True).alias("kept")
    )
    some = store(
        rows.join(suspects, key, "left_semi").select(
            F.monotonically_increasing_id().alias("_row"), F.col(f"_doc.{id_column}").alias("_id"), "_doc"
        )
    )
    names = store(block_names(some.select("_row", F.coalesce(f"_doc.{text_column}", F.lit("")).alias("_text"))))
    ids = names.join(some.select("_row", "_id"), "_row")
    groups = store(
        ids.groupBy("_bytes", "_name").agg(
            F.max(F.struct("_id", "_row")).alias("_stays"), F.count(F.lit(1)).alias("group_size")
        )
    )
    found = names.join(groups, ["_bytes", "_name"]).select("_row", "_stays", "group_size")
    copies = some.join(found, "_row").select(
        "_doc", F.col("_stays._id").alias("keep_id"), "group_size", (F.col("_row") == F.col("_stays._row")).alias("kept")
    )
    return alone.unionByName(copies)


def drop_copies(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``docs`` with one row of each group of equal texts, the one with the largest id."""
    return label_copies(docs, id_column, text_column).filter("kept").select("_doc.*")


def exact_dedup(docs: DataFrame) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256, for every row of ``docs`` (doc_id, text)."""
    labelled = label_copies(docs.select("doc_id", "text"))
    digest = sha256(F.coalesce("_doc.text", F.lit(""))).alias("text_sha256")
    return labelled.select(F.col("_doc.doc_id").alias("doc_id"), "keep_id", "group_size", "kept", digest)


SQL = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
"""
