"""Versioned dimensions kept from load to load, laid out by bucket of their key."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkmart.functions.dates import as_of_date
from sparkmart.operators.dedup import keep_last
from sparkmart.operators.keys import with_surrogate_key
from sparkmart.operators.scd import version_columns
from sparkmart.session import stored
from sparkmart.sinks.generations import Entry, Load

_BUCKET = "_bucket"


def _bucket_of(key: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def _write_buckets(load: Load, table: str, rows: DataFrame, key: str, buckets: int) -> dict[int, str]:
    """Write ``rows`` of some buckets; the folder of each bucket that has rows."""
    folder = load.folder(table)
    laid_out = rows.withColumn(_BUCKET, _bucket_of(F.col(key), buckets))
    laid_out.hint("rebalance", _BUCKET).write.partitionBy(_BUCKET).parquet(f"{load.store.root}/{folder}")
    return {int(name.rpartition("=")[2]): f"{folder}/{name}" for name in load.store.names(folder) if name.startswith(f"{_BUCKET}=")}


def start_history(load: Load, table: str, dimension: DataFrame, key: str, surrogate: str, buckets: int) -> DataFrame:
    """Write the first versions of a dimension, so that later loads can merge into them. Returns it as it will be read."""
    rows = stored(dimension)
    size = rows.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.max(surrogate), F.lit(0)).alias("last")).first()
    places = _write_buckets(load, table, rows, key, buckets)
    return _put(load, table, dimension, places, {"buckets": buckets, "last_key": size["last"], "opened": size["n"], "rewritten": len(places)}, size["n"])


def _put(load: Load, table: str, dimension: DataFrame, places: dict[int, str], notes: dict, rows: int) -> DataFrame:
    """Name the folders of all buckets as the next generation of the table."""
    load.done[table] = "merge" if table in load.old else "create+insert"
    load.metrics[table] = {"rows": rows, "opened": notes["opened"], "rewritten": notes["rewritten"]}
    order = sorted(places)
    return load.put(table, Entry([places[b] for b in order], dimension.schema.json(), rows, {**notes, "at": order}))


def merge_history(
    load: Load, table: str, incoming: DataFrame, key: str, surrogate: str, tracked: list[str], as_of: date | None = None,
    *, latest: list[Column] | None = None,
) -> DataFrame:
    """``merge_versions`` on a stored dimension, which reads only buckets with incoming keys and replaces only those with changes.

    ``incoming`` has all columns of the dimension but the surrogate key and the validity. Of rows that repeat a key the last one by
    ``latest`` counts; of several current versions of a key, the one with the largest surrogate key is compared, and all are closed.
    Other buckets keep their files, which the next generation names again. The version as it will be read is returned.
    """
    entry, today = load.old[table], as_of_date(as_of)
    whole = load.store.frame(entry)
    buckets, places = entry.notes["buckets"], dict(zip(entry.notes["at"], entry.folders))
    arrived = stored(keep_last(incoming, [key], latest or [F.hash(*incoming.columns)]))
    in_buckets = lambda wanted: load.store.frame(Entry([places[b] for b in sorted(wanted) if b in places], entry.schema, 0))
    buckets_of = lambda rows: {r[0] for r in rows.select(_bucket_of(F.col(key), buckets)).distinct().collect()}  # at most ``buckets``

    current = keep_last(in_buckets(buckets_of(arrived)).filter("est_actif"), [key], [F.col(surrogate)])
    old = current.select(F.col(key).alias("_key"), F.struct(*tracked).alias("_old"), F.lit(True).alias("_known"))
    compared = arrived.join(old, F.col(key).eqNullSafe(F.col("_key")), "left")
    same = F.lit(True)
    for name in tracked:
        same = same & F.col(name).eqNullSafe(F.col(f"_old.{name}"))
    opened = stored(compared.filter(F.col("_known").isNull() | ~same).select(*arrived.columns))
    touched = buckets_of(opened)
    if not touched:
        return _put(load, table, whole, places, {**entry.notes, "opened": 0, "rewritten": 0}, entry.rows)

    last = entry.notes["last_key"]
    new = with_surrogate_key(opened, surrogate, [key], first=last + 1).withColumns(version_columns(today)).select(*whole.columns)
    count = opened.count()
    changed = opened.select(F.col(key).alias("_changed"))
    marked = in_buckets(touched).join(changed, F.col(key).eqNullSafe(F.col("_changed")) & F.col("est_actif"), "left")
    closes = F.col("_changed").isNotNull()
    kept = marked.withColumns({"date_fin": F.when(closes, today).otherwise(F.col("date_fin")), "est_actif": F.col("est_actif") & ~closes})
    written = _write_buckets(load, table, kept.select(*whole.columns).unionByName(new), key, buckets)
    notes = {**entry.notes, "last_key": last + count, "opened": count, "rewritten": len(touched)}
    return _put(load, table, whole, {**places, **written}, notes, entry.rows + count)
