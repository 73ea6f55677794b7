"""Catalog sinks: tables and marts as views over generations of files, so that a failed load changes nothing that is read.

A database's tables lie below its location (``Generations``). Loading writes new generations of one or several tables, makes them
current with one switch and points the views there. Should a view not follow, ``repair`` points it at the current version.
"""

from __future__ import annotations

import logging
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkmart.sinks.generations import KEEP, Generations, point_view

log = logging.getLogger("sparkmart")

DATABASES = ["staging", "dwh", "reporting"]


def ensure_databases(spark: SparkSession, names: list[str] = DATABASES, location: str | None = None) -> None:
    """Create the databases that do not exist, below ``location`` if one is given, else in the warehouse folder."""
    for name in names:
        place = f" LOCATION '{location}/{name}'" if location else ""
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}{place}")


def generations(spark: SparkSession, database: str) -> Generations:
    """The files of a database's tables, apart from those of real tables in it."""
    return Generations(spark, f"{spark.catalog.getDatabase(database).locationUri}/_generations")


def table_exists(spark: SparkSession, database: str, table: str) -> bool:
    return spark.catalog.tableExists(f"{database}.{table}")


def _structure(spark: SparkSession, name: str) -> list | None:
    """Columns of a table or view that exists."""
    try:
        return spark.table(name).schema.fields
    except AnalysisException:
        return None


def truncate_table(spark: SparkSession, database: str, table: str) -> None:
    """Empty a table; its columns stay."""
    with generations(spark, database).load() as load:
        load.write(spark.table(f"{database}.{table}").limit(0), table)
    repair(spark, database, [table])


def load_tables(
    spark: SparkSession, database: str, tables: dict[str, DataFrame], partition_by: dict[str, list[str]] | None = None
) -> dict[str, str]:
    """Full, repeatable load of several tables, all or none. Returns what was done with each.

    A table that exists keeps its columns, their order and types. An empty result is skipped, so a failed extract cannot
    empty a table.
    """
    load = generations(spark, database).load()
    with load:
        for table, df in tables.items():
            known = _structure(spark, f"{database}.{table}")
            if known is not None:
                df = df.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in known])
            load.write(df, table, (partition_by or {}).get(table), keep_if_empty=True)
            if load.done[table] == "create+insert" and known is not None:  # by other means than this module
                load.done[table] = "truncate+insert"
    repair(spark, database, [t for t, what in load.done.items() if what != "skipped"])
    return load.done


def load_table(df: DataFrame, database: str, table: str, partition_by: list[str] | None = None) -> str:
    """Full, repeatable load of one table; see ``load_tables``."""
    return load_tables(df.sparkSession, database, {table: df}, {table: partition_by} if partition_by else None)[table]


def repair(spark: SparkSession, database: str, tables: list[str] | None = None, store: Generations | None = None) -> None:
    """Point the views of a database at the current version of their tables (by default, of those below its location)."""
    store = store or generations(spark, database)
    for table, entry in store.entries().items():
        if tables is None or table in tables:
            point_view(spark, f"{database}.{table.rpartition('/')[2]}", store.root, entry)


def publish(spark: SparkSession, database: str, store: Generations, tables: dict[str, str]) -> dict[str, str]:
    """Let views read tables that a flow has written elsewhere, without copying them: (view, table of ``store``).

    A table without rows is skipped.
    """
    entries, done = store.entries(), {}
    for view, table in tables.items():
        if not entries[table].rows:
            done[view] = "skipped"
            continue
        done[view] = "truncate+insert" if table_exists(spark, database, view) else "create+insert"
        point_view(spark, f"{database}.{view}", store.root, entries[table])
    return done


def refresh_marts(
    marts: dict[str, Callable[[], DataFrame]], spark: SparkSession, database: str, location: str, keep: int = KEEP
) -> dict[str, str]:
    """Rebuild the marts below ``location``, then point their views there.

    Readers see the old data until a view is replaced. A mart that fails is tried once more, then keeps its old data and does not stop
    the others. The last ``keep`` refreshes stay, older ones are removed.
    """
    store, done = Generations(spark, location), {}
    with store.load() as load:
        for name, build in marts.items():
            for attempt in ("refreshed", "refreshed again"):
                try:
                    load.write(build(), name)
                    done[name] = attempt
                    break
                except Exception as error:  # one mart must not stop the others
                    log.warning("%s: refresh failed: %s", name, error)
                    done[name] = "failed"
                    store.remove([load.folder(name)])
    for name in [n for n, what in done.items() if what != "failed"]:
        point_view(spark, f"{database}.{name}", store.root, store.entries()[name])
    store.prune(keep)
    return done
