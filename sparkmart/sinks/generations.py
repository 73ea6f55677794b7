"""Tables that are replaced together, or not at all.

A load writes each table to a new folder, its generation, while readers keep the old ones. When all are written, one small file, the
version, names the folders of every table: creating that file is the switch. A load that fails before it leaves nothing
but folders that no version names, which it removes. Old versions can be read, taken back and pruned.

The version file is written under another name and renamed, so it is whole when it appears; a second load that
ends in between fails instead of overwriting it. That needs a file system whose rename is atomic.

The rows of a table are counted by the write itself (``observe`` as its last step, after any shuffle, so that a task
that runs again does not count twice).
"""

from __future__ import annotations

import json
import logging
import uuid
from dataclasses import asdict, dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

log = logging.getLogger("sparkmart")

_VERSIONS = "_versions"
KEEP = 2


class ConcurrentLoad(RuntimeError):
    """Another load became the next version first."""


@dataclass
class Entry:
    """A table of a version: the folders that hold it (relative to the root), its schema, rows and notes of its writer."""

    folders: list[str]
    schema: str
    rows: int
    notes: dict = field(default_factory=dict)


class Generations:
    """The tables below ``root``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._conf = spark._jsparkSession.sessionState().newHadoopConf()

    # --- reading -------------------------------------------------------------

    def versions(self) -> list[int]:
        """Numbers of the versions there are, the last one being current."""
        fs, folder = self._fs(), self._path(_VERSIONS)
        if not fs.exists(folder):
            return []
        names = [status.getPath().getName() for status in fs.listStatus(folder)]
        return sorted(int(name[:-5]) for name in names if name.endswith(".json") and name[:-5].isdigit())

    def entries(self, version: int | None = None) -> dict[str, Entry]:
        """The tables of a version, by default of the current one; nothing if there is none."""
        known = self.versions()
        if not known and version is None:
            return {}
        number = known[-1] if version is None else version
        if number not in known:
            raise KeyError(f"{self.root}: no version {number}")
        stream = self._fs().open(self._path(self._file(number)))
        try:
            text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return {name: Entry(**entry) for name, entry in json.loads(text)["tables"].items()}

    def read(self, table: str, version: int | None = None) -> DataFrame:
        entry = self.entries(version).get(table)
        if entry is None:
            raise KeyError(f"{self.root}: no table {table}")
        return self.frame(entry)

    def frame(self, entry: Entry) -> DataFrame:
        schema = T.StructType.fromJson(json.loads(entry.schema))
        if not entry.folders:
            return self.spark.createDataFrame([], schema)
        rows = self.spark.read.schema(schema).parquet(*[f"{self.root}/{folder}" for folder in entry.folders])
        return rows.select(*[F.col(f"`{name}`") for name in schema.names])  # partition columns at their places

    # --- writing -------------------------------------------------------------

    def load(self) -> Load:
        """A load, for a ``with`` block: it becomes the next version at the end of the block, unless the block fails."""
        return Load(self)

    def take_back(self, version: int) -> int:
        """Make an older version current again, as a new version; its number."""
        return self._commit(self.entries(version), self._next())

    def prune(self, keep: int = KEEP) -> list[str]:
        """Remove all but the last ``keep`` versions, and the generations that none of these names. The folders removed."""
        known = self.versions()
        kept = {folder for number in known[-keep:] for entry in self.entries(number).values() for folder in entry.folders}
        old = {folder for number in known[:-keep] for entry in self.entries(number).values() for folder in entry.folders}
        for number in known[:-keep]:  # first, so that no version names a folder that is gone
            self._fs().delete(self._path(self._file(number)), False)
        removed = sorted(old - kept)
        self.remove(removed)  # a folder whose last part goes is removed with it
        return removed

    def names(self, folder: str) -> list[str]:
        """Names of the files and folders in a folder below the root."""
        return [status.getPath().getName() for status in self._fs().listStatus(self._path(folder))]

    def remove(self, folders: list[str]) -> None:
        for folder in folders:
            self._fs().delete(self._path(folder), True)
            parent = self._path(folder).getParent()
            if self._fs().exists(parent) and not len(self._fs().listStatus(parent)):
                self._fs().delete(parent, False)

    def _file(self, number: int) -> str:
        return f"{_VERSIONS}/{number:010d}.json"

    def _next(self) -> int:
        return (self.versions() or [0])[-1] + 1

    def _commit(self, entries: dict[str, Entry], number: int) -> int:
        jvm, fs = self.spark._jvm, self._fs()
        text = json.dumps({"tables": {name: asdict(entry) for name, entry in entries.items()}}, indent=1)
        draft, final = self._path(f"{_VERSIONS}/.{uuid.uuid4().hex}"), self._path(self._file(number))
        stream = fs.create(draft, True)
        try:
            stream.write(bytearray(text, "utf-8"))
        finally:
            stream.close()
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(final.toUri(), self._conf)
        none = self.spark.sparkContext._gateway.new_array(getattr(jvm, "org.apache.hadoop.fs.Options$Rename"), 0)
        try:
            context.rename(draft, final, none)
        except Exception as error:
            fs.delete(draft, False)
            if "FileAlreadyExistsException" in str(error):
                raise ConcurrentLoad(f"{self.root}: version {number} was made by another load") from error
            raise
        return number

    def _path(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")

    def _fs(self):
        return self._path("x").getFileSystem(self._conf)


class Load:
    """Tables written by one load. ``version`` is its number once it is current."""

    def __init__(self, store: Generations):
        self.store, self.version, self.done, self.metrics = store, None, {}, {}
        self._id, self._staged, self._new = uuid.uuid4().hex[:12], {}, []
        self._base, self._old = 0, {}

    def __enter__(self) -> Load:
        self._base = (self.store.versions() or [0])[-1]
        self._old = self.store.entries() if self._base else {}
        return self

    def __exit__(self, kind, error, trace) -> bool:
        try:
            if kind is None and self._staged:
                self.version = self.store._commit({**self._old, **self._staged}, self._base + 1)
        finally:
            if self.version is None:
                self.store.remove(self._new)
        return False

    @property
    def old(self) -> dict[str, Entry]:
        """The tables as they were when the load began."""
        return self._old

    def write(
        self, df: DataFrame, table: str, partition_by: list[str] | None = None, *, metrics: dict[str, Column] | None = None,
        keep_if_empty: bool = False, notes: dict | None = None,
    ) -> DataFrame:
        """Write the next generation of ``table`` and return it as it will be read.

        With ``keep_if_empty`` a result without rows is not taken over, so that a failed extract cannot empty a table.
        ``metrics`` are aggregates that the write computes on the way; they are found in ``self.metrics[table]``.
        """
        folder, seen = f"{table}/{self._id}", Observation()
        self._new.append(folder)
        rows = df.hint("rebalance", *partition_by) if partition_by else df
        observed = rows.observe(seen, F.count(F.lit(1)).alias("_rows"), *[c.alias(name) for name, c in (metrics or {}).items()])
        writer = observed.write.option("compression", "snappy")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(f"{self.store.root}/{folder}")
        found = dict(seen.get)
        count = found.pop("_rows")
        self.metrics[table] = {"rows": count, **found}
        if keep_if_empty and not count:
            log.warning("%s: nothing to load, skipped", table)
            self.done[table] = "skipped"
            self.store.remove([folder])
            return self.store.frame(self._old[table]) if table in self._old else df.sparkSession.createDataFrame([], df.schema)
        self.done[table] = "truncate+insert" if table in self._old else "create+insert"
        return self.put(table, Entry([folder], df.schema.json(), count, notes or {}))

    def put(self, table: str, entry: Entry) -> DataFrame:
        """Take over an entry as the table: folders of this load, or of earlier ones that stay as they are."""
        self._staged[table] = entry
        return self.store.frame(entry)

    def folder(self, table: str) -> str:
        """A folder of this load for ``table``, to be written by the caller and named by ``put``."""
        name = f"{table}/{self._id}"
        if name not in self._new:
            self._new.append(name)
        return name


def view_text(root: str, entry: Entry) -> str:
    """SQL that reads a table of a version."""
    fields = T.StructType.fromJson(json.loads(entry.schema)).fields
    columns = ", ".join(f"CAST(`{f.name}` AS {f.dataType.simpleString()}) AS `{f.name}`" for f in fields)
    parts = [f"SELECT {columns} FROM parquet.`{root}/{folder}`" for folder in entry.folders]
    return " UNION ALL ".join(parts)


def point_view(spark: SparkSession, name: str, root: str, entry: Entry) -> None:
    """Let the view ``name`` read ``entry``. A real table of that name gives way to the view, and comes back if there can be none."""
    text = view_text(root, entry)
    aside = None
    try:
        kind = spark.catalog.getTable(name).tableType
    except AnalysisException:
        kind = None
    if kind not in (None, "VIEW"):
        aside = f"{name}__{uuid.uuid4().hex[:8]}"
        spark.sql(f"ALTER TABLE {name} RENAME TO {aside}")
    try:
        spark.sql(f"CREATE OR REPLACE VIEW {name} AS {text}")
    except Exception:
        if aside:
            spark.sql(f"ALTER TABLE {aside} RENAME TO {name}")
        raise
    if aside:
        spark.sql(f"DROP TABLE {aside}")
