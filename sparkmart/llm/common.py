"""Session settings, input and intermediate tables of the operators."""

from __future__ import annotations

import ctypes
import pickle
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkmart.session import ensure_checkpoint_dir

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

#: A Python worker holds a few times one batch; both bounds keep it small, whatever the length of the texts.
BATCHES = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "4000",
    "spark.sql.execution.arrow.maxBytesPerBatch": "4194304",
}

#: Stands for a null id where an order of documents is needed: before all others.
NO_ID = -(1 << 63)


def prepare(spark: SparkSession) -> SparkSession:
    """Bound the batches that go to Python workers."""
    for key, value in BATCHES.items():
        spark.conf.set(key, value)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str = "documents") -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def store(df: DataFrame) -> DataFrame:
    """``df`` as a Parquet table in the shared folder. The shuffle files of its making go at once."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    path = f"{spark.sparkContext.getCheckpointDir()}/table-{uuid.uuid4().hex}"
    before = spark.conf.get(_CLEANUP)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    table = spark.read.schema(df.schema).parquet(path)
    table._stored_at = path
    return table


def discard(table: DataFrame) -> None:
    """Delete the files of a stored table that nothing will read again."""
    path = table.sparkSession._jvm.org.apache.hadoop.fs.Path(table._stored_at)
    path.getFileSystem(table.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def sha256(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def text_key(text: Column) -> Column:
    """With the id it tells rows apart: rows equal in both have equal results."""
    return F.xxhash64(text)


class Shared:
    """An object broadcast to the workers, built once in each and kept, with its caches, as long as the worker lives."""

    def __init__(self, spark: SparkSession, value: object):
        self.sent = spark.sparkContext.broadcast({"pickled": cloudpickle.dumps(value)})

    @property
    def value(self) -> object:
        held = self.sent.value
        if "value" not in held:
            held["value"] = pickle.loads(held["pickled"])
        return held["value"]


def give_back() -> None:
    """Return memory that is free in this process to the system, which the C library does not do by itself."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc only
    if trim:
        trim(0)


def released(work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``work`` on batches, with a worker that is as small after each of them as what it keeps. Workers live on between tasks and stages."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch
            give_back()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from work(each(batches))
        give_back()

    return run


def node_id(doc_id: Column) -> Column:
    """The id of a document as a number; rows without one count as one document, before all others."""
    return F.coalesce(doc_id.cast("bigint"), F.lit(NO_ID))


def real_id(node: Column, docs: DataFrame) -> Column:
    """The id that ``node_id`` made a number of. If a row of ``docs`` really has the least number there is, that number is its id."""
    least = docs.agg(F.min(F.col("doc_id").cast("bigint"))).first()[0]
    return node if least == NO_ID else F.when(node > NO_ID, node)
