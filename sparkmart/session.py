"""Session defaults and the shared checkpoint folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


# Settings that the library is written for and that differ from Spark's defaults.
RUNTIME_SETTINGS = {
    # Dates are compared with sources that have no time zone.
    "spark.sql.session.timeZone": "UTC",
    # The JVM does not compile methods above 8000 bytes. Beyond that size a fused
    # stage runs several times slower than the split code Spark falls back to.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def build_session(app_name: str = "sparkmart", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the library's settings. Adaptive execution and its skew handling are on by default."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def apply_settings(spark: SparkSession) -> SparkSession:
    """Bring a session that was built elsewhere to the library's settings."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Make reliable checkpoints possible.

    The cluster names a shared folder in ``spark.checkpoint.dir``. Only a local
    session, where driver and executors are one process, falls back to a
    temporary folder.
    """
    context = spark.sparkContext
    if context.getCheckpointDir():
        return
    shared = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    if shared:
        context.setCheckpointDir(shared)
    elif context.master.startswith("local"):
        context.setCheckpointDir(tempfile.mkdtemp(prefix="sparkmart-checkpoint-"))
    else:
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` written once, partition by partition: partition numbers and row order stay fixed.

    For operators that number rows. ``stored`` suits everything else.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame) -> DataFrame:
    """``df`` written once as a Parquet table below the checkpoint folder and read back.

    Readers load only the columns they need, and Spark knows the true size, so
    it broadcasts what turns out small.  Survives a lost executor.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    path = f"{spark.sparkContext.getCheckpointDir()}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
