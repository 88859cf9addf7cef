"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Runtime options the operators rely on. All can be changed on a live session.
RUNTIME_OPTIONS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Rows that Python workers get and give at a time. Texts are long: larger batches cost
    # memory on both sides and gain nothing.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "500",
    "spark.sql.execution.arrow.maxBytesPerBatch": "8m",
}

ROCKSDB_PROVIDER = (
    "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
)


def get_session(app_name: str, master: str | None = None, **extra: str) -> SparkSession:
    """Build or fetch a session with the options above; the cluster decides the rest."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_OPTIONS, **extra}.items():
        builder = builder.config(key, value)
    return prepare(builder.getOrCreate())


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime options to a session that somebody else built."""
    for key, value in RUNTIME_OPTIONS.items():
        spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by the cluster.

    A machine-local folder is made only where the setting is absent, as in tests.
    """
    configured = spark.sparkContext.getCheckpointDir() or spark.conf.get(
        "spark.checkpoint.dir", None
    )
    if not configured:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
        configured = tempfile.mkdtemp(prefix="risklake-")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(configured)
    return configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Store ``df`` in the shared folder and go on from there, so that plans which read it
    several times compute it once, and alike, even if an executor is lost in between."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Like ``cut_lineage``, as a compressed table of which a reader takes only the columns that it needs."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


@contextmanager
def data_batches_only(spark: SparkSession) -> Iterator[None]:
    """A stream started inside runs no micro-batch without data; state that has run out is removed by the next
    one with data. The stream keeps the setting, the session gets its own back."""
    name = "spark.sql.streaming.noDataMicroBatches.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "false")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)
