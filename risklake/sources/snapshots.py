"""Keyed tables that are folded: one snapshot of the last row per key, and the batches since.

    <table>/batch_id=7/...              the batches, as ``lake.write_batch`` lays them out
    <table>/_snapshot/upto=5/...        the last row per key of the batches up to 5, by key

A snapshot counts once it has its ``_SUCCESS``, which Spark writes last, so a fold that fails halfway
leaves the table as it was, and a repeated one replaces its own folder. A read takes the newest snapshot and the
batches after it; it lists their folders, not all that ever were. Batches are deleted by the fold after the one
that took them in, so reads under way still find them. There is no log besides the folder names.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Files of a snapshot.
FILES = 16


def current(
    versions: DataFrame, key: str | Sequence[str], order: Sequence[str | Column] = ("batch_id",)
) -> DataFrame:
    """Last version per key, greatest ``order`` first.

    An aggregate and not a ranking window: versions of one key are merged before the
    shuffle, however many there are.
    """
    keys = [key] if isinstance(key, str) else list(key)
    rest = [c for c in versions.columns if c not in keys]
    # The whole row settles ties, so that the result does not depend on arrival.
    tie = F.xxhash64(*[F.col(c) for c in rest if not has_map(versions.schema[c].dataType)])
    newest = versions.groupBy(*keys).agg(
        F.max_by(F.struct(*rest), F.struct(*order, tie)).alias("_row")
    )
    return newest.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in rest]).select(*versions.columns)


def has_map(t: T.DataType) -> bool:
    if isinstance(t, T.StructType):
        return any(has_map(f.dataType) for f in t.fields)
    if isinstance(t, T.ArrayType):
        return has_map(t.elementType)
    return isinstance(t, T.MapType)


def _number(folder: str) -> int | None:
    said = folder.rsplit("=", 1)[-1]
    return int(said) if said.isdigit() else None


def _file_system(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop


def matching(spark: SparkSession, path: str, pattern: str) -> list[str]:
    """Paths below ``path`` that match a pattern, by one listing per level."""
    files, folder = _file_system(spark, path)
    found = files.globStatus(spark._jvm.org.apache.hadoop.fs.Path(folder, pattern))
    return sorted(str(f.getPath().toString()) for f in found or [])


def delete(spark: SparkSession, path: str) -> None:
    files, folder = _file_system(spark, path)
    files.delete(folder, True)


def _snapshots(spark: SparkSession, path: str) -> list[int]:
    done = matching(spark, path, "_snapshot/upto=*/_SUCCESS")
    return sorted(n for n in (_number(d.rsplit("/", 1)[0]) for d in done) if n is not None)


def _batches(spark: SparkSession, path: str, levels: int) -> dict[int, list[str]]:
    """Folders of every batch; ``levels`` partition columns lie above the batch."""
    found: dict[int, list[str]] = {}
    for folder in matching(spark, path, "*/" * levels + "batch_id=*"):
        number = _number(folder)
        if number is not None:
            found.setdefault(number, []).append(folder)
    return found


def _read(spark: SparkSession, path: str, folders: Sequence[str]) -> DataFrame:
    rows = spark.read.option("basePath", path).parquet(*folders)
    return rows.withColumn("batch_id", F.col("batch_id").cast("long"))


def read_versions(
    spark: SparkSession, path: str, schema: T.StructType | None = None, partition_by: Sequence[str] = ()
) -> DataFrame:
    """The newest snapshot and the batches after it, all with their ``batch_id``; an empty table of ``schema`` if
    there is none. ``partition_by`` are the columns the batches were written by."""
    folded = _snapshots(spark, path)
    if not folded:
        try:
            return spark.read.parquet(path)
        except AnalysisException:
            if schema is None:
                raise
            return spark.createDataFrame([], schema.add("batch_id", T.LongType()))
    kept = spark.read.parquet(f"{path}/_snapshot/upto={folded[-1]}")
    newer = [f for n, fs in _batches(spark, path, len(partition_by)).items() if n > folded[-1] for f in fs]
    if not newer:
        return kept
    rows = _read(spark, path, newer)
    return kept.unionByName(rows, allowMissingColumns=True).select(*dict.fromkeys([*rows.columns, *kept.columns]))


def fold(
    spark: SparkSession, path: str, key: str | Sequence[str], order: Sequence[str | Column] = ("batch_id",),
    partition_by: Sequence[str] = (), keep: int = 2, files: int = FILES,
) -> int | None:
    """Takes all batches but the newest ``keep`` into a new snapshot, and gives the last batch taken in; None if
    there is nothing to take.

    The newest stay, as their writer may still be at work or write them again. ``order`` is that of the reads. By
    ``partition_by`` the snapshot keeps the folders that reads prune by; otherwise it is laid out by key.
    """
    found = _batches(spark, path, len(partition_by))
    folded = _snapshots(spark, path)
    before = folded[-1] if folded else -1
    numbers = sorted(found)
    taken = [n for n in (numbers[:-keep] if keep else numbers) if n > before]
    if not taken:
        return None
    parts = [_read(spark, path, [f for n in taken for f in found[n]])]
    if folded:
        parts.append(spark.read.parquet(f"{path}/_snapshot/upto={before}"))
    versions = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    keys = [key] if isinstance(key, str) else list(key)
    rows = current(versions, keys, order)
    if partition_by:
        writer = rows.hint("rebalance", *partition_by).write.partitionBy(*partition_by)
    else:
        writer = rows.repartition(files, *keys).sortWithinPartitions(*keys).write
    # A later fold of the same batches writes the same rows.
    writer.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{path}/_snapshot/upto={taken[-1]}")
    for number in folded[:-1]:
        delete(spark, f"{path}/_snapshot/upto={number}")
    for number, folders in found.items():
        if number <= before:
            for folder in folders:
                delete(spark, folder)
    return taken[-1]
