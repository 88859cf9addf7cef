"""Lake tables: layered appends that survive replay, keyed tables, upkeep, reports."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from risklake.sources.snapshots import current, has_map, read_versions

# Where each layer lives below the lake's base path.
LAYERS = {
    "bronze_transactions": "bronze/transactions",
    "silver_enriched": "silver/enriched",
    "silver_velocity_windows": "silver/velocity_windows",
    "silver_behavioral_features": "silver/behavioral_features",
    "gold_decisions": "gold/decisions",
    "gold_analytics": "gold/analytics",
    "quarantine": "quarantine",
    "online": "online",
    "late_verdicts": "late_verdicts",
    "live": "live",
    "messages_enriched": "messages/enriched",
    "messages_verdicts": "messages/verdicts",
    "messages_decisions": "messages/decisions",
    "checkpoints": "checkpoints",
}


def layer(base: str, name: str) -> str:
    return f"{base.rstrip('/')}/{LAYERS[name]}"


# --- appends -------------------------------------------------------------------------


def write_batch(
    df: DataFrame, path: str, batch_id: int, partition_by: Sequence[str] = (), fmt: str = "parquet"
) -> None:
    """Append the rows of one batch. The same batch again replaces itself: each batch owns its ``batch_id``
    partitions, and only those are overwritten."""
    rows = df.withColumn("batch_id", F.lit(batch_id).cast("long"))
    if partition_by:
        # Otherwise each task writes a file into each partition.
        rows = rows.hint("rebalance", *partition_by)
    writer = rows.write.format(fmt).partitionBy(*partition_by, "batch_id")
    writer.mode("overwrite").option("partitionOverwriteMode", "dynamic").save(path)


def with_date_partition(df: DataFrame, ts_col: str = "event_time") -> DataFrame:
    return df.withColumn("date_partition", F.to_date(ts_col))


def write_bronze(df: DataFrame, base: str, batch_id: int, fmt: str = "parquet") -> None:
    rows = with_date_partition(df).withColumn("ingestion_ts", F.current_timestamp())
    write_batch(rows, layer(base, "bronze_transactions"), batch_id, ["date_partition"], fmt)


def write_quarantine(bad: DataFrame, base: str, batch_id: int, fmt: str = "parquet") -> None:
    rows = bad.withColumn("quarantine_ts", F.current_timestamp())
    write_batch(rows, layer(base, "quarantine"), batch_id, fmt=fmt)


def write_silver(df: DataFrame, base: str, batch_id: int, fmt: str = "parquet") -> None:
    write_batch(with_date_partition(df), layer(base, "silver_enriched"), batch_id, ["date_partition"], fmt)


def backfill(df: DataFrame, path: str, partition_by: Sequence[str], fmt: str = "parquet") -> None:
    """Write a large history in one go: rows of a partition are gathered before writing,
    and AQE splits the partitions that are too large for one task."""
    (
        df.hint("rebalance", *partition_by).write.format(fmt).mode("overwrite")
        .option("partitionOverwriteMode", "static").partitionBy(*partition_by).save(path)
    )


# --- keyed tables --------------------------------------------------------------------


def table_exists(spark: SparkSession, path: str, fmt: str = "parquet") -> bool:
    try:
        spark.read.format(fmt).load(path)
        return True
    except AnalysisException:
        return False


def upsert(df: DataFrame, path: str, batch_id: int, partition_by: Sequence[str] = ()) -> None:
    """Insert or replace by key, last write wins; creates the table if absent.

    Every batch is kept as a version and ``read_current`` picks the last one; a replayed batch replaces its own
    version, and ``snapshots.fold`` takes older batches together.
    """
    write_batch(df, path, batch_id, partition_by)


def read_current(
    spark: SparkSession, path: str, key: str | Sequence[str],
    order: Sequence[str | Column] = ("batch_id",), schema: T.StructType | None = None,
    partition_by: Sequence[str] = (),
) -> DataFrame:
    """The last row per key; of a folded table (``snapshots.fold``) from one snapshot and the batches since."""
    return current(read_versions(spark, path, schema, partition_by), key, order)


def first_per_key(df: DataFrame, key: str, order: Sequence[str | Column]) -> DataFrame:
    rest = [c for c in df.columns if c != key]
    first = df.groupBy(key).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("_row"))
    return first.select(key, *[F.col(f"_row.{c}").alias(c) for c in rest]).select(*df.columns)


def new_rows(
    df: DataFrame, existing: DataFrame, key: str, order: Sequence[str | Column]
) -> DataFrame:
    """Rows whose key the table does not have yet; the first of each key in ``order``."""
    return first_per_key(df, key, order).join(existing.select(key), key, "left_anti")


def insert_new(
    df: DataFrame, path: str, key: str, batch_id: int, order: Sequence[str | Column]
) -> None:
    """Insert by key, first write wins. A replayed batch finds the same rows missing."""
    spark = df.sparkSession
    if table_exists(spark, path):
        earlier = spark.read.parquet(path).filter(F.col("batch_id") != batch_id)
        df = new_rows(df, earlier, key, order)
    else:
        df = first_per_key(df, key, order)
    write_batch(df, path, batch_id)


# --- whole tables --------------------------------------------------------------------


def overwrite_table(
    df: DataFrame, path: str, partition_by: Sequence[str] = (), fmt: str = "parquet"
) -> None:
    """Replace the table, its schema included."""
    df.write.format(fmt).mode("overwrite").partitionBy(*partition_by).option("partitionOverwriteMode", "static").save(path)


# Column names of the export, in order.
EXPORT_COLUMNS = (
    "user_id", "avg_txn_amount_30d", "stddev_txn_amount_30d", "amount_deviation_score",
    "hour_of_day_risk_score", "most_common_mcc", "txn_count_30d", "high_risk_mcc_ratio",
    "country_risk", "event_timestamp",
)


def export_offline_features(
    df: DataFrame, path: str, columns: Sequence[str] = EXPORT_COLUMNS
) -> None:
    """Snappy Parquet with the columns a feature view reads, its time column included."""
    (
        df.select(*columns).write.mode("overwrite").option("compression", "snappy")
        .option("partitionOverwriteMode", "static").parquet(path)
    )


def compact(
    spark: SparkSession, path: str, cluster_by: Sequence[str], target: str, files: int,
    partition_by: Sequence[str] = (),
) -> None:
    """Fewer, larger files, sorted by ``cluster_by``, written to ``target``.

    The caller switches readers over; a table is never written over its own input. A hash
    of the row is the last range key, so that equal cluster values can fill several files.
    """
    df = spark.read.parquet(path)
    spread = F.xxhash64(*[F.col(c) for c in df.columns if not has_map(df.schema[c].dataType)])
    ranged = (
        df.withColumn("_spread", spread)
        .repartitionByRange(files, *partition_by, *cluster_by, "_spread")
        .drop("_spread")
        .sortWithinPartitions(*partition_by, *cluster_by)
    )
    overwrite_table(ranged, target, partition_by)


# --- reads and reports ---------------------------------------------------------------


def since(df: DataFrame, date_col: str, as_of: dt.date, days: int) -> DataFrame:
    """Rows of the last ``days`` days; a plain date comparison, so partitions are pruned."""
    return df.filter(F.col(date_col) >= F.lit(as_of - dt.timedelta(days=days)))


def load_since(
    spark: SparkSession, path: str, date_col: str, as_of: dt.date, days: int, fmt: str = "parquet"
) -> DataFrame:
    return since(spark.read.format(fmt).load(path), date_col, as_of, days)


def load_training_records(df: DataFrame, as_of: dt.datetime, days: int = 30) -> DataFrame:
    return df.filter(F.col("created_at") > F.lit(as_of - dt.timedelta(days=days)))


def read_training_jdbc(
    spark: SparkSession, url: str, table: str, as_of: dt.datetime, days: int = 30, **options: str
) -> DataFrame:
    """Training rows of a SQL database. The time filter runs there; pass ``partitionColumn``,
    ``lowerBound``, ``upperBound`` and ``numPartitions`` to read in parallel."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    for name, value in options.items():
        reader = reader.option(name, value)
    return load_training_records(reader.load(), as_of, days)


def lake_status(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Row count per layer."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("layer"), "rows")
        for name, df in tables.items()
    ]
    out = counts[0]
    for one in counts[1:]:
        out = out.unionByName(one)
    return out


def batch_history(df: DataFrame, limit: int = 10, ts_col: str = "event_time") -> DataFrame:
    """The latest batches of a table: how many rows they brought and of what time."""
    return (
        df.groupBy("batch_id")
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.min(ts_col).alias("min_event_time"),
            F.max(ts_col).alias("max_event_time"),
        )
        .orderBy(F.col("batch_id").desc())
        .limit(limit)
    )
