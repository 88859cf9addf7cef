"""Counters that are current while verdicts stream in: processed and flagged, and latency histograms."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from risklake.operators import analytics
from risklake.operators.quality import only_verdicts
from risklake.sources import lake, snapshots

#: Table -> its key. A micro-batch writes the totals that it changed; the last one written counts.
TABLES = {"verdict_counters": ("agent_type", "risk_level"), "latency_histogram": ("agent_type", "le")}


def totals(verdicts: DataFrame, table: str) -> DataFrame:
    """The totals of a table, of a batch or of a stream so far. State holds one row per key, whatever has come."""
    rows = only_verdicts(verdicts)
    return analytics.verdict_counters(rows) if table == "verdict_counters" else analytics.latency_histogram(rows, "latency_ms", ["agent_type"])


def _path(base: str, table: str) -> str:
    return f"{lake.layer(base, 'live')}/{table}"


def start_live(verdicts: DataFrame, base: str, tables: Sequence[str] = tuple(TABLES), trigger: dict | None = None) -> list[StreamingQuery]:
    """One query per table, in update mode."""
    return [
        totals(verdicts, table).writeStream.outputMode("update")
        .foreachBatch(lambda df, batch_id, table=table: lake.upsert(df, _path(base, table), batch_id))
        .option("checkpointLocation", f"{lake.layer(base, 'checkpoints')}/live_{table}")
        .trigger(**(trigger or {"processingTime": "1 second"}))
        .start()
        for table in tables
    ]


def read_live(spark: SparkSession, base: str, table: str) -> DataFrame:
    return lake.read_current(spark, _path(base, table), TABLES[table]).drop("batch_id")


def fold_live(spark: SparkSession, base: str, keep: int = 2) -> dict[str, int]:
    """Take older micro-batches together, so that a read stays small."""
    done = {table: snapshots.fold(spark, _path(base, table), key, keep=keep, files=1) for table, key in TABLES.items()}
    return {table: batch for table, batch in done.items() if batch is not None}
