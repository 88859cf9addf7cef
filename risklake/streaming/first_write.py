"""Insert by key, first write wins, as a stream: the keys live in state, and the table isn't read again."""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from risklake.session import data_batches_only
from risklake.sources import lake, snapshots

# The function travels with the job; workers need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: So many rows at least are gathered before all but the first of each key are dropped.
GATHER_ROWS = 100_000


def _firsts(batches: Sequence[pa.RecordBatch], key: str, by: Sequence[str]) -> pa.Table:
    """The first row of each key; nulls first, as Spark sorts."""
    table = pa.Table.from_batches(batches).combine_chunks()
    order = pc.sort_indices(table.select(by), [(c, "ascending") for c in by], null_placement="at_start")
    keys = table.column(key).combine_chunks().take(order).dictionary_encode("encode").indices
    return table.take(order.take(pa.array(np.unique(keys.to_numpy(), return_index=True)[1])))


def _first_of_task(rows: DataFrame, key: str, by: Sequence[str]) -> DataFrame:
    """The first row per key of each partition, by the columns ``by``. A task holds one row per key and what came since it
    last dropped the others."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size, limit = 0, GATHER_ROWS
        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            if size >= limit:
                held = _firsts(held, key, by).to_batches()
                size = sum(b.num_rows for b in held)
                limit = max(GATHER_ROWS, 2 * size)
        if size:
            yield from _firsts(held, key, by).to_batches(10_000)

    return rows.mapInArrow(run, rows.schema)


def first_rows(stream: DataFrame, key: str, order: Sequence[str | Column], known: DataFrame) -> DataFrame:
    """The first row per key of a stream, by ``order`` and then a hash of the row within a micro-batch. ``known`` is a stream
    of the keys that have had theirs, all in the first micro-batch. Columns to order by, and the key, are of simple types.

    A task first picks the first row of each of its keys in the micro-batch, so that Spark's own deduplication, whose
    state holds every key, as first write wins for ever, has one row per key to judge.
    """
    ranked = stream.withColumns(
        {f"_order{i}": F.col(c) if isinstance(c, str) else c for i, c in enumerate([*order, F.xxhash64(*stream.columns)])}
    )
    by = [c for c in ranked.columns if c not in stream.columns]
    # Not-a-number is the greatest.
    nans = {f"{c}_nan": F.isnan(c) for c, t in ranked.select(by).dtypes if t in ("float", "double")}
    by = ["_new", *[name for c in by for name in (f"{c}_nan", c) if name in (*nans, c)]]
    rows = ranked.withColumns({**nans, "_new": F.lit(True)})
    both = rows.unionByName(known.select(key, F.lit(False).alias("_new")), allowMissingColumns=True)
    firsts = _first_of_task(both.repartition(key), key, by)
    return firsts.dropDuplicates([key]).where("_new").select(*stream.columns)


def _first_batch(spark: SparkSession, path: str, checkpoint: str) -> int:
    """The table's batch ids that were there before the stream are left alone: its own begin behind them. The number is
    stored with the checkpoint, so that a restart goes on with it."""
    kept = f"{checkpoint}/first_batch"
    if not snapshots.matching(spark, kept, "_SUCCESS"):
        batches = [int(b.rsplit("=", 1)[1]) for b in snapshots.matching(spark, path, "batch_id=*")]
        start = max(batches, default=-1) + 1
        spark.range(start, start + 1, 1, 1).write.mode("overwrite").parquet(kept)
    return spark.read.parquet(kept).first()["id"]


def _known_keys(spark: SparkSession, path: str, key: T.StructField, checkpoint: str) -> DataFrame:
    """The keys that the table held when the stream first started, as a stream of one micro-batch. They are stored with
    the checkpoint, so that a first micro-batch that is repeated does not find its own rows in the table."""
    kept, schema = f"{checkpoint}/known", T.StructType([T.StructField(key.name, key.dataType)])
    if not snapshots.matching(spark, kept, "_SUCCESS"):
        exists = lake.table_exists(spark, path)
        keys = lake.read_versions(spark, path).select(F.col(key.name).cast(key.dataType)).distinct() if exists else None
        (spark.createDataFrame([], schema) if keys is None else keys).write.mode("overwrite").parquet(kept)
    return spark.readStream.schema(schema).parquet(kept)


def start_first_writes(
    stream: DataFrame, path: str, key: str, order: Sequence[str | Column], checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Append rows of new keys to the table at ``path``; every micro-batch owns its ``batch_id``.

    The keys that the table holds when the stream first starts are taken into the state once. After a restart the state
    goes on from the checkpoint, and no micro-batch reads the table.
    """
    spark = stream.sparkSession
    offset = _first_batch(spark, path, checkpoint)
    known = _known_keys(spark, path, stream.schema[key], checkpoint)
    writer = (
        first_rows(stream, key, order, known).writeStream
        .foreachBatch(lambda df, batch_id: lake.write_batch(df, path, offset + batch_id))
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "2 seconds"}))
    )
    with data_batches_only(spark):
        return writer.start()
