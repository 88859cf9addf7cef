"""Order statistics and ranks that do not need all rows in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from risklake.session import cut_lineage


def exact_percentile(
    counted: DataFrame, by: str, value: str, n: str, p: float, name: str,
    widths: Sequence[float] = (1.0, 0.001),
) -> DataFrame:
    """Smallest value of each group that at least a share ``p`` of its rows do not exceed.

    ``counted`` has one row per group and value, with the number of rows ``n``, and is best
    a stored table, as it is read several times. Counting narrows the value down: first
    the interval of width ``widths[0]`` that holds it, then the finer one inside, then the
    value. Each step is one aggregate and a window over interval counts, so neither a
    group's rows nor its values come together.
    """
    rows = counted.filter(F.col(value).isNotNull()).select(
        F.col(by), F.col(value).cast("double").alias("_v"), F.col(n).alias("_n"),
        F.lit(None).cast("long").alias("_rank"),
    )
    ordered = Window.partitionBy(by).orderBy("_cell").rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy(by)
    for cell in [F.floor(F.col("_v") / w) for w in widths] + [F.col("_v")]:
        within = rows.withColumn("_cell", cell)
        counts = within.groupBy(by, "_cell").agg(
            F.sum("_n").alias("_n"), F.max("_rank").alias("_rank")
        )
        # At first the wanted rank follows from the group's size, then from the step before.
        wanted = F.coalesce(F.col("_rank"), F.ceil(F.sum("_n").over(whole) * F.lit(p)))
        reached = counts.select(
            by, "_cell", "_n", wanted.alias("_rank"), F.sum("_n").over(ordered).alias("_sum")
        ).filter((F.col("_sum") >= F.col("_rank")) & (F.col("_sum") - F.col("_n") < F.col("_rank")))
        # One row per group: the cell that holds the value, and the rank wanted inside it.
        found = reached.select(
            F.col(by).alias("_by"),
            F.col("_cell").alias("_found"),
            (F.col("_rank") - (F.col("_sum") - F.col("_n"))).alias("_inner_rank"),
        )
        rows = within.join(
            found, F.col(by).eqNullSafe(F.col("_by")) & (F.col("_cell") == F.col("_found"))
        ).select(by, "_v", "_n", F.col("_inner_rank").alias("_rank"))
    return found.select(F.col("_by").alias(by), F.col("_found").alias(name))


def with_global_rank(df: DataFrame, order: Sequence[Column], name: str) -> DataFrame:
    """1-based position in the whole order, plus ``_total`` rows.

    Rows are range-partitioned and sorted in parallel; a row's rank is its place in its
    partition plus the sizes of the partitions before. The sorted rows are checkpointed,
    because both the sizes and the ranks must see the same partition limits even if an
    executor is lost in between.
    """
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    # Upper bits of the id are the partition, the lower 33 the place in it.
    placed = cut_lineage(ranged.withColumn("_id", F.monotonically_increasing_id()))
    part = F.shiftright("_id", 33)
    sizes = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_size"))
    # One row per partition, so one task may sum them up.
    line = Window.partitionBy(F.lit(0)).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "_part",
        F.coalesce(F.sum("_size").over(line), F.lit(0)).alias("_before"),
        F.sum("_size").over(Window.partitionBy(F.lit(0))).alias("_total"),
    )
    place = F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))
    return (
        placed.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_before") + place + 1)
        .drop("_part", "_before", "_id")
    )


def exact_quartile(df: DataFrame, order: Sequence[Column], name: str, groups: int = 4) -> DataFrame:
    """What ``ntile(groups)`` over the whole order gives, computed in parallel."""
    ranked = with_global_rank(df, order, "_rank")
    base = F.floor(F.col("_total") / groups)
    extra = F.col("_total") % groups  # the first so many groups have one row more
    in_large = extra * (base + 1)
    bucket = F.when(
        F.col("_rank") <= in_large, F.ceil(F.col("_rank") / (base + 1))
    ).otherwise(extra + F.ceil((F.col("_rank") - in_large) / F.greatest(base, F.lit(1))))
    return ranked.withColumn(name, bucket.cast("int")).drop("_rank", "_total")
