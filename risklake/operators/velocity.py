"""How often and how much a user has spent lately."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from risklake.config import VelocityConfig
from risklake.functions import timeline as tl
from risklake.functions.scalars import MICROS, micros

USER = ("_user",)
COLUMNS = (
    "txn_count_1h", "amount_sum_1h", "txn_count_24h", "amount_sum_24h", "unique_merchants_1h",
)


def velocity_features(txns: DataFrame, cfg: VelocityConfig = VelocityConfig()) -> DataFrame:
    """Count, amount and distinct merchants of the user's trailing 1 h / 24 h.

    The row itself and others at the same instant are not counted, as a look-up that
    precedes the update would not. Amounts are summed exactly, to six decimals; one that is
    no such number adds nothing. Rows without a user have no history.
    """
    rows = on_timeline(txns)
    return rows.join(velocity_at(rows, cfg), [*USER, "_us"], "left").select(*txns.columns, *COLUMNS)


def on_timeline(txns: DataFrame) -> DataFrame:
    return txns.withColumns({"_us": micros(F.col("event_time")), "_user": tl.own_key("user_id")})


def velocity_at(
    rows: DataFrame, cfg: VelocityConfig, lasts: dict[str, Column] | None = None, held: dict[str, DataFrame] | None = None,
) -> DataFrame:
    """The features per (``_user``, ``_us``) of ``rows``, and of each struct of ``lasts`` (name -> column) the greatest of
    the user's earlier instants; all from one pass over the time line. ``held`` brings structs of the user's other
    dated rows: name -> (``_user``, ``_us``, the struct by that name)."""
    lasts, held = lasts or {}, held or {}
    windows = {"1h": cfg.short_s, "24h": cfg.long_s}
    own = rows.select(
        *USER, "_us", F.lit(1).cast("long").alias("n"), F.col("amount").try_cast(tl.MONEY).alias("amt"),
        *[c.alias(n) for n, c in lasts.items()],
    )
    entries = tl.trailing_entries(own, USER, ("n", "amt"), windows, tuple(lasts)).withColumn("merchants", F.lit(0).cast("long"))
    entries = entries.unionByName(_merchants_in_sight(rows, cfg.short_s), allowMissingColumns=True)
    for table in held.values():
        entries = entries.unionByName(table.withColumn("_asks", F.lit(False)), allowMissingColumns=True)
    sums = ["n_1h", "amt_1h", "n_24h", "amt_24h", "merchants"]
    return tl.sliced(entries, USER, sums, (*lasts, *held)).select(
        *USER,
        "_us",
        F.col("n_1h").alias("txn_count_1h"),
        F.col("amt_1h").cast("double").alias("amount_sum_1h"),
        F.col("n_24h").alias("txn_count_24h"),
        F.col("amt_24h").cast("double").alias("amount_sum_24h"),
        F.col("merchants").alias("unique_merchants_1h"),
        *lasts,
        *held,
    )


def _merchants_in_sight(df: DataFrame, seconds: int) -> DataFrame:
    """Entries whose sum over earlier instants is the number of distinct merchants of the trailing window.

    A merchant is in sight from just after a purchase until ``seconds`` after it, and
    purchases of one slice are never further apart than that, so each (user, merchant,
    slice) is one stretch of sight. A stretch ends early where the next one begins.
    """
    stretch_key = (*USER, "merchant_id")
    stretches = (
        df.filter(F.col("merchant_id").isNotNull())
        .groupBy(*stretch_key, tl.slice_start(F.col("_us")).alias("_slice"))
        .agg(F.min("_us").alias("_first"), F.max("_us").alias("_last"))
    )
    following = F.lead("_first").over(Window.partitionBy(*stretch_key).orderBy("_slice"))
    ends = F.least(F.col("_last") + F.lit(seconds * MICROS), following)
    mark = lambda us, by: F.struct(F.col(us).alias("_us"), F.lit(False).alias("_asks"), F.lit(by).cast("long").alias("merchants"))
    return stretches.select(*USER, "_first", ends.alias("_end")).select(
        *USER, F.inline(F.array(mark("_first", 1), mark("_end", -1)))
    )


def idle_reset_counters(txns: DataFrame, cfg: VelocityConfig = VelocityConfig()) -> DataFrame:
    """Counters that start again after an idle gap longer than their time to live.

    This is what counting with an expiry renewed by each event means. Columns
    ``count_<w>`` and ``amount_<w>`` hold the value found just before the row's instant.
    A counter is the running total now minus the one when the busy spell began; amounts are
    decimals, so that the difference is exact however long the history.
    """
    rows = on_timeline(txns)
    windows = {"1h": cfg.short_s, "24h": cfg.long_s}
    keys = [*USER, "_us"]
    own = rows.select(
        *keys, F.lit(True).alias("_asks"), F.lit(1).cast("long").alias("_n"), F.col("amount").try_cast(tl.MONEY).alias("_amt"),
        F.struct("_us").alias("_seen"),
    )
    running = tl.sliced(own, USER, ("_n", "_amt"), ("_seen",)).select(*keys, "_n", "_amt", F.col("_seen._us").alias("_prev_us"))
    opened = running.select(*keys, F.lit(True).alias("_asks"), *[_spell_opening(s).alias(f"_spell_{w}") for w, s in windows.items()], F.struct("_us", "_n", "_amt", "_prev_us").alias("_now"))
    # The instant itself comes back as the last one up to it.
    spells = tl.sliced(opened, USER, lasts=("_now", *[f"_spell_{w}" for w in windows]), inclusive=True)
    counters = {}
    for w, seconds in windows.items():
        gap = F.col("_us") - F.col("_now._prev_us")
        alive = F.col("_now._prev_us").isNotNull() & (gap <= seconds * MICROS)
        amount = (F.col("_now._amt") - F.col(f"_spell_{w}._amt")).cast("double")
        counters[f"count_{w}"] = F.when(alive, F.col("_now._n") - F.col(f"_spell_{w}._n")).otherwise(F.lit(0).cast("long"))
        counters[f"amount_{w}"] = F.when(alive, amount).otherwise(0.0)
    values = spells.select(*keys, *[c.alias(n) for n, c in counters.items()])
    return rows.join(values, keys, "left").select(*txns.columns, *counters)


def _spell_opening(seconds: int):
    opens = F.col("_prev_us").isNull() | (F.col("_us") - F.col("_prev_us") > seconds * MICROS)
    return F.when(opens, F.struct("_us", "_n", "_amt"))


def same_merchant_1h(txns: DataFrame, cfg: VelocityConfig = VelocityConfig()) -> DataFrame:
    """``same_merchant_count_1h``: the user's earlier purchases at this merchant within 1 h."""
    rows = on_timeline(txns).withColumn("_merchant", tl.own_key("merchant_id"))
    counted = _trailing_count(rows, (*USER, "_merchant"), cfg.short_s, "same_merchant_count_1h")
    return counted.select(*txns.columns, "same_merchant_count_1h")


def burst_rate(txns: DataFrame) -> DataFrame:
    """``burst_per_minute``: the user's transactions per minute over the trailing 5 minutes."""
    counted = _trailing_count(on_timeline(txns), USER, 300, "_burst")
    return counted.select(*txns.columns, (F.col("_burst") / 5.0).alias("burst_per_minute"))


def _trailing_count(rows: DataFrame, keys: tuple[str, ...], seconds: int, name: str) -> DataFrame:
    ones = rows.select(*keys, "_us", F.lit(1).cast("long").alias("n"))
    counts = tl.sliced_trailing(ones, keys, ("n",), {"w": seconds}).withColumnRenamed("n_w", name)
    return rows.join(counts, [*keys, "_us"], "left")
