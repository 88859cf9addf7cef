"""Trailing 1 h / 24 h counters per user, kept as a stream goes by.

A user's past is kept per minute. Full minutes inside a window are added up once for all
instants of a minute. Of the two minutes at its ends the older is sorted once and cut by
bisection, the newer is a running total, so a micro-batch costs its rows times the merchants
of a minute, plus its minutes times those of a window, and not the square of a busy user's rows.
"""

from __future__ import annotations

import sys
from bisect import bisect_left
from collections.abc import Iterator
from itertools import accumulate, groupby
from operator import itemgetter

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from risklake.config import VelocityConfig
from risklake.operators.feature_store import USER_TRANSACTION_STATS, push
from risklake.operators.quality import normalise, split_valid
from risklake.sources import lake
from risklake.streaming.windows import dedupe

OUTPUT = (
    "user_id string, transaction_id string, event_time timestamp, txn_count_1h long, "
    "amount_sum_1h double, txn_count_24h long, amount_sum_24h double, unique_merchants_1h long"
)
MINUTE = 60_000_000

# The processor travels with the job; workers need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


class TrailingCounters(StatefulProcessor):
    def __init__(self, cfg: VelocityConfig, lateness_s: int, include_self: bool):
        self.include_self = include_self
        self.short, self.long = cfg.short_s * 1_000_000, cfg.long_s * 1_000_000
        self.keep = self.long + lateness_s * 1_000_000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.totals = handle.getMapState(
            "totals", "minute long", "n long, amount double, merchants array<string>"
        )
        self.details = handle.getMapState(
            "details", "minute long", "us array<bigint>, amount array<double>, merchant array<string>"
        )

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        # A micro-batch is bounded by its source's per-trigger limit.
        new = pd.concat(list(rows), ignore_index=True).sort_values(["us", "transaction_id"])
        timed = new[new["us"].notna()]
        arrived = zip(*(timed[c].tolist() for c in ("us", "transaction_id", "amount", "merchant_id")))
        totals = {k[0]: (v[0], v[1], set(v[2])) for k, v in self.totals.iterator()}
        stored = set(totals)
        loaded: dict[int, tuple[list, list, list]] = {}
        latest: dict[int, int] = {}
        tails: dict[int, tuple[list, list, dict]] = {}
        between: dict[int, tuple] = {}

        def detail(minute: int) -> tuple[list, list, list]:
            if minute not in loaded:
                held = None
                if minute in stored and self.details.containsKey((minute,)):
                    held = self.details.getValue((minute,))
                loaded[minute] = tuple(list(c) for c in held) if held else ([], [], [])
                latest[minute] = max(loaded[minute][0], default=-1)
            return loaded[minute]

        def tail(minute: int) -> tuple[list, list, dict]:
            """A minute's instants in order, the amounts summed from each on, each merchant's last place."""
            if minute not in tails:
                us, amounts, merchants = detail(minute)
                order = sorted(range(len(us)), key=us.__getitem__)
                sums = list(accumulate((amounts[i] for i in reversed(order)), initial=0.0))[::-1]
                last = {merchants[i]: place for place, i in enumerate(order) if merchants[i] is not None}
                tails[minute] = ([us[i] for i in order], sums, last)
            return tails[minute]

        def full_minutes(width: int, first: int, own: int, want_merchants: bool):
            """Totals between two minutes; instants come in order, so those of one minute share them."""
            if between.get(width, (None,))[0] != (first, own):
                inside = [totals[m] for m in totals if first < m < own]
                seen = set().union(*(t[2] for t in inside)) if want_merchants else set()
                between[width] = ((first, own), sum(t[0] for t in inside), sum(t[1] for t in inside), seen)
            return between[width][1:]

        def window(us: int, width: int, want_merchants: bool):
            start, end = us - width, us + self.include_self
            first, own = start // MINUTE, us // MINUTE
            n, amount, seen = full_minutes(width, first, own, want_merchants)
            more = set()
            if first < own:
                instants, sums, last = tail(first)
                at = bisect_left(instants, start)
                n, amount = n + len(instants) - at, amount + sums[at]
                more.update(merchant for merchant, place in last.items() if place >= at)
            held = detail(own)
            if first < own and latest[own] < end:  # the minute so far, as a whole
                count, sum_, merchants = totals.get(own, (0, 0.0, ()))
                n, amount = n + count, amount + sum_
                more.update(merchants)
            else:
                for u, a, merchant in zip(*held):
                    if start <= u < end:
                        n, amount = n + 1, amount + a
                        if merchant is not None:
                            more.add(merchant)
            return n, amount, len(seen) + len(more - seen)

        def record(us: int, rows: list[tuple]) -> None:
            minute = us // MINUTE
            held, (n, amount, seen) = detail(minute), totals.get(minute, (0, 0.0, set()))
            for _, _, paid, merchant_id in rows:
                merchant = merchant_id if isinstance(merchant_id, str) else None
                held[0].append(us)
                held[1].append(float(paid))
                held[2].append(merchant)
                n, amount = n + 1, amount + float(paid)
                if merchant is not None:
                    seen.add(merchant)
            totals[minute] = (n, amount, seen)
            latest[minute] = max(latest[minute], us)
            tails.pop(minute, None)
            changed.add(minute)

        results, changed = [], set()
        # Plain rows: a user's instants are many and small, too small for a frame each.
        for us, rows_of in groupby(arrived, key=itemgetter(0)):
            us, same_instant = int(us), list(rows_of)
            if self.include_self:
                record(us, same_instant)
            short, long = window(us, self.short, True), window(us, self.long, False)
            for _, transaction_id, _, _ in same_instant:
                results.append((key[0], transaction_id, us, *short[:2], *long[:2], short[2]))
            if not self.include_self:
                record(us, same_instant)

        oldest = (max([int(new["us"].max()), *(m * MINUTE for m in totals)]) - self.keep) // MINUTE
        for minute in changed:
            if minute >= oldest:
                n, amount, seen = totals[minute]
                self.totals.updateValue((int(minute),), (int(n), float(amount), sorted(seen)))
                self.details.updateValue((int(minute),), tuple(loaded[minute]))
        for minute in stored:
            if minute < oldest:
                self.totals.removeKey((int(minute),))
                self.details.removeKey((int(minute),))

        # Forget the user once a whole window has passed without a new row.
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        self.handle.registerTimer(((max(totals) + 1) * MINUTE + self.keep) // 1000)

        names = [c.split()[0] for c in OUTPUT.split(", ")]
        out = pd.DataFrame(results, columns=names)
        out["event_time"] = pd.to_datetime(out["event_time"].astype(np.int64), unit="us", utc=True)
        yield out

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.totals.clear()
        self.details.clear()
        yield from ()

    def close(self) -> None:
        pass


def stream_velocity(
    txns: DataFrame,
    cfg: VelocityConfig = VelocityConfig(),
    lateness_s: int = 600,
    include_self: bool = False,
) -> DataFrame:
    """Streaming form of ``velocity_features``; needs the RocksDB state store.

    Rows are taken in time order within a micro-batch. A row that comes late, but before
    the watermark, sees the past of its own time; rows already given out are not corrected.
    ``include_self`` counts the row's own instant too, which is what the next look-up
    should find. Event time drives the clean-up, so a replayed stream behaves alike.
    """
    marked = "spark.watermarkDelayMs" in txns.schema["event_time"].metadata
    rows = txns if marked else txns.withWatermark("event_time", f"{lateness_s} seconds")
    narrow = rows.select(
        "user_id", "transaction_id", "event_time", F.unix_micros("event_time").alias("us"),
        "amount", "merchant_id",
    )
    return narrow.groupBy("user_id").transformWithStateInPandas(
        TrailingCounters(cfg, lateness_s, include_self), OUTPUT, "append", "EventTime"
    )


def start_counter_updates(
    txns: DataFrame,
    base: str,
    cfg: VelocityConfig = VelocityConfig(),
    trigger: dict | None = None,
) -> StreamingQuery:
    """Keep the online velocity view current from a decoded transaction stream."""
    good, _ = split_valid(normalise(txns))
    # A repeated delivery is no second purchase.
    counters = stream_velocity(dedupe(good, "transaction_id"), cfg, include_self=True)

    def store(batch: DataFrame, batch_id: int) -> None:
        rows = batch.withColumnRenamed("event_time", USER_TRANSACTION_STATS.ts_col)
        push(USER_TRANSACTION_STATS, rows, lake.layer(base, "online"), batch_id)

    return (
        counters.writeStream.foreachBatch(store)
        .option("checkpointLocation", f"{lake.layer(base, 'checkpoints')}/counters")
        .trigger(**(trigger or {"processingTime": "500 milliseconds"}))
        .start()
    )
