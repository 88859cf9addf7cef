"""Streams give what the batch functions give, and survive late, bad and repeated input."""

from __future__ import annotations

import datetime as dt
import json
import os
import pickle
import time
from types import SimpleNamespace

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from risklake import schemas
from risklake.config import VelocityConfig
from risklake.operators import decisions, scoring
from risklake.operators.feature_store import USER_TRANSACTION_STATS, read_online
from risklake.operators.velocity import COLUMNS, velocity_features
from risklake.sources import events as ev
from risklake.sources import lake, messages
from risklake.streaming import collector, counters, decision_sink, enricher, first_write, live, scorer, windows

ONCE = {"availableNow": True}
T0 = dt.datetime(2024, 3, 1, 12, 0, 0)


def txn(i, user="u1", minutes=0.0, **over):
    at = T0 + dt.timedelta(minutes=minutes)
    row = {
        "transaction_id": f"t{i}", "user_id": user, "merchant_id": f"m{i % 3}", "amount": "10.5",
        "currency": "USD", "device_fingerprint": "d1", "merchant_category_code": "7995",
        "country_code": "US", "city": "X", "timestamp": at.isoformat() + "Z", "metadata": {"a": "b"},
    }
    return {**row, **over}


def send(folder, name, rows):
    folder.mkdir(parents=True, exist_ok=True)
    lines = [json.dumps({"key": "k", "value": r if isinstance(r, str) else json.dumps(r)}) for r in rows]
    file = folder / f"{name}.json"
    file.write_text("\n".join(lines))
    # The file source reads in order of modification.
    order = 1_700_000_000 + len(list(folder.iterdir()))
    os.utime(file, (order, order))


def finish(query):
    ended = query.awaitTermination(120)
    if not ended:
        query.stop()
    assert ended
    assert query.exception() is None
    return query


def rows_of(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_enricher_stores_quarantines_and_publishes(spark, tmp_path):
    src, base = tmp_path / "in", str(tmp_path / "lake")
    send(src, "a", [txn(1), txn(2, amount="abc"), txn(3, user=None), "not json", txn(4, amount="-1")])
    cfg = enricher.EnricherConfig(base=base, trigger=ONCE)
    finish(enricher.start_enricher(messages.read_transactions_stream(spark, str(src)), cfg))
    silver = spark.read.parquet(lake.layer(base, "silver_enriched"))
    assert rows_of(silver, "transaction_id", "mcc_label", "mcc_risk_score", "txn_count_1h", "device_seen_before") == [
        ("t1", "gambling", 0.9, 0, False)
    ]
    assert silver.first()["metadata"] == '{"a":"b"}'
    assert silver.first()["event_time"] == T0
    assert spark.read.parquet(lake.layer(base, "bronze_transactions")).count() == 1
    bad = spark.read.parquet(lake.layer(base, "quarantine"))
    assert bad.count() == 4 and bad.filter("quarantine_ts is null or batch_id is null").count() == 0
    sent = spark.read.schema(messages.MESSAGE).option("recursiveFileLookup", "true").json(cfg.out_topic)
    body = json.loads(sent.first()["value"])
    assert sent.first()["key"] == "t1" and body["txn_count_1h"] == 0
    assert set(body) <= set(schemas.PUBLISH_COLUMNS)

    # Restart from the checkpoint: only the new file is read.
    send(src, "b", [txn(5, minutes=1)])
    finish(enricher.start_enricher(messages.read_transactions_stream(spark, str(src)), cfg))
    silver = spark.read.parquet(lake.layer(base, "silver_enriched"))
    assert rows_of(silver, "transaction_id", "batch_id") == [("t1", 0), ("t5", 1)]


def test_replayed_batch_replaces_itself(spark, tmp_path):
    base = str(tmp_path / "lake")
    batch = spark.createDataFrame([txn(1), txn(2)], schemas.TRANSACTION)
    cfg = enricher.EnricherConfig(base=base)
    for _ in range(2):
        enricher.process_batch(batch, 7, cfg)
    assert spark.read.parquet(lake.layer(base, "silver_enriched")).count() == 2
    assert spark.read.parquet(lake.layer(base, "bronze_transactions")).count() == 2


def test_counter_updates_feed_the_next_enrichment(spark, tmp_path):
    src, base = tmp_path / "in", str(tmp_path / "lake")
    send(src, "a", [txn(1), txn(2, minutes=10), txn(2, minutes=10), txn(3, minutes=50), txn(4, user=None)])
    finish(counters.start_counter_updates(messages.read_transactions_stream(spark, str(src)), base, trigger=ONCE))
    online = read_online(USER_TRANSACTION_STATS, spark, lake.layer(base, "online"))
    assert rows_of(online, "user_id", "txn_count_1h", "amount_sum_24h", "unique_merchants_1h") == [("u1", 3, 31.5, 3)]
    cfg = enricher.EnricherConfig(base=base)
    enricher.process_batch(spark.createDataFrame([txn(9, minutes=55)], schemas.TRANSACTION), 0, cfg)
    silver = spark.read.parquet(lake.layer(base, "silver_enriched")).first()
    assert (silver["txn_count_1h"], silver["amount_sum_1h"]) == (3, 31.5)


def test_stream_velocity_equals_batch(spark, tmp_path, txns):
    """The table is streamed in time order, a few files per micro-batch."""
    want = {
        r["transaction_id"]: tuple(round(r[c], 4) for c in COLUMNS)
        for r in velocity_features(txns).collect()
    }
    src = tmp_path / "in"
    narrow = txns.select("transaction_id", "user_id", "merchant_id", "amount", "event_time")
    bounds = [dt.datetime(2024, 1, d) for d in (1, 2, 9, 20)] + [dt.datetime(2025, 1, 1)]
    for i, (low, high) in enumerate(zip(bounds, bounds[1:])):
        part = narrow.filter((F.col("event_time") >= F.lit(low)) & (F.col("event_time") < F.lit(high)))
        part.coalesce(1).write.mode("append").parquet(str(src))
    stream = spark.readStream.schema(narrow.schema).option("maxFilesPerTrigger", 1).parquet(str(src))
    out = str(tmp_path / "out")
    finish(
        counters.stream_velocity(stream).writeStream.option("checkpointLocation", str(tmp_path / "cp"))
        .trigger(availableNow=True).format("parquet").start(out)
    )
    got = {
        r["transaction_id"]: tuple(round(r[c], 4) for c in COLUMNS)
        for r in spark.read.parquet(out).collect()
    }
    assert got == want


@pytest.mark.parametrize("include_self", [False, True])
def test_counters_of_a_busy_user_equal_brute_force(include_self):
    """Several micro-batches with ties, late rows and missing merchants, straight through the processor."""

    class Held(dict):
        containsKey, getValue, updateValue = dict.__contains__, dict.__getitem__, dict.__setitem__
        removeKey, iterator = dict.__delitem__, dict.items

    rng = np.random.default_rng(0)
    cfg = VelocityConfig(short_s=600, long_s=3600)
    job = counters.TrailingCounters(cfg, 600, include_self)
    job.totals, job.details = Held(), Held()
    job.handle = SimpleNamespace(listTimers=list, registerTimer=lambda _: None)
    seen, start = [], 1_700_000_000_000_000
    for batch in range(4):
        late = rng.integers(0, 500, 300) * 1_000_000
        us = start + batch * 900_000_000 + rng.integers(0, 900, 300) * 1_000_000 - late
        new = pd.DataFrame({
            "transaction_id": [f"{batch}-{i:03}" for i in range(300)], "us": us,
            "amount": rng.integers(1, 100, 300) / 4, "merchant_id": rng.choice(["a", "b", "c", None], 300),
        })
        got = pd.concat(job.handleInputRows(("u",), iter([new]), None)).set_index("transaction_id")
        # What has been recorded when an instant is looked at: earlier batches, and this one up to it.
        for row in new.itertuples():
            known = pd.concat([*seen, new[new.us < row.us + include_self]])
            inside = known[(known.us < row.us + include_self) & (known.us >= row.us - 600_000_000)]
            long = known[(known.us < row.us + include_self) & (known.us >= row.us - 3_600_000_000)]
            one = got.loc[row.transaction_id]
            assert (one.txn_count_1h, one.amount_sum_1h, one.unique_merchants_1h) == (len(inside), inside.amount.sum(), inside.merchant_id.nunique())
            assert (one.txn_count_24h, one.amount_sum_24h) == (len(long), long.amount.sum())
        seen.append(new)
    many = pd.DataFrame({"transaction_id": [f"m{i:06}" for i in range(20_000)], "us": start + 4_000_000_000 + np.arange(20_000) * 10_000, "amount": 1.0, "merchant_id": "a"})
    begun = time.time()
    assert len(pd.concat(job.handleInputRows(("u",), iter([many]), None))) == 20_000
    assert time.time() - begun < 20


def test_a_new_user_costs_no_look_ups_of_minutes():
    """Minutes that were never stored are not looked for in the state, however long the user's past in a micro-batch."""
    asked = []

    class Held(dict):
        getValue, updateValue, removeKey, iterator = dict.__getitem__, dict.__setitem__, dict.__delitem__, dict.items

        def containsKey(self, key):
            asked.append(key)
            return key in self

    job = counters.TrailingCounters(VelocityConfig(), 600, False)
    job.totals, job.details = Held(), Held()
    job.handle = SimpleNamespace(listTimers=list, registerTimer=lambda _: None)
    day = 86_400_000_000
    new = pd.DataFrame({"transaction_id": [f"t{i}" for i in range(50)], "us": 20_000 * day + np.arange(50) * day // 2, "amount": 1.5, "merchant_id": "m"})
    got = pd.concat(job.handleInputRows(("u",), iter([new]), None))
    assert got.txn_count_24h.tolist() == [0, 1] + [2] * 48 and asked == []
    kept = set(job.totals)
    # What is stored and too old goes, with its details.
    later = new.tail(1).assign(us=20_000 * day + 100 * day)
    assert pd.concat(job.handleInputRows(("u",), iter([later]), None)).txn_count_24h.tolist() == [0]
    assert kept and set(job.totals) == set(job.details) and not kept & set(job.totals)


def test_windows_stream_equals_batch_and_drops_late_rows(spark, tmp_path):
    src, out, cp = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "cp")
    batches = [
        [txn(i, minutes=i) for i in range(10)] + [txn(20, user="u2", minutes=5)],
        [txn(30, minutes=62), txn(31, minutes=75)],  # watermark reaches 13:05
        [txn(32, minutes=76)],  # and holds for late rows from the next batch on
        [txn(40, minutes=-10), txn(41, minutes=58), txn(42, minutes=90)],  # first two are late
        [txn(50, minutes=300)], [txn(51, minutes=301)],
    ]
    for i, rows in enumerate(batches):
        send(src, f"{i}", rows)

    def decoded():
        stream = messages.read_transactions_stream(spark, str(src), max_per_trigger=1)
        return stream.withColumn("event_time", F.to_timestamp("timestamp")).withColumn(
            "amount", F.col("amount").cast("double")
        )

    finish(windows.start_velocity_windows(decoded(), out, cp, ONCE))
    kept = [r for rows in batches for r in rows if r["transaction_id"] not in ("t40", "t41", "t50", "t51")]
    batch = spark.createDataFrame(kept, schemas.TRANSACTION).withColumn(
        "event_time", F.to_timestamp("timestamp")
    ).withColumn("amount", F.col("amount").cast("double"))
    want = windows.velocity_windows(batch, exact=True)
    got = spark.read.parquet(out).filter(F.col("window_end") <= F.lit(T0 + dt.timedelta(hours=3)))
    assert got.columns == schemas.VELOCITY_WINDOW.names
    assert rows_of(got, *got.columns) == rows_of(want, *got.columns)


def test_dedupe_drops_repeats(spark, tmp_path):
    src = tmp_path / "in"
    send(src, "a", [txn(1), txn(1), txn(2)])
    send(src, "b", [txn(1, minutes=1), txn(3, minutes=2)])
    stream = messages.read_transactions_stream(spark, str(src), max_per_trigger=1).withColumn(
        "event_time", F.to_timestamp("timestamp")
    )
    finish(
        windows.dedupe(stream, "transaction_id").writeStream.format("parquet").trigger(availableNow=True)
        .option("checkpointLocation", str(tmp_path / "cp")).start(str(tmp_path / "out"))
    )
    assert rows_of(spark.read.parquet(str(tmp_path / "out")), "transaction_id") == [("t1",), ("t2",), ("t3",)]


def verdict(t, agent, score, at=T0):
    return {
        "verdict_id": f"{t}-{agent}", "transaction_id": t, "agent_type": agent, "risk_score": score,
        "risk_level": "low", "confidence": 0.9, "reasoning": f"r-{agent}", "features_used": [],
        "latency_ms": 10.0, "timestamp": at.isoformat() + "Z",
    }


def test_stream_decide_completes_or_times_out(spark, tmp_path):
    src, out = tmp_path / "in", str(tmp_path / "out")
    agents = ["velocity", "geolocation", "behavioral", "network"]
    send(src, "a", [verdict("full", a, 0.9) for a in agents[:2]] + [verdict("full", "velocity", 0.1),
                    verdict("full", "supervisor", 1.0), verdict("part", "network", 0.8)])
    send(src, "b", [verdict("full", a, 0.9) for a in agents[2:]])
    send(src, "c", [verdict("full", "network", 0.2)])
    stream = messages.read_verdicts_stream(spark, str(src), max_per_trigger=1)
    query = (
        collector.stream_decide(stream, timeout_ms=4000).writeStream.format("parquet")
        .option("checkpointLocation", str(tmp_path / "cp")).trigger(processingTime="500 milliseconds").start(out)
    )
    try:
        deadline = time.time() + 120
        got = []
        while time.time() < deadline and len(got) < 2:
            time.sleep(1)
            assert query.exception() is None
            try:
                rows = spark.read.parquet(out).collect()
            except Exception:
                continue
            got = sorted((r["transaction_id"], r["complete"], r["action"], r["final_risk_score"]) for r in rows)
        time.sleep(3)
    finally:
        query.stop()
    got = sorted(
        (r["transaction_id"], r["complete"], r["action"], r["final_risk_score"], r["total_latency_ms"])
        for r in spark.read.parquet(out).collect()
    )
    assert got == [("full", True, "decline", 0.9, 40.0), ("part", False, "decline", 0.8, 10.0)]


class StubHandle:
    """State and timers of one key."""

    def __init__(self):
        self.value, self.timers = None, set()
        self.held = SimpleNamespace(get=lambda: self.value, update=self._update, clear=lambda: self._update(None))
        self.listTimers = lambda: sorted(self.timers)
        self.registerTimer, self.deleteTimer = self.timers.add, self.timers.discard

    def _update(self, value):
        self.value = value


@pytest.mark.parametrize("clock", ["processing", "event"])
def test_every_transaction_is_given_out_once(clock):
    """Random deliveries over many micro-batches, through the processor and by plain rules."""
    agents = ["velocity", "geolocation", "behavioral", "network"]
    rng = np.random.default_rng(7 if clock == "event" else 8)
    for _ in range(150):
        handle = StubHandle()
        job = collector.VerdictCollector(4, 1000, clock, 50_000)
        job.handle, job.held = handle, handle.held
        now, out, heard, opened, closed, took, told = 100_000, [], {}, None, False, set(), set()
        want = []
        for _ in range(rng.integers(1, 8)):
            now += int(rng.integers(1, 900))
            values = SimpleNamespace(getCurrentProcessingTimeInMs=lambda: now, getCurrentWatermarkInMs=lambda: now)
            rows = [
                SimpleNamespace(agent_type=agents[rng.integers(4)], risk_score=0.0, reasoning="r", latency_ms=1.0,
                                arrival=(now + int(rng.integers(-5, 5))) * 1000, print=int(rng.integers(3)))
                for _ in range(rng.integers(1, 4))
            ]
            for r in rows:
                r.risk_score = 1 - r.print / 4  # the riskier of one instant counts
            for r in rows:
                if closed:
                    if (r.agent_type, r.print) not in took | told:
                        told.add((r.agent_type, r.print))
                        want.append(("late", [(r.agent_type, r.print)]))
                else:
                    heard[r.agent_type] = min(heard.get(r.agent_type, (r.arrival, r.print)), (r.arrival, r.print))
            if not closed:
                if opened is None:
                    opened = now if clock == "processing" else min(v[0] for v in heard.values()) // 1000
                if len(heard) == 4:
                    want.append((True, sorted((a, v[1]) for a, v in heard.items())))
                    closed, took = True, {(a, v[1]) for a, v in heard.items()}
            # The print tells which verdict of an agent was taken.
            of = {(r.agent_type, r.print): r for r in rows}
            for r in rows:
                r.reasoning = str(r.print)
            got = list(job.handleInputRows(("t",), iter(rows), values))
            for due in [t for t in handle.listTimers() if t <= now]:
                got += list(job.handleExpiredTimer(("t",), values, SimpleNamespace(getExpiryTimeInMs=lambda due=due: due)))
                handle.timers.discard(due)
            if not closed and opened + 1000 <= now:
                want.append((False, sorted((a, v[1]) for a, v in heard.items())))
                closed, took = True, {(a, v[1]) for a, v in heard.items()}
            assert of
            out += [("late" if g.late else g.complete, sorted((v.agent_type, int(v.reasoning)) for v in g.verdicts)) for g in got]
        assert out == want
        assert sum(kind != "late" for kind, _ in out) <= 1
        # Nothing is remembered for ever.
        for _ in range(3):
            for due in handle.listTimers():
                values = SimpleNamespace(getCurrentProcessingTimeInMs=lambda: due, getCurrentWatermarkInMs=lambda: due)
                list(job.handleExpiredTimer(("t",), values, SimpleNamespace(getExpiryTimeInMs=lambda: due)))
                handle.timers.discard(due)
        assert handle.value is None and not handle.timers


def test_a_group_of_transactions_costs_one_state_access(spark):
    """Sixty transactions of one group: each is given out by itself, from one read and one write of the state."""
    agents = ["velocity", "geolocation", "behavioral", "network"]
    handle, calls = StubHandle(), []
    job = collector.VerdictCollector(4, 1000, "event", 50_000)
    job.handle = handle
    job.held = SimpleNamespace(
        get=lambda: calls.append("get") or handle.value, update=lambda v: calls.append("update") or handle._update(v), clear=lambda: handle._update(None)
    )
    at = SimpleNamespace(getCurrentWatermarkInMs=lambda: 0)
    rows = [
        SimpleNamespace(transaction_id=None if i == 1 else f"t{i}", agent_type=a, risk_score=0.5, reasoning="r", latency_ms=1.0, arrival=i * 1_000_000, print=1)
        for a in agents for i in range(60) if i % 3 or a != "network"
    ]
    got = list(job.handleInputRows((7,), iter(rows), at))
    assert {g.transaction_id for g in got} == {None, *(f"t{i}" for i in range(2, 60) if i % 3)} and len(got) == 40
    assert all(g.complete and [v.agent_type for v in g.verdicts] == agents for g in got)
    assert calls == ["get", "update"] and handle.listTimers() == [1000]
    # What came in is not told again; the earliest open one runs out first, and the timer goes to the next.
    assert list(job.handleInputRows((7,), iter(rows), at)) == []
    late = SimpleNamespace(getCurrentWatermarkInMs=lambda: 1000)
    gone = list(job.handleExpiredTimer((7,), late, SimpleNamespace(getExpiryTimeInMs=lambda: 1000)))
    assert [(g.transaction_id, g.complete, len(g.verdicts)) for g in gone] == [("t0", False, 3)]
    assert max(handle.listTimers()) == 4000
    straggler = SimpleNamespace(transaction_id="t0", agent_type="network", risk_score=0.1, reasoning="r", latency_ms=1.0, arrival=0, print=2)
    told = list(job.handleInputRows((7,), iter([straggler, straggler]), late))
    assert [(g.transaction_id, g.late) for g in told] == [("t0", True)]


def test_verdicts_travel_in_packs(spark):
    """Spark hands the collector a row per group and time, not one per verdict, and gets one for all that a group gives out."""
    agents = ["velocity", "geolocation", "behavioral", "network"]
    schema = "bucket long, event_time timestamp, transaction_id string, agent_type string, risk_score double, reasoning string, latency_ms double, arrival long, print long"
    rows = [
        (i % 5, None if i == 7 else T0 + dt.timedelta(microseconds=i % 3), None if i == 3 else f"t{i}", a, None if i == 4 else i / 64, "r" * (i % 2), 1.0, i, i)
        for i in range(40) for a in [*agents, "supervisor", None]
    ]
    sent = spark.createDataFrame(rows, schema).coalesce(1)
    packs = collector.packed(sent, ["bucket", "event_time"])
    got = packs.select("bucket", F.unix_micros("event_time"), "pack").collect()
    assert len(got) == len({(b, us) for b, us, _ in got}) == 16
    heard = sent.where(F.col("agent_type").isin(agents)).select("bucket", F.unix_micros("event_time"), *collector.TAKEN).collect()
    assert sorted(map(str, ((b, us, *v) for b, us, pack in got for v in pickle.loads(pack)))) == sorted(map(str, map(tuple, heard)))

    def given(kind, rows_of):
        out = []
        for bucket in range(5):
            job, handle = kind(4, 1000, "event", 50_000), StubHandle()
            job.handle, job.held = handle, handle.held
            for now in (0, 1000):
                at = SimpleNamespace(getCurrentWatermarkInMs=lambda now=now: now)
                out += job.handleInputRows((bucket,), iter(rows_of(bucket)), at)
            out += job.handleExpiredTimer((bucket,), at, SimpleNamespace(getExpiryTimeInMs=lambda: max(handle.listTimers())))
        return out

    plain = given(collector.VerdictCollector, lambda b: [SimpleNamespace(**dict(zip(collector.TAKEN, r[2:]))) for r in heard if r[0] == b])
    by_pack = given(collector.PackedCollector, lambda b: [g for g in got if g["bucket"] == b])
    assert len(by_pack) == 5 and len(plain) == 40
    back = collector.unpacked(spark.createDataFrame([(g.pack,) for g in by_pack], "pack binary")).collect()
    assert sorted(map(str, back)) == sorted(map(str, plain))


def test_stragglers_and_conflicts_over_restarts(spark, tmp_path):
    """Three verdicts time out, then the fourth comes: it is told apart, and the decision stands."""
    src, base = tmp_path / "in", str(tmp_path / "lake")
    agents = ["velocity", "geolocation", "behavioral", "network"]
    send(src, "a", [verdict("slow", a, 0.9) for a in agents[:3]] + [verdict("two", a, 0.5) for a in agents]
         + [verdict("two", "network", 0.0, T0 + dt.timedelta(seconds=1)), verdict("two", "velocity", 1.0, T0 - dt.timedelta(seconds=1))])

    def run():
        stream = messages.read_verdicts_stream(spark, str(src))
        finish(collector.start_collector(stream, base, timeout_ms=500, trigger={"once": True}))

    run()
    time.sleep(1)
    send(src, "b", [verdict("two", "geolocation", 0.5), verdict("slow", "velocity", 0.9)])
    run()
    send(src, "c", [verdict("slow", "network", 0.1), verdict("two", "geolocation", 0.5)])
    run()
    sent = spark.read.schema(messages.MESSAGE).option("recursiveFileLookup", "true").json(lake.layer(base, "messages_decisions"))
    got = rows_of(messages.decode_json(sent, schemas.DECISION), "transaction_id", "final_risk_score", "timestamp")
    assert got == [("slow", 0.9, "2024-03-01T12:00:00.000000Z"), ("two", 0.6, "2024-03-01T11:59:59.000000Z")]
    late = spark.read.parquet(lake.layer(base, "late_verdicts"))
    assert rows_of(late, "transaction_id", "agent_type", "risk_score") == [("slow", "network", 0.1)]


def test_enricher_takes_a_message_once_and_never_a_damaged_one_for_a_sound_one(spark, tmp_path):
    src, base = tmp_path / "in", str(tmp_path / "lake")
    send(src, "a", [txn(1), txn(1), txn(2, amount="abc"), txn(2, amount="abc"), txn(3, user=None), txn(4)])
    cfg = enricher.EnricherConfig(base=base, trigger=ONCE)
    finish(enricher.start_enricher(messages.read_transactions_stream(spark, str(src)), cfg))
    # Again after a restart; a corrected one; one that is about a time long past.
    send(src, "b", [txn(1), txn(2), txn(3, user=None), txn(5, minutes=-100_000)])
    finish(enricher.start_enricher(messages.read_transactions_stream(spark, str(src)), cfg))
    silver = spark.read.parquet(lake.layer(base, "silver_enriched"))
    assert rows_of(silver, "transaction_id") == [("t1",), ("t2",), ("t4",), ("t5",)]
    bad = spark.read.parquet(lake.layer(base, "quarantine"))
    assert rows_of(bad, "transaction_id") == [("t2",), ("t3",)]
    assert spark.read.parquet(lake.layer(base, "bronze_transactions")).count() == 4


def test_scorer_sends_four_verdicts_with_ids_and_times(spark, tmp_path):
    src, base = tmp_path / "in", str(tmp_path / "lake")
    send(src, "a", [{**txn(1), "txn_count_1h": 99, "device_seen_before": True}, "not json"])
    finish(scorer.start_scorer(scorer.read_enriched_stream(spark, str(src)), base, trigger=ONCE))
    sent = spark.read.schema(messages.MESSAGE).option("recursiveFileLookup", "true").json(lake.layer(base, "messages_verdicts"))
    rows = messages.decode_json(sent, schemas.VERDICT).collect()
    assert {r.agent_type for r in rows} == {"velocity", "geolocation", "behavioral", "network"} and len({r.verdict_id for r in rows}) == 4
    assert {r.timestamp for r in rows} == {"2024-03-01T12:00:00.000000Z"}
    assert next(r.risk_score for r in rows if r.agent_type == "velocity") == 0.3


def test_stream_decide_by_event_time(spark, tmp_path):
    src, out = tmp_path / "in", str(tmp_path / "out")
    later = T0 + dt.timedelta(hours=1)
    agents = ["velocity", "geolocation", "behavioral", "network"]
    send(src, "a", [verdict("full", a, 0.5) for a in agents] + [verdict("part", "network", 0.8)])
    send(src, "b", [verdict("new", "network", 0.1, later)])
    send(src, "c", [verdict("new", "velocity", 0.1, later)])
    stream = messages.read_verdicts_stream(spark, str(src), max_per_trigger=1)
    finish(
        collector.stream_decide(stream, timeout_ms=1000, clock="event").writeStream.format("parquet")
        .option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start(out)
    )
    got = rows_of(spark.read.parquet(out), "transaction_id", "complete", "final_risk_score")
    assert got == [("full", True, 0.5), ("part", False, 0.8)]


def test_timed_out_sets_are_a_registered_query(spark, txns):
    from risklake.plans import catalog
    from tests.conftest import SF_DIR

    rows = catalog.queries()["stream_verdict_timeouts"](spark, SF_DIR).collect()
    want = {r.transaction_id for r in txns.select("transaction_id").collect() if int(r.transaction_id[4:]) % 7 == 0}
    assert {r.transaction_id for r in rows} == want and len(rows) == len(want) > 0
    assert all(not r.complete and r.n_verdicts == 3 for r in rows)


def test_decision_sink_keeps_the_last_and_ignores_verdicts(spark, tmp_path):
    src, base = tmp_path / "in", str(tmp_path / "lake")

    def decision(i, score, minutes=0):
        at = T0 + dt.timedelta(minutes=minutes)
        return {"decision_id": f"d{i}", "transaction_id": f"t{i}", "final_risk_score": score, "action": "x",
                "risk_level": "low", "total_latency_ms": 5.0, "timestamp": at.isoformat() + "Z"}

    send(src, "a", [decision(1, 0.8), decision(2, 0.5), verdict("t9", "network", 0.3)])
    finish(decision_sink.start_decision_sink(messages.read_decisions_stream(spark, str(src)), base, ONCE))
    send(src, "b", [decision(1, 0.2, 5)])
    finish(decision_sink.start_decision_sink(messages.read_decisions_stream(spark, str(src)), base, ONCE))
    current = decision_sink.read_decisions(spark, base)
    assert rows_of(current, "decision_id", "final_risk_score", "risk_bucket") == [("d1", 0.2, "low"), ("d2", 0.5, "medium")]
    assert current.schema["decision_date"].dataType.simpleString() == "date"


def test_table_streams_as_messages(spark, tmp_path):
    """The events table itself as a message stream: encode, decode, window."""
    from tests.conftest import SF_DIR

    raw = ev.stream_events(spark, SF_DIR)
    decoded = messages.decode_json(ev.transaction_messages(raw), schemas.TRANSACTION)
    finish(
        decoded.writeStream.format("parquet").trigger(availableNow=True)
        .option("checkpointLocation", str(tmp_path / "cp")).start(str(tmp_path / "out"))
    )
    back = spark.read.parquet(str(tmp_path / "out")).withColumn("at", F.to_timestamp("timestamp"))
    want = ev.transactions(spark, SF_DIR)
    assert rows_of(back, "transaction_id", F.col("amount").cast("double"), "at", "latitude") == rows_of(
        want, "transaction_id", "amount", "event_time", "latitude"
    )


def test_scored_rows_pass_through_the_stream_schema(spark):
    enriched = spark.createDataFrame([("t1",)], "transaction_id string")
    from risklake.operators.enrich import with_defaults

    full = with_defaults(enriched).withColumns(
        {c: F.lit("x") for c in ("country_code", "city", "merchant_category_code")} | {"amount": F.lit(1.0)}
    )
    out = decisions.decide(scoring.with_verdicts(full))
    assert out.first()["action"] == "approve"


def test_first_writes_go_on_after_a_restart_without_reading_the_table(spark, tmp_path):
    src, table, cp = tmp_path / "in", str(tmp_path / "table"), str(tmp_path / "cp")
    schema = "k string, v int, m array<string>"
    lake.insert_new(spark.createDataFrame([("old", 0, None), (None, 7, None)], schema), table, "k", 4, ["v"])

    def run():
        said = messages.read_messages_stream(spark, str(src), max_per_trigger=1).select(F.from_json("value", schema).alias("r")).select("r.*")
        query = first_write.start_first_writes(said, table, "k", ["v"], cp, ONCE)
        finish(query)
        return query._jsq.explainInternal(True)

    row = lambda k, v: {"k": k, "v": v, "m": [str(v)]}
    send(src, "a", [row("old", -5), row("a", 3), row("a", 2), row("a", None), row(None, 1)])
    send(src, "b", [row("a", 0), row("b", 9)])
    run()
    send(src, "c", [row("a", 1), row("b", 1), row("c", 5), row("c", 4), row("old", 3)])
    plan = run()
    assert "Scan parquet" not in plan
    rows = [(r.k, r.v) for r in spark.read.parquet(table).collect()]
    assert sorted(rows, key=str) == sorted([("old", 0), (None, 7), ("a", None), ("b", 9), ("c", 4)], key=str)
    # The stored batch stands, and the stream's own begin behind it.
    assert sorted(int(r.batch_id) for r in spark.read.parquet(table).select("batch_id").distinct().collect()) == [4, 5, 6, 7]


def test_first_writes_pick_a_tasks_keys_at_once_and_leave_the_state_to_spark(spark, tmp_path, monkeypatch):
    """Python sees no single key, and a task drops rows while they come: nulls first, not-a-number last, copies once."""
    monkeypatch.setattr(first_write, "GATHER_ROWS", 7)
    src, table, cp = tmp_path / "in", str(tmp_path / "table"), str(tmp_path / "cp")
    schema = "k string, v double, n int, m array<string>"
    rng = np.random.default_rng(5)
    rows = [("hot", float(v), n, [str(n)]) for n, v in enumerate(rng.integers(1, 50, 200))] + [("hot", 0.5, n, None) for n in (9, 8, 8)]
    rows += [(k, v, n, None) for k in ("a", None) for n, v in enumerate([2.0, float("nan"), 1.0])]
    rows += [("none", v, 0, []) for v in (-1.0, None, float("nan"))] + [("nan", float("nan"), n, None) for n in (4, 3)]
    rows = [rows[i] for i in rng.permutation(len(rows))]
    lines = [{"k": k, "v": "NaN" if v is not None and np.isnan(v) else v, "n": n, "m": m} for k, v, n, m in rows]
    for part in range(2):  # the second delivers everything again
        send(src, str(part), lines)
    said = messages.read_messages_stream(spark, str(src), max_per_trigger=1).select(F.from_json("value", schema).alias("r")).select("r.*")
    query = first_write.start_first_writes(said, table, "k", ["v", F.col("n")], cp, ONCE)
    finish(query)
    got = sorted(((r.k, r.v, r.n) for r in spark.read.parquet(table).collect()), key=str)
    want = [("a", 1.0, 2), (None, 1.0, 2), ("hot", 0.5, 8), ("none", None, 0), ("nan", float("nan"), 3)]
    assert str(got) == str(sorted(want, key=str))
    plan = query._jsq.explainInternal(True)
    assert "StreamingDeduplicate" in plan and "TransformWithState" not in plan


def test_live_counters_equal_the_batch(spark, tmp_path):
    src, base = tmp_path / "in", str(tmp_path / "lake")
    rng, agents = np.random.default_rng(2), ["velocity", "network", "supervisor"]
    said = [verdict(f"t{i}", agents[rng.integers(3)], float(rng.integers(0, 11)) / 10) | {"latency_ms": float(rng.integers(1, 1500)), "risk_level": "high"} for i in range(60)]
    stream = lambda: messages.read_verdicts_stream(spark, str(src), max_per_trigger=1)
    for k in range(4):
        send(src, str(k), said[15 * k : 15 * k + 15])
        if k % 2:
            for query in live.start_live(stream(), base, trigger=ONCE):
                finish(query)
    batch = spark.createDataFrame(said, schemas.VERDICT)
    for table in live.TABLES:
        rounded = lambda df: df.withColumn("sum_seconds", F.round("sum_seconds", 6)) if "sum_seconds" in df.columns else df
        want = rounded(live.totals(batch, table))
        assert rows_of(rounded(live.read_live(spark, base, table)), *want.columns) == rows_of(want, *want.columns)
    assert set(live.fold_live(spark, base, keep=1)) == set(live.TABLES)
    want = live.totals(batch, "verdict_counters")
    assert rows_of(live.read_live(spark, base, "verdict_counters"), *want.columns) == rows_of(want, *want.columns)


@pytest.mark.parametrize("name", ["stream_verdict_once", "live_verdict_counters", "live_latency_histogram"])
def test_deliveries_share_the_features(spark, monkeypatch, name):
    """The messages of all deliveries are made of stored rows, and travel compressed."""
    from risklake.plans import catalog
    from tests.conftest import SF_DIR

    read, publish = [], messages.publish

    def watched(sent, path, *args, **options):
        # Batches of the streams themselves go elsewhere.
        read.extend(sent.inputFiles() if path.endswith("/topic") else [])
        publish(sent, path, *args, **options)
        read.extend(f for f in spark.read.text(path, recursiveFileLookup=True).inputFiles() if not f.endswith(".gz"))

    monkeypatch.setattr(messages, "publish", watched)
    assert not catalog.queries()[name](spark, SF_DIR).isEmpty()
    assert read and all("/enriched-" in f for f in read)


def test_both_readers_of_the_mixed_topic_share_the_features(spark):
    from risklake.plans import catalog
    from tests.conftest import SF_DIR

    files = catalog.queries()["mixed_topic"](spark, SF_DIR).inputFiles()
    assert files and all("/enriched-" in f for f in files)
