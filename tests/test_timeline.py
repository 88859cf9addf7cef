"""Histories against brute force, among them one of very many rows."""

from __future__ import annotations

import datetime as dt
import random
import statistics

import numpy as np
import pytest
from pyspark.sql import functions as F

from risklake.config import VelocityConfig
from risklake.functions.scalars import haversine_km
from risklake.operators import behavioral, device, enrich, geo, velocity
from risklake.operators import feature_store as fs
from risklake.sources import events as ev

T0 = dt.datetime(2024, 5, 1)
SCHEMA = (
    "transaction_id string, user_id string, merchant_id string, amount double, event_time timestamp, "
    "latitude double, longitude double, country_code string, city string, device_fingerprint string"
)


@pytest.fixture(scope="module")
def dense(spark):
    """One user has half of the rows; ties, window limits and missing values occur."""
    rnd = random.Random(5)
    rows = []
    for i in range(240):
        user = "hot" if i % 2 else f"u{i % 7}"
        # Coarse steps give equal instants and gaps of exactly 1 h and 24 h.
        at = T0 + dt.timedelta(minutes=15 * rnd.randrange(0, 300), microseconds=rnd.choice([0, 0, 1]))
        rows.append((
            f"t{i:03d}", user, rnd.choice(["m1", "m2", "m3", None]), float(rnd.randrange(1, 100)), at,
            rnd.choice([10.0, 20.0, None]), 5.0, rnd.choice(["US", "FR", None]), rnd.choice(["A", "B", "C"]),
            rnd.choice(["d1", "d1", "d1", "d2", "d3", None]),
        ))
    return spark.createDataFrame(rows, SCHEMA)


def keyed(df, *cols):
    out = {}
    for r in df.collect():
        assert r["transaction_id"] not in out
        out[r["transaction_id"]] = tuple(round(r[c], 6) if isinstance(r[c], float) else r[c] for c in cols)
    return out


def test_velocity_against_brute_force(dense):
    got = keyed(velocity.velocity_features(dense), *velocity.COLUMNS)
    rows = dense.collect()
    for r in rows:
        past = [p for p in rows if p["user_id"] == r["user_id"] and p["event_time"] < r["event_time"]]
        hour = [p for p in past if p["event_time"] >= r["event_time"] - dt.timedelta(hours=1)]
        day = [p for p in past if p["event_time"] >= r["event_time"] - dt.timedelta(hours=24)]
        want = (
            len(hour), sum(p["amount"] for p in hour), len(day), sum(p["amount"] for p in day),
            len({p["merchant_id"] for p in hour} - {None}),
        )
        assert got[r["transaction_id"]] == want


def test_idle_reset_against_brute_force(dense):
    got = keyed(velocity.idle_reset_counters(dense), "count_1h", "amount_1h", "count_24h", "amount_24h")
    rows = dense.collect()
    for user in {r["user_id"] for r in rows}:
        mine = sorted((r for r in rows if r["user_id"] == user), key=lambda r: r["event_time"])
        for r in mine:
            want = []
            for hours in (1, 24):
                count, amount, last = 0, 0.0, None
                for p in mine:
                    if last is not None and p["event_time"] - last > dt.timedelta(hours=hours):
                        count, amount = 0, 0.0
                    if p["event_time"] >= r["event_time"]:
                        break
                    count, amount, last = count + 1, amount + p["amount"], p["event_time"]
                want += [count, amount]
            assert got[r["transaction_id"]] == tuple(want), r


def test_geo_against_brute_force(dense):
    got = keyed(geo.geo_features(dense), "last_txn_latitude", "last_country_code", "is_new_country", "is_new_city")
    rows = dense.collect()
    for r in rows:
        past = [p for p in rows if p["user_id"] == r["user_id"] and p["event_time"] < r["event_time"]]
        last = max(past, key=lambda p: (p["event_time"], p["transaction_id"]), default=None)
        new = [bool(past) and r[c] is not None and r[c] not in {p[c] for p in past} for c in ("country_code", "city")]
        want = (last and last["latitude"], last and last["country_code"], *new)
        assert got[r["transaction_id"]] == want


def test_device_against_brute_force(spark, dense):
    labels = spark.createDataFrame(
        [("hot", T0 + dt.timedelta(hours=20)), ("u2", T0 + dt.timedelta(hours=1)), ("u4", T0 + dt.timedelta(hours=40)),
         ("u4", T0 + dt.timedelta(hours=30)), ("elsewhere", T0)],
        "user_id string, fraud_time timestamp",
    )
    got = keyed(device.device_features(dense, labels), *device.COLUMNS)
    rows = dense.collect()
    first_label = {}
    for r in labels.collect():
        first_label[r["user_id"]] = min(r["fraud_time"], first_label.get(r["user_id"], r["fraud_time"]))
    for r in rows:
        past = [p for p in rows if p["device_fingerprint"] == r["device_fingerprint"] and p["event_time"] < r["event_time"]]
        past = past if r["device_fingerprint"] else []
        linked = {p["user_id"] for p in past if first_label.get(p["user_id"], dt.datetime.max) < r["event_time"]} - {r["user_id"]}
        assert got[r["transaction_id"]] == (bool(past), len(linked)), r


def test_point_in_time_join_against_brute_force(spark, dense):
    left = dense.filter("transaction_id < 't120'")
    history = dense.filter("transaction_id >= 't120'").select(
        "user_id", F.date_trunc("day", "event_time").alias("event_timestamp"), "country_code"
    ).groupBy("user_id", "event_timestamp").agg(F.max("country_code").alias("last_country_code"))
    got = keyed(
        fs.point_in_time_join(left, fs.GEO_STATS, history, features=["last_country_code"]),
        "last_country_code", "event_timestamp",
    )
    held = history.collect()
    for r in left.collect():
        past = [h for h in held if h["user_id"] == r["user_id"] and h["event_timestamp"] <= r["event_time"]]
        last = max(past, key=lambda h: h["event_timestamp"], default=None)
        assert got[r["transaction_id"]] == (last and last["last_country_code"], last and last["event_timestamp"])


def test_expired_features_are_null(spark):
    history = spark.createDataFrame([("u", T0, 3)], "user_id string, event_timestamp timestamp, txn_count_1h long")
    asked = spark.createDataFrame(
        [("u", T0 - dt.timedelta(seconds=1)), ("u", T0), ("u", T0 + dt.timedelta(days=1)),
         ("u", T0 + dt.timedelta(days=1, microseconds=1)), ("v", T0)],
        "user_id string, event_time timestamp",
    )
    out = fs.point_in_time_join(asked, fs.USER_TRANSACTION_STATS, history, features=["txn_count_1h"])
    assert [r["txn_count_1h"] for r in out.orderBy("user_id", "event_time").collect()] == [None, 3, 3, None, None]
    online = fs.get_online_features(
        ["user_transaction_stats:txn_count_1h"], asked, {"user_transaction_stats": history}, F.col("event_time")
    )
    assert [r["txn_count_1h"] for r in online.orderBy("user_id", "event_time").collect()] == [3, 3, 3, None, None]


def test_enrichment_equals_its_parts(dense, spark):
    labels = spark.createDataFrame([("hot", T0)], "user_id string, fraud_time timestamp")
    rows = dense.withColumn("merchant_category_code", F.lit("5411"))
    whole = enrich.enrich_history(rows, behavioral.behavioral_features(rows), labels)
    for part, names in (
        (velocity.velocity_features(rows), velocity.COLUMNS),
        (geo.geo_features(rows), ("is_new_country", "is_new_city")),
        (device.device_features(rows, labels), device.COLUMNS),
    ):
        assert keyed(whole, *names) == keyed(part, *names)


def test_rows_without_a_user_have_no_history(spark):
    rows = [(f"t{i}", None, "m", 5.0, T0 + dt.timedelta(minutes=i), 1.0, 1.0, "US", "A", None) for i in range(3)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert set(keyed(velocity.velocity_features(df), *velocity.COLUMNS).values()) == {(0, 0.0, 0, 0.0, 0)}
    assert set(keyed(velocity.idle_reset_counters(df), "count_1h", "amount_24h").values()) == {(0, 0.0)}
    assert set(keyed(geo.geo_features(df), "last_txn_latitude", "is_new_country").values()) == {(None, False)}


def test_sums_are_exact_beside_large_amounts(spark):
    amounts = [1e12, 0.01, 0.01]
    rows = [(f"t{i}", "u", "m", a, T0 + dt.timedelta(hours=2 * min(i, 1), minutes=i), 1.0, 1.0, "US", "A", None) for i, a in enumerate(amounts)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert keyed_exact(velocity.idle_reset_counters(df), "amount_1h")["t2"] == 0.01
    assert keyed_exact(velocity.velocity_features(df), "amount_sum_1h")["t2"] == 0.01


def keyed_exact(df, col):
    return {r["transaction_id"]: r[col] for r in df.collect()}


def test_a_user_with_very_many_rows_in_one_day(spark):
    """Linear: a sliding frame would take hours here. Compared with running totals."""
    n = 200_000
    step = 86_400_000_000 // n
    df = spark.range(n).select(
        F.concat(F.lit("t"), "id").alias("transaction_id"), F.lit("u").alias("user_id"),
        F.concat(F.lit("m"), F.col("id") % 9000).alias("merchant_id"), ((F.col("id") % 1000) / 100.0).alias("amount"),
        F.timestamp_micros(F.lit(1_714_521_600_000_000) + F.col("id") * step).alias("event_time"), "id",
    )
    hour = 3_600_000_000 // step
    out = velocity.velocity_features(df).select("id", *velocity.COLUMNS).toPandas().sort_values("id")
    cents = np.concatenate([[0], np.cumsum(np.arange(n) % 1000)])
    at = np.arange(n)
    low = np.maximum(at - hour, 0)
    assert (out["txn_count_1h"].to_numpy() == at - low).all()
    assert (out["amount_sum_1h"].to_numpy() == (cents[at] - cents[low]) / 100).all()
    assert (out["amount_sum_24h"].to_numpy() == cents[at] / 100).all()
    assert (out["unique_merchants_1h"].to_numpy() == np.minimum(at - low, 9000)).all()


def test_extra_signals(dense):
    same = keyed(velocity.same_merchant_1h(dense, VelocityConfig(short_s=86_400)), "same_merchant_count_1h")
    burst = keyed(velocity.burst_rate(dense), "burst_per_minute")
    rows = dense.collect()
    for r in rows:
        past = [p for p in rows if p["user_id"] == r["user_id"] and p["event_time"] < r["event_time"]]
        day = [p for p in past if p["event_time"] >= r["event_time"] - dt.timedelta(days=1)
               and r["merchant_id"] and p["merchant_id"] == r["merchant_id"]]
        five = [p for p in past if p["event_time"] >= r["event_time"] - dt.timedelta(minutes=5)]
        assert same[r["transaction_id"]] == (len(day),)
        assert burst[r["transaction_id"]] == (len(five) / 5,)


def test_distance(spark):
    pairs = [(51.5, 0.0, 51.5, 0.0), (51.5074, -0.1278, 48.8566, 2.3522), (0.0, 0.0, 0.0, 180.0), (None, 0.0, 1.0, 1.0)]
    df = spark.createDataFrame(pairs, "a double, b double, c double, d double")
    km = [r[0] for r in df.select(haversine_km(*[F.col(c) for c in "abcd"])).collect()]
    assert km[0] == 0 and 330 < km[1] < 350 and km[2] == pytest.approx(20015, abs=1) and km[3] is None


def test_impossible_travel(spark):
    rows = [("a", "u", T0, 51.5, -0.1), ("b", "u", T0 + dt.timedelta(minutes=10), 48.9, 2.35),
            ("c", "u", T0 + dt.timedelta(hours=10), 51.5, -0.1)]
    df = spark.createDataFrame(rows, "transaction_id string, user_id string, event_time timestamp, latitude double, longitude double")
    df = df.withColumns({"country_code": F.lit("X"), "city": F.lit("Y")})
    out = geo.impossible_travel(geo.geo_features(df), 900.0)
    assert {r["transaction_id"]: r["impossible_travel"] for r in out.collect()} == {"a": False, "b": True, "c": False}


def test_building_runs_no_job_and_no_python(txns):
    tracker = txns.sparkSession.sparkContext.statusTracker()
    before = len(tracker.getJobIdsForGroup(None))
    plan = geo.geo_features(velocity.velocity_features(txns))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan
    assert len(tracker.getJobIdsForGroup(None)) == before


def test_reduced_scan(txns):
    plan = velocity.velocity_features(txns).select("transaction_id", "txn_count_1h")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "event_type" not in text.split("ReadSchema")[-1]
    labels = ev.fraud_labels(txns)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(event_type), IsNotNull(props), EqualTo(event_type,error)]" in labels or "EqualTo(event_type,error)" in labels


def test_profiles_are_those_dated_before_the_row(spark):
    """Brute force over a user's days: nothing of a row's own day or later is in its profile."""
    rng = random.Random(4)
    rows = []
    for i in range(200):
        at = dt.datetime(2024, 1, 1) + dt.timedelta(hours=rng.randrange(24 * 80))
        rows.append((f"t{i}", rng.choice(["a", "b", None]), f"m{i % 3}", float(rng.choice([5, 5, 10, 40])), at, 1.0, 1.0, "US", "X", "d1", "ip"))
    rows.append(("only", "c", "m", 5.0, dt.datetime(2024, 1, 5, 3), 1.0, 1.0, "US", "X", "d1", "ip"))
    rows.append(("same", "c", "m", 5.0, dt.datetime(2024, 1, 6), 1.0, 1.0, "US", "X", "d1", "ip"))
    rows.append(("next", "c", "m", 5.0, dt.datetime(2024, 1, 7, 1), 1.0, 1.0, "US", "X", "d1", "ip"))
    txns = spark.createDataFrame(rows, "transaction_id string, user_id string, merchant_id string, amount double, event_time timestamp, "
                                 "latitude double, longitude double, country_code string, city string, device_fingerprint string, ip_address string")
    labels = spark.createDataFrame([], "user_id string, fraud_time timestamp")
    got = {r.transaction_id: r for r in enrich.enrich_history(txns, behavioral.daily_profiles(txns), labels).collect()}
    for name, user, _, _, at, *_ in rows:
        # A profile is dated at the start of a day, and one dated at the row's instant is not before it.
        day = dt.datetime.combine((at - dt.timedelta(microseconds=1)).date(), dt.time())
        seen = sorted((r[4], r[0], r[3]) for r in rows if r[1] == user and user and day - dt.timedelta(days=30) <= r[4] < day)
        r = got[name]
        if not seen:
            assert r.avg_txn_amount_30d == r.amount_deviation_score == r.hour_of_day_risk_score == 0
            continue
        amounts = [s[2] for s in seen]
        mean = sum(amounts) / len(amounts)
        spread = statistics.stdev(amounts) if len(amounts) > 1 else 0
        assert r.avg_txn_amount_30d == pytest.approx(mean)
        assert r.amount_deviation_score == pytest.approx(abs(amounts[-1] - mean) / spread if spread else 0)
        assert r.hour_of_day_risk_score == pytest.approx(sum(s[0].hour < 6 for s in seen) / len(seen))


def test_plans_move_a_user_s_rows_a_few_times_only(txns):
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    assert plan(velocity.velocity_features(txns)).count("Exchange hash") <= 9
    assert plan(velocity.idle_reset_counters(txns)).count("Exchange hash") <= 12
    full = enrich.enrich_history(txns, behavioral.behavioral_features(txns), ev.fraud_labels(txns), ev.ip_reputation(txns))
    assert plan(full).count("Scan parquet") <= 20


def test_what_is_not_asked_for_moves_no_further(spark, dense):
    """Slices that don't ask are left out once they are summed up, and a day isn't moved once for each day it counts for."""
    asking = velocity.velocity_at(velocity.on_timeline(dense), VelocityConfig())._jdf.queryExecution().executedPlan().toString()
    # In the scan of the instants, and in the slices that are looked up.
    assert sum("Filter" in line and "_asks#" in line for line in asking.splitlines()) == 2
    days = behavioral.daily_profiles(dense)._jdf.queryExecution().executedPlan().toString()
    assert 0 <= days.index("Generate explode") < days.index("Exchange hashpartitioning(user_id")
