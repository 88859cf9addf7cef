"""Gates, lake tables, feature store, roll-ups and jobs."""

from __future__ import annotations

import datetime as dt
import math

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from risklake.functions.ranking import exact_percentile, exact_quartile
from risklake.operators import analytics, decisions, enrich, quality, scoring
from risklake.operators import feature_store as fs
from risklake.plans import jobs
from risklake.plans.queries_features import enriched_rows
from risklake.plans.sql_parts import DECIDING, SCORING
from risklake.sources import lake, messages, snapshots
from risklake.streaming.decision_sink import process_decisions, read_decisions
from tests.conftest import SF_DIR

T0 = dt.datetime(2024, 1, 20, 12)


def rows_of(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=str)


# --- gates ---


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(
        st.tuples(
            st.sampled_from(["t", None]), st.sampled_from(["u", None]),
            st.sampled_from(["1.5", "0", "-1", "abc", "", None, "1e3", "NaN"]),
            st.sampled_from(["2024-01-01T00:00:00Z", "2024-01-01 10:00:00", "nope", "", None]),
        ),
        max_size=12,
    )
)
def test_every_row_is_either_good_or_bad(spark, rows):
    df = spark.createDataFrame(rows, "transaction_id string, user_id string, amount string, timestamp string")
    good, bad = quality.split_valid(quality.normalise(df))
    assert good.count() + bad.count() == len(rows)
    assert bad.filter("size(reasons) = 0").count() == 0
    assert good.filter("transaction_id is null or user_id is null or event_time is null or not amount > 0").count() == 0


def test_filters_and_volume(spark, txns):
    mixed = spark.createDataFrame(
        [("velocity", None), ("supervisor", 0.5), (None, 0.4), ("other", None)], "agent_type string, final_risk_score double"
    )
    assert quality.only_decisions(mixed).count() == 2 and quality.only_verdicts(mixed).count() == 1
    dated = lake.with_date_partition(txns)
    assert quality.has_min_rows(dated, dt.date(2024, 1, 2), 5)
    assert not quality.has_min_rows(dated, dt.date(2024, 1, 2), 100_000)


def test_contract(spark):
    df = spark.createDataFrame([("USDX", "4242424", 1.2), ("USD", None, 0.5)], "currency string, card_bin string, risk_score double")
    got = [r["violations"] for r in quality.validate_contract(df).collect()]
    assert got == [["currency longer than 3", "card_bin longer than 6", "risk_score outside 0..1"], []]


# --- tables ---


def test_upsert_keeps_last_and_survives_replay(spark, tmp_path):
    path = str(tmp_path / "t")
    schema = "k string, v int, m map<string,string>"
    lake.upsert(spark.createDataFrame([("a", 1, {"x": "1"}), ("b", 1, None)], schema), path, 0)
    second = spark.createDataFrame([("a", 2, None), ("c", 2, None)], schema)
    for _ in range(2):
        lake.upsert(second, path, 1)
    assert rows_of(lake.read_current(spark, path, "k"), "k", "v") == [("a", 2), ("b", 1), ("c", 2)]
    history = lake.read_versions(spark, path).withColumn("event_time", F.lit(T0))
    assert [(r["batch_id"], r["rows"]) for r in lake.batch_history(history).collect()] == [(1, 2), (0, 2)]
    assert lake.table_exists(spark, path) and not lake.table_exists(spark, path + "x")


def test_a_hundred_batches_are_folded(spark, tmp_path):
    path = str(tmp_path / "t")
    schema = "k int, v int"
    for batch in range(100):
        lake.upsert(spark.createDataFrame([(batch % 7, batch), (100 + batch, batch)], schema).coalesce(1), path, batch)
    want = rows_of(lake.read_current(spark, path, "k"), "k", "v")
    assert len(lake.read_versions(spark, path).inputFiles()) == 100
    assert snapshots.fold(spark, path, "k", keep=2, files=4) == 97
    read = lake.read_current(spark, path, "k")
    assert rows_of(read, "k", "v") == want and len(lake.read_versions(spark, path).inputFiles()) <= 4 + 2
    # A batch that was taken in comes again; new ones follow; the next fold removes what the first one took.
    lake.upsert(spark.createDataFrame([(3, -1)], schema), path, 50)
    assert rows_of(lake.read_current(spark, path, "k"), "k", "v") == want
    lake.upsert(spark.createDataFrame([(3, 1000)], schema), path, 100)
    assert snapshots.fold(spark, path, "k", keep=1, files=4) == 99
    assert snapshots.fold(spark, path, "k", keep=1) is None
    assert len(snapshots.matching(spark, path, "batch_id=*")) == 3
    want = [r for r in want if r[0] != 3] + [(3, 1000)]
    assert rows_of(lake.read_current(spark, path, "k"), "k", "v") == sorted(want, key=str)
    # A fold that failed halfway has no mark, and is not read.
    spark.createDataFrame([(3, -5, 7)], schema + ", batch_id long").write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(path + "/_snapshot/upto=100")
    assert rows_of(lake.read_current(spark, path, "k"), "k", "v") == sorted(want, key=str)


def test_gold_and_online_tables_are_folded(spark, tmp_path):
    base, view = str(tmp_path), fs.USER_TRANSACTION_STATS
    online = lake.layer(base, "online")
    for batch in range(5):
        at = T0 + dt.timedelta(days=batch % 3)
        made = spark.createDataFrame([(f"d{batch % 2}", 0.1 * batch, T0), (f"e{batch}", 0.9, at)], "decision_id string, final_risk_score double, event_time timestamp")
        process_decisions(made, batch, base)
        pushed = [("a", T0 - dt.timedelta(hours=batch), batch), (f"u{batch}", T0, batch), ("tie", T0, 10 - batch)]
        fs.push(view, spark.createDataFrame(pushed, "user_id string, event_timestamp timestamp, txn_count_1h long"), online, batch)
    gold = rows_of(read_decisions(spark, base), "decision_id", "final_risk_score", "decision_date")
    stats = rows_of(fs.read_online(view, spark, online), "user_id", "txn_count_1h")
    assert jobs.fold_tables(spark, base) == {"gold_decisions": 2, "user_transaction_stats": 2}
    assert rows_of(read_decisions(spark, base), "decision_id", "final_risk_score", "decision_date") == gold
    assert rows_of(fs.read_online(view, spark, online), "user_id", "txn_count_1h") == stats and ("tie", 10) in stats
    wanted = spark.createDataFrame([("a",), ("a",), ("nobody",), (None,)], "user_id string")
    assert rows_of(fs.read_online(view, spark, online, wanted), "user_id", "txn_count_1h") == [("a", 0)]
    recent = jobs.recent_decisions(spark, base, dt.date(2024, 1, 22), 1)
    plan = recent._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(decision_date" in plan and rows_of(recent, "decision_id") == [("e1",), ("e2",), ("e4",)]


def test_materialize_goes_on_where_it_stopped(spark, tmp_path, monkeypatch):
    base, view, hour = str(tmp_path), fs.USER_TRANSACTION_STATS, dt.timedelta(hours=1)
    row = lambda user, at, n: (user, T0 + at * hour, n)
    frame = lambda rows: spark.createDataFrame(rows, "user_id string, event_timestamp timestamp, txn_count_1h long")
    first = [row("a", 0, 1), row("a", 1, 2), row("b", 1, 3), row("late", -30, 4), row("c", 9, 5)]
    assert fs.materialize_until(view, frame(first), base, T0 + 2 * hour, 12 * hour) == 0
    state = lambda: rows_of(fs.read_online(view, spark, base), "user_id", "txn_count_1h")
    assert state() == [("a", 2), ("b", 3), ("late", 4)]
    # "b" has a row that came late; the one of "d" is older than late rows may be.
    second = first + [row("b", 1.5, 6), row("d", -40, 7), row("a", 5, 8)]
    crash = lambda *_: (_ for _ in ()).throw(RuntimeError("lost"))
    with monkeypatch.context() as broken:
        broken.setattr(fs, "_remember", crash)
        with pytest.raises(RuntimeError):
            fs.materialize_until(view, frame(second), base, T0 + 6 * hour, 12 * hour)
    after_crash = state()
    assert fs.materialize_until(view, frame(second), base, T0 + 6 * hour, 12 * hour) == 1
    assert state() == after_crash == [("a", 8), ("b", 6), ("late", 4)]
    assert fs.materialize_until(view, frame(second), base, T0 + 10 * hour, 12 * hour) == 2
    assert state() == [("a", 8), ("b", 6), ("c", 5), ("late", 4)]


def test_merged_sketches_stay_within_their_error(spark):
    rows = spark.range(40_000).select(
        F.timestamp_seconds(F.lit(1_700_000_000) + (F.col("id") % 10) * 86_400).alias("event_time"),
        F.when(F.col("id") % 7 == 0, "decline").otherwise("approve").alias("action"), F.lit(0.5).alias("final_risk_score"),
        F.pmod(F.xxhash64("id"), F.lit(100_000)).cast("double").alias("total_latency_ms"), (F.col("id") % 3001).cast("string").alias("user_id"),
    )
    stored = analytics.daily_sketches(rows).cache()
    found = {r.period_end: r for r in analytics.rolling_kpis(stored, 7).collect()}
    assert len(found) == 10 and max(len(bytes(r.latency_sketch)) for r in stored.collect()) < 40_000
    day = F.to_date("event_time")
    for end, r in found.items():
        inside = rows.where((day <= F.lit(end)) & (day > F.lit(end) - F.expr("INTERVAL 7 DAYS")))
        n, below, users = inside.agg(F.count("*"), F.count_if(F.col("total_latency_ms") <= r.p95_latency_ms), F.count_distinct("user_id")).first()
        assert r.total_decisions == n and abs(below / n - 0.95) < 0.01 and abs(r.distinct_users / users - 1) < 0.05
    stored.unpersist()
    assert analytics.rolling_kpis(analytics.daily_sketches(rows.limit(0))).collect() == []


def test_insert_new_keeps_first(spark, tmp_path):
    path = str(tmp_path / "t")
    schema = "k string, v int"
    lake.insert_new(spark.createDataFrame([("a", 2), ("a", 1)], schema), path, "k", 0, ["v"])
    for _ in range(2):
        lake.insert_new(spark.createDataFrame([("a", 9), ("b", 5), ("b", 4)], schema), path, "k", 1, ["v"])
    assert rows_of(spark.read.parquet(path), "k", "v") == [("a", 1), ("b", 4)]


def test_overwrite_changes_schema_and_compact_splits_equal_keys(spark, tmp_path):
    path = str(tmp_path / "t")
    lake.overwrite_table(spark.range(10).withColumn("u", F.lit("same")), path)
    lake.overwrite_table(spark.range(1000).select(F.lit("hot").alias("user_id"), F.col("id").alias("n")), path)
    lake.compact(spark, path, ["user_id"], path + "_new", files=4)
    new = spark.read.parquet(path + "_new")
    assert new.columns == ["user_id", "n"] and new.count() == 1000 and new.agg(F.sum("n")).first()[0] == 499500
    sizes = [r["count"] for r in new.groupBy(F.input_file_name()).count().collect()]
    assert len(sizes) == 4 and max(sizes) < 600
    lake.backfill(new, path + "_b", ["user_id"])
    assert spark.read.parquet(path + "_b").count() == 1000


def test_load_since_prunes_partitions(spark, tmp_path, txns):
    path = str(tmp_path / "silver")
    lake.backfill(lake.with_date_partition(txns), path, ["date_partition"])
    recent = lake.load_since(spark, path, "date_partition", dt.date(2024, 1, 31), 7)
    plan = recent._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date_partition" in plan
    assert recent.count() == txns.filter(F.to_date("event_time") >= F.lit(dt.date(2024, 1, 24))).count() > 0


def test_status_export_messages(spark, tmp_path):
    status = lake.lake_status({"bronze": spark.range(3), "gold": spark.range(0)})
    assert rows_of(status, "layer", "rows") == [("bronze", 3), ("gold", 0)]
    df = spark.createDataFrame([("u", 1.5)], "user_id string, amount double")
    assert messages.select_existing(df, ["nope", "amount"]).columns == ["amount"]
    assert messages.to_messages(df, "user_id", ["amount", "nope"]).first().asDict() == {"key": "u", "value": '{"amount":1.5}'}
    lake.export_offline_features(df, str(tmp_path / "x"), ["user_id"])
    assert any(f.name.endswith(".snappy.parquet") for f in (tmp_path / "x").iterdir())


# --- feature store ---


def test_push_and_online_read(spark, tmp_path):
    base, view = str(tmp_path), fs.USER_TRANSACTION_STATS
    assert fs.read_online(view, spark, base).count() == 0

    def rows(*values):
        return spark.createDataFrame(values, "user_id string, event_timestamp timestamp, txn_count_1h long")

    fs.push(view, rows(("a", T0, 1), ("a", T0 + dt.timedelta(hours=1), 2), ("b", T0, 7)), base, 0)
    # A late push does not undo a newer value.
    fs.push(view, rows(("a", T0 - dt.timedelta(hours=5), 0), ("b", T0 + dt.timedelta(hours=2), 8)), base, 1)
    assert rows_of(fs.read_online(view, spark, base), "user_id", "txn_count_1h") == [("a", 2), ("b", 8)]
    out = fs.materialize(view, view.conform(rows(("a", T0, 1), ("a", T0 + dt.timedelta(days=1), 2))), T0, T0 + dt.timedelta(days=1))
    assert rows_of(out, "user_id", "txn_count_1h") == [("a", 2)]


def test_enrich_fills_defaults(spark):
    txns = spark.createDataFrame([("t", "u", "d", T0)], "transaction_id string, user_id string, device_fingerprint string, event_time timestamp")
    row = enrich.enrich(txns, {}).first()
    assert (row["txn_count_1h"], row["amount_sum_24h"], row["is_new_city"], row["ip_fraud_score"]) == (0, 0.0, False, 0.0)


# --- ranks and percentiles ---


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from("ab"), st.floats(0, 5, width=32)), min_size=1, max_size=60), st.sampled_from([0.05, 0.5, 0.95, 1.0]))
def test_exact_percentile(spark, rows, p):
    df = spark.createDataFrame(rows, "g string, v double")
    counted = df.groupBy("g", "v").agg(F.count(F.lit(1)).alias("n"))
    got = {r["g"]: r["q"] for r in exact_percentile(counted, "g", "v", "n", p, "q").collect()}
    for g in {g for g, _ in rows}:
        values = sorted(v for h, v in rows if h == g)
        assert got[g] == values[math.ceil(p * len(values)) - 1]


@pytest.mark.parametrize("n", [1, 3, 4, 103])
def test_exact_quartile_is_ntile(spark, n):
    df = spark.range(n).select(F.col("id"), (F.col("id") * 7 % 5).alias("score"))
    got = {r["id"]: r["q"] for r in exact_quartile(df, [F.col("score").desc(), F.col("id")], "q").collect()}
    from pyspark.sql import Window

    w = Window.partitionBy(F.lit(0)).orderBy(F.col("score").desc(), "id")
    assert got == {r["id"]: r["q"] for r in df.withColumn("q", F.ntile(4).over(w)).collect()}


# --- roll-ups ---


def test_rollups_do_not_fan_out(spark):
    made = spark.createDataFrame(
        [("t1", "decline", 0.9, 300.0, T0), ("t2", "approve", 0.1, 50.0, T0), ("t3", "review", 0.5, 200.0, T0)],
        "transaction_id string, action string, final_risk_score double, total_latency_ms double, event_time timestamp",
    )
    seen = spark.createDataFrame([("t1", "US", "7995"), ("t1", "US", "7995"), ("t2", "US", None)], "transaction_id string, country_code string, merchant_category_code string")
    assert [tuple(r)[:3] for r in analytics.fraud_by_country(made, seen).collect()] == [("US", 2, 1), (None, 1, 0)]
    assert [tuple(r)[:3] for r in analytics.fraud_by_mcc(made, seen).collect()] == [("7995", 1, 1)]
    kpi, exact = analytics.daily_kpis(made).first(), analytics.daily_kpis(made, exact_p95=True).first()
    assert kpi.asDict() == exact.asDict()
    assert (kpi["sla_breaches"], kpi["p95_latency_ms"], kpi["fraud_rate"]) == (1, 300.0, pytest.approx(1 / 3))
    bars = {r["le"]: r["cumulative"] for r in analytics.latency_histogram(made, "total_latency_ms").collect()}
    assert (bars["0.05"], bars["0.2"], bars["0.5"], bars["+Inf"]) == (1, 2, 3, 3)


# --- jobs ---


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """A lake with silver and gold of the small table."""
    base = str(tmp_path_factory.mktemp("lake"))
    enriched = enriched_rows(spark, SF_DIR)
    lake.write_silver(enriched, base, 0)
    silver = spark.read.parquet(lake.layer(base, "silver_enriched"))
    process_decisions(decisions.decide(scoring.with_verdicts(silver, SCORING), DECIDING), 0, base)
    return base


def test_feature_job(spark, stored):
    as_of = dt.datetime(2024, 1, 30, 12)
    assert not jobs.compute_features(spark, stored, as_of, 0, min_rows=10**6)
    assert jobs.compute_features(spark, stored, as_of, 0, min_rows=5, files=2)
    online = fs.read_online(fs.USER_BEHAVIORAL_STATS, spark, lake.layer(stored, "online"))
    table = spark.read.parquet(lake.layer(stored, "silver_behavioral_features"))
    assert online.count() == table.count() == 15
    assert spark.read.parquet(f"{stored}/offline/user_behavioral_stats").columns == list(lake.EXPORT_COLUMNS)


def test_analytics_job(spark, stored):
    paths = jobs.compute_analytics(spark, stored, dt.date(2024, 1, 31), days=31)
    jobs.cluster_analytics(spark, stored)
    assert [p.rsplit("/", 1)[1] for p in paths] == list(jobs.ROLLUP_CLUSTERS)
    by_country = spark.read.parquet(f"{paths[0]}_clustered")
    assert by_country.agg(F.sum("total_decisions")).first()[0] == read_decisions(spark, stored).count() == 1000


def test_daily_job_reads_recent_dates_only(spark, tmp_path):
    """The date filter reaches the scan of the decision table."""
    rows = [(f"d{i}", 0.5, dt.datetime(2024, 1, i), dt.date(2024, 1, i)) for i in range(1, 20)]
    df = spark.createDataFrame(rows, "decision_id string, final_risk_score double, event_time timestamp, decision_date date")
    base = str(tmp_path)
    for batch in (0, 1):
        lake.upsert(df.withColumn("final_risk_score", F.lit(float(batch))), lake.layer(base, "gold_decisions"), batch, partition_by=["decision_date"])
    made = jobs.recent_decisions(spark, base, dt.date(2024, 1, 19), 3)
    scan = next(x for x in made._jdf.queryExecution().toString().splitlines() if "FileScan" in x)
    assert "decision_date" in scan.split("PartitionFilters: [")[1].split("]")[0]
    assert sorted((r["decision_id"], r["final_risk_score"]) for r in made.collect()) == [(f"d{i}", 1.0) for i in range(16, 20)]
