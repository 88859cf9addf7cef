"""Registered queries that run a stream over a whole table until its end."""

from __future__ import annotations

import datetime as dt
import time
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from risklake import schemas
from risklake.config import AGENTS, DEFAULT_MERCHANT_RISK, MERCHANT_RISK
from risklake.operators import behavioral, device, geo, scoring, velocity
from risklake.operators import feature_store as fs
from risklake.operators.velocity import COLUMNS
from risklake.plans.queries_decisions import decided_rows, histogram_sql
from risklake.plans.queries_features import GATED, PASSES, REASONS, enriched_rows, raw_rows
from risklake.plans.registry import register, rounded
from risklake.plans.sql_parts import DECIDING, SCORING, with_parts
from risklake.session import ROCKSDB_PROVIDER, scratch_path, stored
from risklake.sources import events as ev
from risklake.sources import lake, messages
from risklake.streaming import collector, counters, decision_sink, enricher, first_write, live, scorer, windows

_TO_THE_END = {"availableNow": True}
_ONE_BATCH = {"once": True}


def _finish(query: StreamingQuery) -> None:
    query.awaitTermination()


@register(
    "stream_velocity_windows",
    with_parts(
        """SELECT user_id, epoch_us(date_trunc('hour', event_time)) AS start_us, count(*) AS txn_count,
                  round(sum(amount), 4) AS amount_sum FROM txns
           GROUP BY user_id, date_trunc('hour', event_time)
           HAVING date_trunc('hour', event_time) + INTERVAL 1 HOUR
                  <= (SELECT max(event_time) FROM txns) - INTERVAL 10 MINUTE""",
        "txns",
    ),
)
def stream_velocity_windows(spark, sf_dir):
    """Windows are given out once the watermark has passed their end."""
    work = scratch_path(spark, "windows")
    txns = ev.as_transactions(ev.stream_events(spark, sf_dir))
    _finish(windows.start_velocity_windows(txns, f"{work}/out", f"{work}/checkpoint", _TO_THE_END))
    out = spark.read.parquet(f"{work}/out").select(
        "user_id", F.unix_micros("window_start").alias("start_us"), "txn_count", "amount_sum"
    )
    return rounded(out, 4, "amount_sum")


@register(
    "stream_window_values",
    with_parts(
        """SELECT user_id, epoch_us(date_trunc('hour', event_time)) AS start_us, epoch_us(date_trunc('hour', event_time) + INTERVAL 1 HOUR) AS end_us,
                  round(avg(amount), 6) AS avg_amount, max(amount) AS max_amount, min(amount) AS min_amount, true AS distinct_ok FROM txns
           GROUP BY user_id, date_trunc('hour', event_time)
           HAVING date_trunc('hour', event_time) + INTERVAL 1 HOUR <= (SELECT max(event_time) FROM txns) - INTERVAL 10 MINUTE""",
        "txns",
    ),
)
def stream_window_values(spark, sf_dir):
    """The windows' other columns; are the sketched distinct counts within 15 % (or 1) of the exact ones?"""
    work = scratch_path(spark, "window-values")
    txns = ev.as_transactions(ev.stream_events(spark, sf_dir))
    _finish(windows.start_velocity_windows(txns, f"{work}/out", f"{work}/checkpoint", _TO_THE_END))
    exact = windows.velocity_windows(ev.transactions(spark, sf_dir), exact=True).select(
        "user_id", "window_start", *[F.col(c).alias(f"_{c}") for c in ("unique_merchants", "unique_countries")]
    )
    both = spark.read.parquet(f"{work}/out").join(exact, ["user_id", "window_start"], "left")
    close = lambda c: F.abs(F.col(c) - F.col(f"_{c}")) <= F.greatest(F.lit(1.0), 0.15 * F.col(f"_{c}"))
    return rounded(both.select(
        "user_id", F.unix_micros("window_start").alias("start_us"), F.unix_micros("window_end").alias("end_us"),
        "avg_amount", "max_amount", "min_amount", (close("unique_merchants") & close("unique_countries")).alias("distinct_ok"),
    ), 6, "avg_amount")


@register(
    "stream_velocity_counters",
    with_parts(
        """SELECT transaction_id, txn_count_1h, round(amount_sum_1h, 4) AS amount_sum_1h, txn_count_24h,
                  round(amount_sum_24h, 4) AS amount_sum_24h, unique_merchants_1h FROM velocity""",
        "velocity",
    ),
)
def stream_velocity_counters(spark, sf_dir):
    """The trailing counters from keyed state; a micro-batch is never more than one file."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB_PROVIDER)
    work = scratch_path(spark, "counters")
    txns = ev.as_transactions(ev.stream_events(spark, sf_dir, max_files=1))
    _finish(
        counters.stream_velocity(txns).writeStream.format("parquet")
        .option("checkpointLocation", f"{work}/checkpoint").trigger(**_TO_THE_END).start(f"{work}/out")
    )
    out = spark.read.parquet(f"{work}/out").select("transaction_id", *COLUMNS)
    return rounded(out, 4, "amount_sum_1h", "amount_sum_24h")


@register(
    "stream_enricher",
    with_parts(
        "SELECT t.transaction_id, amount, coalesce(risk, "
        f"{DEFAULT_MERCHANT_RISK}) AS mcc_risk_score, CAST(0 AS BIGINT) AS txn_count_1h, false AS is_new_city "
        "FROM txns t LEFT JOIN (VALUES "
        + ", ".join(f"('{c}', CAST({r} AS DOUBLE))" for c, _, r in MERCHANT_RISK)
        + ") AS m(code, risk) ON m.code = t.merchant_category_code",
        "txns",
    ),
)
def stream_enricher(spark, sf_dir):
    """Messages -> gate -> bronze -> enrichment -> silver -> messages; the online store is new."""
    cfg = enricher.EnricherConfig(base=scratch_path(spark, "enricher"), trigger=_TO_THE_END)
    raw = messages.decode_json(
        ev.transaction_messages(ev.stream_events(spark, sf_dir)), schemas.TRANSACTION
    )
    _finish(enricher.start_enricher(raw, cfg))
    silver = spark.read.parquet(lake.layer(cfg.base, "silver_enriched"))
    return silver.select("transaction_id", "amount", "mcc_risk_score", "txn_count_1h", "is_new_city")


@register(
    "stream_layers",
    with_parts(
        f"""SELECT 'bronze' AS layer, transaction_id, user_id, paid AS amount, '' AS reasons {GATED} WHERE {PASSES}
            UNION ALL SELECT 'published', transaction_id, user_id, paid, '' {GATED} WHERE {PASSES}
            UNION ALL SELECT 'quarantine', transaction_id, user_id, paid, {REASONS} {GATED} WHERE NOT ({PASSES})""",
        "txns",
    ),
)
def stream_layers(spark, sf_dir):
    """Messages, some damaged, through the enrichment job: what it stored and published."""
    base = scratch_path(spark, "layers")
    sent = messages.to_messages(raw_rows(spark, sf_dir), "transaction_id", schemas.TRANSACTION.names)
    messages.publish(sent, f"{base}/topic", 0)
    cfg = enricher.EnricherConfig(base=base, trigger=_TO_THE_END)
    _finish(enricher.start_enricher(messages.read_transactions_stream(spark, f"{base}/topic"), cfg))
    out = spark.read.schema(messages.MESSAGE).option("recursiveFileLookup", "true").json(cfg.out_topic)
    found = {
        "bronze": spark.read.parquet(lake.layer(base, "bronze_transactions")).withColumn("reasons", F.lit("")),
        "published": messages.decode_json(out, schemas.ENRICHED_TRANSACTION).withColumn("reasons", F.lit("")),
        "quarantine": spark.read.parquet(lake.layer(base, "quarantine")).withColumn("reasons", F.array_join("reasons", ", ")),
    }
    tables = [
        df.select(F.lit(name).alias("layer"), "transaction_id", "user_id", F.col("amount").cast("double").alias("amount"), "reasons")
        for name, df in found.items()
    ]
    return reduce(DataFrame.unionByName, tables)


@register(
    "stream_decision_sink",
    with_parts(
        """SELECT decision_id, transaction_id, final_risk_score, action,
                  CASE WHEN final_risk_score >= 0.75 THEN 'high' WHEN final_risk_score >= 0.40
                  THEN 'medium' ELSE 'low' END AS risk_bucket FROM decisions""",
        "decisions",
    ),
)
def stream_decision_sink(spark, sf_dir):
    """Decisions are published as messages, and a stream keeps the gold table from them."""
    base = scratch_path(spark, "sink")
    made = decided_rows(spark, sf_dir).withColumn(
        "timestamp", F.date_format("event_time", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")
    )
    outgoing = messages.to_messages(made, "transaction_id", schemas.DECISION.names)
    messages.publish(outgoing, f"{base}/topic", 0)
    stream = messages.read_decisions_stream(spark, f"{base}/topic")
    _finish(decision_sink.start_decision_sink(stream, base, _TO_THE_END))
    return decision_sink.read_decisions(spark, base).select(
        "decision_id", "transaction_id", "final_risk_score", "action", "risk_bucket"
    )


@register(
    "stream_verdict_collection",
    with_parts(
        "SELECT transaction_id, final_risk_score, action, total_latency_ms FROM decisions "
        "WHERE CAST(substr(transaction_id, 5) AS BIGINT) % 7 <> 0",
        "decisions",
    ),
)
def stream_verdict_collection(spark, sf_dir):
    """Verdicts as messages, every fifth delivered twice, one missing for every seventh
    transaction; a stream gives out those that are complete."""
    return _decided_stream(spark, sf_dir, "verdicts").filter("complete").select(
        "transaction_id", "final_risk_score", "action", "total_latency_ms"
    )


def _decided_stream(spark, sf_dir, folder: str, closing: bool = False):
    """What ``stream_decide`` gives out. With ``closing``, a last verdict far behind all others
    lets the time of every open set run out; its own set stays open."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB_PROVIDER)
    work = scratch_path(spark, folder)
    number = F.substring("transaction_id", 5, 20).cast("long")
    verdicts = (
        scoring.with_verdicts(enriched_rows(spark, sf_dir), SCORING)
        .select("transaction_id", "event_time", F.inline_outer("verdicts"))
        .withColumn("timestamp", F.date_format("event_time", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"))
        .filter(~((number % 7 == 0) & (F.col("agent_type") == "network")))
    )
    copies = F.sequence(F.lit(1), F.when(number % 5 == 0, 2).otherwise(1))
    delivered = verdicts.withColumn("_copy", F.explode(copies))
    batches = [delivered]
    if closing:
        last = {"transaction_id": "closing", "agent_type": AGENTS[0], "risk_score": 0.0, "latency_ms": 0.0,
                "event_time": "2100-01-01T00:00:00Z", "timestamp": "2100-01-01T00:00:00.000000Z"}
        of = {f.name: f.dataType for f in delivered.schema}
        batches.append(spark.range(1).select(*(F.lit(last.get(c)).cast(t).alias(c) for c, t in of.items())))
    # The two deliveries of a verdict are at most the whole table apart.
    for k, batch in enumerate(batches):
        messages.publish(messages.to_messages(batch, "transaction_id", schemas.VERDICT.names), f"{work}/topic", k)
        stream = messages.read_verdicts_stream(spark, f"{work}/topic")
        decided = collector.stream_decide(stream, 1000, DECIDING, lateness="60 days", clock="event")
        _finish(
            decided.writeStream.format("parquet").option("checkpointLocation", f"{work}/checkpoint")
            .trigger(**_TO_THE_END).start(f"{work}/out")
        )
    return spark.read.parquet(f"{work}/out")


_HEARD = [a for a in AGENTS if a != "network"]
_TIMED_OUT = " + ".join(f"{a} * CAST({DECIDING.weights[a]} AS DOUBLE)" for a in _HEARD)
_HEARD_WEIGHTS = " + ".join(f"CAST({DECIDING.weights[a]} AS DOUBLE)" for a in _HEARD)


@register(
    "stream_verdict_timeouts",
    with_parts(
        f"""SELECT transaction_id, false AS complete, n_verdicts, final_risk_score,
                  CASE WHEN final_risk_score >= {DECIDING.decline_at} THEN 'decline'
                       WHEN final_risk_score >= {DECIDING.review_from} THEN 'review' ELSE 'approve' END AS action,
                  total_latency_ms
           FROM (SELECT transaction_id, round(least((CAST(0 AS DOUBLE) + {_TIMED_OUT}) / (CAST(0 AS DOUBLE) + {_HEARD_WEIGHTS}),
                        CAST(1 AS DOUBLE)), 4) AS final_risk_score
                 FROM scores WHERE CAST(substr(transaction_id, 5) AS BIGINT) % 7 = 0)
           JOIN (SELECT transaction_id, count(*) AS n_verdicts, sum(latency_ms) AS total_latency_ms FROM verdicts
                 WHERE agent_type <> 'network' GROUP BY transaction_id) USING (transaction_id)""",
        "scores", "verdicts",
    ),
)
def stream_verdict_timeouts(spark, sf_dir):
    """The same messages; the sets that stay incomplete, given out when their time has run out."""
    return _decided_stream(spark, sf_dir, "timeouts", closing=True).filter("NOT complete").select(
        "transaction_id", "complete", F.size("verdicts").cast("long").alias("n_verdicts"),
        "final_risk_score", "action", "total_latency_ms",
    )


_NUMBER = "CAST(substr(transaction_id, 5) AS BIGINT)"


@register(
    "stream_verdict_once",
    with_parts(
        f"""SELECT 'decided' AS kind, transaction_id, final_risk_score AS score, 4 AS n_verdicts FROM decisions WHERE {_NUMBER} % 7 <> 0
            UNION ALL
            SELECT 'timed out', transaction_id, round(least((CAST(0 AS DOUBLE) + {_TIMED_OUT}) / (CAST(0 AS DOUBLE) + {_HEARD_WEIGHTS}),
                   CAST(1 AS DOUBLE)), 4), 3 FROM scores WHERE {_NUMBER} % 7 = 0
            UNION ALL
            SELECT 'late', transaction_id, CAST(0.125 AS DOUBLE), 1 FROM txns WHERE {_NUMBER} % 14 = 0""",
        "decisions", "scores", "txns",
    ),
)
def stream_verdict_once(spark, sf_dir):
    """By the wall clock: every seventh transaction lacks a verdict and times out; for half of these it comes
    after all, and is told apart. Repeated and conflicting verdicts change nothing."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB_PROVIDER)
    base = scratch_path(spark, "once")
    number = F.substring("transaction_id", 5, 20).cast("long")
    # Read by all three deliveries; the features are computed once.
    verdicts = scoring.verdict_rows(stored(enriched_rows(spark, sf_dir), "enriched"), SCORING)
    missing = (number % 7 == 0) & (F.col("agent_type") == "network")
    heard = verdicts.filter(~missing)
    later = F.date_format(F.col("event_time") + F.expr("INTERVAL 1 SECOND"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")
    conflicting = heard.filter((number % 3 == 0) & (F.col("agent_type") == "velocity")).withColumns(
        {"risk_score": F.lit(0.0), "timestamp": later}
    )
    stragglers = verdicts.filter(missing & (number % 14 == 0)).withColumn("risk_score", F.lit(0.125))
    repeats = heard.filter(number % 5 == 0)
    for k, rows in enumerate([heard.unionByName(conflicting), repeats, stragglers.unionByName(repeats)]):
        if k == 1:
            time.sleep(1.5)  # longer than the collector waits
        messages.publish(messages.to_messages(rows, "transaction_id", schemas.VERDICT.names), f"{base}/topic", k)
        stream = messages.read_verdicts_stream(spark, f"{base}/topic")
        _finish(collector.start_collector(stream, base, 1000, DECIDING, trigger=_ONE_BATCH))
    sent = spark.read.schema(messages.MESSAGE).option("recursiveFileLookup", "true").json(lake.layer(base, "messages_decisions"))
    decided = messages.decode_json(sent, schemas.DECISION)
    # A decision tells the scores it rests on.
    heard_of = F.size(F.split(F.substring_index("reasoning", " | ", 1), ", "))
    late = spark.read.parquet(lake.layer(base, "late_verdicts"))
    return decided.select(
        F.when(heard_of == len(AGENTS), "decided").otherwise("timed out").alias("kind"), "transaction_id",
        F.col("final_risk_score").alias("score"), heard_of.alias("n_verdicts"),
    ).unionByName(late.select(F.lit("late").alias("kind"), "transaction_id", F.col("risk_score").alias("score"), F.lit(1).alias("n_verdicts")))


_STORED = dt.datetime(2024, 1, 30, 12, 0, 0)
_STORED_SQL = "TIMESTAMP '2024-01-30 12:00:00'"


def _newest_sql(key: str, source: str) -> str:
    return f"""SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY event_time DESC) AS r
               FROM {source} WHERE event_time <= {_STORED_SQL}) WHERE r = 1"""


def _held(column: str, table: str, days: int, zero: str = "0", single: bool = False) -> str:
    value = f"CAST(CAST({table}.{column} AS FLOAT) AS DOUBLE)" if single else f"{table}.{column}"
    return f"coalesce(CASE WHEN t.event_time - {table}.event_time <= INTERVAL {days} DAY THEN {value} END, {zero}) AS {column}"


_FROM_STORE = {
    "geo_held": (_newest_sql("user_id", "(SELECT user_id, event_time, geo.* FROM geo JOIN txns USING (transaction_id))"), ("geo", "txns")),
    "device_held": (
        _newest_sql("device_fingerprint", "(SELECT device_fingerprint, event_time, ip_fraud_score, device.* FROM device "
                    "JOIN txns USING (transaction_id) JOIN addresses USING (ip_address))"),
        ("device", "txns", "addresses"),
    ),
    "velocity_held": (_newest_sql("user_id", "velocity"), ("velocity",)),
    "behavior_held": (f"SELECT *, {_STORED_SQL} AS event_time FROM behavior", ("behavior",)),
    "enriched": (
        "SELECT t.* EXCLUDE (latency_ms), CAST(0 AS DOUBLE) AS latency_ms, " + ", ".join([
            _held("txn_count_1h", "v", 1), _held("txn_count_24h", "v", 1), _held("amount_sum_1h", "v", 1, single=True),
            _held("amount_sum_24h", "v", 1, single=True), _held("unique_merchants_1h", "v", 1),
            _held("avg_txn_amount_30d", "b", 30, single=True), _held("amount_deviation_score", "b", 30, single=True),
            _held("hour_of_day_risk_score", "b", 30, single=True), _held("distance_from_last_txn_km", "g", 7, single=True),
            _held("is_new_country", "g", 7, "false"), _held("is_new_city", "g", 7, "false"),
            _held("ip_fraud_score", "d", 7, single=True), _held("device_seen_before", "d", 7, "false"),
            _held("linked_fraud_accounts", "d", 7),
        ]) + """ FROM txns t LEFT JOIN velocity_held v ON v.user_id = t.user_id LEFT JOIN behavior_held b ON b.user_id = t.user_id
        LEFT JOIN geo_held g ON g.user_id = t.user_id LEFT JOIN device_held d ON d.device_fingerprint = t.device_fingerprint""",
        ("txns", "geo_held", "device_held", "velocity_held", "behavior_held"),
    ),
}


def _fill_store(spark, sf_dir, online: str) -> None:
    """All four views as of a moment, pushed to the stored online tables."""
    txns = ev.transactions(spark, sf_dir)
    dated = lambda df: df.withColumnRenamed("event_time", "event_timestamp").filter(F.col("event_timestamp") <= F.lit(_STORED))
    profile = behavioral.behavioral_features(txns).withColumn("event_timestamp", F.lit(_STORED))
    by_device = device.device_features(txns, ev.fraud_labels(txns), ev.ip_reputation(txns))
    fs.push(fs.USER_TRANSACTION_STATS, dated(velocity.velocity_features(txns)), online, 0)
    fs.push(fs.USER_BEHAVIORAL_STATS, profile, online, 0)
    fs.push(fs.GEO_STATS, dated(geo.geo_features(txns)), online, 0)
    fs.push(fs.DEVICE_NETWORK_STATS, dated(by_device), online, 0)


@register(
    "stream_chain",
    with_parts(
        """SELECT decision_id, transaction_id, final_risk_score, action, CAST(CAST(event_time AS DATE) AS STRING) AS decision_date
           FROM decisions""",
        "decisions", instead=_FROM_STORE,
    ),
)
def stream_chain(spark, sf_dir):
    """Four streams joined by message folders: transactions, some delivered twice at once and some again later, are
    enriched from a filled store, scored, decided and kept in gold."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB_PROVIDER)
    base = scratch_path(spark, "chain")
    _fill_store(spark, sf_dir, lake.layer(base, "online"))
    sent = ev.transaction_messages(spark.read.parquet(ev.events_path(sf_dir)))
    number = F.substring("key", 5, 20).cast("long")
    copies = F.sequence(F.lit(1), F.when(number % 5 == 0, 2).otherwise(1))
    deliveries = [sent.withColumn("_copy", F.explode(copies)).drop("_copy"), sent.filter(number % 7 == 0)]
    cfg = enricher.EnricherConfig(base=base, trigger=_TO_THE_END)
    for k, rows in enumerate(deliveries):
        messages.publish(rows, f"{base}/topic", k)
        _finish(enricher.start_enricher(messages.read_transactions_stream(spark, f"{base}/topic"), cfg))
    _finish(scorer.start_scorer(scorer.read_enriched_stream(spark, cfg.out_topic), base, SCORING, _TO_THE_END))
    heard = messages.read_verdicts_stream(spark, lake.layer(base, "messages_verdicts"))
    _finish(collector.start_collector(heard, base, cfg=DECIDING, trigger=_ONE_BATCH))
    decided = messages.read_decisions_stream(spark, lake.layer(base, "messages_decisions"))
    _finish(decision_sink.start_decision_sink(decided, base, _TO_THE_END))
    return decision_sink.read_decisions(spark, base).select(
        "decision_id", "transaction_id", "final_risk_score", "action", F.col("decision_date").cast("string").alias("decision_date")
    )


def _live(spark, sf_dir, table: str) -> DataFrame:
    """The live table after verdicts have come in three micro-batches and a restart."""
    base = scratch_path(spark, "live")
    # Read by all three deliveries; the features are computed once.
    verdicts = scoring.verdict_rows(stored(enriched_rows(spark, sf_dir), "enriched"), SCORING)
    number = F.substring("transaction_id", 5, 20).cast("long")
    for k, part in enumerate([number % 3 == 0, number % 3 == 1, number % 3 == 2]):
        messages.publish(messages.to_messages(verdicts.filter(part), "transaction_id", schemas.VERDICT.names), f"{base}/topic", k)
        stream = messages.read_verdicts_stream(spark, f"{base}/topic")
        for query in live.start_live(stream, base, [table], _TO_THE_END):
            _finish(query)
    return live.read_live(spark, base, table)


@register(
    "live_verdict_counters",
    with_parts(
        """SELECT agent_type, risk_level, count(*) AS processed, count(*) FILTER (risk_score >= 0.5) AS flagged
           FROM verdicts GROUP BY agent_type, risk_level""",
        "verdicts",
    ),
)
def live_verdict_counters(spark, sf_dir):
    return _live(spark, sf_dir, "verdict_counters")


@register("live_latency_histogram", with_parts(histogram_sql("verdicts"), "verdicts"))
def live_latency_histogram(spark, sf_dir):
    return rounded(_live(spark, sf_dir, "latency_histogram"), 6, "sum_seconds")


_PAIR = "user_id || '/' || merchant_id"


@register(
    "stream_first_writes",
    with_parts(
        f"""SELECT pair, event_id, amount FROM (
              SELECT {_PAIR} AS pair, event_id, amount, row_number() OVER (PARTITION BY {_PAIR} ORDER BY k >= 30, event_id) AS r FROM txns)
            WHERE r = 1""",
        "txns",
    ),
)
def stream_first_writes(spark, sf_dir):
    """Rows of some pairs are stored already; a stream adds the others, first row wins, through a restart and with
    everything delivered again."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB_PROVIDER)
    base = scratch_path(spark, "first")
    rows = ev.transactions(spark, sf_dir).select(F.concat_ws("/", "user_id", "merchant_id").alias("pair"), "event_id", "amount", "k")
    table, schema = f"{base}/table", "pair string, event_id long, amount double"
    lake.insert_new(rows.filter("k < 30").drop("k"), table, "pair", 3, ["event_id"])
    for k, delivered in enumerate([rows.filter("k >= 30"), rows]):
        messages.publish(messages.to_messages(delivered, "pair", ["pair", "event_id", "amount"]), f"{base}/topic", k)
        said = messages.read_messages_stream(spark, f"{base}/topic").select(F.from_json("value", schema).alias("r")).select("r.*")
        _finish(first_write.start_first_writes(said, table, "pair", ["event_id"], f"{base}/checkpoint", _TO_THE_END))
    return spark.read.parquet(table).drop("batch_id")
