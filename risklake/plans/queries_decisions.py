"""Registered queries: scoring, decisions, roll-ups, tables and training."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from risklake import schemas
from risklake.config import AGENTS, LATENCY_BOUNDS_S, TrainingConfig
from risklake.operators import analytics, behavioral, decisions, enrich, quality, scoring, training
from risklake.plans import jobs
from risklake.plans.queries_features import enriched_rows
from risklake.plans.registry import register, rounded
from risklake.plans.sql_parts import DECIDING, SCORING, with_parts
from risklake.session import cut_lineage, scratch_path, stored
from risklake.sources import events as ev
from risklake.sources import lake, messages
from risklake.streaming import decision_sink
from risklake.streaming.windows import velocity_windows

# --- scoring ---------------------------------------------------------------------------

_VERDICT = "transaction_id, agent_type, risk_score, risk_level, confidence, reasoning, latency_ms"


def _score_query(agent: str, score):
    @register(f"score_{agent}", with_parts(f"SELECT {_VERDICT} FROM score_{agent}", f"score_{agent}"))
    def query(spark, sf_dir):
        return score(enriched_rows(spark, sf_dir), SCORING).drop("features_used")

    return query


for _agent, _score in (
    ("velocity", scoring.score_velocity),
    ("geolocation", scoring.score_geolocation),
    ("behavioral", scoring.score_behavioral),
    ("network", scoring.score_network),
):
    _score_query(_agent, _score)


@register("score_all", with_parts(f"SELECT {_VERDICT} FROM verdicts", "verdicts"))
def score_all(spark, sf_dir):
    return scoring.score_all(enriched_rows(spark, sf_dir), SCORING).drop("features_used")


@register(
    "verdict_counters",
    with_parts(
        """SELECT agent_type, risk_level, count(*) AS processed, count(*) FILTER (risk_score >= 0.5) AS flagged
           FROM verdicts GROUP BY agent_type, risk_level""",
        "verdicts",
    ),
)
def verdict_counters(spark, sf_dir):
    return analytics.verdict_counters(scoring.score_all(enriched_rows(spark, sf_dir), SCORING))


def histogram_sql(source: str) -> str:
    rows = " UNION ALL ".join(
        f"SELECT agent_type, '{b}' AS le, count(*) FILTER (latency_ms / 1000.0 <= {b}) AS cumulative, "
        f"count(*) AS observations, round(sum(latency_ms / 1000.0), 6) AS sum_seconds "
        f"FROM {source} GROUP BY agent_type"
        for b in LATENCY_BOUNDS_S
    )
    return rows + (
        f" UNION ALL SELECT agent_type, '+Inf', count(*), count(*), round(sum(latency_ms / 1000.0), 6) "
        f"FROM {source} GROUP BY agent_type"
    )


@register("latency_histogram", with_parts(histogram_sql("verdicts"), "verdicts"))
def latency_histogram(spark, sf_dir):
    verdicts = scoring.score_all(enriched_rows(spark, sf_dir), SCORING)
    return rounded(analytics.latency_histogram(verdicts, "latency_ms", ["agent_type"]), 6, "sum_seconds")


# --- decisions -------------------------------------------------------------------------


def decided_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decisions.decide_enriched(enriched_rows(spark, sf_dir), SCORING, DECIDING)


@register(
    "decisions",
    with_parts(
        """SELECT decision_id, transaction_id, final_risk_score, risk_level, action, reasoning, total_latency_ms
           FROM decisions""",
        "decisions",
    ),
)
def decision_rows(spark, sf_dir):
    return decided_rows(spark, sf_dir).select(
        "decision_id", "transaction_id", "final_risk_score", "risk_level", "action", "reasoning",
        "total_latency_ms",
    )


@register(
    "collected_decisions",
    with_parts("SELECT transaction_id, final_risk_score, action, total_latency_ms FROM decisions "
               "WHERE hash_drop <> 0".replace("hash_drop", "CAST(substr(transaction_id, 5) AS BIGINT) % 7"),
               "decisions"),
)
def collected_decisions(spark, sf_dir):
    """Verdicts as separate rows: every seventh transaction lacks one; some come three times,
    the later ones with another score."""
    verdicts = scoring.score_all(enriched_rows(spark, sf_dir), SCORING)
    number = F.substring("transaction_id", 5, 20).cast("long")
    arrived = verdicts.filter(~((number % 7 == 0) & (F.col("agent_type") == "network")))
    copies = F.when((number % 5 == 0) & (F.col("agent_type") == "velocity"), 3).otherwise(1)
    delivered = arrived.withColumn("_copy", F.explode(F.sequence(F.lit(1), copies)))
    said = F.when(F.col("_copy") == 1, F.col("risk_score")).otherwise(0.0)
    out = decisions.decide(decisions.collect_verdicts(delivered.withColumn("risk_score", said), "_copy"), DECIDING)
    return out.select("transaction_id", "final_risk_score", "action", "total_latency_ms")


@register(
    "recent_decisions",
    with_parts(
        """SELECT decision_id, CASE WHEN CAST(substr(transaction_id, 5) AS BIGINT) % 3 = 0 THEN CAST(0 AS DOUBLE)
                  ELSE final_risk_score END AS final_risk_score, CAST(CAST(event_time AS DATE) AS STRING) AS decision_date
           FROM decisions WHERE CAST(event_time AS DATE) >= DATE '2024-01-13'""",
        "decisions",
    ),
)
def recent_decisions(spark, sf_dir):
    """Gold decisions of many days in two versions, read the way the daily job does."""
    base = scratch_path(spark, "gold")
    made = decisions.with_decision_columns(decided_rows(spark, sf_dir)).select(
        "decision_id", "transaction_id", "final_risk_score", "event_time", "decision_date"
    )
    gold = lake.layer(base, "gold_decisions")
    lake.upsert(made.withColumn("final_risk_score", F.lit(0.0)), gold, 0, partition_by=["decision_date"])
    number = F.substring("transaction_id", 5, 20).cast("long")
    lake.upsert(made.filter(number % 3 != 0), gold, 1, partition_by=["decision_date"])
    current = jobs.recent_decisions(spark, base, dt.date(2024, 1, 20), 7)
    return current.select("decision_id", "final_risk_score", F.col("decision_date").cast("string").alias("decision_date"))


@register(
    "needs_explanation",
    with_parts(
        "SELECT transaction_id, round(mean_score, 4) AS mean_score FROM decisions WHERE needs_explanation",
        "decisions",
    ),
)
def needs_explanation(spark, sf_dir):
    rows = decided_rows(spark, sf_dir).filter("needs_explanation")
    return rows.select(
        "transaction_id", F.round(decisions.mean_score(F.col("verdicts")), 4).alias("mean_score")
    )


@register(
    "explanation_requests",
    with_parts(
        f"""SELECT d.transaction_id, CAST(count(*) AS BIGINT) AS signals,
                   string_agg(v.agent_type || '=' || v.reasoning, '|' ORDER BY list_position({list(AGENTS)}, v.agent_type)) AS said
            FROM decisions d JOIN verdicts v ON v.transaction_id = d.transaction_id
            WHERE d.needs_explanation GROUP BY d.transaction_id""",
        "decisions", "verdicts",
    ),
)
def explanation_requests(spark, sf_dir):
    """The JSON payload is read back, so that engines' number formats do not matter."""
    with_verdicts = scoring.with_verdicts(enriched_rows(spark, sf_dir), SCORING)
    requests = decisions.explanation_requests(with_verdicts, DECIDING)
    body = F.from_json(
        "request", "agent_signals array<struct<agent:string,score:double,reasoning:string>>, weighted_score double"
    )
    said = F.array_join(
        F.transform(F.col("body.agent_signals"), lambda s: F.concat(s["agent"], F.lit("="), s["reasoning"])), "|"
    )
    return requests.withColumn("body", body).select(
        "transaction_id", F.size("body.agent_signals").cast("long").alias("signals"), said.alias("said")
    )


@register(
    "mixed_topic",
    with_parts(
        """SELECT 'decision' AS kind, transaction_id, final_risk_score AS score, action AS said FROM decisions
           UNION ALL SELECT 'verdict', transaction_id, risk_score, agent_type FROM verdicts""",
        "decisions", "verdicts",
    ),
)
def mixed_topic(spark, sf_dir):
    """Decisions, verdicts, and verdicts of kinds that nobody collects, all on one topic; each reader takes its own."""
    # The topic's three kinds of messages and its two readers share the features.
    enriched = stored(enriched_rows(spark, sf_dir), "enriched")
    verdicts = scoring.verdict_rows(enriched, SCORING)
    number = F.substring("transaction_id", 5, 20).cast("long")
    others = verdicts.filter(number % 3 == 0).withColumn("agent_type", F.when(number % 2 == 0, "supervisor").otherwise("unheard of"))
    sent = messages.to_messages(verdicts.unionByName(others), "transaction_id", schemas.VERDICT.names).unionByName(
        messages.to_messages(decisions.decide_enriched(enriched, SCORING, DECIDING), "transaction_id", schemas.DECISION.names)
    )
    both = T.StructType([*schemas.VERDICT.fields, *[f for f in schemas.DECISION.fields if f.name not in schemas.VERDICT.names]])
    heard = messages.decode_json(sent, both)
    told = quality.only_decisions(heard).select(F.lit("decision").alias("kind"), "transaction_id", F.col("final_risk_score").alias("score"), F.col("action").alias("said"))
    return told.unionByName(quality.only_verdicts(heard).select(
        F.lit("verdict").alias("kind"), "transaction_id", F.col("risk_score").alias("score"), F.col("agent_type").alias("said")
    ))


@register(
    "decision_columns",
    with_parts(
        """SELECT transaction_id, CASE WHEN final_risk_score >= 0.75 THEN 'high' WHEN final_risk_score >= 0.40
                  THEN 'medium' ELSE 'low' END AS risk_bucket, CAST(CAST(event_time AS DATE) AS STRING) AS decision_date
           FROM decisions""",
        "decisions",
    ),
)
def decision_columns(spark, sf_dir):
    return decisions.with_decision_columns(decided_rows(spark, sf_dir)).select(
        "transaction_id", "risk_bucket", F.col("decision_date").cast("string").alias("decision_date")
    )


@register(
    "training_records",
    with_parts(
        """SELECT md5('training|' || transaction_id) AS record_id, transaction_id,
                  CAST(action = 'decline' AS INT) AS label, 'rule_engine' AS label_source FROM decisions""",
        "decisions",
    ),
)
def training_records(spark, sf_dir):
    return decisions.training_records(decided_rows(spark, sf_dir)).drop("features", "created_at")


# --- roll-ups --------------------------------------------------------------------------


@register(
    "fraud_by_country",
    with_parts(
        """SELECT country_code, count(*) AS total_decisions, count(*) FILTER (action = 'decline') AS declines,
                  count(*) FILTER (action = 'review') AS reviews, count(*) FILTER (action = 'approve') AS approvals,
                  round(avg(final_risk_score), 6) AS avg_risk_score, max(final_risk_score) AS max_risk_score,
                  round(avg(total_latency_ms), 4) AS avg_latency_ms,
                  round(count(*) FILTER (action = 'decline') / count(*), 6) AS fraud_rate
           FROM decisions GROUP BY country_code ORDER BY fraud_rate DESC, country_code""",
        "decisions",
    ),
)
def fraud_by_country(spark, sf_dir):
    rolled = analytics.fraud_by_country(
        decided_rows(spark, sf_dir).drop("country_code"), ev.transactions(spark, sf_dir)
    )
    return rounded(rounded(rolled, 6, "avg_risk_score", "fraud_rate"), 4, "avg_latency_ms")


@register(
    "fraud_by_mcc",
    with_parts(
        """SELECT merchant_category_code, count(*) AS total_decisions,
                  count(*) FILTER (action = 'decline') AS declines,
                  round(avg(final_risk_score), 6) AS avg_risk_score,
                  round(count(*) FILTER (action = 'decline') / count(*), 6) AS fraud_rate
           FROM decisions GROUP BY merchant_category_code ORDER BY fraud_rate DESC, merchant_category_code""",
        "decisions",
    ),
)
def fraud_by_mcc(spark, sf_dir):
    rolled = analytics.fraud_by_mcc(
        decided_rows(spark, sf_dir).drop("merchant_category_code"), ev.transactions(spark, sf_dir)
    )
    return rounded(rolled, 6, "avg_risk_score", "fraud_rate")


@register(
    "fraud_by_hour",
    with_parts(
        """SELECT CAST(hour(event_time) AS BIGINT) AS hour_utc, count(*) AS total_decisions,
                  count(*) FILTER (action = 'decline') AS declines,
                  round(avg(final_risk_score), 6) AS avg_risk_score,
                  round(count(*) FILTER (action = 'decline') / count(*), 6) AS fraud_rate
           FROM decisions GROUP BY hour(event_time) ORDER BY hour_utc""",
        "decisions",
    ),
)
def fraud_by_hour(spark, sf_dir):
    rolled = analytics.fraud_by_hour(decided_rows(spark, sf_dir))
    return rounded(rolled.withColumn("hour_utc", F.col("hour_utc").cast("long")), 6, "avg_risk_score", "fraud_rate")


@register(
    "velocity_summary",
    with_parts(
        """SELECT user_id, txn_count_7d, round(amount_sum_7d, 2) AS amount_sum_7d, round(avg_amount_7d, 4) AS avg_amount_7d,
                  avg_ip_fraud_score, peak_txn_count_1h,
                  CAST(ntile(4) OVER (ORDER BY avg_ip_fraud_score DESC, user_id) AS BIGINT) AS risk_percentile_bucket
           FROM (SELECT user_id, count(*) AS txn_count_7d, sum(amount) AS amount_sum_7d, avg(amount) AS avg_amount_7d,
                        round(avg(ip_fraud_score), 6) AS avg_ip_fraud_score, max(txn_count_1h) AS peak_txn_count_1h
                 FROM enriched GROUP BY user_id)
           ORDER BY txn_count_7d DESC, user_id LIMIT 10000""",
        "enriched",
    ),
)
def velocity_summary(spark, sf_dir):
    out = analytics.velocity_summary(enriched_rows(spark, sf_dir))
    out = out.withColumn("risk_percentile_bucket", F.col("risk_percentile_bucket").cast("long"))
    return rounded(rounded(out, 2, "amount_sum_7d"), 4, "avg_amount_7d")


@register(
    "velocity_summary_week",
    with_parts(
        """SELECT user_id, txn_count_7d, round(amount_sum_7d, 2) AS amount_sum_7d, avg_ip_fraud_score, peak_txn_count_1h,
                  CAST(ntile(4) OVER (ORDER BY avg_ip_fraud_score DESC, user_id) AS BIGINT) AS risk_percentile_bucket
           FROM (SELECT user_id, count(*) AS txn_count_7d, sum(amount) AS amount_sum_7d,
                        round(avg(ip_fraud_score), 6) AS avg_ip_fraud_score, max(txn_count_1h) AS peak_txn_count_1h
                 FROM enriched WHERE event_time >= TIMESTAMP '2024-01-24' GROUP BY user_id)
           ORDER BY txn_count_7d DESC, user_id LIMIT 10000""",
        "enriched",
    ),
)
def velocity_summary_week(spark, sf_dir):
    """The summary as the daily job makes it: of the last seven days' rows, whose features look farther back."""
    dated = lake.with_date_partition(enriched_rows(spark, sf_dir))
    out = analytics.velocity_summary(lake.since(dated, "date_partition", dt.date(2024, 1, 31), 7)).drop("avg_amount_7d")
    return rounded(out.withColumn("risk_percentile_bucket", F.col("risk_percentile_bucket").cast("long")), 2, "amount_sum_7d")


_KPI = """
    SELECT CAST(CAST(event_time AS DATE) AS STRING) AS decision_date, count(*) AS total_decisions,
           count(*) FILTER (action = 'decline') AS total_declines, count(*) FILTER (action = 'review') AS total_reviews,
           round(avg(final_risk_score), 6) AS avg_risk_score, round(avg(total_latency_ms), 4) AS avg_latency_ms,
           quantile_disc(total_latency_ms, 0.95) AS p95_latency_ms,
           count(*) FILTER (total_latency_ms > 200) AS sla_breaches,
           round(count(*) FILTER (action = 'decline') / count(*), 6) AS fraud_rate,
           round(count(*) FILTER (total_latency_ms > 200) / count(*), 6) AS sla_breach_rate
    FROM decisions GROUP BY CAST(event_time AS DATE)"""


def _kpis(spark, sf_dir, exact: bool) -> DataFrame:
    out = analytics.daily_kpis(decided_rows(spark, sf_dir), exact_p95=exact)
    out = out.withColumn("decision_date", F.col("decision_date").cast("string"))
    return rounded(rounded(out, 6, "avg_risk_score", "fraud_rate", "sla_breach_rate"), 4, "avg_latency_ms")


@register("daily_kpis", with_parts(_KPI, "decisions"))
def daily_kpis(spark, sf_dir):
    return _kpis(spark, sf_dir, exact=True)


@register("approx_p95")
def approx_p95(spark, sf_dir):
    """The default form of the daily KPIs, with the bounded sketch."""
    return _kpis(spark, sf_dir, exact=False)


_WINDOWS = """
    SELECT user_id, epoch_us(date_trunc('hour', event_time)) AS start_us, count(*) AS txn_count,
           round(sum(amount), 4) AS amount_sum, round(avg(amount), 6) AS avg_amount,
           count(DISTINCT merchant_id) AS unique_merchants, count(DISTINCT country_code) AS unique_countries,
           max(amount) AS max_amount, min(amount) AS min_amount
    FROM txns GROUP BY user_id, date_trunc('hour', event_time)"""


def _windows(spark, sf_dir, exact: bool) -> DataFrame:
    out = velocity_windows(ev.transactions(spark, sf_dir), exact=exact)
    out = out.withColumn("start_us", F.unix_micros("window_start")).drop("window_start", "window_end")
    return rounded(rounded(out, 4, "amount_sum"), 6, "avg_amount")


@register("velocity_windows", with_parts(_WINDOWS, "txns"))
def exact_windows(spark, sf_dir):
    return _windows(spark, sf_dir, exact=True)


@register("approx_distinct_windows")
def approx_distinct_windows(spark, sf_dir):
    return _windows(spark, sf_dir, exact=False)


@register(
    "approx_distinct_error",
    with_parts(
        """SELECT DISTINCT user_id, epoch_us(date_trunc('hour', event_time)) AS start_us,
                  true AS merchants_ok, true AS countries_ok FROM txns""",
        "txns",
    ),
)
def approx_distinct_error(spark, sf_dir):
    """Per window: are the sketched distinct counts within three standard errors of 5 % (or 1) of the exact ones?"""
    txns = ev.transactions(spark, sf_dir)
    keys, counts = ["user_id", "window_start"], ["unique_merchants", "unique_countries"]
    exact = velocity_windows(txns, exact=True).select(*keys, *[F.col(c).alias(f"exact_{c}") for c in counts])
    both = velocity_windows(txns).select(*keys, *counts).join(exact, keys, "full")

    def close(name: str):
        off = F.abs(F.col(name) - F.col(f"exact_{name}")) <= F.greatest(F.lit(1.0), 0.15 * F.col(f"exact_{name}"))
        return F.coalesce(off, F.lit(False))

    return both.select(
        "user_id", F.unix_micros("window_start").alias("start_us"),
        close("unique_merchants").alias("merchants_ok"), close("unique_countries").alias("countries_ok"),
    )


@register(
    "approx_p95_error",
    with_parts("SELECT DISTINCT CAST(CAST(event_time AS DATE) AS STRING) AS decision_date, true AS p95_ok FROM txns", "txns"),
)
def approx_p95_error(spark, sf_dir):
    """Per day: is the rank of the sketched percentile within its stated error of n / 10,000 (or 1)?"""
    made = cut_lineage(
        decided_rows(spark, sf_dir).select("event_time", "action", "final_risk_score", "total_latency_ms")
    )
    sketched = analytics.daily_kpis(made).select("decision_date", F.col("p95_latency_ms").alias("p95"))
    days = made.withColumn("decision_date", F.to_date("event_time")).join(sketched, "decision_date", "left")
    latency, n = F.col("total_latency_ms"), F.count("total_latency_ms")
    slack = n / 10_000 + 1
    ok = (F.count_if(latency < F.col("p95")) <= 0.95 * n + slack) & (F.count_if(latency <= F.col("p95")) >= 0.95 * n - slack)
    return days.groupBy("decision_date").agg(ok.alias("p95_ok")).withColumn(
        "decision_date", F.col("decision_date").cast("string")
    )


@register(
    "rolling_kpis",
    with_parts(
        """SELECT CAST(p AS STRING) AS period_end, count(*) AS total_decisions, count(*) FILTER (action = 'decline') AS total_declines,
                  count(*) FILTER (action = 'review') AS total_reviews, round(avg(final_risk_score), 6) AS avg_risk_score,
                  round(avg(total_latency_ms), 4) AS avg_latency_ms, count(*) FILTER (total_latency_ms > 200) AS sla_breaches,
                  true AS p95_ok, true AS distinct_ok
           FROM decisions JOIN (SELECT DISTINCT CAST(event_time AS DATE) AS d FROM decisions) ON d = CAST(event_time AS DATE),
                (SELECT unnest(generate_series((SELECT min(event_time) FROM txns)::DATE, (SELECT max(event_time) FROM txns)::DATE, INTERVAL 1 DAY))::DATE AS p)
           WHERE p >= d AND p < d + INTERVAL 7 DAY GROUP BY p""",
        "decisions", "txns",
    ),
)
def rolling_kpis(spark, sf_dir):
    """Seven days up to each date, merged from stored daily sketches; are the sketched values within their error
    (ranks to 1 %, distinct users to 5 %) of the decisions themselves?"""
    path = scratch_path(spark, "sketches")
    made = cut_lineage(decided_rows(spark, sf_dir).select("user_id", "event_time", "action", "final_risk_score", "total_latency_ms"))
    lake.overwrite_table(analytics.daily_sketches(made), path, ["decision_date"])
    rolled = analytics.rolling_kpis(spark.read.parquet(path))
    day = F.to_date("event_time")
    spans = made.withColumn("period_end", F.explode(F.sequence(day, F.date_add(day, 6))))
    both = spans.join(rolled.select("period_end", "p95_latency_ms", "distinct_users"), "period_end")
    n, p95, latency = F.count("total_latency_ms"), F.col("p95_latency_ms"), F.col("total_latency_ms")
    users = F.count_distinct("user_id")
    ranked = (F.count_if(latency < p95) <= 0.96 * n + 1) & (F.count_if(latency <= p95) >= 0.94 * n - 1)
    close = F.abs(F.max("distinct_users") - users) <= F.greatest(F.lit(1.0), 0.05 * users)
    judged = both.groupBy("period_end").agg(ranked.alias("p95_ok"), close.alias("distinct_ok"))
    out = rolled.join(judged, "period_end").select(
        F.col("period_end").cast("string").alias("period_end"), "total_decisions", "total_declines", "total_reviews",
        "avg_risk_score", "avg_latency_ms", "sla_breaches", "p95_ok", "distinct_ok",
    )
    return rounded(rounded(out, 6, "avg_risk_score"), 4, "avg_latency_ms")


# --- tables ----------------------------------------------------------------------------


def _versions(spark, sf_dir) -> DataFrame:
    """Transactions as versions of their user's row, in batches of one day."""
    return ev.transactions(spark, sf_dir).select(
        "user_id", "transaction_id", "amount", "event_time",
        F.datediff(F.to_date("event_time"), F.lit(dt.date(2024, 1, 1))).cast("long").alias("batch_id"),
    )


_VERSIONS = "SELECT *, date_diff('day', DATE '2024-01-01', CAST(event_time AS DATE)) AS batch_id FROM txns"


@register(
    "upsert_current",
    with_parts(
        f"""SELECT user_id, transaction_id, amount, batch_id FROM (
              SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY batch_id DESC, event_time DESC) AS r
              FROM ({_VERSIONS})) WHERE r = 1""",
        "txns",
    ),
)
def upsert_current(spark, sf_dir):
    return lake.current(_versions(spark, sf_dir), "user_id", ("batch_id", "event_time")).drop("event_time")


@register(
    "insert_new",
    with_parts(
        f"""SELECT user_id, transaction_id, batch_id FROM (
              SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_time) AS r
              FROM ({_VERSIONS}) WHERE batch_id >= 1) n
            WHERE r = 1 AND user_id NOT IN (SELECT user_id FROM ({_VERSIONS}) WHERE batch_id = 0)""",
        "txns",
    ),
)
def insert_new(spark, sf_dir):
    """Users of the first day exist already; later rows add the others, first row wins."""
    versions = _versions(spark, sf_dir)
    known, later = versions.filter("batch_id = 0"), versions.filter("batch_id >= 1")
    return lake.new_rows(later, known.select("user_id").distinct(), "user_id", ["event_time"]).select(
        "user_id", "transaction_id", "batch_id"
    )


@register(
    "load_since",
    with_parts(
        "SELECT transaction_id, amount FROM txns WHERE CAST(event_time AS DATE) >= DATE '2024-01-24'", "txns"
    ),
)
def load_since(spark, sf_dir):
    rows = lake.with_date_partition(ev.transactions(spark, sf_dir))
    return lake.since(rows, "date_partition", dt.date(2024, 1, 31), 7).select("transaction_id", "amount")


@register(
    "lake_status",
    """SELECT 'bronze' AS layer, count(*) AS rows FROM events UNION ALL
       SELECT 'silver_enriched', count(*) FROM events WHERE value > 0 UNION ALL
       SELECT 'gold_decisions', count(*) FROM orders""",
)
def lake_status(spark, sf_dir):
    bronze = ev.transactions(spark, sf_dir)
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    return lake.lake_status(
        {"bronze": bronze, "silver_enriched": bronze.filter("amount > 0"), "gold_decisions": orders}
    )


@register(
    "stored_lake_status",
    with_parts(
        """SELECT 'bronze' AS layer, count(*) AS rows FROM txns UNION ALL SELECT 'silver_enriched', count(*) FROM txns WHERE k >= 10
           UNION ALL SELECT 'gold_decisions', count(*) FROM txns WHERE k >= 30""",
        "txns",
    ),
)
def stored_lake_status(spark, sf_dir):
    """Row counts of the stored layers; gold holds the decisions in force, some of them written twice."""
    base, rows = scratch_path(spark, "lake"), ev.transactions(spark, sf_dir)
    lake.write_bronze(rows, base, 0)
    lake.write_silver(rows.filter("k >= 10"), base, 0)
    made = rows.select(F.md5("transaction_id").alias("decision_id"), "transaction_id", F.lit(0.5).alias("final_risk_score"), "event_time", "k")
    for batch_id, part in enumerate(("k >= 50", "k BETWEEN 30 AND 70")):
        decision_sink.process_decisions(made.filter(part).drop("k"), batch_id, base)
    return lake.lake_status({
        "bronze": spark.read.parquet(lake.layer(base, "bronze_transactions")),
        "silver_enriched": spark.read.parquet(lake.layer(base, "silver_enriched")),
        "gold_decisions": decision_sink.read_decisions(spark, base),
    })


@register(
    "batch_history",
    with_parts(
        f"""SELECT batch_id, count(*) AS rows, epoch_us(min(event_time)) AS min_us, epoch_us(max(event_time)) AS max_us
            FROM ({_VERSIONS}) GROUP BY batch_id ORDER BY batch_id DESC LIMIT 10""",
        "txns",
    ),
)
def batch_history(spark, sf_dir):
    return lake.batch_history(_versions(spark, sf_dir)).select(
        "batch_id", "rows", F.unix_micros("min_event_time").alias("min_us"),
        F.unix_micros("max_event_time").alias("max_us"),
    )


@register(
    "message_round_trip",
    with_parts(
        "SELECT transaction_id, amount, city, latitude, CAST(k AS STRING) AS k, epoch_us(event_time) AS at_us FROM txns",
        "txns",
    ),
)
def message_round_trip(spark, sf_dir):
    """Transactions as keyed JSON messages and back."""
    sent = ev.transaction_messages(spark.read.parquet(ev.events_path(sf_dir)))
    received = quality.normalise(messages.decode_json(sent, schemas.TRANSACTION))
    return received.select(
        "transaction_id", "amount", "city", "latitude", F.col("metadata")["k"].alias("k"),
        F.unix_micros("event_time").alias("at_us"),
    )


@register(
    "compacted_table",
    with_parts("SELECT user_id, count(*) AS rows, round(sum(amount), 2) AS amount FROM txns GROUP BY user_id", "txns"),
)
def compacted_table(spark, sf_dir):
    """The table written, compacted and clustered by user into another path, and read there."""
    path = scratch_path(spark, "table")
    lake.overwrite_table(ev.transactions(spark, sf_dir).select("transaction_id", "user_id", "amount"), path)
    lake.compact(spark, path, ["user_id"], f"{path}_clustered", files=4)
    grouped = spark.read.parquet(f"{path}_clustered").groupBy("user_id")
    return grouped.agg(F.count(F.lit(1)).alias("rows"), F.round(F.sum("amount"), 2).alias("amount"))


@register(
    "upserted_table",
    with_parts(
        """SELECT user_id, transaction_id, amount, event_id % 3 AS batch_id FROM (
             SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id % 3 DESC, event_time DESC) AS r FROM txns)
           WHERE r = 1""",
        "txns",
    ),
)
def upserted_table(spark, sf_dir):
    """Three batches upserted by user into a stored table, the middle one twice."""
    path = scratch_path(spark, "keyed")
    rows = ev.transactions(spark, sf_dir).select("user_id", "transaction_id", "amount", "event_time", "event_id")
    for batch_id in (0, 1, 1, 2):
        lake.upsert(rows.filter(F.col("event_id") % 3 == batch_id).drop("event_id"), path, batch_id)
    return lake.read_current(spark, path, "user_id", ("batch_id", "event_time")).drop("event_time")


# --- training --------------------------------------------------------------------------


def _training_table(spark, sf_dir) -> DataFrame:
    """Records as they lie in the training table: label and JSON features."""
    bad = F.when(F.col("k") % 50 == 7, F.lit("n/a")).otherwise(F.col("amount").cast("string"))
    return ev.transactions(spark, sf_dir).select(
        F.col("transaction_id").alias("record_id"), "transaction_id",
        F.col("is_fraud").cast("int").alias("label"), F.lit("rule_engine").alias("label_source"),
        F.to_json(
            F.create_map(
                F.lit("amount"), bad,
                F.lit("hour_of_day"), F.hour("event_time").cast("string"),
                F.lit("network_risk"), F.col("address_score").cast("string"),
            )
        ).alias("features"),
        F.col("event_time").alias("created_at"),
    )


@register(
    "training_gate",
    with_parts(
        """SELECT count(*) AS rows, round(avg(CAST(is_fraud AS INT)), 4) AS fraud_rate,
                  count(*) > 1000 AND avg(CAST(is_fraud AS INT)) BETWEEN 0.001 AND 0.5 AS ok FROM txns
           WHERE event_time > TIMESTAMP '2024-01-01 00:00:00'""",
        "txns",
    ),
)
def training_gate(spark, sf_dir):
    recent = lake.load_training_records(_training_table(spark, sf_dir), dt.datetime(2024, 1, 31))
    return quality.validate_training(recent)


@register(
    "class_balance",
    with_parts(
        """SELECT round(avg(CAST(is_fraud AS INT)), 6) AS fraud_rate,
                  CAST(floor(count(*) FILTER (NOT is_fraud) / count(*) FILTER (is_fraud)) AS BIGINT) AS scale_pos_weight
           FROM txns""",
        "txns",
    ),
)
def class_balance(spark, sf_dir):
    return rounded(training.class_balance(_training_table(spark, sf_dir)), 6, "fraud_rate")


@register(
    "expand_features",
    with_parts(
        """SELECT transaction_id AS record_id, CAST(is_fraud AS INT) AS label,
                  CASE WHEN k % 50 = 7 THEN NULL ELSE amount END AS amount,
                  CAST(hour(event_time) AS DOUBLE) AS hour_of_day, address_score AS network_risk FROM txns""",
        "txns",
    ),
)
def expand_features(spark, sf_dir):
    names = ["amount", "hour_of_day", "network_risk"]
    return training.expand_features(_training_table(spark, sf_dir), names).drop("created_at")


@register(
    "feature_keys",
    with_parts(
        """SELECT name, count(*) AS records, name IN ('amount', 'hour_of_day', 'network_risk') AS used FROM (
             SELECT unnest(['amount', 'hour_of_day', 'network_risk', 'once_' || event_id, 'some_' || event_id % 40]) AS name FROM txns)
           GROUP BY name""",
        "txns",
    ),
)
def feature_keys(spark, sf_dir):
    """Keys of the JSON features when every record brings one of its own; three are taken."""
    number = F.substring("record_id", 5, 20)
    body = F.from_json("features", "map<string,string>")
    own = F.create_map(F.concat(F.lit("once_"), number), F.lit("1"), F.concat(F.lit("some_"), number.cast("long") % 40), F.lit("1"))
    records = _training_table(spark, sf_dir).withColumn("features", F.to_json(F.map_concat(body, own)))
    return training.feature_keys(records, most=3)


_MODEL_FEATURES = [
    "amount", "txn_count_24h", "amount_sum_24h", "distance_from_last_txn_km", "amount_deviation_score",
    "hour_of_day_risk_score", "ip_fraud_score", "linked_fraud_accounts", "latency_ms",
]


@register("model_scores")
def model_scores(spark, sf_dir):
    """A small model trained on four fifths of the enriched rows scores the rest. Profiles are those dated before each
    row, so that the model sees nothing later than the row itself."""
    txns = ev.transactions(spark, sf_dir)
    known = enrich.enrich_history(txns, behavioral.daily_profiles(txns), ev.fraud_labels(txns), ev.ip_reputation(txns))
    # Trees read their input many times, and the other rows are scored: the features are computed once.
    rows = known.select(
        F.col("transaction_id").alias("record_id"), F.col("is_fraud").cast("int").alias("label"),
        *_MODEL_FEATURES,
    ).persist()
    cfg = TrainingConfig(trees=5, depth=3)
    learn, rest = training.split(rows, cfg)
    model = training.train(learn, _MODEL_FEATURES, cfg)
    scores = training.predict(rest, model, _MODEL_FEATURES).select("record_id", "label", "fraud_probability")
    scores = stored(scores, "scores")
    rows.unpersist()
    return scores


_SHARE = "CAST('0x' || substr(md5(transaction_id || '|42'), 1, 8) AS BIGINT) % 100"


@register("training_split", with_parts(f"SELECT transaction_id AS record_id, {_SHARE} < 80 AS in_train FROM txns", "txns"))
def training_split(spark, sf_dir):
    """Which records are learnt from."""
    learn, rest = training.split(_training_table(spark, sf_dir))
    return learn.select("record_id", F.lit(True).alias("in_train")).unionByName(
        rest.select("record_id", F.lit(False).alias("in_train"))
    )


@register(
    "trained_model",
    with_parts(
        f"""SELECT transaction_id AS record_id, CAST(hour(event_time) < 6 AS INT) AS label,
                   CASE WHEN k % 50 = 7 THEN CAST(0 AS DOUBLE) ELSE amount END AS amount,
                   true AS in_range, true AS called_right, true AS good, true AS promoted
            FROM txns WHERE {_SHARE} >= 80""",
        "txns",
    ),
)
def trained_model(spark, sf_dir):
    """A label that follows from one feature: trained, judged, promoted, loaded, and used on the other records."""
    names = ["amount", "hour_of_day", "network_risk"]
    records = _training_table(spark, sf_dir).withColumn("label", (F.hour("created_at") < 6).cast("int"))
    # Trees read their input many times; the features are stored once.
    rows = cut_lineage(training.expand_features(records, names))
    cfg = TrainingConfig(trees=3, depth=2)
    learn, rest = training.split(rows, cfg)
    model = training.train(learn, names, cfg)
    metrics = training.evaluate(model, rest, names)
    path = scratch_path(spark, "model")
    promoted = training.promote(model, metrics, path, cfg)
    p = F.col("fraud_probability")
    return training.predict(rest, path, names).select(
        "record_id", "label", "amount", p.between(0.0, 1.0).alias("in_range"),
        ((p >= 0.5) == (F.col("label") == 1)).alias("called_right"),
        F.lit(metrics["roc_auc"] >= 0.9).alias("good"), F.lit(promoted).alias("promoted"),
    )
