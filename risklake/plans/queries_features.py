"""Registered queries: gates, reference joins, features and the feature store."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from risklake.config import MERCHANT_RISK, VelocityConfig
from risklake.functions.scalars import category_hash, haversine_km
from risklake.operators import behavioral, device, enrich, geo, quality, velocity
from risklake.operators import feature_store as fs
from risklake.plans.registry import register, rounded
from risklake.plans.sql_parts import distance_sql, with_parts
from risklake.session import cut_lineage, scratch_path
from risklake.sources import events as ev
from risklake.sources import lake, snapshots

# --- gates ---------------------------------------------------------------------------

RAW = """
    SELECT CASE WHEN k = 40 THEN NULL ELSE transaction_id END AS transaction_id,
           CASE WHEN k = 50 THEN NULL ELSE user_id END AS user_id, event_id,
           CASE WHEN k % 20 = 0 THEN NULL WHEN k % 20 = 1 THEN 'abc' WHEN k % 20 = 2 THEN '-1'
                WHEN k % 20 = 3 THEN '0' ELSE CAST(amount AS STRING) END AS amount,
           CASE WHEN k = 60 THEN NULL WHEN k = 61 THEN 'nope' ELSE CAST(event_time AS STRING) END AS "timestamp"
    FROM txns"""
GATED = f"""
    FROM (SELECT *, TRY_CAST("timestamp" AS TIMESTAMP) AS seen, TRY_CAST(amount AS DOUBLE) AS paid FROM ({RAW}))"""
PASSES = "transaction_id IS NOT NULL AND user_id IS NOT NULL AND coalesce(paid > 0, false) AND seen IS NOT NULL"

REASONS = """concat_ws(', ', CASE WHEN transaction_id IS NULL THEN 'transaction_id missing' END,
              CASE WHEN user_id IS NULL THEN 'user_id missing' END,
              CASE WHEN NOT coalesce(paid > 0, false) THEN 'amount not positive' END,
              CASE WHEN seen IS NULL THEN 'timestamp missing' END)"""

def raw_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transactions as text, some of them damaged."""
    k = F.col("k")
    return ev.transactions(spark, sf_dir).select(
        F.when(k != 40, F.col("transaction_id")).alias("transaction_id"),
        F.when(k != 50, F.col("user_id")).alias("user_id"),
        "event_id",
        F.when(k % 20 == 0, None).when(k % 20 == 1, "abc").when(k % 20 == 2, "-1")
        .when(k % 20 == 3, "0").otherwise(F.col("amount").cast("string")).alias("amount"),
        F.when(k == 60, None).when(k == 61, "nope")
        .otherwise(F.col("event_time").cast("string")).alias("timestamp"),
    )


@register("dq_good", with_parts(f"SELECT event_id, transaction_id, user_id, paid AS amount {GATED} WHERE {PASSES}", "txns"))
def dq_good(spark, sf_dir):
    good, _ = quality.split_valid(quality.normalise(raw_rows(spark, sf_dir)))
    return good.select("event_id", "transaction_id", "user_id", "amount")


@register(
    "dq_bad",
    with_parts(
        f"SELECT event_id, {REASONS} AS reasons {GATED} WHERE NOT ({PASSES})",
        "txns",
    ),
)
def dq_bad(spark, sf_dir):
    _, bad = quality.split_valid(quality.normalise(raw_rows(spark, sf_dir)))
    return bad.select("event_id", F.array_join("reasons", ", ").alias("reasons"))


@register(
    "contract_check",
    with_parts(
        """SELECT event_id, concat_ws(', ', CASE WHEN k < 5 THEN 'currency longer than 3' END,
                  CASE WHEN k % 10 = 4 THEN 'country_code longer than 2' END,
                  CASE WHEN k >= 95 THEN 'risk_score outside 0..1' END) AS violations
           FROM txns""",
        "txns",
    ),
)
def contract_check(spark, sf_dir):
    k = F.col("k")
    rows = ev.transactions(spark, sf_dir).withColumns(
        {
            "currency": F.when(k < 5, F.concat("currency", F.lit("X"))).otherwise(F.col("currency")),
            "country_code": F.when(k % 10 == 4, F.concat("country_code", F.lit("Y"))).otherwise(F.col("country_code")),
            "risk_score": F.when(k >= 95, k / 90.0).when(k == 7, None).otherwise(k / 100.0),
        }
    )
    return quality.validate_contract(rows).select("event_id", F.array_join("violations", ", ").alias("violations"))


@register(
    "silver_volume_gate",
    """SELECT CAST(CAST(ts AS DATE) AS STRING) AS day, count(*) >= 100 AS enough
       FROM events GROUP BY CAST(ts AS DATE)""",
)
def silver_volume_gate(spark, sf_dir):
    """The daily volume gate for every day of the table at once."""
    rows = lake.with_date_partition(ev.transactions(spark, sf_dir))
    return quality.daily_volume(rows).select(F.col("date_partition").cast("string").alias("day"), "enough")


# --- reference joins and scalars -------------------------------------------------------


@register(
    "mcc_risk_join",
    with_parts(
        "SELECT t.transaction_id, merchant_category_code, mcc_label, coalesce(mcc_risk_score, 0.1) AS mcc_risk_score "
        "FROM txns t LEFT JOIN (VALUES "
        + ", ".join(f"('{c}', '{n}', CAST({r} AS DOUBLE))" for c, n, r in MERCHANT_RISK)
        + ") AS m(code, mcc_label, mcc_risk_score) ON m.code = t.merchant_category_code",
        "txns",
    ),
)
def mcc_risk_join(spark, sf_dir):
    return enrich.with_mcc_risk(ev.transactions(spark, sf_dir)).select(
        "transaction_id", "merchant_category_code", "mcc_label", "mcc_risk_score"
    )


@register(
    "haversine",
    with_parts(
        f"SELECT transaction_id, round({distance_sql('51.5074', '-0.1278', 'latitude', 'longitude')}, 3) AS km FROM txns",
        "txns",
    ),
)
def haversine(spark, sf_dir):
    km = haversine_km(F.lit(51.5074), F.lit(-0.1278), F.col("latitude"), F.col("longitude"))
    return ev.transactions(spark, sf_dir).select("transaction_id", F.round(km, 3).alias("km"))


@register(
    "metadata_round_trip",
    with_parts("SELECT transaction_id, CAST(k AS STRING) AS k, currency FROM txns", "txns"),
)
def metadata_round_trip(spark, sf_dir):
    rows = ev.transactions(spark, sf_dir).withColumn(
        "metadata", F.create_map(F.lit("k"), F.col("k").cast("string"), F.lit("cur"), F.col("currency"))
    )
    back = enrich.metadata_from_json(enrich.metadata_to_json(rows))
    return back.select(
        "transaction_id", F.col("metadata")["k"].alias("k"), F.col("metadata")["cur"].alias("currency")
    )


# --- features --------------------------------------------------------------------------


@register(
    "velocity_features",
    with_parts(
        """SELECT transaction_id, txn_count_1h, round(amount_sum_1h, 4) AS amount_sum_1h, txn_count_24h,
                  round(amount_sum_24h, 4) AS amount_sum_24h, unique_merchants_1h FROM velocity""",
        "velocity",
    ),
)
def velocity_features(spark, sf_dir):
    out = velocity.velocity_features(ev.transactions(spark, sf_dir))
    return rounded(out.select("transaction_id", *velocity.COLUMNS), 4, "amount_sum_1h", "amount_sum_24h")


def _idle_sql(hours: int, tag: str) -> str:
    return f"""
    SELECT transaction_id,
           count(*) OVER s - 1 AS count_{tag}, round(sum(amount) OVER s - amount, 4) AS amount_{tag}
    FROM (SELECT *, sum(opens) OVER (PARTITION BY user_id ORDER BY event_time) AS spell
          FROM (SELECT *, CASE WHEN event_time - lag(event_time) OVER u <= INTERVAL {hours} HOUR THEN 0 ELSE 1 END AS opens
                FROM txns WINDOW u AS (PARTITION BY user_id ORDER BY event_time)))
    WINDOW s AS (PARTITION BY user_id, spell ORDER BY event_time)"""


@register(
    "velocity_idle_reset",
    with_parts(
        f"""SELECT a.transaction_id, count_1h, amount_1h + 0 AS amount_1h, count_24h, amount_24h + 0 AS amount_24h
            FROM ({_idle_sql(1, '1h')}) a JOIN ({_idle_sql(24, '24h')}) b ON a.transaction_id = b.transaction_id""",
        "txns",
    ),
)
def velocity_idle_reset(spark, sf_dir):
    out = velocity.idle_reset_counters(ev.transactions(spark, sf_dir)).select(
        "transaction_id", "count_1h", "amount_1h", "count_24h", "amount_24h"
    )
    # Adding zero turns a rounded -0.0 into 0.0.
    return out.withColumns({c: F.round(c, 4) + 0.0 for c in ("amount_1h", "amount_24h")})


@register(
    "same_merchant_velocity",
    with_parts(
        """SELECT transaction_id, count(*) OVER (PARTITION BY user_id, merchant_id ORDER BY event_time
             RANGE BETWEEN INTERVAL 240 HOUR PRECEDING AND INTERVAL 1 MICROSECOND PRECEDING) AS same_merchant_count
           FROM txns""",
        "txns",
    ),
)
def same_merchant_velocity(spark, sf_dir):
    """Ten days instead of one hour: the table has no repeat within an hour."""
    ten_days = VelocityConfig(short_s=240 * 3600)
    return velocity.same_merchant_1h(ev.transactions(spark, sf_dir), ten_days).select(
        "transaction_id", F.col("same_merchant_count_1h").alias("same_merchant_count")
    )


@register(
    "burst_rate",
    with_parts(
        """SELECT transaction_id, round(count(*) OVER (PARTITION BY user_id ORDER BY event_time
             RANGE BETWEEN INTERVAL 5 MINUTE PRECEDING AND INTERVAL 1 MICROSECOND PRECEDING)
             / CAST(5 AS DOUBLE), 4) AS burst_per_minute FROM txns""",
        "txns",
    ),
)
def burst_rate(spark, sf_dir):
    out = velocity.burst_rate(ev.transactions(spark, sf_dir)).select("transaction_id", "burst_per_minute")
    return rounded(out, 4, "burst_per_minute")


@register(
    "behavioral_features",
    with_parts(
        """SELECT user_id, round(avg_txn_amount_30d, 6) AS avg_txn_amount_30d,
                  round(stddev_txn_amount_30d, 6) AS stddev_txn_amount_30d,
                  round(amount_deviation_score, 6) AS amount_deviation_score,
                  round(hour_of_day_risk_score, 6) AS hour_of_day_risk_score, top_mcc, txn_count_30d,
                  round(high_risk_mcc_ratio, 6) AS high_risk_mcc_ratio, last_country_code,
                  round(country_risk, 6) AS country_risk FROM behavior""",
        "behavior",
    ),
)
def behavioral_features(spark, sf_dir):
    out = behavioral.behavioral_features(ev.transactions(spark, sf_dir)).drop("most_common_mcc")
    return rounded(
        out, 6, "avg_txn_amount_30d", "stddev_txn_amount_30d", "amount_deviation_score",
        "hour_of_day_risk_score", "high_risk_mcc_ratio", "country_risk",
    )


@register(
    "user_amount_stats",
    with_parts(
        """SELECT user_id, round(avg(amount), 6) AS avg_txn_amount_30d,
                  round(stddev_samp(amount), 6) AS stddev_txn_amount_30d, count(*) AS txn_count_30d,
                  arg_max(amount, event_time) AS last_txn_amount,
                  count(*) FILTER (hour(event_time) < 6) AS night_txn_count FROM txns GROUP BY user_id""",
        "txns",
    ),
)
def user_amount_stats(spark, sf_dir):
    out = behavioral.user_amount_stats(ev.transactions(spark, sf_dir)).select(
        "user_id", "avg_txn_amount_30d", "stddev_txn_amount_30d", "txn_count_30d", "last_txn_amount",
        "night_txn_count",
    )
    return rounded(out, 6, "avg_txn_amount_30d", "stddev_txn_amount_30d")


# The 32-bit Murmur3 hash, seed 42, of the table's category codes.
_CATEGORY_HASHES = (
    ("5411", 1366658706), ("5732", 1125261409), ("5812", -388231877), ("5912", 1670560257),
    ("7995", 2106764947), ("6051", -45289912), ("4829", 628799438), ("6211", -1191601706),
    ("5999", 1133079546), ("5541", -31164867),
)
_HASHES = "(VALUES " + ", ".join(f"('{c}', CAST({h} AS FLOAT))" for c, h in _CATEGORY_HASHES) + ") AS m(code, h)"


@register(
    "category_hash",
    with_parts(
        f"""SELECT transaction_id, coalesce(h, CAST(42 AS FLOAT)) AS hashed
            FROM txns LEFT JOIN {_HASHES} ON m.code = CASE WHEN k <> 5 THEN merchant_category_code END""",
        "txns",
    ),
)
def category_hashes(spark, sf_dir):
    """The numeric stand-in of every row's category; some rows have none."""
    code = F.when(F.col("k") != 5, F.col("merchant_category_code"))
    return ev.transactions(spark, sf_dir).select("transaction_id", category_hash(code).alias("hashed"))


@register(
    "most_common_mcc",
    with_parts(f"SELECT user_id, h AS most_common_mcc FROM top_mcc JOIN {_HASHES} ON m.code = top_mcc", "top_mcc"),
)
def most_common_mcc(spark, sf_dir):
    out = behavioral.behavioral_features(ev.transactions(spark, sf_dir))
    return out.select("user_id", "most_common_mcc")


@register("top_mcc", with_parts("SELECT user_id, top_mcc, mcc_freq FROM top_mcc", "top_mcc"))
def top_mcc(spark, sf_dir):
    return behavioral.top_category(ev.transactions(spark, sf_dir))


@register(
    "last_country_risk",
    with_parts(
        "SELECT user_id, last_country_code, round(country_risk, 6) AS country_risk FROM behavior", "behavior"
    ),
)
def last_country_risk(spark, sf_dir):
    out = behavioral.with_country_risk(behavioral.last_country(ev.transactions(spark, sf_dir)))
    return rounded(out.select("user_id", "last_country_code", "country_risk"), 6, "country_risk")


@register(
    "geo_features",
    with_parts(
        """SELECT transaction_id, last_txn_latitude, last_txn_longitude, last_country_code,
                  round(distance_from_last_txn_km, 3) AS distance_from_last_txn_km, is_new_country, is_new_city
           FROM geo""",
        "geo",
    ),
)
def geo_features(spark, sf_dir):
    out = geo.geo_features(ev.transactions(spark, sf_dir)).select("transaction_id", *geo.COLUMNS)
    return rounded(out, 3, "distance_from_last_txn_km").drop("speed_kmh")


@register(
    "impossible_travel",
    with_parts(
        """SELECT transaction_id, round(distance_from_last_txn_km / hours, 1) AS speed_kmh
           FROM geo WHERE distance_from_last_txn_km / hours > 900""",
        "geo",
    ),
)
def impossible_travel(spark, sf_dir):
    flagged = geo.impossible_travel(geo.geo_features(ev.transactions(spark, sf_dir)), 900.0)
    return flagged.filter("impossible_travel").select("transaction_id", F.round("speed_kmh", 1).alias("speed_kmh"))


@register(
    "device_features",
    with_parts(
        """SELECT t.transaction_id, device_seen_before, linked_fraud_accounts, ip_fraud_score, is_vpn, is_tor
           FROM txns t JOIN device d ON d.transaction_id = t.transaction_id
           JOIN addresses a ON a.ip_address = t.ip_address""",
        "device", "addresses",
    ),
)
def device_features(spark, sf_dir):
    txns = ev.transactions(spark, sf_dir)
    out = device.device_features(txns, ev.fraud_labels(txns), ev.ip_reputation(txns))
    return out.select(
        "transaction_id", "device_seen_before", "linked_fraud_accounts", "ip_fraud_score", "is_vpn", "is_tor"
    )


def enriched_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole table with all features, the input of scoring and roll-ups."""
    txns = ev.transactions(spark, sf_dir)
    return enrich.enrich_history(
        txns, behavioral.behavioral_features(txns), ev.fraud_labels(txns), ev.ip_reputation(txns)
    )


@register(
    "enriched_transactions",
    with_parts(
        """SELECT transaction_id, txn_count_1h, txn_count_24h, round(amount_sum_1h, 4) AS amount_sum_1h,
                  round(amount_sum_24h, 4) AS amount_sum_24h, unique_merchants_1h,
                  round(distance_from_last_txn_km, 3) AS distance_from_last_txn_km, is_new_country, is_new_city,
                  round(avg_txn_amount_30d, 6) AS avg_txn_amount_30d,
                  round(amount_deviation_score, 6) AS amount_deviation_score,
                  round(hour_of_day_risk_score, 6) AS hour_of_day_risk_score,
                  ip_fraud_score, device_seen_before, linked_fraud_accounts FROM enriched""",
        "enriched",
    ),
)
def enriched_transactions(spark, sf_dir):
    out = enriched_rows(spark, sf_dir).select(
        "transaction_id", "txn_count_1h", "txn_count_24h", "amount_sum_1h", "amount_sum_24h",
        "unique_merchants_1h", "distance_from_last_txn_km", "is_new_country", "is_new_city",
        "avg_txn_amount_30d", "amount_deviation_score", "hour_of_day_risk_score", "ip_fraud_score",
        "device_seen_before", "linked_fraud_accounts",
    )
    out = rounded(out, 4, "amount_sum_1h", "amount_sum_24h")
    out = rounded(out, 3, "distance_from_last_txn_km")
    return rounded(out, 6, "avg_txn_amount_30d", "amount_deviation_score", "hour_of_day_risk_score")


_DAILY = """
    SELECT u.user_id, d.day AS seen, avg(t.amount) AS mean,
           CASE WHEN coalesce(stddev_samp(t.amount), 0) > 0 AND min(t.amount) < max(t.amount)
                THEN abs((arg_max(t.amount, t.event_time) - avg(t.amount)) / stddev_samp(t.amount)) ELSE 0 END AS deviation,
           count(*) FILTER (hour(t.event_time) < 6) / count(*) AS night, count(*) AS n
    FROM (SELECT DISTINCT user_id FROM txns) u,
         (SELECT unnest(generate_series((SELECT min(event_time) FROM txns)::DATE, (SELECT max(event_time) FROM txns)::DATE + 1, INTERVAL 1 DAY))::TIMESTAMP AS day) d,
         txns t
    WHERE t.user_id = u.user_id AND t.event_time < d.day AND t.event_time >= d.day - INTERVAL 30 DAY
    GROUP BY u.user_id, d.day"""


@register(
    "dated_profiles",
    with_parts(
        """SELECT t.transaction_id, round(coalesce(p.mean, 0) + 1e-9, 6) AS avg_txn_amount_30d, round(coalesce(p.deviation, 0) + 1e-9, 6) AS amount_deviation_score,
                  round(coalesce(p.night, 0) + 1e-9, 6) AS hour_of_day_risk_score, v.txn_count_24h
           FROM txns t JOIN velocity v USING (transaction_id) ASOF LEFT JOIN daily p ON p.user_id = t.user_id AND t.event_time > p.seen""",
        "txns", "velocity", "daily", instead={"daily": (_DAILY, ("txns",))},
    ),
)
def dated_profiles(spark, sf_dir):
    """Every row with the profile of the days before its own, as of which nothing later is known."""
    txns = ev.transactions(spark, sf_dir)
    profiles = behavioral.daily_profiles(txns)
    out = enrich.enrich_history(txns, profiles, ev.fraud_labels(txns), ev.ip_reputation(txns)).select(
        "transaction_id", *enrich.PROFILE, "txn_count_24h"
    )
    # A little is added, as means of cents lie halfway between two roundings.
    return rounded(out.withColumns({c: F.col(c) + 1e-9 for c in enrich.PROFILE}), 6, *enrich.PROFILE)


@register(
    "point_in_time_views",
    with_parts(
        """SELECT t.transaction_id, round(CAST(CASE WHEN t.event_time - p.seen <= INTERVAL 30 DAY THEN p.mean END AS FLOAT), 2) AS avg_txn_amount_30d,
                  CASE WHEN t.event_time - g.seen <= INTERVAL 7 DAY THEN g.country END AS last_country_code,
                  CASE WHEN t.event_time - d.seen <= INTERVAL 7 DAY THEN d.score END AS ip_fraud_score
           FROM (SELECT * FROM txns WHERE event_id % 3 = 0) t
           ASOF LEFT JOIN daily p ON p.user_id = t.user_id AND t.event_time >= p.seen
           ASOF LEFT JOIN (SELECT user_id, event_time AS seen, country_code AS country FROM txns WHERE event_id % 3 <> 0 AND k % 10 = 0) g
             ON g.user_id = t.user_id AND t.event_time >= g.seen
           ASOF LEFT JOIN (SELECT device_fingerprint, event_time AS seen, CAST(max(address_score) AS FLOAT) AS score FROM txns
                           WHERE event_id % 3 = 1 GROUP BY ALL) d
             ON d.device_fingerprint = t.device_fingerprint AND t.event_time >= d.seen""",
        "txns", "daily", instead={"daily": (_DAILY, ("txns",))},
    ),
)
def point_in_time_views(spark, sf_dir):
    """Three views of two keys looked up for every third transaction, each as of its time."""
    txns = ev.transactions(spark, sf_dir)
    dated = lambda view, df: view.conform(df.withColumnRenamed("event_time", "event_timestamp"))
    histories = {
        "user_behavioral_stats": fs.USER_BEHAVIORAL_STATS.conform(behavioral.daily_profiles(txns)),
        "geo_stats": dated(fs.GEO_STATS, txns.filter("event_id % 3 <> 0 AND k % 10 = 0").withColumnRenamed("country_code", "last_country_code")),
        "device_network_stats": dated(fs.DEVICE_NETWORK_STATS, txns.filter("event_id % 3 = 1").withColumnRenamed("address_score", "ip_fraud_score")),
    }
    asked = {"user_behavioral_stats": ["avg_txn_amount_30d"], "geo_stats": ["last_country_code"], "device_network_stats": ["ip_fraud_score"]}
    rows = txns.filter("event_id % 3 = 0").select("transaction_id", "user_id", "device_fingerprint", "event_time")
    out = fs.point_in_time_views(rows, histories, features=asked)
    return rounded(out, 2, "avg_txn_amount_30d").select("transaction_id", "avg_txn_amount_30d", "last_country_code", "ip_fraud_score")


# --- feature store ---------------------------------------------------------------------


def _velocity_history(txns: DataFrame) -> DataFrame:
    """Rows of the velocity view: values at each purchase."""
    rows = velocity.velocity_features(txns).withColumnRenamed("event_time", "event_timestamp")
    return fs.USER_TRANSACTION_STATS.conform(rows)


@register(
    "point_in_time_join",
    with_parts(
        """SELECT transaction_id,
                  CASE WHEN event_time - seen <= INTERVAL 7 DAY THEN lat END AS last_txn_latitude,
                  CASE WHEN event_time - seen <= INTERVAL 7 DAY THEN country END AS last_country_code
           FROM (SELECT transaction_id, user_id, event_time FROM txns WHERE event_type_purchase) a
           ASOF LEFT JOIN (SELECT user_id, event_time AS seen, CAST(latitude AS FLOAT) AS lat,
                                  country_code AS country FROM txns WHERE NOT event_type_purchase AND k % 10 = 0) b
             ON a.user_id = b.user_id AND a.event_time >= b.seen""".replace("event_type_purchase", "event_id % 3 = 0"),
        "txns",
    ),
)
def point_in_time_join(spark, sf_dir):
    """Every third transaction looks up where the other rows last placed its user."""
    txns = ev.transactions(spark, sf_dir)
    asking = txns.filter("event_id % 3 = 0").select("transaction_id", "user_id", "event_time")
    history = fs.GEO_STATS.conform(
        txns.filter("event_id % 3 <> 0 AND k % 10 = 0").select(
            "user_id",
            F.col("event_time").alias("event_timestamp"),
            F.col("latitude").alias("last_txn_latitude"),
            F.col("country_code").alias("last_country_code"),
        )
    )
    out = fs.point_in_time_join(
        asking, fs.GEO_STATS, history, features=["last_txn_latitude", "last_country_code"]
    )
    return out.select("transaction_id", "last_txn_latitude", "last_country_code")


_AS_OF = dt.datetime(2024, 1, 30, 12, 0, 0)
_AS_OF_SQL = "TIMESTAMP '2024-01-30 12:00:00'"
_START = dt.datetime(2024, 1, 10)
_START_SQL = "TIMESTAMP '2024-01-10 00:00:00'"


def _latest_sql(condition: str) -> str:
    return f"""
    SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_time DESC) AS r
                   FROM velocity WHERE {condition}) WHERE r = 1"""


@register(
    "materialize",
    with_parts(
        f"""SELECT user_id, epoch_us(event_time) AS at_us, txn_count_24h,
                   round(CAST(CAST(amount_sum_24h AS FLOAT) AS DOUBLE), 2) AS amount_sum_24h
            FROM ({_latest_sql(f'event_time > {_START_SQL} AND event_time <= {_AS_OF_SQL}')})""",
        "velocity",
    ),
)
def materialize(spark, sf_dir):
    history = _velocity_history(ev.transactions(spark, sf_dir))
    out = fs.materialize(fs.USER_TRANSACTION_STATS, history, _START, _AS_OF)
    return out.select(
        "user_id", F.unix_micros("event_timestamp").alias("at_us"), "txn_count_24h",
        F.round(F.col("amount_sum_24h").cast("double"), 2).alias("amount_sum_24h"),
    )


@register(
    "online_features",
    with_parts(
        f"""SELECT u.user_id, CASE WHEN {_AS_OF_SQL} - event_time <= INTERVAL 1 DAY THEN txn_count_24h END AS txn_count_24h,
                   CASE WHEN {_AS_OF_SQL} - event_time <= INTERVAL 1 DAY THEN unique_merchants_1h END AS unique_merchants_1h
            FROM (SELECT DISTINCT user_id FROM txns) u
            LEFT JOIN ({_latest_sql(f'event_time <= {_AS_OF_SQL}')}) l ON l.user_id = u.user_id""",
        "velocity",
    ),
)
def online_features(spark, sf_dir):
    """Velocity values of all users at a moment; those of more than a day before are NULL."""
    txns = ev.transactions(spark, sf_dir)
    store = fs.latest(fs.USER_TRANSACTION_STATS, _velocity_history(txns), _AS_OF)
    return fs.get_online_features(
        ["user_transaction_stats:txn_count_24h", "user_transaction_stats:unique_merchants_1h"],
        txns.select("user_id").distinct(),
        {"user_transaction_stats": store},
        _AS_OF,
    )


@register(
    "enrich_from_store",
    with_parts(
        f"""SELECT t.transaction_id,
              coalesce(CASE WHEN t.event_time - l.event_time <= INTERVAL 1 DAY THEN l.txn_count_24h END, 0) AS txn_count_24h,
              coalesce(round(b.avg_txn_amount_30d, 2), 0) AS avg_txn_amount_30d, 0.0 AS ip_fraud_score,
              false AS device_seen_before
            FROM txns t LEFT JOIN ({_latest_sql(f'event_time <= {_AS_OF_SQL}')}) l ON l.user_id = t.user_id
            LEFT JOIN behavior b ON b.user_id = t.user_id WHERE t.event_time > {_AS_OF_SQL}""".replace("0.0 AS", "CAST(0 AS DOUBLE) AS"),
        "velocity", "behavior",
    ),
)
def enrich_from_store(spark, sf_dir):
    """Transactions after a moment, enriched from the feature tables of that moment."""
    txns = ev.transactions(spark, sf_dir)
    stores = {
        "user_transaction_stats": fs.latest(fs.USER_TRANSACTION_STATS, _velocity_history(txns), _AS_OF),
        "user_behavioral_stats": behavioral.behavioral_features(txns).withColumn(
            "event_timestamp", F.lit(_AS_OF)
        ),
    }
    out = enrich.enrich(txns.filter(F.col("event_time") > F.lit(_AS_OF)), stores)
    return rounded(
        out.select(
            "transaction_id", "txn_count_24h", "avg_txn_amount_30d", "ip_fraud_score", "device_seen_before"
        ),
        2, "avg_txn_amount_30d",
    )


@register(
    "pushed_features",
    with_parts(
        f"""SELECT user_id, txn_count_24h, epoch_us(event_time) AS at_us FROM ({_latest_sql('true')})""", "velocity"
    ),
)
def pushed_features(spark, sf_dir):
    """Velocity values pushed to the stored online view, newer half first, then read."""
    base, view = scratch_path(spark, "online"), fs.USER_TRANSACTION_STATS
    history = _velocity_history(ev.transactions(spark, sf_dir))
    newer = F.col("event_timestamp") > F.lit(_START)
    fs.push(view, history.filter(newer), base, 0)
    fs.push(view, history.filter(~newer), base, 1)
    return fs.read_online(view, spark, base).select(
        "user_id", "txn_count_24h", F.unix_micros("event_timestamp").alias("at_us")
    )


@register(
    "materialized_view",
    with_parts(
        f"""SELECT user_id, txn_count_24h, epoch_us(event_time) AS at_us FROM ({_latest_sql(f"event_time <= {_AS_OF_SQL}")})""", "velocity"
    ),
)
def materialized_view(spark, sf_dir):
    """The online view kept by two runs, the second of which fails before it remembers its end and is repeated; rows
    of a third of the users come late, after the first run."""
    base, view = scratch_path(spark, "materialized"), fs.USER_TRANSACTION_STATS
    history = cut_lineage(_velocity_history(ev.transactions(spark, sf_dir)))
    late = F.xxhash64("user_id") % 3 == 0
    wait = dt.timedelta(days=60)
    fs.materialize_until(view, history.filter(~late), base, _START, wait)
    fs.push(view, view.conform(history).filter(F.col("event_timestamp") <= F.lit(_AS_OF)), base, 1)  # and no end is remembered
    fs.materialize_until(view, history, base, _AS_OF, wait)
    return fs.read_online(view, spark, base).select(
        "user_id", "txn_count_24h", F.unix_micros("event_timestamp").alias("at_us")
    )


_FOLDED = """
    SELECT user_id, count(*) AS n, round(sum(amount), 4) AS spent, k % 8 AS batch FROM txns GROUP BY user_id, k % 8"""


def _last_batch_sql(stage: str, condition: str) -> str:
    return f"""SELECT '{stage}' AS stage, user_id, n, spent FROM (
      SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY batch DESC) AS r FROM ({_FOLDED}) WHERE {condition}) WHERE r = 1"""


@register(
    "folded_table",
    with_parts(
        " UNION ALL ".join([_last_batch_sql("batches", "batch < 5"), _last_batch_sql("folded", "batch < 5"), _last_batch_sql("folded again", "true")]),
        "txns",
    ),
)
def folded_table(spark, sf_dir):
    """A keyed table in eight batches: read from its batches, after a fold, and after more batches and another fold."""
    path = scratch_path(spark, "folded")
    totals = ev.transactions(spark, sf_dir).groupBy("user_id", (F.col("k") % 8).alias("batch")).agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("amount"), 4).alias("spent")
    )

    def told(stage: str) -> DataFrame:
        # Stored, since the next fold deletes what this read is made of.
        current = lake.read_current(spark, path, "user_id").select(F.lit(stage).alias("stage"), "user_id", "n", "spent")
        return cut_lineage(current)

    for batch in range(5):
        lake.upsert(totals.filter(F.col("batch") == batch).drop("batch"), path, batch)
    stages = [told("batches")]
    snapshots.fold(spark, path, "user_id")
    stages.append(told("folded"))
    for batch in range(5, 8):
        lake.upsert(totals.filter(F.col("batch") == batch).drop("batch"), path, batch)
    snapshots.fold(spark, path, "user_id", keep=1)
    stages.append(told("folded again"))
    return stages[0].unionByName(stages[1]).unionByName(stages[2])


@register(
    "exported_features",
    with_parts(
        """SELECT user_id, round(avg_txn_amount_30d, 6) AS avg_txn_amount_30d, txn_count_30d,
                  round(country_risk, 6) AS country_risk FROM behavior""",
        "behavior",
    ),
)
def exported_features(spark, sf_dir):
    """The behavioural profile exported for offline use, and read there."""
    path = scratch_path(spark, "offline")
    profile = behavioral.behavioral_features(ev.transactions(spark, sf_dir))
    lake.export_offline_features(profile.withColumn("event_timestamp", F.lit(_AS_OF)), path)
    out = spark.read.parquet(path).select("user_id", "avg_txn_amount_30d", "txn_count_30d", "country_risk")
    return rounded(out, 6, "avg_txn_amount_30d", "country_risk")
