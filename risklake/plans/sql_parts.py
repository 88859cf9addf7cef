"""Named pieces of the check SQL, put together by ``with_parts``."""

from __future__ import annotations

from risklake.config import (
    AGENTS, COUNTRY_RISK, DEFAULT_COUNTRY_RISK, EARTH_RADIUS_KM, HIGH_RISK_CATEGORIES,
    DecisionConfig, ScoringConfig,
)
from risklake.operators.scoring import NOTHING_FOUND
from risklake.sources.events import K_SQL, TRANSACTION_SQL

# The generic events are too sparse for the default limits to fire; the registered
# queries use lower ones so that every rule is exercised.
SCORING = ScoringConfig(
    count_1h=1, count_24h=5, hours_per_average=1, spend_multiple=2,
    deviation_mid=1.0, deviation_high=1.5, night_ratio=0.28, ip_mid=0.4, ip_high=0.7, linked_high=1,
)
DECIDING = DecisionConfig(review_from=0.25, decline_at=0.45, critical_at=0.6)


def _in(codes) -> str:
    return "(" + ", ".join(f"'{c}'" for c in codes) + ")"


def distance_sql(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    h = (
        f"(power(sin(radians({lat2} - {lat1}) / 2), 2) + cos(radians({lat1})) * cos(radians({lat2})) "
        f"* power(sin(radians({lon2} - {lon1}) / 2), 2))"
    )
    return f"2 * CAST({EARTH_RADIUS_KM} AS DOUBLE) * asin(sqrt(CASE WHEN {h} > 1 THEN 1.0 ELSE {h} END))"


def _fixed(value: str, digits: int) -> str:
    return f"printf('%.{digits}f', round(CAST({value} AS DOUBLE), {digits}))"


def _rules() -> dict[str, list[tuple[str, float, str]]]:
    c = SCORING
    daily = f"(avg_txn_amount_30d * {c.hours_per_average})"
    dev, ip, linked = "amount_deviation_score", "ip_fraud_score", "linked_fraud_accounts"
    amount = f"'Amount ' || {_fixed('amount', 2)} || ' is ' || {_fixed(dev, 1)} || 'σ above 30d average'"
    return {
        "velocity": [
            (f"txn_count_1h > {c.count_1h}", c.count_1h_points,
             "'High hourly velocity: ' || txn_count_1h || ' txns/hour'"),
            (f"txn_count_24h > {c.count_24h}", c.count_24h_points,
             "'High daily velocity: ' || txn_count_24h || ' txns/24h'"),
            (f"avg_txn_amount_30d > 0 AND amount_sum_1h > {daily} * {c.spend_multiple}", c.spend_points,
             f"'Hourly spend ' || {_fixed('amount_sum_1h', 2)} || ' is >3x average (' || {_fixed(daily, 2)} || ')'"),
        ],
        "geolocation": [
            (f"distance_from_last_txn_km > {c.distance_km}", c.distance_points,
             f"'Large location jump: ' || {_fixed('distance_from_last_txn_km', 1)} || ' km from last transaction'"),
            ("is_new_country", c.new_country_points, "'First transaction in country: ' || country_code"),
            ("is_new_city", c.new_city_points, "'First transaction in city: ' || city"),
        ],
        "behavioral": [
            (f"avg_txn_amount_30d > 0 AND {dev} > {c.deviation_high}", c.deviation_high_points,
             f"{amount} || ' (' || {_fixed('avg_txn_amount_30d', 2)} || ')'"),
            (f"avg_txn_amount_30d > 0 AND {dev} > {c.deviation_mid} AND NOT {dev} > {c.deviation_high}",
             c.deviation_mid_points, amount),
            (f"hour_of_day_risk_score > {c.night_ratio}", c.night_points,
             f"'Unusual transaction hour (risk score: ' || {_fixed('hour_of_day_risk_score', 2)} || ')'"),
            (f"merchant_category_code IN {_in(c.high_risk_categories)}", c.category_points,
             "'High-risk merchant category: ' || merchant_category_code"),
        ],
        "network": [
            (f"{ip} > {c.ip_high}", c.ip_high_points, f"'High-risk IP (score: ' || {_fixed(ip, 2)} || ')'"),
            (f"{ip} > {c.ip_mid} AND NOT {ip} > {c.ip_high}", c.ip_mid_points,
             f"'Suspicious IP (score: ' || {_fixed(ip, 2)} || ')'"),
            ("NOT coalesce(device_seen_before, false)", c.new_device_points,
             "'First-time device fingerprint for this user'"),
            (f"{linked} > {c.linked_high}", c.linked_high_points,
             f"'Device/IP linked to ' || {linked} || ' known-fraud accounts'"),
            (f"{linked} > {c.linked_any} AND NOT {linked} > {c.linked_high}", c.linked_any_points,
             f"'Device/IP linked to ' || {linked} || ' suspicious account(s)'"),
        ],
    }


def _agent_select(agent: str) -> str:
    rules = _rules()[agent]
    total = "CAST(0 AS DOUBLE)" + "".join(
        f" + CASE WHEN {cond} THEN CAST({points} AS DOUBLE) ELSE CAST(0 AS DOUBLE) END"
        for cond, points, _ in rules
    )
    messages = ", ".join(f"CASE WHEN {cond} THEN {text} END" for cond, _, text in rules)
    return f"""
    SELECT transaction_id, '{agent}' AS agent_type, risk_score,
           CASE WHEN risk_score >= 0.75 THEN 'critical' WHEN risk_score >= 0.5 THEN 'high'
                WHEN risk_score >= 0.25 THEN 'medium' ELSE 'low' END AS risk_level,
           CAST({SCORING.confidence[agent]} AS DOUBLE) AS confidence,
           CASE WHEN said = '' THEN '{NOTHING_FOUND[agent]}' ELSE said END AS reasoning,
           latency_ms
    FROM (SELECT transaction_id, latency_ms, least({total}, CAST(1 AS DOUBLE)) AS risk_score,
                 concat_ws('; ', {messages}) AS said FROM enriched)"""


_D = DECIDING
_WEIGHTED = "CAST(0 AS DOUBLE)" + "".join(
    f" + {a} * CAST({_D.weights[a]} AS DOUBLE)" for a in AGENTS
)
_WEIGHTS = "CAST(0 AS DOUBLE)" + "".join(f" + CAST({_D.weights[a]} AS DOUBLE)" for a in AGENTS)
_LISTED = " || ', ' || ".join(f"'{a}: ' || {_fixed(a, 3)}" for a in AGENTS)

PARTS: dict[str, str] = {
    "txns": "SELECT " + ", ".join(f"{sql} AS {n}" for n, sql in TRANSACTION_SQL.items())
    + f" FROM (SELECT *, {K_SQL} AS k FROM events) AS e",
    "velocity": """
    SELECT *, count(*) OVER h AS txn_count_1h, coalesce(sum(amount) OVER h, 0) AS amount_sum_1h,
           count(*) OVER d AS txn_count_24h, coalesce(sum(amount) OVER d, 0) AS amount_sum_24h,
           count(DISTINCT merchant_id) OVER h AS unique_merchants_1h
    FROM txns WINDOW
      h AS (PARTITION BY user_id ORDER BY event_time
            RANGE BETWEEN INTERVAL 1 HOUR PRECEDING AND INTERVAL 1 MICROSECOND PRECEDING),
      d AS (PARTITION BY user_id ORDER BY event_time
            RANGE BETWEEN INTERVAL 24 HOUR PRECEDING AND INTERVAL 1 MICROSECOND PRECEDING)""",
    "steps": """
    SELECT *, lag(latitude) OVER u AS lat0, lag(longitude) OVER u AS lon0, lag(country_code) OVER u AS country0,
           lag(event_time) OVER u AS time0,
           min(event_time) OVER (PARTITION BY user_id, country_code) AS country_first,
           min(event_time) OVER (PARTITION BY user_id, city) AS city_first
    FROM txns WINDOW u AS (PARTITION BY user_id ORDER BY event_time, transaction_id)""",
    "geo": f"""
    SELECT transaction_id, lat0 AS last_txn_latitude, lon0 AS last_txn_longitude, country0 AS last_country_code,
           {distance_sql('lat0', 'lon0', 'latitude', 'longitude')} AS distance_from_last_txn_km,
           (epoch_us(event_time) - epoch_us(time0)) / CAST(3600000000 AS DOUBLE) AS hours,
           time0 IS NOT NULL AND event_time = country_first AS is_new_country,
           time0 IS NOT NULL AND event_time = city_first AS is_new_city
    FROM steps""",
    "links": """
    SELECT u.device_fingerprint, u.user_id, greatest(used, labelled) AS link_time
    FROM (SELECT device_fingerprint, user_id, min(event_time) AS used FROM txns GROUP BY ALL) u
    JOIN (SELECT user_id, min(event_time) AS labelled FROM txns WHERE is_fraud GROUP BY ALL) f
      ON u.user_id = f.user_id""",
    "device": """
    SELECT t.transaction_id, any_value(seen) AS device_seen_before, count(l.user_id) AS linked_fraud_accounts
    FROM (SELECT *, min(event_time) OVER (PARTITION BY device_fingerprint) < event_time AS seen FROM txns) t
    LEFT JOIN links l ON l.device_fingerprint = t.device_fingerprint AND l.user_id <> t.user_id
                     AND l.link_time < t.event_time
    GROUP BY t.transaction_id""",
    "addresses": """
    SELECT ip_address, max(address_score) AS ip_fraud_score, max(k) >= 97 AS is_vpn, max(k) >= 99 AS is_tor
    FROM txns GROUP BY ip_address""",
    "top_mcc": """
    SELECT user_id, merchant_category_code AS top_mcc, mcc_freq FROM (
      SELECT user_id, merchant_category_code, count(*) AS mcc_freq,
             row_number() OVER (PARTITION BY user_id ORDER BY count(*) DESC, merchant_category_code) AS r
      FROM txns GROUP BY user_id, merchant_category_code) WHERE r = 1""",
    "country_risk": "SELECT * FROM (VALUES "
    + ", ".join(f"('{c}', CAST(CAST({r} AS FLOAT) AS DOUBLE))" for c, r in COUNTRY_RISK)
    + ") AS x(code, risk)",
    "behavior": f"""
    SELECT s.user_id, avg_txn_amount_30d, stddev_txn_amount_30d,
           CASE WHEN stddev_txn_amount_30d > 0
                THEN abs((last_amount - avg_txn_amount_30d) / stddev_txn_amount_30d) ELSE 0 END
             AS amount_deviation_score,
           night / n AS hour_of_day_risk_score, top_mcc, n AS txn_count_30d,
           risky / n AS high_risk_mcc_ratio, last_country AS last_country_code,
           coalesce(risk, {DEFAULT_COUNTRY_RISK}) AS country_risk
    FROM (SELECT user_id, avg(amount) AS avg_txn_amount_30d,
                 coalesce(stddev_samp(amount), 0) AS stddev_txn_amount_30d, count(*) AS n,
                 arg_max(amount, event_time) AS last_amount, arg_max(country_code, event_time) AS last_country,
                 CAST(count(*) FILTER (hour(event_time) BETWEEN 0 AND 5) AS DOUBLE) AS night,
                 CAST(count(*) FILTER (merchant_category_code IN {_in(HIGH_RISK_CATEGORIES)}) AS DOUBLE) AS risky
          FROM txns GROUP BY user_id) s
    JOIN top_mcc m ON m.user_id = s.user_id LEFT JOIN country_risk c ON c.code = s.last_country""",
    "enriched": """
    SELECT v.*, coalesce(g.distance_from_last_txn_km, 0) AS distance_from_last_txn_km,
           g.is_new_country, g.is_new_city, b.avg_txn_amount_30d, b.amount_deviation_score,
           b.hour_of_day_risk_score, a.ip_fraud_score, d.device_seen_before, d.linked_fraud_accounts
    FROM velocity v JOIN geo g ON g.transaction_id = v.transaction_id
    JOIN device d ON d.transaction_id = v.transaction_id
    JOIN behavior b ON b.user_id = v.user_id JOIN addresses a ON a.ip_address = v.ip_address""",
    **{f"score_{a}": _agent_select(a) for a in AGENTS},
    "verdicts": " UNION ALL ".join(f"SELECT * FROM score_{a}" for a in AGENTS),
    "scores": "SELECT transaction_id, sum(latency_ms) AS total_latency_ms, "
    + ", ".join(f"max(risk_score) FILTER (agent_type = '{a}') AS {a}" for a in AGENTS)
    + " FROM verdicts GROUP BY transaction_id",
    "decisions": f"""
    SELECT d.transaction_id, final_risk_score, action,
           CASE WHEN final_risk_score >= {_D.critical_at} THEN 'critical' WHEN action = 'decline' THEN 'high'
                WHEN action = 'review' THEN 'medium' ELSE 'low' END AS risk_level,
           'Agent scores — ' || {_LISTED} || ' | Weighted score: ' || {_fixed('final_risk_score', 4)}
             || ' → action: ' || action AS reasoning,
           total_latency_ms, mean_score,
           mean_score >= {_D.review_from} AND mean_score < {_D.decline_at} AS needs_explanation,
           md5('decision|' || d.transaction_id) AS decision_id,
           t.event_time, t.country_code, t.merchant_category_code, t.user_id
    FROM (SELECT *, CASE WHEN final_risk_score >= {_D.decline_at} THEN 'decline'
                         WHEN final_risk_score >= {_D.review_from} THEN 'review' ELSE 'approve' END AS action
          FROM (SELECT *, round(least(({_WEIGHTED}) / ({_WEIGHTS}), CAST(1 AS DOUBLE)), 4) AS final_risk_score,
                       (velocity + geolocation + behavioral + network) / 4 AS mean_score
                FROM scores)) d
    JOIN txns t ON t.transaction_id = d.transaction_id""",
}

NEEDS: dict[str, tuple[str, ...]] = {
    "txns": (), "velocity": ("txns",), "steps": ("txns",), "geo": ("steps",), "links": ("txns",),
    "device": ("links",), "addresses": ("txns",), "top_mcc": ("txns",), "country_risk": (),
    "behavior": ("txns", "top_mcc", "country_risk"),
    "enriched": ("velocity", "geo", "device", "behavior", "addresses"),
    **{f"score_{a}": ("enriched",) for a in AGENTS},
    "verdicts": tuple(f"score_{a}" for a in AGENTS),
    "scores": ("verdicts",), "decisions": ("scores", "txns"),
}


def with_parts(body: str, *parts: str, instead: dict[str, tuple[str, tuple[str, ...]]] | None = None) -> str:
    """``body`` preceded by the WITH clause of the parts it needs, in order. ``instead`` replaces
    parts, or adds some: name -> (SQL, parts that it needs)."""
    known = {p: (sql, NEEDS[p]) for p, sql in PARTS.items()} | (instead or {})
    ordered: list[str] = []

    def visit(part: str) -> None:
        for need in known[part][1]:
            visit(need)
        if part not in ordered:
            ordered.append(part)

    for part in parts:
        visit(part)
    clauses = ", ".join(f"{p} AS MATERIALIZED ({known[p][0]})" for p in ordered)
    return f"WITH {clauses} {body}"
