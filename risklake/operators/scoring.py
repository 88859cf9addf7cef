"""Four explainable rule sets, each giving a verdict on an enriched transaction.

A score is the sum of the points of the rules that fire, added in the order listed, so
that a total just at a level's limit comes out the same everywhere. A NULL feature fires
nothing, except a missing ``device_seen_before``, which counts as not seen.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from risklake.config import AGENTS, ScoringConfig
from risklake.functions.scalars import fixed, risk_level, stable_id

Rule = tuple[Column, float, Column]  # condition, points, message

NOTHING_FOUND = {
    "velocity": "No velocity anomalies detected.",
    "geolocation": "No geolocation anomalies detected.",
    "behavioral": "Behaviour consistent with history.",
    "network": "No network anomalies detected.",
}
FEATURES_USED = {
    "velocity": ("txn_count_1h", "txn_count_24h", "amount_sum_1h", "amount_sum_24h"),
    "geolocation": ("distance_from_last_txn_km", "is_new_country", "is_new_city", "country_code"),
    "behavioral": (
        "avg_txn_amount_30d", "amount_deviation_score", "hour_of_day_risk_score",
        "merchant_category_code",
    ),
    "network": ("ip_fraud_score", "device_seen_before", "linked_fraud_accounts"),
}
VERDICT_COLUMNS = (
    "agent_type", "risk_score", "risk_level", "confidence", "reasoning", "features_used", "latency_ms",
)


def _text(*parts: str | Column) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def _velocity_rules(df: DataFrame, cfg: ScoringConfig) -> list[Rule]:
    c = F.col
    daily_average = c("avg_txn_amount_30d") * cfg.hours_per_average
    rules = [
        (
            c("txn_count_1h") > cfg.count_1h, cfg.count_1h_points,
            _text("High hourly velocity: ", c("txn_count_1h"), " txns/hour"),
        ),
        (
            c("txn_count_24h") > cfg.count_24h, cfg.count_24h_points,
            _text("High daily velocity: ", c("txn_count_24h"), " txns/24h"),
        ),
        (
            (c("avg_txn_amount_30d") > 0)
            & (c("amount_sum_1h") > daily_average * cfg.spend_multiple),
            cfg.spend_points,
            _text(
                "Hourly spend ", fixed(c("amount_sum_1h"), 2), " is >3x average (",
                fixed(daily_average, 2), ")",
            ),
        ),
    ]
    # Documented signals, scored only where their columns have been computed.
    if "same_merchant_count_1h" in df.columns:
        rules.append(
            (
                c("same_merchant_count_1h") > cfg.same_merchant_1h, cfg.same_merchant_points,
                _text("Repeated merchant: ", c("same_merchant_count_1h"), " txns/hour"),
            )
        )
    if "burst_per_minute" in df.columns:
        rules.append(
            (
                c("burst_per_minute") > cfg.burst_per_minute, cfg.burst_points,
                _text("Burst: ", fixed(c("burst_per_minute"), 1), " txns/min"),
            )
        )
    return rules


def _geolocation_rules(df: DataFrame, cfg: ScoringConfig) -> list[Rule]:
    c = F.col
    return [
        (
            c("distance_from_last_txn_km") > cfg.distance_km, cfg.distance_points,
            _text(
                "Large location jump: ", fixed(c("distance_from_last_txn_km"), 1),
                " km from last transaction",
            ),
        ),
        (
            c("is_new_country"), cfg.new_country_points,
            _text("First transaction in country: ", c("country_code")),
        ),
        (c("is_new_city"), cfg.new_city_points, _text("First transaction in city: ", c("city"))),
        (
            c("country_code").isin(*cfg.high_risk_countries) if cfg.high_risk_countries else F.lit(False),
            cfg.high_risk_country_points,
            _text("High-risk country code: ", c("country_code")),
        ),
    ]


def _behavioral_rules(df: DataFrame, cfg: ScoringConfig) -> list[Rule]:
    c = F.col
    deviation = c("amount_deviation_score")
    has_average = c("avg_txn_amount_30d") > 0
    opening = _text("Amount ", fixed(c("amount"), 2), " is ", fixed(deviation, 1), "σ above 30d average")
    return [
        (
            has_average & (deviation > cfg.deviation_high), cfg.deviation_high_points,
            _text(opening, " (", fixed(c("avg_txn_amount_30d"), 2), ")"),
        ),
        (
            has_average & (deviation > cfg.deviation_mid) & ~(deviation > cfg.deviation_high),
            cfg.deviation_mid_points, opening,
        ),
        (
            c("hour_of_day_risk_score") > cfg.night_ratio, cfg.night_points,
            _text(
                "Unusual transaction hour (risk score: ", fixed(c("hour_of_day_risk_score"), 2), ")"
            ),
        ),
        (
            c("merchant_category_code").isin(*cfg.high_risk_categories), cfg.category_points,
            _text("High-risk merchant category: ", c("merchant_category_code")),
        ),
    ]


def _network_rules(df: DataFrame, cfg: ScoringConfig) -> list[Rule]:
    c = F.col
    ip, linked = c("ip_fraud_score"), c("linked_fraud_accounts")
    return [
        (
            ip > cfg.ip_high, cfg.ip_high_points,
            _text("High-risk IP (score: ", fixed(ip, 2), ")"),
        ),
        (
            (ip > cfg.ip_mid) & ~(ip > cfg.ip_high), cfg.ip_mid_points,
            _text("Suspicious IP (score: ", fixed(ip, 2), ")"),
        ),
        (
            ~F.coalesce(c("device_seen_before"), F.lit(False)), cfg.new_device_points,
            F.lit("First-time device fingerprint for this user"),
        ),
        (
            linked > cfg.linked_high, cfg.linked_high_points,
            _text("Device/IP linked to ", linked, " known-fraud accounts"),
        ),
        (
            (linked > cfg.linked_any) & ~(linked > cfg.linked_high), cfg.linked_any_points,
            _text("Device/IP linked to ", linked, " suspicious account(s)"),
        ),
    ]


_RULES = {
    "velocity": _velocity_rules,
    "geolocation": _geolocation_rules,
    "behavioral": _behavioral_rules,
    "network": _network_rules,
}


def risk_score(df: DataFrame, agent: str, cfg: ScoringConfig = ScoringConfig()) -> Column:
    points = [F.when(fires, F.lit(float(p))).otherwise(0.0) for fires, p, _ in _RULES[agent](df, cfg)]
    return F.least(reduce(lambda total, p: total + p, points, F.lit(0.0)), F.lit(1.0))


def latency(df: DataFrame) -> Column:
    """``latency_ms`` of ``df`` where it has such a column: a set-based job has no time per
    row to measure."""
    return F.col("latency_ms").cast("double") if "latency_ms" in df.columns else F.lit(0.0)


def verdict(
    df: DataFrame, agent: str, cfg: ScoringConfig = ScoringConfig(), score: Column | None = None
) -> Column:
    """One agent's verdict as a struct column; ``score`` if it has been computed before."""
    score = risk_score(df, agent, cfg) if score is None else score
    messages = F.concat_ws(
        "; ", *[F.when(fires, F.coalesce(m, F.lit(""))) for fires, _, m in _RULES[agent](df, cfg)]
    )
    return F.struct(
        F.lit(agent).alias("agent_type"),
        score.alias("risk_score"),
        risk_level(score).alias("risk_level"),
        F.lit(cfg.confidence[agent]).alias("confidence"),
        F.when(messages == "", NOTHING_FOUND[agent]).otherwise(messages).alias("reasoning"),
        F.array(*[F.lit(f) for f in FEATURES_USED[agent]]).alias("features_used"),
        latency(df).alias("latency_ms"),
    )


def _score(enriched: DataFrame, agent: str, cfg: ScoringConfig) -> DataFrame:
    return enriched.select("transaction_id", verdict(enriched, agent, cfg).alias("_v")).select(
        "transaction_id", "_v.*"
    )


def score_velocity(enriched: DataFrame, cfg: ScoringConfig = ScoringConfig()) -> DataFrame:
    return _score(enriched, "velocity", cfg)


def score_geolocation(enriched: DataFrame, cfg: ScoringConfig = ScoringConfig()) -> DataFrame:
    return _score(enriched, "geolocation", cfg)


def score_behavioral(enriched: DataFrame, cfg: ScoringConfig = ScoringConfig()) -> DataFrame:
    return _score(enriched, "behavioral", cfg)


def score_network(enriched: DataFrame, cfg: ScoringConfig = ScoringConfig()) -> DataFrame:
    return _score(enriched, "network", cfg)


def with_scores(enriched: DataFrame, cfg: ScoringConfig = ScoringConfig()) -> DataFrame:
    """Add ``_score_<agent>``: plain numbers, so that whoever needs only these pays only for these."""
    return enriched.withColumns({f"_score_{a}": risk_score(enriched, a, cfg) for a in AGENTS})


def with_verdicts(enriched: DataFrame, cfg: ScoringConfig = ScoringConfig()) -> DataFrame:
    """Add ``verdicts``, the four agents' verdicts in their fixed order. No shuffle."""
    scored = with_scores(enriched, cfg)
    given = F.array(*[verdict(scored, a, cfg, F.col(f"_score_{a}")) for a in AGENTS])
    return scored.withColumn("verdicts", given).drop(*[f"_score_{a}" for a in AGENTS])


def score_all(enriched: DataFrame, cfg: ScoringConfig = ScoringConfig()) -> DataFrame:
    """Four verdict rows per transaction, from one pass over the input."""
    # The list is never empty, so "outer" changes no row; it keeps the optimizer from
    # filtering on the size of the list, that is on all the rules, which is slow to plan.
    return with_verdicts(enriched, cfg).select("transaction_id", F.inline_outer("verdicts"))


def verdict_rows(enriched: DataFrame, cfg: ScoringConfig = ScoringConfig()) -> DataFrame:
    """``score_all`` with what a verdict needs on its way: ``verdict_id``, the same on every attempt, and the
    transaction's ``event_time``, also as the text ``timestamp``."""
    given = with_verdicts(enriched, cfg).select("transaction_id", "event_time", F.inline_outer("verdicts"))
    return given.withColumns({
        "verdict_id": stable_id(F.lit("verdict"), F.col("transaction_id"), F.col("agent_type")),
        "timestamp": F.date_format("event_time", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"),
    })
