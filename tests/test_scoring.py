"""Every limit of every rule, as rows of one DataFrame per rule set."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from risklake import schemas
from risklake.config import AGENTS, DecisionConfig, ScoringConfig
from risklake.operators import decisions, scoring

CLEAN = {
    "transaction_id": "t", "user_id": "user_12345", "merchant_id": "merchant_999", "amount": 49.99,
    "merchant_category_code": "5411", "country_code": "US", "city": "New York",
    "txn_count_1h": 2, "txn_count_24h": 5, "amount_sum_1h": 100.0, "amount_sum_24h": 250.0,
    "avg_txn_amount_30d": 55.0, "amount_deviation_score": 0.5, "hour_of_day_risk_score": 0.1,
    "ip_fraud_score": 0.05, "device_seen_before": True, "linked_fraud_accounts": 0,
    "distance_from_last_txn_km": 2.5, "is_new_country": False, "is_new_city": False,
}
SCHEMA = (
    "transaction_id string, user_id string, merchant_id string, amount double, merchant_category_code string, "
    "country_code string, city string, txn_count_1h long, txn_count_24h long, amount_sum_1h double, "
    "amount_sum_24h double, avg_txn_amount_30d double, amount_deviation_score double, "
    "hour_of_day_risk_score double, ip_fraud_score double, device_seen_before boolean, "
    "linked_fraud_accounts long, distance_from_last_txn_km double, is_new_country boolean, is_new_city boolean"
)
D, H, A, M = "amount_deviation_score", "hour_of_day_risk_score", "avg_txn_amount_30d", "merchant_category_code"
KM, NEW_COUNTRY, NEW_CITY = "distance_from_last_txn_km", "is_new_country", "is_new_city"
IP, SEEN, LINKED = "ip_fraud_score", "device_seen_before", "linked_fraud_accounts"

CASES = {
    "behavioral": [
        ({}, 0.0, "low", "Behaviour consistent with history."),
        ({D: 3.5}, 0.35, "medium", "Amount 49.99 is 3.5σ above 30d average (55.00)"),
        ({D: 3.0}, 0.15, "low", "Amount 49.99 is 3.0σ above 30d average"),
        ({D: 2.5}, 0.15, "low", None), ({D: 2.0}, 0.0, "low", None), ({D: 1.9}, 0.0, "low", None),
        ({A: None, D: 5.0}, 0.0, "low", None), ({A: 0.0, D: 5.0}, 0.0, "low", None), ({D: None}, 0.0, "low", None),
        ({H: 0.9}, 0.20, "low", "Unusual transaction hour (risk score: 0.90)"),
        ({H: 0.7}, 0.0, "low", None), ({H: None}, 0.0, "low", None),
        *[({M: c}, 0.20, "low", f"High-risk merchant category: {c}") for c in ("5912", "7995", "6051", "4829", "6211", "5999")],
        ({M: None}, 0.0, "low", None),
        ({D: 4.0, H: 0.9}, 0.55, "high", None),
        ({D: 4.0, H: 0.9, M: "7995"}, 0.75, "critical", None),
    ],
    "geolocation": [
        ({}, 0.0, "low", "No geolocation anomalies detected."),
        ({KM: 8000.0}, 0.40, "medium", "Large location jump: 8000.0 km from last transaction"),
        ({KM: 500.0}, 0.0, "low", None), ({KM: 499.9}, 0.0, "low", None), ({KM: None}, 0.0, "low", None),
        ({NEW_COUNTRY: True}, 0.25, "medium", "First transaction in country: US"),
        ({NEW_CITY: True}, 0.10, "low", "First transaction in city: New York"),
        ({NEW_COUNTRY: None, NEW_CITY: None}, 0.0, "low", None),
        ({KM: 8000.0, NEW_COUNTRY: True}, 0.65, "high", None),
        ({KM: 8000.0, NEW_COUNTRY: True, NEW_CITY: True}, 0.75, "critical", None),
    ],
    "network": [
        ({}, 0.0, "low", "No network anomalies detected."),
        ({IP: 0.95}, 0.40, "medium", "High-risk IP (score: 0.95)"), ({IP: 0.8}, 0.20, "low", "Suspicious IP (score: 0.80)"),
        ({IP: 0.65}, 0.20, "low", None), ({IP: 0.5}, 0.0, "low", None), ({IP: None}, 0.0, "low", None),
        ({SEEN: False}, 0.15, "low", "First-time device fingerprint for this user"),
        ({SEEN: None}, 0.15, "low", "First-time device fingerprint for this user"),
        ({LINKED: 4}, 0.40, "medium", "Device/IP linked to 4 known-fraud accounts"),
        ({LINKED: 3}, 0.20, "low", "Device/IP linked to 3 suspicious account(s)"),
        ({LINKED: 2}, 0.20, "low", None), ({LINKED: 1}, 0.20, "low", None), ({LINKED: None}, 0.0, "low", None),
        ({IP: 0.95, SEEN: False}, 0.55, "high", None),
        ({IP: 0.95, SEEN: False, LINKED: 5}, 0.95, "critical",
         "High-risk IP (score: 0.95); First-time device fingerprint for this user; Device/IP linked to 5 known-fraud accounts"),
    ],
    "velocity": [
        ({}, 0.0, "low", "No velocity anomalies detected."),
        ({"txn_count_1h": 15}, 0.30, "medium", "High hourly velocity: 15 txns/hour"),
        ({"txn_count_1h": 10}, 0.0, "low", None),
        ({"txn_count_24h": 51}, 0.15, "low", "High daily velocity: 51 txns/24h"), ({"txn_count_24h": 50}, 0.0, "low", None),
        ({"amount_sum_1h": 3960.01}, 0.25, "medium", "Hourly spend 3960.01 is >3x average (1320.00)"),
        ({"amount_sum_1h": 3960.0}, 0.0, "low", None), ({"amount_sum_1h": 1e6, A: None}, 0.0, "low", None),
        ({"amount_sum_1h": 1e6, A: 0.0}, 0.0, "low", None),
        ({"txn_count_1h": 15, "txn_count_24h": 60, "amount_sum_1h": 5000.0}, 0.70, "high", None),
    ],
}
SCORERS = {
    "behavioral": scoring.score_behavioral, "geolocation": scoring.score_geolocation,
    "network": scoring.score_network, "velocity": scoring.score_velocity,
}


def enriched(spark, overrides):
    rows = [{**CLEAN, "transaction_id": f"{i:03d}", **o} for i, o in enumerate(overrides)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.mark.parametrize("agent", AGENTS)
def test_limits(spark, agent):
    cases = CASES[agent]
    out = SCORERS[agent](enriched(spark, [c[0] for c in cases])).orderBy("transaction_id").collect()
    confidence = {"velocity": 0.85, "geolocation": 0.80, "behavioral": 0.82, "network": 0.88}[agent]
    for (override, score, level, text), row in zip(cases, out):
        assert row["risk_score"] == pytest.approx(score), override
        assert row["risk_level"] == level, override
        assert row["agent_type"] == agent and row["confidence"] == confidence
        assert tuple(row["features_used"]) == scoring.FEATURES_USED[agent]
        if text is not None:
            assert row["reasoning"] == text


def test_high_risk_row_and_country_list(spark):
    high = {"txn_count_1h": 15, D: 4.5, IP: 0.95, LINKED: 5, KM: 8000.0, NEW_COUNTRY: True}
    by_agent = {r["agent_type"]: r for r in scoring.score_all(enriched(spark, [high])).collect()}
    assert [by_agent[a]["risk_score"] for a in AGENTS] == pytest.approx([0.30, 0.65, 0.35, 0.80])
    listed = scoring.score_geolocation(enriched(spark, [{}]), ScoringConfig(high_risk_countries=("US",))).first()
    assert (listed["risk_score"], listed["reasoning"]) == (pytest.approx(0.2), "High-risk country code: US")


def test_documented_signals_score_where_computed(spark):
    df = enriched(spark, [{}]).withColumns(
        {"same_merchant_count_1h": F.lit(6), "burst_per_minute": F.lit(5.2)}
    )
    row = scoring.score_velocity(df).first()
    assert row["risk_score"] == pytest.approx(0.45)
    assert row["reasoning"] == "Repeated merchant: 6 txns/hour; Burst: 5.2 txns/min"


def test_score_all_equals_single_scorers_and_has_no_shuffle_or_python(spark):
    df = enriched(spark, [c[0] for a in AGENTS for c in CASES[a]])
    together = scoring.score_all(df)
    single = SCORERS["velocity"](df)
    for a in AGENTS[1:]:
        single = single.unionByName(SCORERS[a](df))
    key = ["transaction_id", "agent_type", "risk_score", "reasoning"]
    assert sorted(map(tuple, together.select(key).collect())) == sorted(map(tuple, single.select(key).collect()))
    plan = decisions.decide(scoring.with_verdicts(df))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan


def verdict_rows(spark, scores, extra=()):
    """scores: {transaction: {agent: score}}"""
    rows = [(t, a, s, f"r {a}", 10.0) for t, by in scores.items() for a, s in by.items()] + list(extra)
    return spark.createDataFrame(rows, "transaction_id string, agent_type string, risk_score double, reasoning string, latency_ms double").withColumn("at", F.lit(0))


def all_four(score):
    return dict.fromkeys(AGENTS, score)


def test_decision_bands(spark):
    scores = {"a": all_four(0.1), "b": all_four(0.55), "c": all_four(0.9), "d": all_four(1.0), "e": all_four(0.75),
              "f": all_four(0.4), "g": {"velocity": 1.0, "geolocation": 0.0, "behavioral": 0.5, "network": 0.2}}
    out = decisions.decide(decisions.collect_verdicts(verdict_rows(spark, scores), "at"))
    got = {r["transaction_id"]: r for r in out.collect()}
    assert {t: (r["action"], r["risk_level"], r["final_risk_score"]) for t, r in got.items()} == {
        "a": ("approve", "low", 0.1), "b": ("review", "medium", 0.55), "c": ("decline", "critical", 0.9),
        "d": ("decline", "critical", 1.0), "e": ("decline", "high", 0.75), "f": ("review", "medium", 0.4),
        "g": ("review", "medium", 0.4),
    }
    assert got["g"]["reasoning"] == (
        "Agent scores — velocity: 1.000, geolocation: 0.000, behavioral: 0.500, network: 0.200"
        " | Weighted score: 0.4000 → action: review"
    )
    assert got["a"]["total_latency_ms"] == 40.0
    assert [got[t]["needs_explanation"] for t in "abcdefg"] == [False, True, False, False, False, True, True]


def test_incomplete_duplicate_and_unknown_verdicts(spark):
    scores = {"full": all_four(0.2), "three": {a: 0.9 for a in AGENTS[:3]}}
    copies = [("three", "velocity", 0.9, "r velocity", 10.0)] * 5 + [("three", "supervisor", 0.9, "s", 1.0)]
    collected = decisions.collect_verdicts(verdict_rows(spark, scores, copies + copies), "at")
    assert [r["transaction_id"] for r in collected.collect()] == ["full"]
    lone = decisions.decide(decisions.collect_verdicts(verdict_rows(spark, {"x": {"network": 0.8}}), "at", expected=1)).first()
    assert (lone["final_risk_score"], lone["action"]) == (0.8, "decline")


def test_the_verdict_that_arrived_first_counts_and_one_shuffle_is_enough(spark):
    rows = verdict_rows(spark, {"a": {"network": 0.9}}).unionByName(
        verdict_rows(spark, {"a": {"network": 0.1}}).withColumn("at", F.lit(1)))
    collected = decisions.collect_verdicts(rows, "at", expected=1)
    assert collected.first()["verdicts"][0]["risk_score"] == 0.9
    assert collected._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1


def test_explanations_and_training_records(spark):
    collected = decisions.collect_verdicts(verdict_rows(spark, {"b": all_four(0.55), "c": all_four(0.9)}), "at")
    request = decisions.explanation_requests(collected).collect()
    assert len(request) == 1 and '"weighted_score":0.55' in request[0]["request"]
    assert '"transaction":{"transaction_id":"b"}' in request[0]["request"]
    told = collected.withColumn("told", F.when(F.col("transaction_id") == "b", "odd hour").otherwise(""))
    texts = {r["transaction_id"]: r["reasoning"] for r in decisions.decide(told, explanation="told").collect()}
    assert texts["b"].endswith(" | LLM analysis: odd hour") and "LLM" not in texts["c"]
    decided = decisions.decide(collected).withColumn("event_time", F.current_timestamp())
    records = {r["transaction_id"]: r for r in decisions.training_records(decided).collect()}
    assert {t: r["label"] for t, r in records.items()} == {"b": 0, "c": 1}
    assert set(records["b"].asDict()) == set(schemas.TRAINING_RECORD.names)
    again = decisions.decide(collected).collect()
    assert len({r["decision_id"] for r in again}) == 2


def test_fused_decision_is_the_same(spark):
    df = enriched(spark, [c[0] for a in AGENTS for c in CASES[a]]).withColumn("latency_ms", F.lit(7.25))
    fused, stepwise = decisions.decide_enriched(df), decisions.decide(scoring.with_verdicts(df))
    assert sorted(fused.columns) == sorted(stepwise.columns)
    rows = [sorted((str(r.asDict(True)) for r in x.select(sorted(x.columns)).collect())) for x in (fused, stepwise)]
    assert rows[0] == rows[1]
    slim = fused.groupBy("action").count()._jdf.queryExecution().optimizedPlan().toString()
    assert "reasoning" not in slim and "features_used" not in slim


def test_threshold_must_fit_the_band():
    with pytest.raises(ValueError):
        DecisionConfig(review_from=0.8)
