"""Record schemas of the messages and tables."""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields.items()])


_STR, _DBL, _LONG, _BOOL = T.StringType(), T.DoubleType(), T.LongType(), T.BooleanType()

# Amount and timestamp arrive as text; the quality gate decides what they are worth.
TRANSACTION = _struct(
    transaction_id=_STR, user_id=_STR, merchant_id=_STR, amount=_STR, currency=_STR,
    card_bin=_STR, card_last4=_STR, ip_address=_STR, device_fingerprint=_STR,
    merchant_category_code=_STR, country_code=_STR, city=_STR,
    latitude=_DBL, longitude=_DBL, timestamp=_STR, metadata=T.MapType(_STR, _STR),
)

FEATURES = _struct(
    txn_count_1h=_LONG, txn_count_24h=_LONG, amount_sum_1h=_DBL, amount_sum_24h=_DBL,
    unique_merchants_1h=_LONG,
    distance_from_last_txn_km=_DBL, is_new_country=_BOOL, is_new_city=_BOOL,
    avg_txn_amount_30d=_DBL, amount_deviation_score=_DBL, hour_of_day_risk_score=_DBL,
    ip_fraud_score=_DBL, device_seen_before=_BOOL, linked_fraud_accounts=_LONG,
)

ENRICHED_TRANSACTION = T.StructType(TRANSACTION.fields + FEATURES.fields)

VERDICT = _struct(
    verdict_id=_STR, transaction_id=_STR, agent_type=_STR, risk_score=_DBL, risk_level=_STR,
    confidence=_DBL, reasoning=_STR, features_used=T.ArrayType(_STR), latency_ms=_DBL,
    timestamp=_STR, metadata=T.MapType(_STR, _STR),
)

DECISION = _struct(
    decision_id=_STR, transaction_id=_STR, final_risk_score=_DBL, risk_level=_STR,
    action=_STR, reasoning=_STR, total_latency_ms=_DBL, timestamp=_STR,
)

VELOCITY_WINDOW = _struct(
    user_id=_STR, window_start=T.TimestampType(), window_end=T.TimestampType(),
    txn_count=_LONG, amount_sum=_DBL, avg_amount=_DBL, unique_merchants=_LONG,
    unique_countries=_LONG, max_amount=_DBL, min_amount=_DBL,
)

TRAINING_RECORD = _struct(
    record_id=_STR, transaction_id=_STR, label=T.IntegerType(), label_source=_STR,
    features=_STR, created_at=T.TimestampType(),
)

# Longest text each field may hold, and bounds of the scores (fixed values of the contract).
MAX_LENGTHS = {
    "currency": 3,
    "card_bin": 6,
    "card_last4": 4,
    "merchant_category_code": 4,
    "country_code": 2,
}
UNIT_INTERVAL_COLUMNS = ("risk_score", "confidence", "final_risk_score")

# Column order of a published enriched message.
PUBLISH_COLUMNS = TRANSACTION.names + FEATURES.names
