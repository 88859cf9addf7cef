"""Attaching features and reference risks to transactions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from risklake.config import DEFAULT_MERCHANT_RISK, MERCHANT_RISK, VelocityConfig
from risklake.operators import device, geo, velocity
from risklake.operators.feature_store import ENRICHMENT_REFS, USER_BEHAVIORAL_STATS, get_online_features, held_entries
from risklake.schemas import FEATURES

MAP = "map<string,string>"


def with_defaults(df: DataFrame) -> DataFrame:
    """Every feature column present, in its type, with 0 / 0.0 / false where missing."""
    zero = {"bigint": F.lit(0), "double": F.lit(0.0), "boolean": F.lit(False)}
    have = set(df.columns)
    columns = {}
    for f in FEATURES.fields:
        kind = f.dataType.simpleString()
        value = F.col(f.name).cast(kind) if f.name in have else F.lit(None).cast(kind)
        columns[f.name] = F.coalesce(value, zero[kind].cast(kind))
    return df.withColumns(columns)


def enrich(
    txns: DataFrame, stores: dict[str, DataFrame], as_of: Column | None = None
) -> DataFrame:
    """Latest feature values per user and device onto each transaction, with defaults.

    ``stores``: view name -> table with one row per key. Views not given count as empty.
    """
    refs = [r for r in ENRICHMENT_REFS if r.split(":")[0] in stores]
    moment = F.col("event_time") if as_of is None else as_of
    return with_defaults(get_online_features(refs, txns, stores, moment))


PROFILE = ("avg_txn_amount_30d", "amount_deviation_score", "hour_of_day_risk_score")


def user_history_features(
    txns: DataFrame,
    behavioral: DataFrame,
    cfg: VelocityConfig = VelocityConfig(),
) -> DataFrame:
    """``transaction_id`` and all features that depend on the user.

    Only the needed columns move, by (user, instant), which no busy user can skew. Dated profiles go along the same
    time line.
    """
    rows = velocity.on_timeline(txns).select(
        "transaction_id", "_user", "_us", "amount", "merchant_id", "latitude", "longitude", "country_code", "city",
    )
    key = F.concat(F.lit("k:"), F.col("user_id")).alias("_user")
    sight = {"_prev": geo.sight()}
    if USER_BEHAVIORAL_STATS.ts_col in behavioral.columns:
        held = held_entries(USER_BEHAVIORAL_STATS, behavioral, PROFILE)
        profiles = held.select(key, "_us", F.col(f"_{USER_BEHAVIORAL_STATS.name}").alias("_profile"))
        known = geo.attach_geo(rows, velocity.velocity_at(rows, cfg, sight, {"_profile": profiles}))
        fresh = F.col("_us") - F.col("_profile._us") <= USER_BEHAVIORAL_STATS.ttl_us
        known = known.withColumns({c: F.when(fresh, F.col(f"_profile.{c}")) for c in PROFILE})
    else:
        known = geo.attach_geo(rows, velocity.velocity_at(rows, cfg, sight)).join(behavioral.select(key, *PROFILE), "_user", "left")
    return known.select("transaction_id", *velocity.COLUMNS, *geo.COLUMNS, *PROFILE)


def device_history_features(txns: DataFrame, fraud_labels: DataFrame) -> DataFrame:
    """``transaction_id`` and the features that depend on the device."""
    rows = txns.select("transaction_id", "user_id", "device_fingerprint", "event_time")
    return device.device_features(rows, fraud_labels).select(
        "transaction_id", *device.COLUMNS
    )


def enrich_history(
    txns: DataFrame,
    behavioral: DataFrame,
    fraud_labels: DataFrame,
    ip_reputation: DataFrame | None = None,
    cfg: VelocityConfig = VelocityConfig(),
) -> DataFrame:
    """All 14 features for a whole history of transactions: velocity, location and device as
    of each row's instant; address scores as given, the same on every row.

    ``txns`` must have unique ids (``lake.first_per_key`` makes them so): a repeated
    delivery is no second purchase. ``behavioral`` are dated profiles (``behavioral.daily_profiles``), of which a row
    sees the newest one dated before it, or, without an ``event_timestamp``, the one profile in force.

    The two histories are computed from the few columns they need; the full rows are
    shuffled once, by transaction id, which no key can skew.
    """
    by_user = user_history_features(txns, behavioral, cfg)
    by_device = device_history_features(txns, fraud_labels)
    known = txns.join(by_user, "transaction_id", "left").join(by_device, "transaction_id", "left")
    if ip_reputation is not None:
        known = device.with_ip_reputation(known, ip_reputation)
    return with_defaults(known)


def with_mcc_risk(df: DataFrame) -> DataFrame:
    """Label and risk of the merchant category; 0.1 where the category is not listed."""
    listed = df.sparkSession.createDataFrame(
        MERCHANT_RISK, "merchant_category_code string, mcc_label string, mcc_risk_score double"
    )
    return df.join(F.broadcast(listed), "merchant_category_code", "left").withColumn(
        "mcc_risk_score", F.coalesce("mcc_risk_score", F.lit(DEFAULT_MERCHANT_RISK))
    )


def metadata_to_json(df: DataFrame) -> DataFrame:
    """``metadata`` map -> JSON text, ``{}`` where there is none."""
    return df.withColumn(
        "metadata", F.coalesce(F.to_json("metadata"), F.lit("{}"))
    )


def metadata_from_json(df: DataFrame) -> DataFrame:
    return df.withColumn("metadata", F.from_json("metadata", MAP))
