"""The daily jobs: what is read, computed and written, in order."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from risklake.config import TrainingConfig
from risklake.operators import analytics, behavioral, quality, training
from risklake.operators.feature_store import USER_BEHAVIORAL_STATS, VIEWS, fold_online, materialize, push
from risklake.session import cut_lineage
from risklake.sources import lake
from risklake.streaming import decision_sink

# Rows of a roll-up sit in few files, each clustered on the column it is looked up by.
ROLLUP_CLUSTERS = {
    "fraud_by_country": ["country_code"],
    "fraud_by_mcc": ["merchant_category_code"],
    "fraud_by_hour": ["hour_utc"],
    "velocity_summary": ["user_id"],
    "daily_kpis": ["decision_date"],
}


def compute_features(
    spark: SparkSession, base: str, as_of: dt.datetime, batch_id: int, days: int = 30,
    min_rows: int = 100, files: int = 16,
) -> bool:
    """Daily behavioural profile: check, compute, store, export, cluster, put online.

    Returns False, and writes nothing, if the day before ``as_of`` has too few rows.
    """
    silver_path = lake.layer(base, "silver_enriched")
    silver = spark.read.parquet(silver_path)
    day_before = (as_of - dt.timedelta(days=1)).date()
    if not quality.has_min_rows(silver, day_before, min_rows):
        return False
    recent = lake.since(silver, "date_partition", as_of.date(), days)
    profile = behavioral.behavioral_features(recent).withColumn(
        USER_BEHAVIORAL_STATS.ts_col, F.lit(as_of)
    )
    table = lake.layer(base, "silver_behavioral_features")
    lake.overwrite_table(profile, table)
    # What follows reads the stored table, so the profile is computed once.
    stored = spark.read.parquet(table)
    lake.export_offline_features(stored, f"{base}/offline/{USER_BEHAVIORAL_STATS.name}")
    lake.compact(spark, table, ["user_id"], f"{table}_clustered", files)
    fresh = materialize(USER_BEHAVIORAL_STATS, stored, as_of - dt.timedelta(days=1), as_of)
    push(USER_BEHAVIORAL_STATS, fresh, lake.layer(base, "online"), batch_id)
    return True


def recent_decisions(spark: SparkSession, base: str, as_of: dt.date, days: int) -> DataFrame:
    """Current decisions of the last ``days`` days. A decision keeps its date in all versions (its
    id follows from the transaction), so older partitions are left out before versions are compared."""
    versions = lake.read_versions(spark, lake.layer(base, "gold_decisions"), partition_by=decision_sink.DATES)
    return lake.current(lake.since(versions, "decision_date", as_of, days), "decision_id", ("batch_id", "event_time"))


def compute_analytics(spark: SparkSession, base: str, as_of: dt.date, days: int = 7) -> list[str]:
    """Daily roll-ups of the last ``days`` days; returns the paths written."""
    made = recent_decisions(spark, base, as_of, days)
    enriched = lake.load_since(spark, lake.layer(base, "silver_enriched"), "date_partition", as_of, days)
    rollups = {
        "fraud_by_country": analytics.fraud_by_country(made, enriched),
        "fraud_by_mcc": analytics.fraud_by_mcc(made, enriched),
        "fraud_by_hour": analytics.fraud_by_hour(made),
        "velocity_summary": analytics.velocity_summary(
            lake.first_per_key(
                enriched.select("transaction_id", "user_id", "amount", "ip_fraud_score", "txn_count_1h"),
                "transaction_id", ("user_id", "amount"),
            )
        ),
        "daily_kpis": analytics.daily_kpis(made),
    }
    paths = []
    for name, table in rollups.items():
        path = f"{lake.layer(base, 'gold_analytics')}/{name}"
        lake.overwrite_table(table.withColumn("computed_at", F.current_timestamp()), path)
        paths.append(path)
    return paths


def cluster_analytics(spark: SparkSession, base: str, files: int = 1) -> None:
    """Roll-ups once more, compacted and clustered, next to the originals."""
    for name, columns in ROLLUP_CLUSTERS.items():
        path = f"{lake.layer(base, 'gold_analytics')}/{name}"
        if lake.table_exists(spark, path):
            lake.compact(spark, path, columns, f"{path}_clustered", files)


def fold_tables(spark: SparkSession, base: str, keep: int = 2) -> dict[str, int]:
    """Take older batches of the keyed tables together; table -> last batch taken in, where there was one."""
    done = {"gold_decisions": decision_sink.fold_decisions(spark, base, keep)}
    done |= {name: fold_online(view, spark, lake.layer(base, "online"), keep) for name, view in VIEWS.items()}
    return {name: batch for name, batch in done.items() if batch is not None}


def retrain(
    records: DataFrame, as_of: dt.datetime, model_path: str, cfg: TrainingConfig = TrainingConfig()
) -> dict:
    """Extract, check, train, judge, promote. Raises if the data does not pass."""
    recent = lake.load_training_records(records, as_of)
    names = training.feature_names(recent)
    # Read by the gate, the fit and the judgement; worked out once.
    table = cut_lineage(training.expand_features(recent, names))
    check = quality.validate_training(table, cfg).first()
    if not check["ok"]:
        raise ValueError(f"training data refused: {check['rows']} rows, fraud rate {check['fraud_rate']}")
    train_rows, test_rows = training.split(table, cfg)
    model = training.train(train_rows, names, cfg)
    metrics = training.evaluate(model, test_rows, names)
    promoted = training.promote(model, metrics, model_path, cfg)
    return {
        **metrics, "rows": check["rows"], "fraud_rate": check["fraud_rate"], "promoted": promoted, "features": names,
        "surplus_features": training.feature_keys(recent).filter("NOT used").count(),
    }
