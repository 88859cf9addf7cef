"""Quality gates: which rows may enter, and why the others may not."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from risklake.config import AGENTS, TrainingConfig
from risklake.schemas import MAX_LENGTHS, UNIT_INTERVAL_COLUMNS


def normalise(df: DataFrame) -> DataFrame:
    """Text timestamp -> ``event_time``, text amount -> double; NULL where not readable."""
    return df.withColumn(
        "event_time", F.try_to_timestamp(F.col("timestamp"))
    ).withColumn("amount", F.col("amount").try_cast("double"))


def _reasons(checks: dict[str, Column]) -> Column:
    return F.array_compact(
        F.array(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in checks.items()])
    )


def gate_reasons(df: DataFrame) -> Column:
    # After normalise() an unreadable timestamp shows as a NULL event_time.
    readable = F.col("event_time" if "event_time" in df.columns else "timestamp").isNotNull()
    return _reasons(
        {
            "transaction_id missing": F.col("transaction_id").isNotNull(),
            "user_id missing": F.col("user_id").isNotNull(),
            # NaN sorts above every number, so an upper limit is needed to keep it out.
            "amount not positive": (F.col("amount") > 0) & (F.col("amount") < float("inf")),
            "timestamp missing": readable,
        }
    )


def split_valid(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good, bad); every input row is in exactly one of them. Bad rows carry ``reasons``."""
    checked = df.withColumn("reasons", gate_reasons(df))
    failed = F.size("reasons") > 0
    return checked.filter(~failed).drop("reasons"), checked.filter(failed)


def validate_contract(df: DataFrame) -> DataFrame:
    """Add ``violations``: fields that are too long, scores outside 0..1."""
    present = set(df.columns)
    checks = {
        f"{name} longer than {limit}": F.col(name).isNull() | (F.length(name) <= limit)
        for name, limit in MAX_LENGTHS.items()
        if name in present
    }
    checks |= {
        f"{name} outside 0..1": F.col(name).isNull() | F.col(name).between(0.0, 1.0)
        for name in UNIT_INTERVAL_COLUMNS
        if name in present
    }
    return df.withColumn("violations", _reasons(checks))


def only_decisions(df: DataFrame) -> DataFrame:
    """Decisions share a topic with verdicts; only decisions have a final score."""
    return df.filter(F.col("final_risk_score").isNotNull())


def only_verdicts(df: DataFrame) -> DataFrame:
    return df.filter(F.col("agent_type").isin(*AGENTS))


def daily_volume(df: DataFrame, minimum: int = 100) -> DataFrame:
    """Per ``date_partition``: are there at least ``minimum`` rows?"""
    return df.groupBy("date_partition").agg((F.count(F.lit(1)) >= minimum).alias("enough"))


def has_min_rows(df: DataFrame, date: dt.date, minimum: int = 100) -> bool:
    """Is there enough data for a day? Reads that day's partition only."""
    day = df.filter(F.col("date_partition") == F.lit(date))
    return not daily_volume(day, minimum).filter("enough").isEmpty()


def validate_training(df: DataFrame, cfg: TrainingConfig = TrainingConfig()) -> DataFrame:
    """One row: ``rows``, ``fraud_rate``, ``ok``."""
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.round(F.avg(F.col("label").cast("double")), 4).alias("fraud_rate"),
        F.coalesce(
            (F.count(F.lit(1)) > cfg.min_rows)
            & F.avg(F.col("label").cast("double")).between(cfg.min_fraud_rate, cfg.max_fraud_rate),
            F.lit(False),
        ).alias("ok"),
    )
