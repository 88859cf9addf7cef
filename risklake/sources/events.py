"""Card transactions seen in a generic ``events`` table.

The table (event_id, ts, user_id, event_type, value, props) holds no payment columns, so
merchants, devices, places and categories follow from its ids by fixed arithmetic. The
expressions are plain SQL, the same for every engine that reads the table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_PLACE = "(user_id + CASE WHEN k < 6 THEN k ELSE 0 END) % 14"

TRANSACTION_SQL = {
    "transaction_id": "'txn_' || CAST(event_id AS STRING)",
    "user_id": "'user_' || CAST(user_id AS STRING)",
    "merchant_id": "'merchant_' || CAST((event_id * 7919) % 97 AS STRING)",
    "amount": "value",
    "currency": "split_part('USD,EUR,GBP,CAD,AUD', ',', CAST(event_id % 5 AS INT) + 1)",
    "card_bin": "'4' || CAST(10000 + user_id % 90000 AS STRING)",
    "card_last4": "CAST(1000 + user_id % 9000 AS STRING)",
    "ip_address": "'10.0.' || CAST(user_id % 200 AS STRING) || '.' || CAST(k % 50 AS STRING)",
    "device_fingerprint": (
        "CASE WHEN k < 10 THEN 'device_s' || CAST(user_id % 10 AS STRING) "
        "ELSE 'device_' || CAST(user_id AS STRING) END"
    ),
    "merchant_category_code": (
        "split_part('5411,5732,5812,5912,7995,6051,4829,6211,5999,5541', ',', "
        "CAST((user_id + k) % 10 AS INT) + 1)"
    ),
    "country_code": (
        f"split_part('US,GB,DE,FR,IN,BR,CN,RU,NG,RO,UA,VN,CA,ZA', ',', CAST({_PLACE} AS INT) + 1)"
    ),
    "city": "'city_' || CAST((user_id + CASE WHEN k < 20 THEN k ELSE 0 END) % 40 AS STRING)",
    "latitude": f"CAST(-60.0 + 9.0 * ({_PLACE}) AS DOUBLE)",
    "longitude": f"CAST(-170.0 + 24.0 * ({_PLACE}) AS DOUBLE)",
    "event_time": "CAST(ts AS TIMESTAMP)",
    # Helpers of the checked queries: one agent's latency, address score, known fraud.
    "latency_ms": "CAST((5.0 + 3.0 * k) / 4.0 AS DOUBLE)",
    "address_score": "CAST((user_id * 37 + k) % 100 AS DOUBLE) / CAST(100.0 AS DOUBLE)",
    "is_fraud": "(event_type = 'error' AND k >= 95)",
    "event_id": "event_id",
    "k": "k",
}
K_SQL = "CAST(regexp_extract(props, '[0-9]+', 0) AS INT)"


def events_path(sf_dir: str) -> str:
    return f"{sf_dir.rstrip('/')}/events.parquet"


def as_transactions(events: DataFrame) -> DataFrame:
    """Works on a batch or a streaming ``events`` DataFrame."""
    return events.withColumn("k", F.expr(K_SQL)).selectExpr(
        *[f"{sql} AS {name}" for name, sql in TRANSACTION_SQL.items()]
    )


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_transactions(spark.read.parquet(events_path(sf_dir)))


def stream_events(spark: SparkSession, sf_dir: str, max_files: int | None = None) -> DataFrame:
    """The table as a stream; ``max_files`` bounds a micro-batch."""
    schema = spark.read.parquet(events_path(sf_dir)).schema
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    # A pattern, so that the table may be one file or a folder of files.
    return reader.parquet(f"{sf_dir.rstrip('/')}/event[s].parquet")


def transaction_messages(events: DataFrame) -> DataFrame:
    """The transactions as the JSON messages they would arrive in: amount and time as text."""
    from risklake import schemas
    from risklake.sources.messages import to_messages

    wire = as_transactions(events).withColumns(
        {
            "amount": F.col("amount").cast("string"),
            "timestamp": F.date_format("event_time", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"),
            "metadata": F.create_map(F.lit("k"), F.col("k").cast("string")),
        }
    )
    return to_messages(wire, "transaction_id", schemas.TRANSACTION.names)


def fraud_labels(txns: DataFrame) -> DataFrame:
    return txns.filter("is_fraud").select("user_id", F.col("event_time").alias("fraud_time"))


def ip_reputation(txns: DataFrame) -> DataFrame:
    """One row per address: the worst score seen, and whether it hides its origin."""
    return txns.groupBy("ip_address").agg(
        F.max("address_score").alias("ip_fraud_score"),
        F.max(F.col("k") >= 97).alias("is_vpn"),
        F.max(F.col("k") >= 99).alias("is_tor"),
    )
