"""What is known about the device and the address behind a transaction."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from risklake.functions import timeline as tl
from risklake.functions.scalars import micros

DEVICE = ("_device",)
REPUTATION = ("ip_fraud_score", "is_vpn", "is_tor", "asn")
COLUMNS = ("device_seen_before", "linked_fraud_accounts")


def device_features(
    txns: DataFrame,
    fraud_labels: DataFrame,
    ip_reputation: DataFrame | None = None,
) -> DataFrame:
    """Device history at each transaction's instant.

    ``fraud_labels``: ``user_id, fraud_time``. ``ip_reputation``: ``ip_address`` and any of
    ip_fraud_score, is_vpn, is_tor, asn; one row per address is used.

    ``linked_fraud_accounts`` counts other users who had been seen on the device and
    labelled as fraud, both before the instant.
    """
    # Rows without a device get a key of their own, so that they never meet in one task.
    rows = txns.withColumns({"_us": micros(F.col("event_time")), "_device": tl.own_key("device_fingerprint")})
    known = _history(rows, _fraud_links(rows, fraud_labels)).drop("_us", "_device")
    return known if ip_reputation is None else with_ip_reputation(known, ip_reputation)


def with_ip_reputation(df: DataFrame, ip_reputation: DataFrame) -> DataFrame:
    present = [c for c in REPUTATION if c in ip_reputation.columns]
    one = ip_reputation.groupBy("ip_address").agg(F.max(F.struct(*present)).alias("_row"))
    latest = one.select("ip_address", *[F.col(f"_row.{c}").alias(c) for c in present])
    keyed = latest.withColumn("_ip", F.concat(F.lit("k:"), F.col("ip_address"))).drop("ip_address")
    rows = df.drop(*present).withColumn("_ip", tl.own_key("ip_address"))
    return rows.join(keyed, "_ip", "left").drop("_ip")


def _fraud_links(rows: DataFrame, fraud_labels: DataFrame) -> DataFrame:
    """(device, user, instant from which the user taints the device); never rows x rows."""
    first_use = (
        rows.filter(F.col("device_fingerprint").isNotNull() & F.col("user_id").isNotNull())
        .groupBy("_device", "user_id")
        .agg(F.min("_us").alias("_used"))
    )
    first_fraud = (
        fraud_labels.filter(F.col("user_id").isNotNull())
        .groupBy("user_id")
        .agg(F.min(micros(F.col("fraud_time"))).alias("_labelled"))
    )
    return first_use.join(first_fraud, "user_id").select(
        "_device", "user_id", F.greatest("_used", "_labelled").alias("_link_us")
    )


def _columns(seen: Column) -> dict[str, Column]:
    has_device = F.col("device_fingerprint").isNotNull()
    own_taint = F.coalesce((F.col("_own") < F.col("_us")).cast("long"), F.lit(0))
    return {
        "device_seen_before": has_device & F.coalesce(seen, F.lit(False)),
        "linked_fraud_accounts": F.when(
            has_device, F.coalesce(F.col("_tainted"), F.lit(0)) - own_taint
        ).otherwise(F.lit(0)).cast("long"),
    }


def _history(rows: DataFrame, links: DataFrame) -> DataFrame:
    def entries(df: DataFrame, us: str, tainted: int, earlier: int, asks: bool) -> DataFrame:
        return df.select(
            "_device", F.col(us).alias("_us"),
            F.lit(tainted).cast("long").alias("_tainted"),
            F.lit(earlier).cast("long").alias("_earlier"),
            F.lit(asks).alias("_asks"),
        )

    line = entries(rows, "_us", 0, 1, True).unionByName(entries(links, "_link_us", 1, 0, False))
    by_instant = tl.sliced(line, DEVICE, ("_tainted", "_earlier"))
    looked_up = rows.join(by_instant, ["_device", "_us"], "left").join(
        links.withColumnRenamed("_link_us", "_own"), ["_device", "user_id"], "left"
    )
    return looked_up.withColumns(_columns(F.col("_earlier") > 0)).select(*rows.columns, *COLUMNS)
