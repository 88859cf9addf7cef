"""Feature views: what they hold, how they are kept current, how they are read."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from risklake.functions import timeline as tl
from risklake.functions.scalars import MICROS, micros
from risklake.sources import lake, snapshots


@dataclass(frozen=True)
class FeatureView:
    """An entity key, a time column, typed columns, and how long a value stays good."""

    name: str
    keys: tuple[str, ...]
    ttl: dt.timedelta
    schema: dict[str, str]
    ts_col: str = "event_timestamp"

    @property
    def columns(self) -> list[str]:
        return list(self.schema)

    @property
    def ttl_us(self) -> int:
        return int(self.ttl.total_seconds()) * MICROS

    def struct(self) -> T.StructType:
        ddl = [f"{k} string" for k in self.keys] + [f"{self.ts_col} timestamp"]
        return T.StructType.fromDDL(", ".join(ddl + [f"{c} {t}" for c, t in self.schema.items()]))

    def conform(self, df: DataFrame) -> DataFrame:
        """Only this view's columns, in its types; columns ``df`` lacks are NULL."""
        have = set(df.columns)
        return df.select(
            *self.keys,
            F.col(self.ts_col).cast("timestamp").alias(self.ts_col),
            *[
                (F.col(c) if c in have else F.lit(None)).cast(t).alias(c)
                for c, t in self.schema.items()
            ],
        )


USER_TRANSACTION_STATS = FeatureView(
    "user_transaction_stats", ("user_id",), dt.timedelta(days=1),
    {
        "txn_count_1h": "long", "txn_count_24h": "long",
        "amount_sum_1h": "float", "amount_sum_24h": "float", "unique_merchants_1h": "long",
    },
)
USER_BEHAVIORAL_STATS = FeatureView(
    "user_behavioral_stats", ("user_id",), dt.timedelta(days=30),
    {
        "avg_txn_amount_30d": "float", "stddev_txn_amount_30d": "float",
        "amount_deviation_score": "float", "hour_of_day_risk_score": "float",
        "most_common_mcc": "float",
    },
)
GEO_STATS = FeatureView(
    "geo_stats", ("user_id",), dt.timedelta(days=7),
    {
        "last_txn_latitude": "float", "last_txn_longitude": "float",
        "distance_from_last_txn_km": "float", "is_new_country": "boolean",
        "is_new_city": "boolean", "last_country_code": "string",
    },
)
DEVICE_NETWORK_STATS = FeatureView(
    "device_network_stats", ("device_fingerprint",), dt.timedelta(days=7),
    {
        "ip_fraud_score": "float", "device_seen_before": "boolean",
        "linked_fraud_accounts": "long", "is_vpn": "boolean", "is_tor": "boolean",
        "asn": "string",
    },
)
VIEWS = {
    v.name: v
    for v in (USER_TRANSACTION_STATS, USER_BEHAVIORAL_STATS, GEO_STATS, DEVICE_NETWORK_STATS)
}

# What an enrichment look-up asks for.
ENRICHMENT_REFS = (
    "user_transaction_stats:txn_count_1h",
    "user_transaction_stats:txn_count_24h",
    "user_transaction_stats:amount_sum_1h",
    "user_transaction_stats:amount_sum_24h",
    "user_transaction_stats:unique_merchants_1h",
    "user_behavioral_stats:avg_txn_amount_30d",
    "user_behavioral_stats:amount_deviation_score",
    "user_behavioral_stats:hour_of_day_risk_score",
    "device_network_stats:ip_fraud_score",
    "device_network_stats:device_seen_before",
    "device_network_stats:linked_fraud_accounts",
    "geo_stats:distance_from_last_txn_km",
    "geo_stats:is_new_country",
    "geo_stats:is_new_city",
)


def _dated(view: FeatureView, payload: Sequence[str]) -> Column:
    """Row as a struct that compares by time first; the rest only settles ties."""
    return F.struct(micros(F.col(view.ts_col)).alias("_us"), *payload)


def latest(view: FeatureView, df: DataFrame, as_of: dt.datetime | None = None) -> DataFrame:
    """Newest row per key, by aggregation, so that a key's history never sits in one task."""
    if as_of is not None:
        df = df.filter(F.col(view.ts_col) <= F.lit(as_of))
    payload = [view.ts_col, *[c for c in view.columns if c in df.columns]]
    newest = df.groupBy(*view.keys).agg(F.max(_dated(view, payload)).alias("_row"))
    return newest.select(*view.keys, *[F.col(f"_row.{c}").alias(c) for c in payload])


def materialize(view: FeatureView, df: DataFrame, start: dt.datetime, end: dt.datetime) -> DataFrame:
    """Newest row per key of those dated in (start, end]."""
    return latest(view, df.filter((F.col(view.ts_col) > F.lit(start)) & (F.col(view.ts_col) <= F.lit(end))))


def push(view: FeatureView, df: DataFrame, base: str, batch_id: int) -> None:
    """Write rows to the view's online table; the newest per key is what reads return."""
    lake.upsert(latest(view, view.conform(df)), f"{base}/{view.name}", batch_id)


def read_online(view: FeatureView, spark, base: str, wanted: DataFrame | None = None) -> DataFrame:
    """The newest row per key; only of the keys of ``wanted``, if it is given, which are picked before anything moves."""
    rows = lake.read_versions(spark, f"{base}/{view.name}", view.struct()).drop("batch_id")
    if wanted is not None:
        rows = rows.join(wanted.select(*view.keys).distinct(), list(view.keys), "left_semi")
    return latest(view, rows)


def fold_online(view: FeatureView, spark, base: str, keep: int = 2) -> int | None:
    """Take older pushes together, so that a read lists one snapshot and a few pushes."""
    return snapshots.fold(spark, f"{base}/{view.name}", view.keys, [micros(F.col(view.ts_col)), view.ts_col, *view.columns], keep=keep)


def _ends(spark, path: str) -> list[int]:
    done = snapshots.matching(spark, path, "_materialized/end=*/_SUCCESS")
    return sorted(int(d.rsplit("/", 2)[1].split("=")[1]) for d in done)


def materialize_until(
    view: FeatureView, history: DataFrame, base: str, end: dt.datetime, late: dt.timedelta = dt.timedelta(days=1)
) -> int:
    """Push the newest rows up to ``end`` that have not been pushed, and remember ``end``; gives the push's batch id.

    Goes on from the last ``end`` remembered, ``late`` before it, so that rows which came late are picked up. ``end`` is
    remembered after the push only: a run that fails in between is repeated with the same batch, which replaces
    itself. The online table should have no other writer.
    """
    spark, path = history.sparkSession, f"{base}/{view.name}"
    ends = _ends(spark, path)
    rows = view.conform(history).filter(F.col(view.ts_col) <= F.lit(end))
    if ends:
        rows = rows.filter(F.unix_micros(view.ts_col) > ends[-1] - int(late.total_seconds()) * MICROS)
    push(view, rows, base, len(ends))
    _remember(spark, path, end)
    return len(ends)


def _remember(spark, path: str, end: dt.datetime) -> None:
    at = spark.range(1).select(F.unix_micros(F.lit(end).cast("timestamp")).alias("end_us"))
    at.coalesce(1).write.mode("overwrite").parquet(f"{path}/_materialized/end={at.first()['end_us']}")


def _within_ttl(view: FeatureView, asked_us: Column, feature_us: Column) -> Column:
    return feature_us.isNotNull() & (asked_us - feature_us <= F.lit(view.ttl_us))


def get_online_features(
    refs: Sequence[str],
    entities: DataFrame,
    stores: dict[str, DataFrame],
    as_of: dt.datetime | Column | None = None,
) -> DataFrame:
    """Add the asked ``view:feature`` values to each entity row; NULL once expired.

    ``stores`` maps view name to a table with one row per key. ``as_of`` is a time, or a
    column of ``entities`` such as the event's own time.
    """
    asked: dict[str, list[str]] = {}
    for ref in refs:
        name, feature = ref.split(":")
        asked.setdefault(name, []).append(feature)
    moment = as_of if isinstance(as_of, Column) else F.lit(as_of or dt.datetime.now(dt.timezone.utc))
    out = entities.withColumn("_asked_us", micros(moment))
    for keys in dict.fromkeys(VIEWS[name].keys for name in asked):
        # Tables of one key are put together first, one row per key each, so that the
        # entity rows are joined once per key and AQE can split a frequent one.
        names = [n for n in asked if VIEWS[n].keys == keys]
        tables = [
            stores[n].select(
                *keys, F.struct(micros(F.col(VIEWS[n].ts_col)).alias("_us"), *asked[n]).alias(f"_{n}")
            )
            for n in names
        ]
        together = reduce(lambda left, right: left.join(right, list(keys), "full"), tables)
        values = {
            f: F.when(_within_ttl(VIEWS[n], F.col("_asked_us"), F.col(f"_{n}._us")), F.col(f"_{n}.{f}"))
            for n in names
            for f in asked[n]
        }
        out = (
            out.drop(*values)
            .join(together, list(keys), "left")
            .withColumns(values)
            .drop(*[f"_{n}" for n in names])
        )
    return out.drop("_asked_us")


def point_in_time_join(
    left: DataFrame,
    view: FeatureView,
    history: DataFrame,
    ts_col: str = "event_time",
    features: Sequence[str] | None = None,
) -> DataFrame:
    """To each row of ``left`` the view's newest values at or before its time.

    Values older than the view's time to live are NULL, so is ``<ts_col of view>``. The
    two sides are merged on one time line per key: no range join, linear in the rows. A row
    without a key has no values.
    """
    return point_in_time_views(left, {view.name: history}, ts_col, {view.name: list(features or view.columns)})


def held_entries(view: FeatureView, history: DataFrame, features: Sequence[str]) -> DataFrame:
    """Rows of a view for a time line of its key: the key, ``_us`` and the values as a struct ``_<view>``."""
    return history.select(
        *view.keys, micros(F.col(view.ts_col)).alias("_us"), _dated(view, [view.ts_col, *features]).alias(f"_{view.name}")
    ).dropna(subset=list(view.keys))


def point_in_time_views(
    left: DataFrame, histories: dict[str, DataFrame], ts_col: str = "event_time",
    features: dict[str, Sequence[str]] | None = None, before: bool = False,
) -> DataFrame:
    """To each row of ``left`` the newest values of several views at or before its time, or strictly ``before`` it.

    ``histories``: view name -> its dated rows. All views of one key lie on one time line, which is passed once.
    Values older than their view's time to live are NULL; so is the view's time column, which has the view's name
    in front where there are several views.
    """
    asked = {n: list((features or {}).get(n) or VIEWS[n].columns) for n in histories}
    names = {n: VIEWS[n].ts_col if len(asked) == 1 else f"{n}_{VIEWS[n].ts_col}" for n in asked}
    out = left.withColumn("_asked_us", micros(F.col(ts_col))).drop(*names.values(), *[f for fs in asked.values() for f in fs])
    for keys in dict.fromkeys(VIEWS[n].keys for n in asked):
        mine = [n for n in asked if VIEWS[n].keys == keys]
        line = out.select(*keys, F.col("_asked_us").alias("_us"), F.lit(True).alias("_asks")).dropna(subset=list(keys))
        for n in mine:
            held = held_entries(VIEWS[n], histories[n], asked[n]).withColumn("_asks", F.lit(False))
            line = line.unionByName(held, allowMissingColumns=True)
        found = tl.sliced(line, list(keys), lasts=[f"_{n}" for n in mine], inclusive=not before).withColumnRenamed("_us", "_asked_us")
        values = {}
        for n in mine:
            fresh = _within_ttl(VIEWS[n], F.col("_asked_us"), F.col(f"_{n}._us"))
            values[names[n]] = F.when(fresh, F.col(f"_{n}.{VIEWS[n].ts_col}"))
            values |= {f: F.when(fresh, F.col(f"_{n}.{f}")) for f in asked[n]}
        out = out.join(found, [*keys, "_asked_us"], "left").withColumns(values).drop(*[f"_{n}" for n in mine])
    return out.drop("_asked_us")
