"""Where a user is, compared with where they were."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from risklake.functions import timeline as tl
from risklake.functions.scalars import MICROS, haversine_km
from risklake.operators.velocity import USER, on_timeline

COLUMNS = (
    "last_txn_latitude", "last_txn_longitude", "last_country_code",
    "distance_from_last_txn_km", "speed_kmh", "is_new_country", "is_new_city",
)


def _place(kind: str, name: str) -> Column:
    return F.concat(F.lit(f"{kind}:"), F.col(name))


def geo_features(txns: DataFrame) -> DataFrame:
    """Distance and speed since the user's previous instant; first visits to places.

    A place is new if the user has earlier rows but none there. Rows without a user have no
    history.
    """
    rows = on_timeline(txns)
    previous = tl.sliced_last(rows.select(*USER, "_us", sight().alias("_prev")), USER, "_prev", inclusive=False)
    return attach_geo(rows, previous).select(*txns.columns, *COLUMNS)


def sight() -> Column:
    """A row as the user's position, ordered by instant, then id."""
    return F.struct("_us", "transaction_id", "latitude", "longitude", "country_code")


def _first_there(place: Column) -> Column:
    return F.coalesce(F.array_contains("_places", place), F.lit(False))


def _columns() -> dict[str, Column]:
    known = F.col("_prev").isNotNull()
    distance = haversine_km(
        F.col("_prev.latitude"), F.col("_prev.longitude"), F.col("latitude"), F.col("longitude")
    )
    hours = (F.col("_us") - F.col("_prev._us")) / F.lit(3600.0 * MICROS)

    return {
        "last_txn_latitude": F.col("_prev.latitude"),
        "last_txn_longitude": F.col("_prev.longitude"),
        "last_country_code": F.col("_prev.country_code"),
        "distance_from_last_txn_km": distance,
        "speed_kmh": distance / hours,
        "is_new_country": known & _first_there(_place("country", "country_code")),
        "is_new_city": known & _first_there(_place("city", "city")),
    }


def _first_visits(rows: DataFrame) -> DataFrame:
    """Per (user, instant): the countries and cities that the user is at for the first time."""
    at = rows.select(*USER, "_us", F.explode(F.array_compact(F.array(_place("country", "country_code"), _place("city", "city")))).alias("_place"))
    first = at.groupBy(*USER, "_place").agg(F.min("_us").alias("_us"))
    return first.groupBy(*USER, "_us").agg(F.collect_set("_place").alias("_places"))


def attach_geo(rows: DataFrame, at_instant: DataFrame) -> DataFrame:
    """``rows`` (with ``_user`` and ``_us``) with the columns of ``at_instant`` and the features. The former
    has, per (user, instant), as ``_prev`` the user's last ``sight`` before."""
    keys = [*USER, "_us"]
    known = rows.join(at_instant.join(_first_visits(rows), keys, "left"), keys, "left")
    return known.withColumns(_columns()).drop("_prev", "_places")


def impossible_travel(geo: DataFrame, max_speed_kmh: float) -> DataFrame:
    """Flag rows that would need to have travelled faster than ``max_speed_kmh``."""
    return geo.withColumn(
        "impossible_travel", F.coalesce(F.col("speed_kmh") > max_speed_kmh, F.lit(False))
    )
