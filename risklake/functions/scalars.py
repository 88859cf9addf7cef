"""Column expressions used by several operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from risklake.config import EARTH_RADIUS_KM

MICROS = 1_000_000


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance in km; NULL where any coordinate is."""
    phi1, phi2 = F.radians(lat1), F.radians(lat2)
    half_dphi = F.radians(lat2 - lat1) / 2
    half_dlam = F.radians(lon2 - lon1) / 2
    h = (
        F.sin(half_dphi) * F.sin(half_dphi)
        + F.cos(phi1) * F.cos(phi2) * F.sin(half_dlam) * F.sin(half_dlam)
    )
    # Rounding can push h a hair above 1 for antipodal points.
    return 2 * EARTH_RADIUS_KM * F.asin(F.sqrt(F.when(h > 1, 1.0).otherwise(h)))


def risk_level(score: Column) -> Column:
    return (
        F.when(score >= 0.75, "critical")
        .when(score >= 0.5, "high")
        .when(score >= 0.25, "medium")
        .otherwise("low")
    )


def risk_bucket(score: Column) -> Column:
    return F.when(score >= 0.75, "high").when(score >= 0.40, "medium").otherwise("low")


def category_hash(code: Column) -> Column:
    """Numeric stand-in for a category code (a NULL code gives 42.0)."""
    return F.hash(code).cast("float")


def stable_id(*parts: Column) -> Column:
    """Identifier that is the same on every attempt."""
    return F.md5(F.concat_ws("|", *parts))


def fixed(value: Column, digits: int) -> Column:
    """Number as text with a fixed count of decimals, ties away from zero."""
    return value.try_cast(f"decimal(38,{digits})").cast("string")


def micros(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp"))
