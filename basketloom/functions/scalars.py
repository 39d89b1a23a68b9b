"""Column expressions used by the queries and feature tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Earth radius in km and the sales thresholds (low, medium) per class.
EARTH_KM = 6373.0
SALES_GROUPS = {
    "A": (225_000, 400_000),
    "WS": (225_000, 400_000),
    "B": (100_000, 150_000),
    "C": (50_000, 75_000),
}

Name = str | Column


def haversine(lat_a: Name, lng_a: Name, lat_b: Name, lng_b: Name) -> Column:
    """Great-circle distance in km between two positions in degrees, to the metre."""
    phi_a, phi_b = F.radians(lat_a), F.radians(lat_b)
    half_phi = F.sin((phi_b - phi_a) / 2)
    half_lambda = F.sin((F.radians(lng_b) - F.radians(lng_a)) / 2)
    chord = half_phi * half_phi + F.cos(phi_a) * F.cos(phi_b) * half_lambda * half_lambda
    return F.round(F.asin(F.when(chord > 1, F.lit(1.0)).otherwise(F.sqrt(chord))) * (2 * EARTH_KM), 3)


def sales_group(
    sales: str, classification: str, limits: Mapping[str, Sequence[float]] = SALES_GROUPS
) -> Column:
    """Low / Medium / High by the limits of the class; null for a class without limits.

    A missing amount of a known class is High, since no limit holds it back.
    """
    out = F.when(F.lit(False), F.lit(None).cast("string"))
    for name, (low, medium) in limits.items():
        level = (
            F.when(F.col(sales) <= low, "Low").when(F.col(sales) <= medium, "Medium").otherwise("High")
        )
        out = out.when(F.col(classification) == name, level)
    return out


def week_end(day: Name) -> Column:
    """Saturday of the Sunday-to-Saturday week."""
    return F.date_add(day, 7 - F.dayofweek(day))


def month_key(day: Name) -> Column:
    return F.date_format(day, "yyyy-MM")


def clean_label(prefix: str, label: Name) -> Column:
    """Prefixed label fit for a column name: blanks become underscores."""
    return F.concat(F.lit(prefix), F.regexp_replace(label, " ", "_"))


def rename_strict(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Rename, but refuse names the table does not have."""
    missing = sorted(set(names) - set(df.columns))
    if missing:
        raise ValueError(f"no such columns: {missing}")
    return df.withColumnsRenamed(dict(names))


def suffix_all(df: DataFrame, suffix: str) -> DataFrame:
    return df.toDF(*[c + suffix for c in df.columns])
