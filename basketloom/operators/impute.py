"""Null imputation by constants, column statistics and group statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketloom.operators.summaries import exact_percentiles, selected_percentiles
from basketloom.sources.stage import settle


def mean_of(name: str):
    """Mean as double: exact decimal sum over the count."""
    return F.try_divide(F.sum(name).cast("double"), F.count(name))


def fill_mean(df: DataFrame, name: str, out: str) -> DataFrame:
    mean = df.agg(mean_of(name)).scalar()
    return df.withColumn(out, F.coalesce(F.col(name).cast("double"), mean))


def fill_median(df: DataFrame, name: str, out: str) -> DataFrame:
    median = settle(selected_percentiles(df, [name], {"median": 0.5}), "median")
    return df.withColumn(out, F.coalesce(F.col(name).cast("double"), median.select("median").scalar()))


def fill_mode(df: DataFrame, name: str, out: str) -> DataFrame:
    """Most frequent value; the smallest one on ties."""
    counts = df.filter(F.col(name).isNotNull()).groupBy(name).agg(F.count(F.lit(1)).alias("n"))
    mode = counts.orderBy(F.col("n").desc(), F.col(name)).limit(1).select(name)
    return df.withColumn(out, F.coalesce(F.col(name), mode.scalar()))


def _fill_from_groups(df: DataFrame, stats: DataFrame, name: str, by: str, out: str) -> DataFrame:
    # settled, so the planner sees its true size and broadcasts it if small
    filled = df.join(settle(stats, "fills"), by, "left")
    return filled.withColumn(out, F.coalesce(F.col(name).cast("double"), F.col("__fill"))).select(
        *[c for c in df.columns if c != out], out
    )


def fill_group_mean(df: DataFrame, name: str, by: str, out: str) -> DataFrame:
    """Nulls get the mean of their group; a null group or an all-null group stays null."""
    return _fill_from_groups(df, df.groupBy(by).agg(mean_of(name).alias("__fill")), name, by, out)


def fill_group_median(df: DataFrame, name: str, by: str, out: str) -> DataFrame:
    stats = exact_percentiles(df.select(by, name), [by], name, {"__fill": 0.5})
    return _fill_from_groups(df, stats, name, by, out)
