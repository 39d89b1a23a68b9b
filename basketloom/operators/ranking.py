"""Ranks, running totals and neighbour values within groups of any size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketloom.operators.ordered import over_neighbours, running_totals
from basketloom.sources.stage import settle


def row_numbers(df: DataFrame, by: Sequence[str], order: Sequence[Column], out: str) -> DataFrame:
    """1..N along a unique order within each group."""
    return running_totals(df, by, order, {out: F.lit(1).cast("bigint")})


def value_ranks(df: DataFrame, by: Sequence[str], value: str, descending: bool = True) -> DataFrame:
    """``rank_min``, ``rank_max``, ``rank_average`` and ``rank_dense`` of a value; nulls last.

    The distinct values are ranked from their counts, so rows that share a value
    never meet in one task, and the ranks are joined back.
    """
    by_value = F.col(value).desc_nulls_last() if descending else F.col(value).asc_nulls_last()
    counts = settle(df.groupBy(*by, value).agg(F.count(F.lit(1)).alias("__n")), "values")
    ranked = running_totals(counts, by, [by_value], {"rank_max": F.col("__n"), "rank_dense": F.lit(1).cast("bigint")})
    keys = [*by, value]
    ranks = ranked.select(
        *[F.col(k).alias(f"__{k}") for k in keys],
        (F.col("rank_max") - F.col("__n") + 1).alias("rank_min"),
        "rank_max",
        (F.col("rank_max") - (F.col("__n") - 1).cast("double") / 2).alias("rank_average"),
        "rank_dense",
    )
    same = [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys]
    return df.join(ranks, same).select(*df.columns, "rank_min", "rank_max", "rank_dense", "rank_average")


def cumulative(df: DataFrame, by: Sequence[str], order: Sequence[Column], value: str) -> DataFrame:
    """``cumulative_sum`` (null on null rows) and ``expanding_mean`` of an exact column."""
    sums = running_totals(
        df,
        by,
        order,
        {"__sum": F.col(value), "__n": F.when(F.col(value).isNotNull(), 1).otherwise(0)},
    )
    return sums.select(
        *df.columns,
        F.when(F.col(value).isNotNull(), F.col("__sum")).alias("cumulative_sum"),
        F.try_divide(F.col("__sum").cast("double"), F.col("__n")).alias("expanding_mean"),
    )


def rolling_mean(df: DataFrame, by: Sequence[str], order: Sequence[Column], value: str, rows: int, out: str) -> DataFrame:
    """Mean of the last ``rows`` rows; null unless all of them have a value."""

    def columns(spec):
        frame = spec.rowsBetween(-(rows - 1), 0)
        total = F.sum(value).over(frame).cast("double")
        return {out: F.when(F.count(value).over(frame) == rows, total / rows)}

    return over_neighbours(df, by, order, columns, back=rows - 1)


def lag_lead(df: DataFrame, by: Sequence[str], order: Sequence[Column], value: str) -> DataFrame:
    """``previous`` and ``next`` value along the order."""
    return over_neighbours(
        df,
        by,
        order,
        lambda spec: {"previous": F.lag(value).over(spec), "next": F.lead(value).over(spec)},
        back=1,
        ahead=1,
    )


def first_last(df: DataFrame, by: str, value: str) -> DataFrame:
    """Lowest and highest value of the group on every row: two aggregates, no sort."""
    ends = settle(
        df.groupBy(by).agg(F.min(value).alias("first_value"), F.max(value).alias("last_value")), "ends"
    ).withColumnRenamed(by, "__key")
    return df.join(ends, F.col(by).eqNullSafe(F.col("__key")), "left").drop("__key")


def top_per_group(df: DataFrame, by: Sequence[str], order: Sequence[Column], n: int) -> DataFrame:
    """First ``n`` rows of every group; each task drops the rest before the shuffle."""
    spec = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn("position", F.row_number().over(spec)).filter(F.col("position") <= n)
