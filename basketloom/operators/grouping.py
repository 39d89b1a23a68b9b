"""Grouped aggregates, shares, pivots and profiles."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketloom.operators.summaries import exact_percentiles, long_form

Metrics = Mapping[str, Sequence[str]] | Iterable[tuple[str, str]]


def group_by_and_rename(df: DataFrame, dims: str | Sequence[str], metrics: Metrics) -> DataFrame:
    """Group by ``dims`` and name each result ``<function>_<column>``.

    ``metrics`` maps a function to its columns, or lists (function, column)
    pairs; a column may appear under several functions. No dims: one row.
    """
    if isinstance(metrics, Mapping):
        metrics = [(fn, c) for fn, columns in metrics.items() for c in columns]
    dims = [dims] if isinstance(dims, str) else list(dims)
    return df.groupBy(*dims).agg(*[getattr(F, fn)(c).alias(f"{fn}_{c}") for fn, c in metrics])


def ratio(over: str | Column, under: str | Column) -> Column:
    """Quotient as double, null where the divisor is zero or null."""
    as_col = [F.col(c) if isinstance(c, str) else c for c in (over, under)]
    return F.try_divide(as_col[0].cast("double"), as_col[1].cast("double"))


def share_of_total(df: DataFrame, entity: str, part: str, amounts: Mapping[str, str]) -> DataFrame:
    """Sums per (entity, part) and their share of the entity's total.

    The window runs over sums: one row per part, however large the entity is.
    """
    sums = df.groupBy(entity, part).agg(*[F.sum(c).alias(c) for c in amounts])
    whole = Window.partitionBy(entity)
    return sums.select("*", *[ratio(F.col(c), F.sum(c).over(whole)).alias(n) for c, n in amounts.items()])


def listed(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    """The rows as they are; a value of the column that is not listed is an error, null is not."""
    name = F.col(column)
    stray = F.raise_error(F.concat(F.lit(f"{column} has a value that is not listed: "), name.cast("string")))
    checked = F.when(name.isNull() | name.isin(list(values)), name).otherwise(stray.cast(df.schema[column].dataType))
    return df.withColumn(column, checked)


def _pivoted(df: DataFrame, key: str, column: str, values: Sequence[str] | None):
    """Without a list, Spark finds the values first; with one, any other value is an error."""
    if values is None:
        return df.groupBy(key).pivot(column)
    return listed(df, column, values).groupBy(key).pivot(column, list(values))


def pivot_single(df: DataFrame, key: str, column: str, values: Sequence[str] | None, agg: Column) -> DataFrame:
    return _pivoted(df, key, column, values).agg(agg)


def pivot_multi(
    df: DataFrame, key: str, column: str, values: Sequence[str] | None, aggs: Mapping[str, Column]
) -> DataFrame:
    """Columns ``<value>_<name>``, several aggregates per value."""
    return _pivoted(df, key, column, values).agg(*[a.alias(n) for n, a in aggs.items()])


def profile(
    df: DataFrame, key: str, means: Sequence[str], medians: Sequence[str] = (), by: str | None = None
) -> DataFrame:
    """Count of the key, means, and exact medians; overall or per group."""
    keys = [by] if by else []
    base = df.groupBy(*keys).agg(
        F.count(key).alias(f"count_{key}"),
        *[ratio(F.sum(c), F.count(c)).alias(f"mean_{c}") for c in means],
    )
    if not medians:
        return base
    middle = exact_percentiles(
        long_form(df, medians, keys), [*keys, "column_name"], "value", {"median": 0.5}
    )
    wide = (
        middle.groupBy(*keys)
        .pivot("column_name", list(medians))
        .agg(F.first("median"))
        .select(*keys, *[F.col(c).alias(f"median_{c}") for c in medians])
    )
    if by:
        named = wide.withColumnRenamed(by, "__by")
        return base.join(named, F.col(by).eqNullSafe(F.col("__by")), "left").drop("__by")
    # both are single rows
    return base.select("*", *[wide.select(f"median_{c}").scalar().alias(f"median_{c}") for c in medians])


def profile_with_total(df: DataFrame, by: str, key: str, means: Sequence[str]) -> DataFrame:
    """Means per group plus an ``overall`` row, from one pass over the rows.

    Group sums are rolled up, so the rows are not duplicated for the total.
    """
    sums = df.groupBy(by).agg(
        F.count(key).alias("__n"),
        *[e for c in means for e in (F.sum(c).alias(f"__s_{c}"), F.count(c).alias(f"__n_{c}"))],
    )
    rolled = sums.rollup(by).agg(
        F.grouping(by).alias("__all"),
        F.sum("__n").alias(f"count_{key}"),
        *[ratio(F.sum(f"__s_{c}"), F.sum(f"__n_{c}")).alias(f"avg_{c}") for c in means],
    )
    label = F.when(F.col("__all") == 1, F.lit("overall")).otherwise(F.col(by).cast("string"))
    return rolled.withColumn(by, label).drop("__all")


def full_profile(df: DataFrame, by: str, key: str, means: Sequence[str], medians: Sequence[str]) -> DataFrame:
    """:func:`profile` per group, the group's label as text, and the row ``overall``."""
    groups = profile(df, key, means, medians, by=by)
    whole = profile(df, key, means, medians)
    return groups.withColumn(by, F.col(by).cast("string")).unionByName(whole.withColumn(by, F.lit("overall")))


def transpose(df: DataFrame, label: str, labels: Sequence[str]) -> DataFrame:
    """Metrics as rows, the given labels as columns."""
    metrics = [c for c in df.columns if c != label]
    cells = df.select(label, *[F.col(c).cast("double").alias(c) for c in metrics])
    return (
        cells.unpivot([label], metrics, "metric", "value")
        .groupBy("metric")
        .pivot(label, list(labels))
        .agg(F.first("value"))
    )
