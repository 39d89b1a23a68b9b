"""Data checks: sizes, schema, nulls, keys, coverage and value counts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketloom.operators.ordered import spread


def _is_missing(df: DataFrame, name: str) -> Column:
    floating = isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType))
    return F.col(name).isNull() | F.isnan(name) if floating else F.col(name).isNull()


def _one_row_per_column(df: DataFrame, fields: Mapping[str, Column]) -> Column:
    return F.struct(*[c.alias(n) for n, c in fields.items()])


def schema_info(df: DataFrame) -> DataFrame:
    """Position, name, type and non-null count of every column, in one pass."""
    rows = [
        _one_row_per_column(
            df,
            {
                "position": F.lit(i),
                "column_name": F.lit(f.name),
                "data_type": F.lit(f.dataType.simpleString()),
                "non_null": F.count(f.name),
            },
        )
        for i, f in enumerate(df.schema.fields)
    ]
    return df.agg(F.array(*rows).alias("r")).select(F.inline("r"))


def shape(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("n_columns", F.lit(len(df.columns)))


def null_counts(df: DataFrame) -> DataFrame:
    """Nulls (and NaN in floating columns) per column, most first."""
    rows = [
        _one_row_per_column(
            df, {"column_name": F.lit(c), "nulls": F.count(F.when(_is_missing(df, c), F.lit(1)))}
        )
        for c in df.columns
    ]
    return (
        df.agg(F.array(*rows).alias("r"))
        .select(F.inline("r"))
        .orderBy(F.col("nulls").desc(), F.col("column_name"))
    )


def grain_check(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows against distinct keys; null is one more key value.

    Keys are about as many as rows, so only they are dealt, over tasks of like size.
    """
    per_key = spread(df.select(*keys), *keys).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"), F.count(F.lit(1)).alias("n_groups")
    ).withColumn("is_key", (F.col("n_rows") == F.col("n_groups")).cast("int"))


def distinct_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[F.countDistinct(c).alias(f"distinct_{c}") for c in columns],
    )


def dimension_coverage(fact: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """How many keys of the fact the dimension knows."""
    in_fact = fact.select(key).distinct()
    known = dim.select(key).distinct().withColumn("known", F.lit(1))
    return in_fact.join(known, key, "left").agg(
        F.count(F.lit(1)).alias("fact_keys"),
        F.count("known").alias("known_keys"),
        (F.count(F.lit(1)) - F.count("known")).alias("missing_keys"),
    )


def value_counts(df: DataFrame, *columns: str) -> DataFrame:
    return (
        df.groupBy(*columns)
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.col("n").desc(), *[F.col(c).asc_nulls_last() for c in columns])
    )


def stage_row_counts(df: DataFrame, stages: Mapping[str, Column]) -> DataFrame:
    """Rows left after each filter of a chain, all in one pass."""
    kept, counts = F.lit(True), [F.count(F.lit(1)).alias("all_rows")]
    for name, condition in stages.items():
        kept = kept & condition
        counts.append(F.count(F.when(kept, F.lit(1))).alias(name))
    return df.agg(*counts)


def event_rate(df: DataFrame, **flags: str) -> DataFrame:
    """Mean of 0/1 columns: ``event_rate(df, event_rate="label")``."""
    return df.agg(
        *[F.try_divide(F.sum(c).cast("double"), F.count(c)).alias(n) for n, c in flags.items()]
    )
