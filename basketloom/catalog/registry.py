"""Collects the queries and the SQL they are checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketloom.catalog.views import with_views

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
CHECKS: dict[str, str] = {}


def tidy(df: DataFrame) -> DataFrame:
    """Plain result types: bigint, double, string, boolean."""

    def plain(field: T.StructField):
        kind, column = field.dataType, F.col(f"`{field.name}`")
        if isinstance(kind, T.IntegralType):
            column = column.cast("bigint")
        elif isinstance(kind, (T.DecimalType, T.FloatType)):
            column = column.cast("double")
        elif isinstance(kind, T.DateType):
            column = column.cast("string")
        return column.alias(field.name)

    return df.select(*[plain(f) for f in df.schema.fields])


def query(name: str, sql: str | None = None, views: str = "") -> Callable[[Query], Query]:
    """Register a query and, if it has one, its SQL over the named views."""

    def add(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = lambda spark, sf_dir: tidy(fn(spark, sf_dir))
        if sql is not None:
            CHECKS[name] = with_views(views.split(), sql)
        return fn

    return add
