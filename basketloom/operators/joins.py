"""Joins that need more than ``DataFrame.join``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Values in a block of :func:`pair_with_all`.
BLOCK = 1_000


def pair_with_all(df: DataFrame, values: DataFrame, name: str) -> DataFrame:
    """Every row of ``df`` with every value of a one-column table, of any length.

    A grid of value blocks and row salts: a row has one salt and goes to every
    block, a value has one block and goes to every salt, and the two meet in an
    equi-join, so no task holds all rows or all values. How large the result
    gets is the caller's decision. Null values are paired too.
    """
    blocks = max(1, -(-values.count() // BLOCK))
    salts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ids = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    rows = df.withColumn("__salt", F.pmod(F.xxhash64(*df.columns), F.lit(salts)).cast("int")).withColumn("__block", ids(blocks))
    short = values.select(F.col(values.columns[0]).alias(name)).withColumn("__block", F.pmod(F.xxhash64(name), F.lit(blocks)).cast("int"))
    return rows.join(short.withColumn("__salt", ids(salts)), ["__block", "__salt"]).select(*df.columns, name)
