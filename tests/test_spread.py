"""Aggregates with about one group per row keep a task's memory the same at every size."""

import re

from pyspark.sql import functions as F

import pytest

from basketloom.catalog import features
from basketloom.catalog.registry import QUERIES
from basketloom.operators import checks, ordered
from basketloom.plans import customers
from basketloom.sources import stage


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_tasks_follow_the_bytes_read(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    spark.range(20_000).select(F.col("id").alias("k"), F.xxhash64("id").alias("x")).write.parquet(path)
    df = spark.read.parquet(path)
    size = ordered.bytes_read(df)
    assert ordered.spread(df, "k").rdd.getNumPartitions() == 1
    unknown = spark.createDataFrame([(1,)], "k int")
    assert ordered.spread(unknown, "k").rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))
    monkeypatch.setattr(ordered, "SPREAD_BYTES", -(-size // 5))
    assert ordered.spread(df, "k").rdd.getNumPartitions() == 5
    monkeypatch.setattr(ordered, "MOST_BLOCKS", 3)
    assert ordered.spread(df, "k").rdd.getNumPartitions() == 3


def test_grain_is_counted_on_dealt_keys(spark):
    rows = [(1, 1, "a"), (1, 2, "b"), (1, 2, "c"), (None, 1, "d"), (None, 1, "e"), (None, None, "f")]
    df = spark.createDataFrame(rows, "a int, b int, c string")
    table = checks.grain_check(df, ["a", "b"])
    assert tuple(table.first()) == (6, 4, 0)
    assert tuple(checks.grain_check(df, ["c"]).first()) == (6, 6, 1)
    assert tuple(checks.grain_check(df.filter("a > 9"), ["a"]).first()) == (0, 0, 1)
    assert "REPARTITION_BY_NUM" in _plan(table)


def test_customer_sums_hold_no_groups_in_front_of_the_exchange(spark):
    schema = "customer_id int, category string, product_id int, pay string, qty int, dollars decimal(18,2), order_id int, payment_type_id int"
    rows = [
        (1, "A", 1, "cash", 2, 1, 1, 1), (1, "A", 1, "card", 1, 2, 2, 2), (1, "B", 2, "cash", None, 3, 2, 1),
        (1, None, None, None, 4, None, None, None), (None, "A", 1, "cash", 5, 7, 3, 1),
    ]
    df = spark.createDataFrame([(*r[:5], None if r[5] is None else f"{r[5]}.50", *r[6:]) for r in rows], schema.replace("decimal(18,2)", "string"))
    df = df.withColumn("dollars", F.col("dollars").cast("decimal(18,2)"))
    table = customers.overall_features(df)
    got = {r.customer_id: tuple(r)[1:7] for r in table.collect()}
    # sales, qty, orders, products, payments, categories
    assert got == {1: (7.5, 7, 2, 2, 2, 2), None: (7.5, 5, 1, 1, 1, 1)}
    assert "REPARTITION_BY_NUM" in _plan(table)


def test_distinct_counts_double_orders_and_not_rows(spark):
    rows = [(1, 1, 1), (1, 1, 2), (1, 1, 2), (1, 2, None), (1, None, 3), (None, 1, 1), (None, None, None), (2, None, None)]
    df = spark.createDataFrame(rows, "customer_id int, order_id int, payment_type_id int").select(
        "*", F.lit("A").alias("category"), F.lit(1).alias("product_id"), F.lit("cash").alias("pay"), F.lit(1).alias("qty"),
        F.lit("1.50").cast("decimal(18,2)").alias("dollars"),
    )
    table = customers.overall_features(df)
    got = {r.customer_id: (r.orders, r.unique_payments_used) for r in table.collect()}
    assert got == {1: (2, 3), None: (1, 1), 2: (0, 0)}
    assert re.search(r"hashpartitioning\(customer_id#\d+L?, order_id#\d+L?, \d+\), REPARTITION_BY_NUM", _plan(table))


def test_wide_totals_run_in_methods_that_are_compiled(spark, sf, monkeypatch):
    name, seen = "spark.sql.codegen.hugeMethodLimit", []
    before = spark.conf.get(name)
    real = features.settle
    monkeypatch.setattr(features, "settle", lambda df, label: seen.append((label, spark.conf.get(name))) or real(df, label))
    assert QUERIES["trailing_features"](spark, sf).count() > 0
    assert ("totals", str(stage.COMPILED)) in seen and spark.conf.get(name) == before
    with pytest.raises(ZeroDivisionError), stage.compiled(spark):
        1 / 0
    assert spark.conf.get(name) == before
