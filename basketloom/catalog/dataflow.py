"""Partitioning, caching and stage tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketloom.catalog import views as v
from basketloom.catalog.registry import query
from basketloom.plans.enrich import enrich
from basketloom.plans.panel import weekly_aggregate
from basketloom.sources.resume import Stages
from basketloom.sources.stage import cached, settle, stage_path


@query(
    "repartition_n",
    "SELECT 6 AS partitions, count(*) AS n_rows, 1 AS keys_stay_together FROM sales",
    "sales",
)
def _(spark, sf):
    """Six partitions by product; every product lies in one of them."""
    placed = v.sales(spark, sf).repartition(6, "product_id").withColumn("p", F.spark_partition_id())
    per_key = placed.groupBy("product_id").agg(
        F.count(F.lit(1)).alias("n"), F.min("p").alias("low"), F.max("p").alias("high")
    )
    return per_key.agg(
        F.countDistinct("low").alias("partitions"),
        F.sum("n").alias("n_rows"),
        F.min((F.col("low") == F.col("high")).cast("int")).alias("keys_stay_together"),
    )


@query(
    "persist_reuse",
    """SELECT payment_type_id, CAST(sum(dollars) AS DOUBLE) AS dollars,
       CAST(sum(dollars) AS DOUBLE) / (SELECT CAST(sum(dollars) AS DOUBLE) FROM sales) AS share
       FROM sales GROUP BY payment_type_id""",
    "sales",
)
def _(spark, sf):
    """One cached aggregate read twice: by the rows and by their total. It is released when both are done."""
    sums = v.sales(spark, sf).groupBy("payment_type_id").agg(F.sum("dollars").alias("dollars"))
    with cached(sums):
        total = sums.agg(F.sum("dollars").cast("double")).scalar()
        return settle(sums.select("*", F.try_divide(F.col("dollars").cast("double"), total).alias("share")), "shares")


@query(
    "checkpoint_parquet",
    """SELECT customer_id, CAST(week_end AS VARCHAR) AS week_end, CAST(sales AS DOUBLE) AS sales, orders,
       CAST(units AS BIGINT) AS units FROM weekly""",
    "weekly",
)
def _(spark, sf):
    """Two stages through resumable tables; a second job over the same folder only reads them."""
    folder = stage_path(spark, "job")
    tables = [v.sales(spark, sf), v.product_dim(spark, sf), v.payment_dim(spark, sf)]

    def job() -> tuple[Stages, DataFrame]:
        stages = Stages(spark, folder)
        rows = stages.table("enriched", lambda: enrich(*tables), reads=tables)
        return stages, stages.table("weekly", lambda: weekly_aggregate(rows, v.CATEGORIES, v.PAYMENTS), reads=["enriched"])

    job()
    stages, table = job()
    if stages.made:
        raise RuntimeError(f"made again: {stages.made}")
    return table.select("customer_id", "week_end", "sales", "orders", "units")
