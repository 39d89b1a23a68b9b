"""Projections, filters, sorts, limits and set operations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketloom.catalog import views as v
from basketloom.catalog.registry import query
from basketloom.functions import scalars
from basketloom.operators import ranking

_OUTLETS = "SELECT * REPLACE (CAST(total_sales AS DOUBLE) AS total_sales) FROM outlets"
_SALES = "SELECT * REPLACE (CAST(dollars AS DOUBLE) AS dollars, CAST(tran_dt AS VARCHAR) AS tran_dt) FROM sales"


@query("select_columns", "SELECT region, outlet_code FROM outlets", "outlets")
def _(spark, sf):
    return v.outlets(spark, sf).select("region", "outlet_code")


@query("row_slice", f"{_OUTLETS} ORDER BY outlet_code LIMIT 6 OFFSET 5", "outlets")
def _(spark, sf):
    return v.outlets(spark, sf).orderBy("outlet_code").offset(5).limit(6)


@query(
    "with_column",
    "SELECT outlet_code, CAST(total_sales AS DOUBLE) / 1000 AS sales_k FROM outlets",
    "outlets",
)
def _(spark, sf):
    df = v.outlets(spark, sf).withColumn("sales_k", F.col("total_sales").cast("double") / 1000)
    return df.select("outlet_code", "sales_k")


@query("rename_column", "SELECT outlet_code AS code, area AS district FROM outlets", "outlets")
def _(spark, sf):
    """A source that does not exist is ignored, as in Spark."""
    df = v.outlets(spark, sf).select("outlet_code", "area")
    return df.withColumnRenamed("outlet_code", "code").withColumnsRenamed({"area": "district", "nothing": "x"})


@query(
    "rename_bulk",
    "SELECT customer_id AS customer_id_r, age AS age_r, omni_shopper AS omni_shopper_r FROM customer_dim",
    "customer_dim",
)
def _(spark, sf):
    return scalars.suffix_all(v.customer_dim(spark, sf).select("customer_id", "age", "omni_shopper"), "_r")


@query("drop_columns", "SELECT region, area, outlet_code FROM outlets", "outlets")
def _(spark, sf):
    return v.outlets(spark, sf).drop(
        "outlet_type", "latitude", "longitude", "total_sales", "classification"
    )


@query("filter_simple", f"{_OUTLETS} WHERE total_sales > 400000", "outlets")
def _(spark, sf):
    return v.outlets(spark, sf).filter("total_sales > 400000")


@query("filter_compound", f"{_OUTLETS} WHERE total_sales > 300000 AND total_sales <= 400000", "outlets")
def _(spark, sf):
    sales = F.col("total_sales")
    return v.outlets(spark, sf).where((sales > 300000) & (sales <= 400000))


@query(
    "filter_query_expr",
    f"""{_OUTLETS} WHERE (outlet_type IN ('BUILDING', 'MACHINERY') AND region = 'ASIA')
        OR (NOT outlet_type IN ('BUILDING', 'MACHINERY', 'FURNITURE') AND region = 'EUROPE')""",
    "outlets",
)
def _(spark, sf):
    return v.outlets(spark, sf).filter(
        "(outlet_type in ('BUILDING', 'MACHINERY') and region = 'ASIA') or "
        "(not outlet_type in ('BUILDING', 'MACHINERY', 'FURNITURE') and region = 'EUROPE')"
    )


@query("filter_isnull", f"{_OUTLETS} WHERE total_sales IS NULL", "outlets")
def _(spark, sf):
    return v.outlets(spark, sf).filter(F.col("total_sales").isNull())


@query(
    "filter_date",
    f"{_SALES} WHERE tran_dt > (SELECT max(tran_dt) FROM sales) - 28 AND tran_dt >= DATE '2000-01-01'",
    "sales",
)
def _(spark, sf):
    """A literal bound, and a bound four weeks before the newest date (a scalar subquery)."""
    sales = v.sales(spark, sf)
    newest = v.table(spark, sf, "orders").join(
        v.table(spark, sf, "lineitem"), F.col("o_orderkey") == F.col("l_orderkey"), "left_semi"
    ).agg(F.max(F.col("o_orderdate").cast("date"))).scalar()
    day = F.col("tran_dt")
    return sales.filter((day > F.date_sub(newest, 28)) & (day >= F.lit("2000-01-01").cast("date")))


@query("distinct_rows", "SELECT DISTINCT region, classification FROM outlets", "outlets")
def _(spark, sf):
    return v.outlets(spark, sf).select("region", "classification").distinct()


@query(
    "drop_nulls",
    f"{_OUTLETS} WHERE total_sales IS NOT NULL AND latitude IS NOT NULL AND longitude IS NOT NULL",
    "outlets",
)
def _(spark, sf):
    return v.outlets(spark, sf).dropna()


_RANKED = "SELECT outlet_code, CAST(total_sales AS DOUBLE) AS total_sales, row_number() OVER (ORDER BY {}) AS rank FROM outlets"


@query(
    "sort_single",
    _RANKED.format("total_sales DESC NULLS LAST, outlet_code"),
    "outlets",
)
def _(spark, sf):
    """Descending sort of the whole table; the place of each row is part of the result."""
    df = v.outlets(spark, sf).select("outlet_code", "total_sales")
    order = [F.col("total_sales").desc_nulls_last(), F.col("outlet_code")]
    return ranking.row_numbers(df, [], order, "rank").orderBy("rank")


@query(
    "sort_multi",
    """SELECT outlet_code, area, CAST(total_sales AS DOUBLE) AS total_sales,
       row_number() OVER (ORDER BY area, total_sales DESC NULLS LAST, outlet_code) AS rank FROM outlets""",
    "outlets",
)
def _(spark, sf):
    df = v.outlets(spark, sf).select("outlet_code", "area", "total_sales")
    order = [F.col("area"), F.col("total_sales").desc_nulls_last(), F.col("outlet_code")]
    return ranking.row_numbers(df, [], order, "rank").orderBy("rank")


@query("top_n", f"{_OUTLETS} ORDER BY total_sales DESC NULLS LAST, outlet_code LIMIT 20", "outlets")
def _(spark, sf):
    return v.outlets(spark, sf).orderBy(F.col("total_sales").desc_nulls_last(), "outlet_code").limit(20)


@query(
    "top_n_per_group",
    """SELECT * FROM (SELECT area, outlet_code, CAST(total_sales AS DOUBLE) AS total_sales, row_number() OVER
       (PARTITION BY area ORDER BY total_sales DESC NULLS LAST, outlet_code) AS position FROM outlets)
       WHERE position <= 3""",
    "outlets",
)
def _(spark, sf):
    df = v.outlets(spark, sf).select("area", "outlet_code", "total_sales")
    return ranking.top_per_group(df, ["area"], [F.col("total_sales").desc_nulls_last(), F.col("outlet_code")], 3)


@query(
    "union_by_name",
    f"{_OUTLETS} UNION ALL BY NAME {_OUTLETS.replace('FROM outlets', 'FROM more_outlets')}",
    "outlets more_outlets",
)
def _(spark, sf):
    return v.outlets(spark, sf).unionByName(v.more_outlets(spark, sf))


@query(
    "union_many",
    """SELECT region, classification, count(*) AS n FROM (SELECT region, classification FROM outlets
       UNION ALL SELECT region, classification FROM more_outlets
       UNION ALL SELECT region, classification FROM outlets) GROUP BY ALL""",
    "outlets more_outlets",
)
def _(spark, sf):
    frames = [v.outlets(spark, sf), v.more_outlets(spark, sf), v.outlets(spark, sf)]
    return reduce(DataFrame.unionByName, frames).groupBy("region", "classification").agg(
        F.count(F.lit(1)).alias("n")
    )


@query(
    "union_positional",
    """SELECT CAST(omni_shopper AS VARCHAR) AS label, count(*) AS n FROM customer_dim GROUP BY 1
       UNION ALL SELECT 'overall', count(*) FROM customer_dim""",
    "customer_dim",
)
def _(spark, sf):
    """An integer label meets the text 'overall': cast before the union."""
    customer = v.customer_dim(spark, sf)
    n = F.count(F.lit(1)).alias("n")
    groups = customer.groupBy(F.col("omni_shopper").cast("string").alias("label")).agg(n)
    return groups.union(customer.agg(n).select(F.lit("overall"), "n"))
