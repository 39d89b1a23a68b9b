"""Scalar and user-defined functions."""

from __future__ import annotations

import math

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from basketloom.catalog import views as v
from basketloom.catalog.registry import query
from basketloom.functions import scalars as fn
from basketloom.functions import udfs
from basketloom.operators.grouping import ratio
from basketloom.plans import panel

_CODE = "SELECT outlet_code, {} FROM outlets"
_LOG = "CASE WHEN total_sales > 0 THEN round(ln(CAST(total_sales AS DOUBLE)), 9) END AS log_sales"
_GROUP = (
    "CASE WHEN classification IN ('A', 'WS') THEN CASE WHEN total_sales <= 225000 THEN 'Low' "
    "WHEN total_sales <= 400000 THEN 'Medium' ELSE 'High' END "
    "WHEN classification = 'B' THEN CASE WHEN total_sales <= 100000 THEN 'Low' "
    "WHEN total_sales <= 150000 THEN 'Medium' ELSE 'High' END "
    "WHEN classification = 'C' THEN CASE WHEN total_sales <= 50000 THEN 'Low' "
    "WHEN total_sales <= 75000 THEN 'Medium' ELSE 'High' END END AS sales_group"
)
_SALES_KEY = "SELECT order_id, line_no, product_id, customer_id, {} FROM sales"
_KEY = ["order_id", "line_no", "product_id", "customer_id"]
_DAY = "SELECT o_orderkey, CAST({} AS VARCHAR) AS {} FROM orders"
_KM = (
    "round(6373.0 * 2 * asin(sqrt(power(sin((radians(lat_b) - radians(lat_a)) / 2), 2) + cos(radians(lat_a)) * "
    "cos(radians(lat_b)) * power(sin((radians(lng_b) - radians(lng_a)) / 2), 2))), 3)"
)
_ARGS = ["lat_a", "lng_a", "lat_b", "lng_b"]


def _outlets(spark, sf):
    return v.outlets(spark, sf)


@query("fn_log", _CODE.format(_LOG), "outlets")
def _(spark, sf):
    x = F.log(F.col("total_sales").cast("double"))
    return _outlets(spark, sf).select("outlet_code", F.round(x, 9).alias("log_sales"))


@query("fn_case_multi", _CODE.format(_GROUP), "outlets")
def _(spark, sf):
    return _outlets(spark, sf).select(
        "outlet_code", fn.sales_group("total_sales", "classification").alias("sales_group")
    )


@query(
    "fn_when_otherwise",
    _SALES_KEY.format("CASE WHEN payment_type_id = 2 THEN CAST(dollars AS DOUBLE) ELSE 0 END AS payment_2_dollars"),
    "sales",
)
def _(spark, sf):
    amount = F.when(F.col("payment_type_id") == 2, F.col("dollars").cast("double")).otherwise(0.0)
    return v.sales(spark, sf).select(*_KEY, amount.alias("payment_2_dollars"))


@query("fn_haversine", f"SELECT pair_id, {_KM} AS distance FROM points", "points")
def _(spark, sf):
    return v.points(spark, sf).select("pair_id", fn.haversine(*_ARGS).alias("distance"))


@query("fn_round", _CODE.format("round(CAST(total_sales AS DOUBLE) / 1000, 1) AS sales_k"), "outlets")
def _(spark, sf):
    sales_k = F.col("total_sales").cast("double") / 1000
    return _outlets(spark, sf).select("outlet_code", F.round(sales_k, 1).alias("sales_k"))


@query(
    "fn_arith",
    _SALES_KEY.format(
        "CAST(dollars AS DOUBLE) / nullif(qty, 0) AS aur, CAST(dollars * 2 + 1 AS DOUBLE) AS twice_plus_one, qty - 1 AS qty_less_one"
    ),
    "sales",
)
def _(spark, sf):
    return v.sales(spark, sf).select(
        *_KEY,
        ratio("dollars", "qty").alias("aur"),
        (F.col("dollars") * 2 + 1).alias("twice_plus_one"),
        (F.col("qty") - 1).alias("qty_less_one"),
    )


@query("fn_to_date", _DAY.format("CAST(o_orderdate AS DATE)", "day"))
def _(spark, sf):
    text = F.col("o_orderdate").cast("string")
    return v.table(spark, sf, "orders").select("o_orderkey", F.to_date(text).alias("day"))


@query(
    "fn_week_end",
    _DAY.format("CAST(o_orderdate AS DATE) + CAST(6 - dayofweek(o_orderdate) AS INT)", "week_end"),
)
def _(spark, sf):
    orders = v.table(spark, sf, "orders")
    return orders.select("o_orderkey", fn.week_end(F.col("o_orderdate").cast("date")).alias("week_end"))


@query(
    "fn_date_parts",
    """SELECT o_orderkey, year(o_orderdate) AS year, month(o_orderdate) AS month,
       weekofyear(o_orderdate) AS weekofyear FROM orders""",
)
def _(spark, sf):
    orders = v.table(spark, sf, "orders")
    return orders.select("o_orderkey", *[f("o_orderdate").alias(f.__name__) for f in (F.year, F.month, F.weekofyear)])


@query("fn_month_key", "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m') AS month FROM orders")
def _(spark, sf):
    return v.table(spark, sf, "orders").select("o_orderkey", fn.month_key("o_orderdate").alias("month"))


@query(
    "fn_date_range",
    """SELECT CAST(CAST(unnest(generate_series(min(w), max(w), INTERVAL 7 DAY)) AS DATE) AS VARCHAR) AS week_end FROM
       (SELECT CAST(o_orderdate AS DATE) + CAST(6 - dayofweek(o_orderdate) AS INT) AS w FROM orders)""",
)
def _(spark, sf):
    """All Saturdays between the first and the last order."""
    week = fn.week_end(F.col("o_orderdate").cast("date"))
    ends = v.table(spark, sf, "orders").agg(F.min(week).alias("a"), F.max(week).alias("b"))
    return ends.select(panel.saturdays(F.col("a"), F.col("b")).alias("week_end"))


@query("fn_concat_prefix", "SELECT product_id, 'cat_' || category AS label FROM product_dim", "product_dim")
def _(spark, sf):
    return v.product_dim(spark, sf).select("product_id", F.concat(F.lit("cat_"), "category").alias("label"))


@query(
    "fn_regexp_replace",
    "SELECT payment_type_id, 'pay_' || replace(payment_type, ' ', '_') AS label FROM payment_dim",
    "payment_dim",
)
def _(spark, sf):
    return v.payment_dim(spark, sf).select("payment_type_id", fn.clean_label("pay_", "payment_type").alias("label"))


@query(
    "fn_cast",
    """SELECT c_custkey, CAST(c_acctbal AS BIGINT) AS whole, CAST(c_nationkey AS VARCHAR) AS nation_text,
       CAST(TRY_CAST(c_name AS INT) AS DOUBLE) AS not_a_number FROM
       (SELECT c_custkey, trunc(c_acctbal) AS c_acctbal, c_nationkey, c_name FROM customer)""",
)
def _(spark, sf):
    """Spark cuts the fraction off; text that is no number gives null."""
    return v.table(spark, sf, "customer").select(
        "c_custkey",
        F.col("c_acctbal").cast("bigint").alias("whole"),
        F.col("c_nationkey").cast("string").alias("nation_text"),
        F.col("c_name").try_cast("int").cast("double").alias("not_a_number"),
    )


@query(
    "fn_coalesce_isnull",
    _CODE.format(
        "CAST(coalesce(total_sales, 0) AS DOUBLE) AS sales, CAST(latitude IS NULL AS INT) AS no_position, "
        "CAST(total_sales IS NULL AS INT) AS no_sales"
    ),
    "outlets",
)
def _(spark, sf):
    return _outlets(spark, sf).select(
        "outlet_code",
        F.coalesce(F.col("total_sales").cast("double"), F.lit(0.0)).alias("sales"),
        (F.isnull("latitude") | F.isnan("latitude")).cast("int").alias("no_position"),
        F.isnull("total_sales").cast("int").alias("no_sales"),
    )


@query("fn_vector_element", "SELECT vec_id, CAST(embedding[2] AS DOUBLE) AS second FROM vectors", "vectors")
def _(spark, sf):
    vector = array_to_vector("embedding")
    return v.vectors(spark, sf).select("vec_id", vector_to_array(vector)[1].alias("second"))


@query("udf_scalar", _CODE.format(_LOG), "outlets")
def _(spark, sf):
    """One Python call per value, kept to compare it with ``fn_log``."""
    log = F.udf(lambda x: math.log(x) if x is not None and x > 0 else None, "double")
    x = log(F.col("total_sales").cast("double"))
    return _outlets(spark, sf).select("outlet_code", F.round(x, 9).alias("log_sales"))


@query("udf_row", f"SELECT pair_id, {_KM} AS distance FROM points", "points")
def _(spark, sf):
    return v.points(spark, sf).select("pair_id", udfs.haversine_udf(*_ARGS).alias("distance"))


@query("udf_vectorized", f"SELECT pair_id, {_KM} AS distance FROM points", "points")
def _(spark, sf):
    return v.points(spark, sf).select("pair_id", udfs.haversine_pandas(*_ARGS).alias("distance"))


@query(
    "haversine_variants",
    f"""SELECT pair_id, {_KM} AS by_expression, {_KM} AS by_udf, {_KM} AS by_pandas, {_KM} AS by_batches
        FROM points""",
    "points",
)
def _(spark, sf):
    """The same distance four ways."""
    batches = udfs.haversine_batches(v.points(spark, sf), _ARGS, "by_batches")
    return batches.select(
        "pair_id",
        fn.haversine(*_ARGS).alias("by_expression"),
        udfs.haversine_udf(*_ARGS).alias("by_udf"),
        udfs.haversine_pandas(*_ARGS).alias("by_pandas"),
        "by_batches",
    )
