"""Null imputation."""

from __future__ import annotations

from pyspark.sql import functions as F

from basketloom.catalog import views as v
from basketloom.catalog.registry import query
from basketloom.operators import impute, summaries

_MEAN = "CAST(sum(total_sales) AS DOUBLE) / count(total_sales)"
_BY_CLASS = """SELECT outlet_code, coalesce(CAST(total_sales AS DOUBLE), fill) AS filled FROM outlets
    LEFT JOIN (SELECT classification, {} AS fill FROM outlets GROUP BY 1) USING (classification)"""


def _base(spark, sf):
    return v.outlets(spark, sf).select("outlet_code", "classification", "latitude", "total_sales")


@query(
    "fill_constant",
    """SELECT outlet_code, classification, coalesce(latitude, 0) AS latitude,
       CAST(coalesce(total_sales, 0) AS DOUBLE) AS total_sales FROM outlets""",
    "outlets",
)
def _(spark, sf):
    return _base(spark, sf).fillna(0, subset=["latitude", "total_sales"])


@query(
    "fill_mean",
    f"""SELECT outlet_code, coalesce(CAST(total_sales AS DOUBLE), (SELECT {_MEAN} FROM outlets)) AS filled
        FROM outlets""",
    "outlets",
)
def _(spark, sf):
    return impute.fill_mean(_base(spark, sf), "total_sales", "filled").select("outlet_code", "filled")


@query(
    "fill_median",
    """SELECT outlet_code, coalesce(CAST(total_sales AS DOUBLE),
       (SELECT median(CAST(total_sales AS DOUBLE)) FROM outlets)) AS filled FROM outlets""",
    "outlets",
)
def _(spark, sf):
    return impute.fill_median(_base(spark, sf), "total_sales", "filled").select("outlet_code", "filled")


@query(
    "fill_mode",
    """SELECT outlet_code, CAST(coalesce(total_sales, (SELECT total_sales FROM outlets WHERE total_sales IS NOT NULL
       GROUP BY total_sales ORDER BY count(*) DESC, total_sales LIMIT 1)) AS DOUBLE) AS filled FROM outlets""",
    "outlets",
)
def _(spark, sf):
    return impute.fill_mode(_base(spark, sf), "total_sales", "filled").select("outlet_code", "filled")


@query("fill_group_mean", _BY_CLASS.format(_MEAN), "outlets")
def _(spark, sf):
    df = impute.fill_group_mean(_base(spark, sf), "total_sales", "classification", "filled")
    return df.select("outlet_code", "filled")


@query("fill_group_median", _BY_CLASS.format("median(CAST(total_sales AS DOUBLE))"), "outlets")
def _(spark, sf):
    df = impute.fill_group_median(_base(spark, sf), "total_sales", "classification", "filled")
    return df.select("outlet_code", "filled")


_COMPARED = ["total_sales", "with_mean", "with_class_mean"]


@query(
    "impute_compare",
    "SELECT * FROM (WITH c AS (SELECT CAST(total_sales AS DOUBLE) AS total_sales, "
    f"coalesce(CAST(total_sales AS DOUBLE), (SELECT {_MEAN} FROM outlets)) AS with_mean, "
    f"coalesce(CAST(total_sales AS DOUBLE), fill) AS with_class_mean FROM outlets LEFT JOIN "
    f"(SELECT classification, {_MEAN} AS fill FROM outlets GROUP BY 1) USING (classification)) "
    + " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, count({c}) AS count, round(avg({c}), 4) AS mean,
        round(stddev({c}), 4) AS std, round(min({c}), 4) AS min, round(quantile_cont({c}, 0.25), 4) AS p25,
        round(quantile_cont({c}, 0.5), 4) AS p50, round(quantile_cont({c}, 0.75), 4) AS p75,
        round(max({c}), 4) AS max FROM c"""
        for c in _COMPARED
    )
    + ")",
    "outlets",
)
def _(spark, sf):
    filled = impute.fill_mean(_base(spark, sf), "total_sales", "with_mean")
    filled = impute.fill_group_mean(filled, "total_sales", "classification", "with_class_mean")
    table = summaries.describe_numeric(filled, _COMPARED)
    return table.select("column_name", "count", *[F.round(c, 4).alias(c) for c in table.columns[2:]])
