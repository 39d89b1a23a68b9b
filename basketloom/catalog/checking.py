"""Exploration and data checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from basketloom.catalog import views as v
from basketloom.catalog.registry import query
from basketloom.operators import checks, summaries

_OUTLET_COLUMNS = [
    ("region", "string"),
    ("area", "string"),
    ("outlet_code", "bigint"),
    ("outlet_type", "string"),
    ("latitude", "double"),
    ("longitude", "double"),
    ("total_sales", "decimal(18,2)"),
    ("classification", "string"),
]
_NUMERIC = ["latitude", "longitude", "total_sales"]
_TEXT = ["region", "area", "outlet_type", "classification"]


def _rounded(df, digits=4):
    """Doubles rounded on both sides: engines add them in different orders."""
    doubles = {n for n, t in df.dtypes if t == "double"}
    return df.select(*[F.round(c, digits).alias(c) if c in doubles else F.col(c) for c in df.columns])


def _union(parts):
    return "\nUNION ALL ".join(parts)


_OUTLETS = "SELECT * REPLACE (CAST(total_sales AS DOUBLE) AS total_sales) FROM outlets"


@query("head_n", f"{_OUTLETS} ORDER BY outlet_code LIMIT 5", "outlets")
def _(spark, sf):
    return v.outlets(spark, sf).orderBy("outlet_code").limit(5)


@query("tail_n", f"{_OUTLETS} ORDER BY outlet_code DESC LIMIT 5", "outlets")
def _(spark, sf):
    return v.outlets(spark, sf).orderBy(F.col("outlet_code").desc()).limit(5)


@query(
    "schema_info",
    _union(
        f"SELECT {i} AS position, '{c}' AS column_name, '{t}' AS data_type, count({c}) AS non_null FROM outlets"
        for i, (c, t) in enumerate(_OUTLET_COLUMNS)
    ),
    "outlets",
)
def _(spark, sf):
    return checks.schema_info(v.outlets(spark, sf))


@query("column_list", "SELECT column_name FROM (DESCRIBE SELECT * FROM lineitem)")
def _(spark, sf):
    """The columns of the order lines, as rows of the schema check."""
    return checks.schema_info(v.table(spark, sf, "lineitem")).select("column_name")


@query("shape", "SELECT count(*) AS n_rows, 8 AS n_columns FROM sales", "sales")
def _(spark, sf):
    return checks.shape(v.sales(spark, sf))


def _moments(c, by=""):
    lead = f"{by}, " if by else ""
    return (
        f"SELECT {lead}'{c}' AS column_name, count({c}) AS count, round(avg(CAST({c} AS DOUBLE)), 4) AS mean, "
        f"round(stddev(CAST({c} AS DOUBLE)), 4) AS std, round(min(CAST({c} AS DOUBLE)), 4) AS min, "
        + ", ".join(
            f"round(quantile_cont(CAST({c} AS DOUBLE), {q}), 4) AS {n}"
            for n, q in (("p25", 0.25), ("p50", 0.5), ("p75", 0.75))
        )
        + f", round(max(CAST({c} AS DOUBLE)), 4) AS max FROM outlets"
        + (f" GROUP BY {by}" if by else "")
    )


@query("describe_numeric", _union(_moments(c) for c in _NUMERIC), "outlets")
def _(spark, sf):
    return _rounded(summaries.describe_numeric(v.outlets(spark, sf), _NUMERIC))


@query(
    "describe_string",
    _union(
        f"""SELECT '{c}' AS column_name, count({c}) AS count, count(DISTINCT {c}) AS "unique",
            (SELECT {c} FROM outlets GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1) AS top,
            (SELECT count(*) FROM outlets GROUP BY {c} ORDER BY count(*) DESC LIMIT 1) AS freq FROM outlets"""
        for c in _TEXT
    ),
    "outlets",
)
def _(spark, sf):
    return summaries.describe_string(v.outlets(spark, sf), _TEXT)


@query("describe_grouped", _union(_moments(c, "classification") for c in _NUMERIC), "outlets")
def _(spark, sf):
    return _rounded(summaries.describe_numeric(v.outlets(spark, sf), _NUMERIC, by=["classification"]))


def _stat(label, over, text):
    return (
        f"SELECT '{label}' AS summary, "
        + ", ".join(f"round(CAST({over.format(c=c)} AS DOUBLE), 4) AS {c}" for c in ("latitude", "total_sales"))
        + f", {text} AS area FROM outlets"
    )


@query(
    "summary_default",
    _union(
        [
            _stat("count", "count({c})", "CAST(count(area) AS VARCHAR)"),
            _stat("mean", "avg(CAST({c} AS DOUBLE))", "NULL"),
            _stat("stddev", "stddev(CAST({c} AS DOUBLE))", "NULL"),
            _stat("min", "min({c})", "min(area)"),
            *[_stat(f"{p}%", "quantile_disc({c}, " + str(p / 100) + ")", "NULL") for p in (25, 50, 75)],
            _stat("max", "max({c})", "max(area)"),
        ]
    ),
    "outlets",
)
def _(spark, sf):
    return _rounded(summaries.summary(v.outlets(spark, sf), ["latitude", "total_sales"], ["area"]))


_POINTS = ", ".join(
    f"round(CAST(quantile_disc({{c}}, {p} / 100.0) AS DOUBLE), 4) AS p{f'{p:g}'.replace('.', '_')}"
    for p in summaries.LONG_PERCENTS
)


@query(
    "summary_percentiles",
    _union(
        f"SELECT '{c}' AS column_name, count({c}) AS count, round(avg(CAST({c} AS DOUBLE)), 4) AS mean, "
        f"round(stddev(CAST({c} AS DOUBLE)), 4) AS stddev, round(CAST(min({c}) AS DOUBLE), 4) AS min, "
        f"{_POINTS.format(c=c)}, round(CAST(max({c}) AS DOUBLE), 4) AS max FROM outlets"
        for c in ("outlet_code", "latitude", "longitude", "total_sales")
    ),
    "outlets",
)
def _(spark, sf):
    return _rounded(
        summaries.summary_percentiles(
            v.outlets(spark, sf), ["outlet_code", "latitude", "longitude", "total_sales"]
        )
    )


@query(
    "null_counts",
    _union(
        f"SELECT '{c}' AS column_name, count(*) - count({c}) AS nulls FROM outlets" for c, _t in _OUTLET_COLUMNS
    ),
    "outlets",
)
def _(spark, sf):
    return checks.null_counts(v.outlets(spark, sf))


@query(
    "grain_check",
    """SELECT n_rows, n_groups, CAST(n_rows = n_groups AS INT) AS is_key FROM (
         SELECT CAST(sum(n) AS BIGINT) AS n_rows, count(*) AS n_groups
         FROM (SELECT count(*) AS n FROM sales GROUP BY order_id, line_no))""",
    "sales",
)
def _(spark, sf):
    return checks.grain_check(v.sales(spark, sf), ["order_id", "line_no"])


@query(
    "distinct_counts",
    """SELECT count(*) AS n_rows, count(DISTINCT order_id) AS distinct_order_id,
       count(DISTINCT customer_id) AS distinct_customer_id, count(DISTINCT product_id) AS distinct_product_id
       FROM sales""",
    "sales",
)
def _(spark, sf):
    return checks.distinct_counts(v.sales(spark, sf), ["order_id", "customer_id", "product_id"])


@query(
    "dimension_coverage",
    """SELECT count(*) AS fact_keys, count(active_ind) AS known_keys, count(*) - count(active_ind) AS missing_keys
       FROM outlets LEFT JOIN outlet_active USING (outlet_code)""",
    "outlets outlet_active",
)
def _(spark, sf):
    return checks.dimension_coverage(v.outlets(spark, sf), v.outlet_active(spark, sf), "outlet_code")


@query(
    "value_counts",
    "SELECT classification, count(*) AS n FROM outlets GROUP BY classification",
    "outlets",
)
def _(spark, sf):
    return checks.value_counts(v.outlets(spark, sf), "classification")


@query(
    "stage_row_counts",
    """SELECT count(*) AS all_rows, count(*) FILTER (WHERE dollars > 1500) AS large,
       count(*) FILTER (WHERE dollars > 1500 AND qty < 4) AS large_few,
       count(*) FILTER (WHERE dollars > 1500 AND qty < 4 AND tran_dt >= DATE '1998-01-01') AS recent
       FROM sales""",
    "sales",
)
def _(spark, sf):
    return checks.stage_row_counts(
        v.sales(spark, sf),
        {
            "large": F.col("dollars") > 1500,
            "large_few": F.col("qty") < 4,
            "recent": F.col("tran_dt") >= F.lit("1998-01-01").cast("date"),
        },
    )


@query(
    "event_rate",
    """SELECT CAST(sum(label) AS DOUBLE) / count(label) AS event_rate,
       CAST(sum(prediction) AS DOUBLE) / count(prediction) AS predicted_rate FROM binary_scores""",
    "binary_scores",
)
def _(spark, sf):
    return checks.event_rate(v.binary_scores(spark, sf), event_rate="label", predicted_rate="prediction")
