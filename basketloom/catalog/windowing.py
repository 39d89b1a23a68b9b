"""Window functions on the outlets and on the weekly panel."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from basketloom.catalog import views as v
from basketloom.catalog.features import panel_base, totals, totals_sql
from basketloom.catalog.registry import query
from basketloom.operators import ranking
from basketloom.operators.grouping import ratio
from basketloom.plans import panel

_W = "SELECT outlet_code, {} AS {} FROM outlets"
_BY_SALES = "PARTITION BY area ORDER BY total_sales DESC NULLS LAST"
_BY_CLASS = "PARTITION BY area ORDER BY classification, total_sales DESC NULLS LAST, outlet_code"
_UP = "PARTITION BY area ORDER BY total_sales NULLS LAST, outlet_code"


def _outlets(spark, sf):
    return v.outlets(spark, sf).select("outlet_code", "area", "classification", "total_sales")


def _by_class():
    return [F.col("classification"), F.col("total_sales").desc_nulls_last(), F.col("outlet_code")]


@query("row_number_by_group", _W.format(f"row_number() OVER ({_BY_SALES}, outlet_code)", "row_num"), "outlets")
def _(spark, sf):
    order = [F.col("total_sales").desc_nulls_last(), F.col("outlet_code")]
    return ranking.row_numbers(_outlets(spark, sf), ["area"], order, "row_num").select("outlet_code", "row_num")


def _rank(name, sql):
    @query(name, _W.format(sql, name), "outlets")
    def _(spark, sf):
        return ranking.value_ranks(_outlets(spark, sf), ["area"], "total_sales").select("outlet_code", name)


_rank("rank_min", f"rank() OVER ({_BY_SALES})")
_rank("rank_dense", f"dense_rank() OVER ({_BY_SALES})")
_TIES = "count(*) OVER (PARTITION BY area, total_sales)"
_rank("rank_max", f"rank() OVER ({_BY_SALES}) + {_TIES} - 1")
_rank("rank_average", f"CAST(rank() OVER ({_BY_SALES}) AS DOUBLE) + CAST({_TIES} - 1 AS DOUBLE) / 2")


@query("row_number_multi_order", _W.format(f"row_number() OVER ({_BY_CLASS})", "rank"), "outlets")
def _(spark, sf):
    return ranking.row_numbers(_outlets(spark, sf), ["area"], _by_class(), "rank").select("outlet_code", "rank")


@query(
    "cumulative_sum",
    _W.format(
        f"CASE WHEN total_sales IS NOT NULL THEN CAST(sum(total_sales) OVER ({_BY_CLASS} ROWS UNBOUNDED PRECEDING) AS DOUBLE) END",
        "cumulative_sum",
    ),
    "outlets",
)
def _(spark, sf):
    df = ranking.cumulative(_outlets(spark, sf), ["area"], _by_class(), "total_sales")
    return df.select("outlet_code", "cumulative_sum")


_LAST7 = f"OVER ({_BY_CLASS} ROWS 6 PRECEDING)"


@query(
    "rolling_mean_7",
    _W.format(
        f"CASE WHEN count(total_sales) {_LAST7} = 7 THEN round(CAST(sum(total_sales) {_LAST7} AS DOUBLE) / 7, 1) END",
        "rolling_mean",
    ),
    "outlets",
)
def _(spark, sf):
    df = ranking.rolling_mean(_outlets(spark, sf), ["area"], _by_class(), "total_sales", 7, "rolling_mean")
    return df.select("outlet_code", F.round("rolling_mean", 1).alias("rolling_mean"))


_SO_FAR = f"OVER ({_BY_CLASS} ROWS UNBOUNDED PRECEDING)"


@query(
    "expanding_mean",
    _W.format(
        f"round(CAST(sum(total_sales) {_SO_FAR} AS DOUBLE) / nullif(count(total_sales) {_SO_FAR}, 0), 1)",
        "expanding_mean",
    ),
    "outlets",
)
def _(spark, sf):
    df = ranking.cumulative(_outlets(spark, sf), ["area"], _by_class(), "total_sales")
    return df.select("outlet_code", F.round("expanding_mean", 1).alias("expanding_mean"))


@query(
    "first_last_value",
    """SELECT outlet_code, CAST(min(total_sales) OVER (PARTITION BY area) AS DOUBLE) AS first_value,
       CAST(max(total_sales) OVER (PARTITION BY area) AS DOUBLE) AS last_value FROM outlets""",
    "outlets",
)
def _(spark, sf):
    df = ranking.first_last(_outlets(spark, sf), "area", "total_sales")
    return df.select("outlet_code", "first_value", "last_value")


@query(
    "lag_lead",
    f"""SELECT outlet_code, CAST(lag(total_sales) OVER ({_UP}) AS DOUBLE) AS previous,
        CAST(lead(total_sales) OVER ({_UP}) AS DOUBLE) AS next FROM outlets""",
    "outlets",
)
def _(spark, sf):
    order = [F.col("total_sales").asc_nulls_last(), F.col("outlet_code")]
    df = ranking.lag_lead(_outlets(spark, sf), ["area"], order, "total_sales")
    return df.select("outlet_code", "previous", "next")


@query(
    "label_next_4w_flag",
    f"SELECT customer_id, count(*) AS weeks, {totals_sql(['purchase_flag_next_4w'])} FROM flagged GROUP BY customer_id",
    "flagged",
)
def _(spark, sf):
    flagged = panel.with_flag_and_labels(panel_base(spark, sf))
    return totals(flagged, ["purchase_flag_next_4w"])


@query(
    "label_next_4w_sales",
    f"SELECT customer_id, count(*) AS weeks, {totals_sql(['sales_next_4w'])} FROM flagged GROUP BY customer_id",
    "flagged",
)
def _(spark, sf):
    flagged = panel.with_flag_and_labels(panel_base(spark, sf))
    return totals(flagged, ["sales_next_4w"])


_SUMS = [f"{c}_{n}w" for c in ("sales", "orders", "units") for n in panel.SPANS]


@query(
    "trailing_sums",
    f"SELECT customer_id, count(*) AS weeks, {totals_sql(_SUMS)} FROM rolled GROUP BY customer_id",
    "rolled",
)
def _(spark, sf):
    spec = Window.partitionBy("customer_id").orderBy("week_end")
    base = panel_base(spark, sf)
    return totals(panel.trailing_sums(base, ["sales", "orders", "units"], panel.SPANS, spec), _SUMS)


_LAG = "lag(sales, {n}) OVER (PARTITION BY customer_id ORDER BY week_end)"


def _lags(spark, sf, *spans):
    spec = Window.partitionBy("customer_id").orderBy("week_end")
    base = panel_base(spark, sf).select("customer_id", "week_end", F.col("sales").cast("double").alias("sales"))
    return base.select("*", *[F.lag("sales", n).over(spec).alias(f"sales_lag_{n}w") for n in spans])


@query(
    "lag_features",
    f"""SELECT customer_id, count(*) AS weeks, {totals_sql(['sales_lag_1w', 'sales_lag_4w'])} FROM
        (SELECT customer_id, CAST({_LAG.format(n=1)} AS DOUBLE) AS sales_lag_1w,
         CAST({_LAG.format(n=4)} AS DOUBLE) AS sales_lag_4w FROM panel) GROUP BY customer_id""",
    "panel",
)
def _(spark, sf):
    return totals(_lags(spark, sf, 1, 4), ["sales_lag_1w", "sales_lag_4w"])


@query(
    "pct_change",
    f"""SELECT customer_id, count(*) AS weeks, {totals_sql(['sales_change_13w'])} FROM
        (SELECT customer_id, (CAST(sales_13w AS DOUBLE) - CAST(before AS DOUBLE)) / nullif(CAST(before AS DOUBLE), 0)
         AS sales_change_13w FROM (SELECT customer_id, sales_13w,
         lag(sales_13w, 13) OVER (PARTITION BY customer_id ORDER BY week_end) AS before FROM rolled))
        GROUP BY customer_id""",
    "rolled",
)
def _(spark, sf):
    """Quarter-over-quarter change of the quarter's sales."""
    spec = Window.partitionBy("customer_id").orderBy("week_end")
    quarter = panel.trailing_sums(panel_base(spark, sf), ["sales"], [13], spec)
    before = quarter.withColumn("before", F.lag("sales_13w", 13).over(spec))
    change = ratio(F.col("sales_13w") - F.col("before"), F.col("before"))
    return totals(before.withColumn("sales_change_13w", change), ["sales_change_13w"])
