"""Feature tables. Panel results are checked by totals per customer over all weeks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketloom.catalog import views as v
from basketloom.catalog.grouping import enriched
from basketloom.catalog.registry import query
from basketloom.plans import customers, panel
from basketloom.sources.stage import compiled, settle

_C, _P = v.CATEGORIES, v.PAYMENTS
_BASE = panel.base_columns(_C, _P)
_SPLITS = panel.split_columns(_C, _P)
_COUNTS = {"orders", "units", "purchase_flag"}


# ---- SQL of the same tables -------------------------------------------------

def _split_sql():
    parts = [f"sum(dollars) FILTER (WHERE category = '{c}') AS cat_{c}" for c in _C]
    return ", ".join(parts + [f"sum(dollars) FILTER (WHERE pay = '{p}') AS pay_{p}" for p in _P])


v.add_view(
    "weekly",
    f"""SELECT customer_id, week_end, sum(dollars) AS sales, count(DISTINCT order_id) AS orders,
        sum(qty) AS units, {_split_sql()} FROM enriched GROUP BY 1, 2""",
    ["enriched"],
)
v.add_view(
    "calendar",
    """SELECT customer_id, week_end, min_week, max_week FROM
       (SELECT customer_id, min(week_end) AS min_week, max(week_end) AS max_week FROM weekly GROUP BY 1) JOIN
       (SELECT CAST(unnest(generate_series(min(week_end), max(week_end), INTERVAL 7 DAY)) AS DATE) AS week_end
        FROM weekly) ON week_end >= min_week""",
    ["weekly"],
)
v.add_view(
    "panel",
    "SELECT customer_id, week_end, min_week, max_week, "
    + ", ".join(f"coalesce({c}, 0) AS {c}" for c in ["sales", "orders", "units", *_SPLITS])
    + " FROM calendar LEFT JOIN weekly USING (customer_id, week_end)",
    ["calendar", "weekly"],
)
_NEXT = "OVER (PARTITION BY customer_id ORDER BY week_end ROWS BETWEEN 1 FOLLOWING AND 4 FOLLOWING)"
v.add_view(
    "flagged",
    f"""SELECT *, max(purchase_flag) {_NEXT} AS purchase_flag_next_4w,
        CAST(sum(sales) {_NEXT} AS DOUBLE) AS sales_next_4w
        FROM (SELECT *, CASE WHEN sales > 0 THEN 1 ELSE 0 END AS purchase_flag FROM panel)""",
    ["panel"],
)
v.add_view(
    "rolled",
    "SELECT *, "
    + ", ".join(
        f"sum({c}) OVER (PARTITION BY customer_id ORDER BY week_end ROWS {n - 1} PRECEDING) AS {c}_{n}w"
        for c in _BASE
        for n in panel.SPANS
    )
    + " FROM flagged",
    ["flagged"],
)


def _over(a, b, name):
    return f"CAST({a} AS DOUBLE) / nullif(CAST({b} AS DOUBLE), 0) AS {name}"


_SUFFIX = ["", *[f"_{n}w" for n in panel.SPANS]]
_RATIOS = {
    f"{n}{s}": _over(f"{a}{s}", f"{b}{s}", f"{n}{s}")
    for s in _SUFFIX
    for n, a, b in (("aov", "sales", "orders"), ("aur", "sales", "units"), ("upt", "units", "orders"))
}
_SHARES = {f"{c}_26w_perc": _over(f"{c}_26w", "sales_26w", f"{c}_26w_perc") for c in _SPLITS}
_STEPS = [("1w", "sales"), *[(f"{n}w", f"sales_{n}w") for n in panel.SPANS]]
_TRENDS = {
    f"sales_{a}_over_{b}": _over(x, y, f"sales_{a}_over_{b}")
    for (a, x), (b, y) in zip(_STEPS, _STEPS[1:])
}
_TIMES = {
    "year": "year(week_end) AS year",
    "month": "month(week_end) AS month",
    "weekofyear": "weekofyear(week_end) AS weekofyear",
}
_TRAILING = [f"{c}_{n}w" for c in _BASE for n in panel.SPANS]
v.add_view(
    "features",
    "SELECT *, " + ", ".join([*_RATIOS.values(), *_SHARES.values(), *_TRENDS.values(), *_TIMES.values()]) + " FROM rolled",
    ["rolled"],
)
_FEATURES = [*_BASE, *_TRAILING, *_RATIOS, *_SHARES, *_TRENDS, *_TIMES]
v.add_view(
    "modelled",
    """SELECT * FROM features WHERE week_end IN (SELECT max(week_end) FROM features GROUP BY date_trunc('month', week_end))
       AND sales_52w > 0 AND week_end < (SELECT max(week_end) FROM features) - 21""",
    ["features"],
)


def totals_sql(columns: Sequence[str]) -> str:
    """Exact totals: every value in whole millionths, added as integers; a null counts -7."""
    return ", ".join(
        f"CAST(sum(coalesce(CAST(floor(CAST({c} AS DOUBLE) * 1000000) AS BIGINT), -7)) AS DOUBLE) AS {c}"
        for c in columns
    )


def totals(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    def exact(c: str):
        whole = F.floor(F.col(c).cast("double") * 1000000.0)
        return F.sum(F.coalesce(whole, F.lit(-7).cast("bigint"))).cast("double")

    return (
        df.select("customer_id", *columns)
        .groupBy("customer_id")
        .agg(F.count(F.lit(1)).alias("weeks"), *[exact(c).alias(c) for c in columns])
    )


def _totals_of(view, columns):
    return f"SELECT customer_id, count(*) AS weeks, {totals_sql(columns)} FROM {view} GROUP BY customer_id"


# ---- the same tables on Spark ------------------------------------------------

def weekly(spark, sf) -> DataFrame:
    return panel.weekly_aggregate(enriched(spark, sf), _C, _P)


def panel_base(spark, sf) -> DataFrame:
    return panel.weekly_base(weekly(spark, sf))


def running_base(spark, sf) -> DataFrame:
    return panel.weekly_base(weekly(spark, sf), running=True)


def trailing(spark, sf) -> DataFrame:
    return panel.trailing_features(panel.with_flag_and_labels(running_base(spark, sf)), _C, _P)


def rolling(spark, sf) -> DataFrame:
    return panel.rolling_feature_table(running_base(spark, sf), _C, _P)


def modelled(spark, sf) -> DataFrame:
    return panel.model_table(settle(weekly(spark, sf), "weekly"), _C, _P)


_stored: dict[tuple[str, str, str], DataFrame] = {}


def stored(spark, sf, name, build) -> DataFrame:
    """A feature table written once per application, as the batch jobs keep it."""
    key = (spark.sparkContext.applicationId, sf, name)
    if key not in _stored:
        _stored[key] = settle(build(spark, sf), name)
    return _stored[key]


def customer_table(spark, sf) -> DataFrame:
    return customers.customer_features(
        v.sales(spark, sf),
        v.product_dim(spark, sf),
        settle(v.payment_dim(spark, sf), "payment"),
        v.customer_dim(spark, sf),
        _C,
        _P,
    )


_CUSTOMER_SQL = (
    "SELECT customer_id, sales, qty, orders, unique_products_bought, unique_payments_used, "
    "unique_categories_bought, sales / orders AS aov, sales / qty AS aur, CAST(qty AS DOUBLE) / orders AS upt, "
    + ", ".join(
        f"CAST(s_{c} AS DOUBLE) / sales AS {c}_cat_sales, CAST(u_{c} AS DOUBLE) / qty AS {c}_cat_units" for c in _C
    )
    + ", "
    + ", ".join(f"CAST(p_{p} AS DOUBLE) / sales AS pay_{p}" for p in _P)
    + ", email_subscribed, omni_shopper FROM (SELECT customer_id, CAST(sum(dollars) AS DOUBLE) AS sales, "
    "CAST(sum(qty) AS BIGINT) AS qty, count(DISTINCT order_id) AS orders, "
    "count(DISTINCT product_id) AS unique_products_bought, count(DISTINCT payment_type_id) AS unique_payments_used, "
    "count(DISTINCT category) AS unique_categories_bought, "
    + ", ".join(
        f"sum(dollars) FILTER (WHERE category = '{c}') AS s_{c}, sum(qty) FILTER (WHERE category = '{c}') AS u_{c}"
        for c in _C
    )
    + ", "
    + ", ".join(f"sum(dollars) FILTER (WHERE pay = '{p}') AS p_{p}" for p in _P)
    + " FROM enriched GROUP BY customer_id) LEFT JOIN customer_dim USING (customer_id)"
)
v.add_view("customer_table", _CUSTOMER_SQL, ["enriched", "customer_dim"])


@query("customer_features", "SELECT * FROM customer_table", "customer_table")
def _(spark, sf):
    return customer_table(spark, sf)


@query(
    "category_share_features",
    "SELECT customer_id, "
    + ", ".join(f"{c}_cat_{k}" for c in _C for k in ("sales", "units"))
    + " FROM customer_table",
    "customer_table",
)
def _(spark, sf):
    return customers.category_share_features(enriched(spark, sf), _C)


@query(
    "payment_share_features",
    "SELECT customer_id, " + ", ".join(f"pay_{p}" for p in _P) + " FROM customer_table",
    "customer_table",
)
def _(spark, sf):
    return customers.payment_share_features(enriched(spark, sf), _P)


@query(
    "weekly_aggregate",
    "SELECT customer_id, CAST(week_end AS VARCHAR) AS week_end, CAST(sales AS DOUBLE) AS sales, orders, "
    "CAST(units AS BIGINT) AS units, " + ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in _SPLITS) + " FROM weekly",
    "weekly",
)
def _(spark, sf):
    return weekly(spark, sf)


@query(
    "calendar_fill",
    """SELECT customer_id, CAST(min_week AS VARCHAR) AS min_week, CAST(max_week AS VARCHAR) AS max_week,
       count(*) AS weeks, CAST(min(week_end) AS VARCHAR) AS first_week, CAST(max(week_end) AS VARCHAR) AS last_week,
       count(DISTINCT week_end) AS distinct_weeks FROM calendar GROUP BY customer_id, min_week, max_week""",
    "calendar",
)
def _(spark, sf):
    base = panel_base(spark, sf)
    return base.groupBy("customer_id", "min_week", "max_week").agg(
        F.count(F.lit(1)).alias("weeks"),
        F.min("week_end").alias("first_week"),
        F.max("week_end").alias("last_week"),
        F.countDistinct("week_end").alias("distinct_weeks"),
    )


@query("weekly_base", _totals_of("panel", ["sales", "orders", "units", *_SPLITS]), "panel")
def _(spark, sf):
    return totals(panel_base(spark, sf), ["sales", "orders", "units", *_SPLITS])


@query("trailing_features", _totals_of("rolled", _TRAILING), "rolled")
def _(spark, sf):
    """All trailing sums; run here, since 68 columns in one generated method are not compiled."""
    with compiled(spark):
        return settle(totals(trailing(spark, sf), _TRAILING), "totals")


@query("trailing_ratios", _totals_of("features", list(_RATIOS)), "features")
def _(spark, sf):
    return totals(panel.derived(trailing(spark, sf), panel.ratio_columns()), list(_RATIOS))


@query("trailing_shares", _totals_of("features", list(_SHARES)), "features")
def _(spark, sf):
    return totals(panel.derived(trailing(spark, sf), panel.share_columns(_C, _P)), list(_SHARES))


@query("trend_ratios", _totals_of("features", list(_TRENDS)), "features")
def _(spark, sf):
    return totals(panel.derived(trailing(spark, sf), panel.trend_columns()), list(_TRENDS))


@query("time_elements", _totals_of("features", list(_TIMES)), "features")
def _(spark, sf):
    return totals(panel.derived(panel_base(spark, sf), panel.time_columns()), list(_TIMES))


@query("rolling_feature_table", _totals_of("features", [*_FEATURES, *panel.LABELS]), "features")
def _(spark, sf):
    return totals(rolling(spark, sf), [*_FEATURES, *panel.LABELS])


def table_sql(view: str) -> str:
    """All columns of a feature table: ids and dates as they are, labels, then every feature as double."""
    plain = "customer_id, CAST(week_end AS VARCHAR) AS week_end, CAST(min_week AS VARCHAR) AS min_week, CAST(max_week AS VARCHAR) AS max_week"
    values = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in _FEATURES)
    return f"SELECT {plain}, {', '.join(panel.LABELS)}, {values} FROM {view}"


def whole_table(df: DataFrame) -> DataFrame:
    return df.select(*panel.IDS, *panel.LABELS, *[F.col(c).cast("double").alias(c) for c in _FEATURES])


@query("model_dataset", table_sql("modelled"), "modelled")
def _(spark, sf):
    """All features and both labels, without the panel."""
    return whole_table(modelled(spark, sf))
