"""Joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from basketloom.catalog import views as v
from basketloom.catalog.registry import query
from basketloom.functions.scalars import week_end
from basketloom.operators import joins
from basketloom.plans import panel
from basketloom.sources.stage import settle

_SALES = """s.order_id, s.line_no, CAST(s.tran_dt AS VARCHAR) AS tran_dt, s.customer_id,
    CAST(s.dollars AS DOUBLE) AS dollars, s.qty, s.product_id, s.payment_type_id"""


def _pair(spark, sf):
    return v.outlets(spark, sf).select("outlet_code", "area"), v.outlet_active(spark, sf)


@query(
    "join_inner",
    f"SELECT {_SALES}, category FROM sales s JOIN product_dim USING (product_id)",
    "sales product_dim",
)
def _(spark, sf):
    product = v.product_dim(spark, sf).select("product_id", "category")
    return v.sales(spark, sf).join(product, "product_id", "inner")


@query(
    "join_left",
    f"""SELECT {_SALES}, category, payment_type FROM sales s LEFT JOIN product_dim USING (product_id)
        LEFT JOIN payment_dim USING (payment_type_id)""",
    "sales product_dim payment_dim",
)
def _(spark, sf):
    product = v.product_dim(spark, sf).select("product_id", "category")
    payment = settle(v.payment_dim(spark, sf), "payment")
    return v.sales(spark, sf).join(product, ["product_id"], "left").join(payment, ["payment_type_id"], "left")


@query(
    "join_left_diff_names",
    f"SELECT {_SALES}, c.customer_id AS c_id, age FROM sales s LEFT JOIN customer_dim c ON s.customer_id = c.customer_id",
    "sales customer_dim",
)
def _(spark, sf):
    sales = v.sales(spark, sf)
    customer = v.customer_dim(spark, sf).select(F.col("customer_id").alias("c_id"), "age")
    return sales.join(customer, [sales.customer_id == customer.c_id], "left")


_WEEK = "SELECT customer_id, tran_dt + CAST(6 - dayofweek(tran_dt) AS INT) AS week_end, dollars, qty FROM sales"


@query(
    "join_multi_key",
    f"""SELECT customer_id, CAST(week_end AS VARCHAR) AS week_end, CAST(sales AS DOUBLE) AS sales, units FROM
        (SELECT customer_id, week_end, sum(dollars) AS sales FROM ({_WEEK}) GROUP BY 1, 2) LEFT JOIN
        (SELECT customer_id, week_end, CAST(sum(qty) AS BIGINT) AS units FROM ({_WEEK}) GROUP BY 1, 2)
        USING (customer_id, week_end)""",
    "sales",
)
def _(spark, sf):
    weeks = v.sales(spark, sf).withColumn("week_end", week_end("tran_dt"))
    by_week = weeks.groupBy("customer_id", "week_end")
    return by_week.agg(F.sum("dollars").alias("sales")).join(
        by_week.agg(F.sum("qty").alias("units")), ["customer_id", "week_end"], "left"
    )


@query(
    "join_right",
    """SELECT CAST(outlet_code AS DOUBLE) AS outlet_code, area, active_ind
       FROM outlets RIGHT JOIN outlet_active USING (outlet_code)""",
    "outlets outlet_active",
)
def _(spark, sf):
    left, right = _pair(spark, sf)
    return left.join(right, "outlet_code", "right").withColumn("outlet_code", F.col("outlet_code").cast("double"))


@query(
    "join_full",
    """SELECT outlet_code, area, CAST(active_ind AS DOUBLE) AS active_ind
       FROM outlets FULL JOIN outlet_active USING (outlet_code)""",
    "outlets outlet_active",
)
def _(spark, sf):
    left, right = _pair(spark, sf)
    return left.join(right, "outlet_code", "full").withColumn("active_ind", F.col("active_ind").cast("double"))


@query(
    "join_semi",
    "SELECT outlet_code, area FROM outlets WHERE outlet_code IN (SELECT outlet_code FROM outlet_active)",
    "outlets outlet_active",
)
def _(spark, sf):
    left, right = _pair(spark, sf)
    return left.join(right, "outlet_code", "left_semi")


@query(
    "join_anti",
    "SELECT outlet_code, area FROM outlets WHERE outlet_code NOT IN (SELECT outlet_code FROM outlet_active)",
    "outlets outlet_active",
)
def _(spark, sf):
    left, right = _pair(spark, sf)
    return left.join(right, "outlet_code", "left_anti")


@query("join_cross", "SELECT outlet_code, r_name AS target FROM outlets CROSS JOIN region", "outlets")
def _(spark, sf):
    """Every outlet with every region: the short side is carried as one array."""
    regions = v.table(spark, sf, "region").select("r_name")
    return joins.pair_with_all(v.outlets(spark, sf).select("outlet_code"), regions, "target")


@query(
    "join_broadcast",
    f"SELECT {_SALES}, payment_type FROM sales s LEFT JOIN payment_dim USING (payment_type_id)",
    "sales payment_dim",
)
def _(spark, sf):
    payment = settle(v.payment_dim(spark, sf), "payment")
    return v.sales(spark, sf).join(payment, "payment_type_id", "left")


@query(
    "join_index",
    """SELECT outlet_code, area, CAST(active_ind AS DOUBLE) AS active_ind
       FROM outlets LEFT JOIN outlet_active USING (outlet_code)""",
    "outlets outlet_active",
)
def _(spark, sf):
    """What an index join does, on the key column that stands for the index."""
    left, right = _pair(spark, sf)
    return left.join(right, "outlet_code", "left").withColumn("active_ind", F.col("active_ind").cast("double"))


@query(
    "join_back_filter",
    f"""SELECT {_SALES} FROM sales s WHERE s.tran_dt IN
        (SELECT max(tran_dt) FROM sales GROUP BY date_trunc('month', tran_dt))""",
    "sales",
)
def _(spark, sf):
    """Keep the last selling day of every month."""
    sales = v.sales(spark, sf)
    days = sales.groupBy(F.trunc("tran_dt", "month").alias("month")).agg(F.max("tran_dt").alias("tran_dt"))
    short = settle(days.select("tran_dt"), "days")
    return sales.join(short, "tran_dt", "left_semi")


@query(
    "join_range",
    """SELECT c.customer_id, CAST(w.week_end AS VARCHAR) AS week_end FROM
       (SELECT customer_id, min(tran_dt + CAST(6 - dayofweek(tran_dt) AS INT)) AS min_week FROM sales GROUP BY 1) c
       JOIN (SELECT CAST(unnest(generate_series(min(d), max(d), INTERVAL 7 DAY)) AS DATE) AS week_end FROM
             (SELECT tran_dt + CAST(6 - dayofweek(tran_dt) AS INT) AS d FROM sales)) w
       ON w.week_end >= c.min_week""",
    "sales",
)
def _(spark, sf):
    """All weeks from each customer's first week on: a sequence per row, no join."""
    weeks = v.sales(spark, sf).select("customer_id", week_end("tran_dt").alias("week_end"))
    first = weeks.groupBy("customer_id").agg(F.min("week_end").alias("min_week"))
    last = weeks.agg(F.max("week_end")).scalar()
    return first.select("customer_id", panel.saturdays(F.col("min_week"), last).alias("week_end"))


@query(
    "join_side_by_side",
    """SELECT outlet_code, CAST(total_sales AS DOUBLE) AS total_sales, CAST(active_ind AS DOUBLE) AS active_ind
       FROM outlets FULL JOIN outlet_active USING (outlet_code)""",
    "outlets outlet_active",
)
def _(spark, sf):
    """Columns of two tables next to each other, aligned by the key."""
    left = v.outlets(spark, sf).select("outlet_code", "total_sales")
    both = left.join(v.outlet_active(spark, sf), "outlet_code", "full")
    return both.withColumn("active_ind", F.col("active_ind").cast("double"))
