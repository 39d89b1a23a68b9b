"""The views all queries read: once as DataFrames, once as SQL text."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the test tables: the pivot columns.
CATEGORIES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]
PAYMENTS = ["urgent", "high", "medium", "not_specified", "low"]

MONEY = "decimal(18,2)"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines with date, customer, amount, product and payment type."""
    lines = table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders")
    return lines.join(orders, lines.l_orderkey == orders.o_orderkey).select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("line_no"),
        F.col("o_orderdate").cast("date").alias("tran_dt"),
        F.col("o_custkey").alias("customer_id"),
        F.col("l_extendedprice").cast(MONEY).alias("dollars"),
        F.col("l_quantity").cast("bigint").alias("qty"),
        F.col("l_partkey").alias("product_id"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("payment_type_id"),
    )


def product_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_type").alias("category"),
        F.col("p_retailprice").alias("price"),
    )


def payment_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "orders")
        .select("o_orderpriority")
        .distinct()
        .select(
            F.substring("o_orderpriority", 1, 1).cast("int").alias("payment_type_id"),
            F.lower(F.expr("substring(o_orderpriority, 3)")).alias("payment_type"),
        )
    )


def customer_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("customer_id"),
        (F.col("c_custkey") % 50 + 18).alias("age"),
        F.col("c_acctbal").cast(MONEY).alias("hh_income"),
        (F.col("c_acctbal") < 0).cast("int").alias("omni_shopper"),
        F.col("c_mktsegment").isin("BUILDING", "MACHINERY").cast("int").alias("email_subscribed"),
    )


def _outlet_sales(balance: str) -> Column:
    money = (F.col(balance).cast(MONEY) * 50).cast(MONEY)
    return F.when(F.col(balance) >= 0, money)


def _degrees(code: str, step: int, span: int, shift: int) -> Column:
    return (F.col(code) * step % span).cast("double") / 100 - shift


def _with_place(df: DataFrame, nation_key: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    return df.join(nation, F.col(nation_key) == nation.n_nationkey).join(
        region, nation.n_regionkey == region.r_regionkey
    )


def outlets(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = _with_place(table(spark, sf_dir, "customer"), "c_nationkey", spark, sf_dir)
    known = F.col("c_custkey") % 59 != 0
    return customer.select(
        F.col("r_name").alias("region"),
        F.col("n_name").alias("area"),
        F.col("c_custkey").alias("outlet_code"),
        F.col("c_mktsegment").alias("outlet_type"),
        F.when(known, _degrees("c_custkey", 37, 18000, 90)).alias("latitude"),
        F.when(known, _degrees("c_custkey", 73, 36000, 180)).alias("longitude"),
        _outlet_sales("c_acctbal").alias("total_sales"),
        F.when(F.col("c_mktsegment") == "AUTOMOBILE", "A")
        .when(F.col("c_mktsegment") == "BUILDING", "B")
        .when(F.col("c_mktsegment") == "HOUSEHOLD", "C")
        .when(F.col("c_mktsegment") == "MACHINERY", "WS")
        .otherwise("D")
        .alias("classification"),
    )


def more_outlets(spark: SparkSession, sf_dir: str) -> DataFrame:
    supplier = _with_place(table(spark, sf_dir, "supplier"), "s_nationkey", spark, sf_dir)
    return supplier.select(
        (F.col("s_suppkey") + 10_000_000).alias("outlet_code"),
        F.lit("SUPPLIER").alias("outlet_type"),
        F.col("n_name").alias("area"),
        F.col("r_name").alias("region"),
        F.lit("WS").alias("classification"),
        _outlet_sales("s_acctbal").alias("total_sales"),
        _degrees("s_suppkey", 37, 18000, 90).alias("latitude"),
        _degrees("s_suppkey", 73, 36000, 180).alias("longitude"),
    )


def outlet_active(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Activity flags: no entry for furniture outlets, entries for suppliers besides."""
    customer = table(spark, sf_dir, "customer").filter(F.col("c_mktsegment") != "FURNITURE")
    supplier = table(spark, sf_dir, "supplier")
    return customer.select(
        F.col("c_custkey").alias("outlet_code"), (F.col("c_acctbal") > 0).cast("int").alias("active_ind")
    ).unionAll(
        supplier.select(
            (F.col("s_suppkey") + 10_000_000).alias("outlet_code"),
            (F.col("s_acctbal") > 0).cast("int").alias("active_ind"),
        )
    )


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each outlet with the position of the outlet of the next code."""
    here = outlets(spark, sf_dir).select("outlet_code", "latitude", "longitude")
    count = table(spark, sf_dir, "customer").agg(F.count(F.lit(1))).scalar()
    a = here.select(
        F.col("outlet_code").alias("pair_id"),
        F.col("latitude").alias("lat_a"),
        F.col("longitude").alias("lng_a"),
        ((F.col("outlet_code") + 1) % count).alias("code_b"),
    ).dropna(subset=["lat_a", "lng_a"])
    b = here.select(
        F.col("outlet_code").alias("code_b"),
        F.col("latitude").alias("lat_b"),
        F.col("longitude").alias("lng_b"),
    ).dropna(subset=["lat_b", "lng_b"])
    return a.join(b, "code_b").select("pair_id", "lat_a", "lng_a", "lat_b", "lng_b")


def binary_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels")
    docs = table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    return labels.join(docs, "doc_id").select(
        "doc_id",
        F.col("quality").alias("label"),
        F.col("n_chars").alias("score"),
        (F.col("n_chars") > 2000).cast("int").alias("prediction"),
    )


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")


_PLACE = "JOIN nation ON {} = n_nationkey JOIN region ON n_regionkey = r_regionkey"

# In order of use: a view may read the ones above it.
_SQL = {
    "sales": """
        SELECT l_orderkey AS order_id, l_linenumber AS line_no, CAST(o_orderdate AS DATE) AS tran_dt,
               o_custkey AS customer_id, CAST(l_extendedprice AS DECIMAL(18,2)) AS dollars,
               CAST(l_quantity AS BIGINT) AS qty, l_partkey AS product_id,
               CAST(substr(o_orderpriority, 1, 1) AS INT) AS payment_type_id
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "product_dim": "SELECT p_partkey AS product_id, p_type AS category, p_retailprice AS price FROM part",
    "payment_dim": """
        SELECT DISTINCT CAST(substr(o_orderpriority, 1, 1) AS INT) AS payment_type_id,
               lower(substr(o_orderpriority, 3)) AS payment_type FROM orders""",
    "customer_dim": """
        SELECT c_custkey AS customer_id, 18 + c_custkey % 50 AS age,
               CAST(c_acctbal AS DECIMAL(18,2)) AS hh_income,
               CAST(c_acctbal < 0 AS INT) AS omni_shopper,
               CAST(c_mktsegment IN ('BUILDING', 'MACHINERY') AS INT) AS email_subscribed
        FROM customer""",
    "outlets": f"""
        SELECT r_name AS region, n_name AS area, c_custkey AS outlet_code, c_mktsegment AS outlet_type,
               CASE WHEN c_custkey % 59 <> 0 THEN CAST(c_custkey * 37 % 18000 AS DOUBLE) / 100 - 90 END AS latitude,
               CASE WHEN c_custkey % 59 <> 0 THEN CAST(c_custkey * 73 % 36000 AS DOUBLE) / 100 - 180 END AS longitude,
               CASE WHEN c_acctbal >= 0
                    THEN CAST(CAST(c_acctbal AS DECIMAL(18,2)) * 50 AS DECIMAL(18,2)) END AS total_sales,
               CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'A' WHEN 'BUILDING' THEN 'B'
                    WHEN 'HOUSEHOLD' THEN 'C' WHEN 'MACHINERY' THEN 'WS' ELSE 'D' END AS classification
        FROM customer {_PLACE.format('c_nationkey')}""",
    "more_outlets": f"""
        SELECT 10000000 + s_suppkey AS outlet_code, 'SUPPLIER' AS outlet_type, n_name AS area,
               r_name AS region, 'WS' AS classification,
               CASE WHEN s_acctbal >= 0
                    THEN CAST(CAST(s_acctbal AS DECIMAL(18,2)) * 50 AS DECIMAL(18,2)) END AS total_sales,
               CAST(s_suppkey * 37 % 18000 AS DOUBLE) / 100 - 90 AS latitude,
               CAST(s_suppkey * 73 % 36000 AS DOUBLE) / 100 - 180 AS longitude
        FROM supplier {_PLACE.format('s_nationkey')}""",
    "outlet_active": """
        SELECT c_custkey AS outlet_code, CAST(c_acctbal > 0 AS INT) AS active_ind
        FROM customer WHERE c_mktsegment <> 'FURNITURE'
        UNION ALL SELECT 10000000 + s_suppkey, CAST(s_acctbal > 0 AS INT) FROM supplier""",
    "points": """
        SELECT a.outlet_code AS pair_id, a.latitude AS lat_a, a.longitude AS lng_a,
               b.latitude AS lat_b, b.longitude AS lng_b
        FROM outlets a JOIN outlets b
          ON (a.outlet_code + 1) % (SELECT count(*) FROM customer) = b.outlet_code
        WHERE a.latitude IS NOT NULL AND b.latitude IS NOT NULL""",
    "binary_scores": """
        SELECT doc_id, quality AS label, n_chars AS score, CAST(n_chars > 2000 AS INT) AS prediction
        FROM labels JOIN documents USING (doc_id)""",
    "vectors": "SELECT vec_id, embedding, label FROM embeddings",
}

_READS = {"points": ["outlets"]}


def add_view(name: str, sql: str, reads: Iterable[str] = ()) -> None:
    """Add a derived view, so that several checks can share its SQL."""
    _SQL[name] = sql
    _READS[name] = list(reads)


def with_views(names: Iterable[str], sql: str) -> str:
    """Put the SQL of the named views, and of those they read, in front of ``sql``."""
    wanted: set[str] = set()
    todo = list(names)
    while todo:
        name = todo.pop()
        if name not in wanted:
            wanted.add(name)
            todo += _READS.get(name, [])
    parts = [f"{n} AS ({_SQL[n].strip()})" for n in _SQL if n in wanted]
    return ("WITH " + ",\n".join(parts) + "\n" if parts else "") + sql.strip()
