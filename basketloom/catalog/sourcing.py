"""Sources and sinks: every query writes a whole table and reads it back."""

from __future__ import annotations

from pyspark.ml.feature import MinMaxScaler, MinMaxScalerModel, VectorAssembler
from pyspark.sql import functions as F

from basketloom.catalog import views as v
from basketloom.catalog.registry import query
from basketloom.sources import files
from basketloom.sources.stage import stage_path

_CUSTOMER = "customer_id bigint, age bigint, hh_income decimal(18,2), omni_shopper int, email_subscribed int"
_CUSTOMER_SQL = """
    SELECT customer_id, age, CAST(hh_income AS DOUBLE) AS hh_income, omni_shopper, email_subscribed
    FROM customer_dim"""


@query("read_csv", _CUSTOMER_SQL, "customer_dim")
def _(spark, sf):
    path = stage_path(spark, "csv")
    files.write_csv(v.customer_dim(spark, sf), path, sep="|")
    return files.read_csv(spark, path, _CUSTOMER, sep="|")


@query("read_csv_gz", "SELECT * FROM points", "points")
def _(spark, sf):
    path = stage_path(spark, "gz")
    files.write_csv(v.points(spark, sf), path, compression="gzip")
    schema = "pair_id bigint, lat_a double, lng_a double, lat_b double, lng_b double"
    return files.read_csv_gz(spark, path, schema)


_OUTLET = (
    "region string, area string, outlet_code bigint, outlet_type string, latitude double, "
    "longitude double, total_sales decimal(18,2), classification string"
)


@query(
    "drop_blank_rows",
    "SELECT * REPLACE (CAST(total_sales AS DOUBLE) AS total_sales) FROM outlets",
    "outlets",
)
def _(spark, sf):
    """A padded file: one blank row per supplier and a column without a name."""
    path = stage_path(spark, "padded")
    outlets = v.outlets(spark, sf).withColumn("_c8", F.lit(None).cast("string"))
    blank = v.table(spark, sf, "supplier").select(
        *[F.lit(None).cast(f.dataType).alias(f.name) for f in outlets.schema.fields]
    )
    files.write_csv(outlets.unionByName(blank), path)
    return files.drop_blank_rows(files.read_csv(spark, path, _OUTLET + ", _c8 string"))


@query(
    "read_parquet",
    """SELECT customer_id, CAST(age AS DOUBLE) AS age, CAST(NULL AS DOUBLE) AS hh_income FROM customer_dim WHERE omni_shopper = 1
       UNION ALL SELECT customer_id, NULL, CAST(hh_income AS DOUBLE) FROM customer_dim WHERE omni_shopper = 0""",
    "customer_dim",
)
def _(spark, sf):
    """Two folders whose columns differ, read as one table."""
    base, customer = stage_path(spark, "merge"), v.customer_dim(spark, sf)
    omni, single = f"{base}/omni", f"{base}/single"
    files.write_parquet(customer.filter("omni_shopper = 1").select("customer_id", F.col("age").cast("bigint").alias("age")), omni)
    files.write_parquet(customer.filter("omni_shopper = 0").select("customer_id", "hh_income"), single)
    merged = files.read_parquet(spark, omni, single, merge_schema=True)
    return merged.select("customer_id", F.col("age").cast("double").alias("age"), "hh_income")


@query("read_object_store", _CUSTOMER_SQL, "customer_dim")
def _(spark, sf):
    uri = files.as_uri(spark, stage_path(spark, "store"))
    files.write_parquet(v.customer_dim(spark, sf), uri)
    return files.read_parquet(spark, uri)


@query(
    "write_csv",
    """SELECT payment_type_id, count(*) AS n, CAST(sum(dollars) AS DOUBLE) AS dollars
       FROM sales GROUP BY payment_type_id""",
    "sales",
)
def _(spark, sf):
    path = stage_path(spark, "profile")
    profile = v.sales(spark, sf).groupBy("payment_type_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum("dollars").alias("dollars")
    )
    files.write_csv(profile, path, single_file=True)
    return files.read_csv(spark, path, "payment_type_id int, n bigint, dollars decimal(28,2)")


@query(
    "write_parquet",
    "SELECT count(*) AS n_rows, CAST(sum(age) AS BIGINT) AS age, 8 AS n_files FROM customer_dim",
    "customer_dim",
)
def _(spark, sf):
    path = stage_path(spark, "eight")
    files.write_parquet(v.customer_dim(spark, sf), path, files=8)
    back = files.read_parquet(spark, path).withColumn("f", F.input_file_name())
    return back.agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("age").alias("age"), F.countDistinct("f").alias("n_files")
    )


@query(
    "write_partitioned",
    """SELECT year(tran_dt) AS year, count(*) AS n, CAST(sum(dollars) AS DOUBLE) AS dollars
       FROM sales GROUP BY 1""",
    "sales",
)
def _(spark, sf):
    path = stage_path(spark, "years")
    files.write_partitioned(v.sales(spark, sf).withColumn("year", F.year("tran_dt")), path, ["year"])
    back = files.read_parquet(spark, path)
    return back.groupBy("year").agg(F.count(F.lit(1)).alias("n"), F.sum("dollars").alias("dollars"))


@query("save_load_model", "SELECT count(*) AS n_rows, count(*) AS n_equal FROM customer_dim", "customer_dim")
def _(spark, sf):
    """A fitted scaler scores the same after it was saved and loaded."""
    assembler = VectorAssembler(inputCols=["age", "hh_income"], outputCol="features")
    data = assembler.transform(v.customer_dim(spark, sf))
    fitted = MinMaxScaler(inputCol="features", outputCol="scaled").fit(data)
    path = stage_path(spark, "scaler")
    fitted.write().overwrite().save(path)
    loaded = MinMaxScalerModel.load(path).setOutputCol("again")
    both = loaded.transform(fitted.transform(data))
    return both.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count(F.when(F.col("scaled") == F.col("again"), 1)).alias("n_equal"),
    )


@query("sample_export", _CUSTOMER_SQL + " ORDER BY customer_id LIMIT 50", "customer_dim")
def _(spark, sf):
    path = stage_path(spark, "sample")
    files.sample_export(v.customer_dim(spark, sf), path, ["customer_id"])
    return files.read_csv(spark, path, _CUSTOMER)
