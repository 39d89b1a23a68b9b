"""Batch jobs: feature tables from CSV files, training, and scoring with saved models.

    spark-submit basketloom/plans/jobs.py build-features SALES.csv PRODUCT.csv PAYMENT.csv CUSTOMER.csv OUT
    spark-submit basketloom/plans/jobs.py train-clusters OUT/customers MODELS [K]
    spark-submit basketloom/plans/jobs.py train-forest OUT/weekly MODELS
    spark-submit basketloom/plans/jobs.py score-clusters FEATURES MODELS OUT
    spark-submit basketloom/plans/jobs.py add-latest WEEKLY FEATURES
    spark-submit basketloom/plans/jobs.py score-latest FEATURES MODELS OUT

All start from any folder.
"""

from __future__ import annotations

import os
import sys

if __name__ == "__main__":
    sys.path.insert(0, os.path.abspath(os.path.join(os.path.dirname(__file__), "..", "..")))

from pyspark.ml import PipelineModel
from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.ml.clustering import KMeansModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketloom.functions.scalars import clean_label
from basketloom.operators.summaries import numeric_columns
from basketloom.plans.customers import customer_features
from basketloom.plans.enrich import enrich
from basketloom.plans.models import (
    assign_clusters, auc_roc, feature_stages, fit_forest, fit_kmeans, hash_split, predict, settled_input, training_rows, with_score,
)
from basketloom.plans.panel import feature_columns, latest_features, model_table, weekly_aggregate
from basketloom.sources.files import newest_partition, read_named, write_parquet, write_partitioned
from basketloom.sources.stage import discard, settle

# The columns that the jobs read from CSV files, by their headers.
SALES = {
    "order_id": "bigint", "customer_id": "bigint", "tran_dt": "date", "product_id": "bigint", "payment_type_id": "int",
    "qty": "bigint", "dollars": "decimal(18,2)",
}
PRODUCT = {"product_id": "bigint", "category": "string"}
PAYMENT = {"payment_type_id": "int", "payment_type": "string"}
CUSTOMER = {"customer_id": "bigint", "age": "int", "hh_income": "decimal(18,2)", "omni_shopper": "int", "email_subscribed": "int"}
LABEL = "purchase_flag_next_4w"


def build_features(spark: SparkSession, sales: str, product: str, payment: str, customer: str, out: str) -> DataFrame:
    """Read four CSV tables and write ``customers`` and ``weekly`` below ``out``; returns the customer features.

    Categories and payment types are those of the two dimension files, which are
    read on the driver as column names; a sale with another one is an error.
    """
    tables = {
        "sales": read_named(spark, sales, SALES), "product": read_named(spark, product, PRODUCT),
        "payment": read_named(spark, payment, PAYMENT), "customer": read_named(spark, customer, CUSTOMER),
    }
    kinds = tables["product"].select("category").distinct().filter("category is not null")
    labels = tables["payment"].select(clean_label("", "payment_type").alias("pay")).distinct().filter("pay is not null")
    categories, payments = (sorted(r[0] for r in names.collect()) for names in (kinds, labels))
    features = customer_features(*(tables[n] for n in ("sales", "product", "payment", "customer")), categories, payments)
    write_parquet(features.join(tables["customer"].select("customer_id", "age", "hh_income"), "customer_id", "left"), f"{out}/customers")
    rows = enrich(tables["sales"], tables["product"], tables["payment"])
    write_parquet(weekly_aggregate(rows, categories, payments), f"{out}/weekly")
    return spark.read.parquet(f"{out}/customers")


def train_clusters(spark: SparkSession, customers_path: str, model_path: str, k: str | int = 4) -> DataFrame:
    """Fit scaling and k-means to all features of the customer table, and save both; returns the cluster sizes."""
    data = filled(spark.read.parquet(customers_path))
    names = [c for c in data.columns if c not in ("customer_id", "age", "hh_income")]
    stages = feature_stages(names, scale=names).fit(data)
    rows = settled_input(stages.transform(data).select("customer_id", "features"), "customer_id")
    try:
        model = fit_kmeans(rows, int(k))
        sizes = assign_clusters(model, rows, "customer_id").groupBy("prediction").count().collect()
    finally:
        rows.unpersist()
    stages.write().overwrite().save(f"{model_path}/stages")
    model.write().overwrite().save(f"{model_path}/kmeans")
    return spark.createDataFrame([tuple(r) for r in sizes], "prediction int, n bigint")


def train_forest(spark: SparkSession, weekly_path: str, model_path: str, **params) -> DataFrame:
    """Build the modelling rows, fit the forest on the training side and save it with its stages.

    Returns (is_train, n_rows, auc) of both sides. The trees see all rows of the training side.
    """
    weekly = spark.read.parquet(weekly_path)
    rows = hash_split(filled(model_table(weekly, *splits(weekly))), ["customer_id", "week_end"])
    names = [c for c in feature_columns(rows) if c != "is_train"]
    stages = feature_stages(names).fit(rows)
    ready = settle(stages.transform(rows).select("customer_id", "week_end", LABEL, "is_train", "features"), "model_rows")
    training = training_rows(ready.filter("is_train = 1"), LABEL, ["customer_id", "week_end"])
    try:
        forest = fit_forest(training, LABEL, **params)
    finally:
        discard(training)
    stages.write().overwrite().save(f"{model_path}/stages")
    forest.write().overwrite().save(f"{model_path}/forest")
    scored = settle(with_score(predict(forest, ready)).select("is_train", LABEL, "score"), "scored")
    discard(ready)
    sides = [scored.filter(F.col("is_train") == side) for side in (1, 0)]
    areas = [auc_roc(side, LABEL, "score").select(F.lit(k).alias("is_train"), F.lit(side.count()).alias("n_rows"), "auc") for k, side in zip((1, 0), sides)]
    return areas[0].unionByName(areas[1])


def filled(df: DataFrame) -> DataFrame:
    """Numeric nulls to 0; dates and text stay."""
    return df.fillna(0, subset=numeric_columns(df))


def splits(weekly: DataFrame) -> tuple[list[str], list[str]]:
    """Categories and payment types that a weekly table has columns for."""
    return tuple([c[4:] for c in weekly.columns if c.startswith(kind)] for kind in ("cat_", "pay_"))


def add_latest(spark: SparkSession, weekly_path: str, features_path: str) -> DataFrame:
    """Add the newest week's features to a table in folders by week; other weeks' folders stay."""
    weekly = spark.read.parquet(weekly_path)
    write_partitioned(latest_features(weekly, *splits(weekly)), features_path, ["week_end"])
    return newest_partition(spark, features_path, "week_end")


def score_latest(spark: SparkSession, features_path: str, model_path: str, out: str) -> DataFrame:
    """Score the newest week, read from its own folder, with the saved stages and forest."""
    stages = PipelineModel.load(f"{model_path}/stages")
    forest = RandomForestClassificationModel.load(f"{model_path}/forest")
    rows = stages.transform(filled(newest_partition(spark, features_path, "week_end")))
    scored = with_score(predict(forest, rows.select("customer_id", "week_end", "features")))
    write_parquet(scored.select("customer_id", "week_end", "prediction", "score"), out)
    return spark.read.parquet(out)


def score_clusters(spark: SparkSession, features_path: str, model_path: str, out: str) -> DataFrame:
    """Cluster label per customer with the saved stages and centres."""
    stages = PipelineModel.load(f"{model_path}/stages")
    model = KMeansModel.load(f"{model_path}/kmeans")
    rows = stages.transform(filled(spark.read.parquet(features_path)))
    write_parquet(assign_clusters(model, rows, "customer_id"), out)
    return spark.read.parquet(out)


JOBS = {
    "build-features": build_features, "train-clusters": train_clusters, "train-forest": train_forest,
    "score-clusters": score_clusters, "add-latest": add_latest, "score-latest": score_latest,
}

if __name__ == "__main__":
    JOBS[sys.argv[1]](SparkSession.builder.appName(sys.argv[1]).getOrCreate(), *sys.argv[2:])
