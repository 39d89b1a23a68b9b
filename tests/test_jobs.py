"""The batch jobs one after another: CSV files to features, models and scores."""

import pytest
from pyspark.sql import functions as F

from basketloom.catalog import features as tables
from basketloom.catalog import views as v
from basketloom.plans import jobs
from basketloom.sources import files


@pytest.fixture(scope="module")
def built(spark, sf, tmp_path_factory):
    base = tmp_path_factory.mktemp("jobs")
    paths = {n: str(base / n) for n in ("sales", "product", "payment", "customer")}
    for name, table in (("sales", v.sales), ("product", v.product_dim), ("payment", v.payment_dim), ("customer", v.customer_dim)):
        df = table(spark, sf)
        # other columns, in another order
        files.write_csv(df.select(F.lit("x").alias("unused"), *reversed(df.columns)), paths[name])
    jobs.build_features(spark, *paths.values(), str(base / "out"))
    return base


def test_features_from_csv(spark, sf, built):
    want = tables.customer_table(spark, sf)
    got = spark.read.parquet(str(built / "out" / "customers"))
    shared = [c for c in want.columns if c in got.columns]
    assert set(want.columns) == set(shared) and {"age", "hh_income"} < set(got.columns)
    as_text = lambda df: sorted(map(str, df.select(*[F.col(c).cast("double").alias(c) for c in shared]).collect()))
    assert as_text(got) == as_text(want)
    weekly = spark.read.parquet(str(built / "out" / "weekly"))
    assert weekly.exceptAll(tables.weekly(spark, sf).select(*weekly.columns)).count() == 0 and weekly.count() == tables.weekly(spark, sf).count()


def test_clusters_are_trained_and_scored(spark, built):
    sizes = jobs.train_clusters(spark, str(built / "out" / "customers"), str(built / "models"), "3").collect()
    scored = jobs.score_clusters(spark, str(built / "out" / "customers"), str(built / "models"), str(built / "labels"))
    assert {(r.prediction, r.n) for r in sizes} == {tuple(r) for r in scored.groupBy("prediction").count().collect()}


def test_a_forest_is_trained_and_scores_the_newest_week(spark, built):
    sides = {r.is_train: r for r in jobs.train_forest(spark, str(built / "out" / "weekly"), str(built / "models"), numTrees=5, maxDepth=6).collect()}
    assert sides[1].n_rows > 2 * sides[0].n_rows > 0 and sides[1].auc > 0.5 and 0 <= sides[0].auc <= 1  # purchases here are drawn at random
    newest = jobs.add_latest(spark, str(built / "out" / "weekly"), str(built / "features"))
    scored = jobs.score_latest(spark, str(built / "features"), str(built / "models"), str(built / "scored"))
    assert scored.count() == newest.count() and scored.select("week_end").distinct().count() == 1
    assert scored.filter("score between 0 and 1").count() == scored.count()


def test_unlisted_categories_are_errors(spark, sf):
    from basketloom.plans import panel

    with pytest.raises(Exception, match="not listed"):
        panel.weekly_aggregate(tables.enriched(spark, sf), v.CATEGORIES[:-1], v.PAYMENTS).collect()


def test_csv_columns_are_found_by_name(spark, tmp_path):
    (tmp_path / "a.csv").write_text("b,extra,a\n 7 ,x,2020-01-03\n,y,\n")
    got = files.read_named(spark, str(tmp_path / "a.csv"), {"a": "date", "b": "int"})
    assert got.dtypes == [("a", "date"), ("b", "int")] and [str(r.a) for r in got.collect()] == ["2020-01-03", "None"]
