"""Models: saved ones score alike, metrics agree with the evaluators."""

import random

import pytest
from pyspark.ml.clustering import KMeansModel
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from basketloom.catalog import learning, load
from basketloom.catalog import views as v
from basketloom.plans import jobs, models

QUERIES, _ = load()


@pytest.fixture(scope="module")
def vectors(spark, sf):
    df = v.vectors(spark, sf)
    return df.withColumn("features", array_to_vector(F.col("embedding").cast("array<double>"))).persist()


def test_sweep_sse_falls(vectors):
    rows = models.kmeans_sweep(vectors, "vec_id", ks=[2, 16], parallelism=2).orderBy("k").collect()
    assert [r.k for r in rows] == [2, 16] and rows[0].sse > rows[1].sse
    assert {r.n_rows for r in rows} == {vectors.count()}
    assert all(-1 <= r.silhouette <= 1 for r in rows)


def test_saved_centres_assign_alike(vectors, tmp_path):
    data = models.settled_input(vectors, "vec_id")
    model = models.fit_kmeans(data, 5)
    model.write().overwrite().save(str(tmp_path / "m"))
    again = KMeansModel.load(str(tmp_path / "m"))
    a = models.assign_clusters(model, data, "vec_id")
    b = models.assign_clusters(again, data, "vec_id")
    assert a.exceptAll(b).count() == 0
    sse = models.cluster_sse(model.transform(data), "prediction").agg(F.sum("sse")).first()[0]
    assert sse == pytest.approx(again.transform(data).select(
        F.sum(_squared(again)).alias("s")).first().s, rel=1e-6)


def _squared(model):
    from pyspark.ml.functions import vector_to_array

    x = vector_to_array("features")
    centres = F.array(*[F.array(*[F.lit(float(c)) for c in centre]) for centre in model.clusterCenters()])
    own = centres[F.col("prediction")]
    return F.aggregate(F.zip_with(x, own, lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, d: s + d)


def test_auc_agrees_with_the_evaluator(spark, sf):
    df = v.binary_scores(spark, sf)
    by_rank = models.auc_roc(df, "label", "score").first().auc
    raw = df.withColumn("rawPrediction", F.col("score").cast("double"))
    assert by_rank == pytest.approx(models.evaluator_auc(raw, "label"), abs=1e-6)
    assert models.auc_roc(df, "label", "score").first().auc == by_rank


def test_split_depends_on_the_key_alone(spark):
    df = spark.range(5000)
    a = models.hash_split(df, ["id"])
    b = models.hash_split(df.repartition(7).filter("id % 2 = 0"), ["id"])
    assert b.exceptAll(a).count() == 0
    assert 0.77 < a.agg(F.avg("is_train")).first()[0] < 0.83


def test_importances_add_up_and_jobs_score(spark, tmp_path):
    df = spark.range(600).select(
        F.col("id").alias("customer_id"),
        F.expr("date_add(date'2020-01-04', cast(7 * (id % 3) as int))").alias("week_end"),
        (F.col("id") % 10).cast("double").alias("a"),
        F.when(F.col("id") % 7 == 0, None).otherwise(F.col("id") % 5).cast("double").alias("b"),
        (F.col("id") % 10 > 4).cast("int").alias("label"),
    )
    stages = models.feature_stages(["a", "b"]).fit(df)
    data = stages.transform(jobs.filled(df))
    forest = models.fit_forest(data, "label", numTrees=3, maxDepth=3)
    table = models.feature_importance(data, forest, ["a", "b"]).collect()
    assert [r.name for r in table] == ["a", "b"]
    assert sum(r.relative_importance for r in table) == pytest.approx(1.0)
    df.write.parquet(str(tmp_path / "f"))
    stages.write().overwrite().save(str(tmp_path / "m/stages"))
    forest.write().overwrite().save(str(tmp_path / "m/forest"))
    out = jobs.score_latest(spark, str(tmp_path / "f"), str(tmp_path / "m"), str(tmp_path / "out"))
    assert out.count() == 200 and dict(out.dtypes)["score"] == "float"
    assert out.select("week_end").distinct().count() == 1


def _lloyd(rows, k, iterations):
    """The exact fit, point by point; rows are (key, point)."""
    rows = sorted(rows)
    centres = [list(p) for _, p in rows[:k]]
    near = lambda p: min((sum((x - y) ** 2 for x, y in zip(p, c)), i) for i, c in enumerate(centres))
    for _ in range(iterations):
        own = [near(p)[1] for _, p in rows]
        for i in range(len(centres)):
            mine = [p for (_, p), o in zip(rows, own) if o == i]
            if mine:
                centres[i] = [sum(x) // len(mine) for x in zip(*mine)]
    centres = sorted(centres)
    return centres, {key: near(p) for key, p in rows}


@pytest.fixture(scope="module")
def points(spark):
    rng = random.Random(11)
    rows = [(i, [rng.randint(-1_000_000, 1_000_000) for _ in range(3)]) for i in range(120)]
    rows += [(200 + i, rows[i][1]) for i in range(20)] + [(300 + i, [5, 5, 5]) for i in range(30)]
    return rows, spark.createDataFrame(rows, "id int, point array<bigint>")


@pytest.mark.parametrize("parts", [1, 7])
def test_exact_sweep_against_plain_python(points, parts):
    rows, df = points
    models_ = models.exact_sweep(df.repartition(parts), "id", [2, 5, 9], 6)
    scores = {r.k: r for r in models.score_sweep(df.repartition(parts), models_).collect()}
    for k in (2, 5, 9):
        centres, places = _lloyd(rows, k, 6)
        assert models_[k] == centres
        got = {r.id: (r.prediction, r.distance) for r in models.place(df, "id", models_[k]).collect()}
        assert got == {i: (c, pytest.approx(d / 1e12)) for i, (d, c) in places.items()}
        assert scores[k].n_rows == len(rows) and scores[k].sse == pytest.approx(sum(d for d, _ in places.values()) / 1e12)
        predicted = models.place(df, "id", models_[k]).join(df, "id").withColumn("features", array_to_vector(F.col("point").cast("array<double>")))
        assert scores[k].silhouette == pytest.approx(models.silhouette(predicted, "prediction"))


def test_exact_clusters_of_few_or_no_points(spark, points):
    _, df = points
    assert models.exact_kmeans(df.filter("id < 2"), "id", 4) == sorted([list(r.point) for r in df.filter("id < 2").collect()])
    assert models.exact_kmeans(df.limit(0), "id", 4) == []


def test_squares_do_not_overflow():
    import numpy as np

    big = np.full((1000, 9), 1_000_000.0)
    total = None
    for _ in range(50):
        total = models._add_moments(big, [np.full((1, 9), -1_000_000.0)], total)
    n, high, low = total.sums[0][0, :3].tolist()
    assert n == 50_000 and high * models._Moments.HALF + low == 50_000 * 9 * 4 * 10**12


def test_scaled_points(spark):
    df = spark.createDataFrame([(1, 2.0, 5), (2, 4.0, 5), (3, 3.0, 5)], "id int, a double, b int")
    assert {r.id: list(r.point) for r in models.fixed_points(df, "id", ["a", "b"]).collect()} == {1: [0, 500_000], 2: [1_000_000, 500_000], 3: [500_000, 500_000]}


def test_training_rows_are_bounded_per_class(spark):
    df = spark.range(20_000).select("id", (F.col("id") % 10 == 0).cast("int").alias("y"))
    n = {r.y: r["count"] for r in models.bounded_rows(df, "y", ["id"], 3000).groupBy("y").count().collect()}
    assert n[1] == 2000 and 2800 <= n[0] <= 3200
    again = models.bounded_rows(df.repartition(9), "y", ["id"], 3000)
    assert again.exceptAll(models.bounded_rows(df, "y", ["id"], 3000)).count() == 0


@pytest.mark.parametrize("fit", [models.fit_forest, models.fit_boosted])
def test_full_size_trees_learn_what_can_be_learned(spark, fit):
    """Held-out rows of a label that follows two features, a tenth of it at random."""
    x, y = (F.pmod(F.xxhash64("id", F.lit(k)), F.lit(1000)) / 1000 for k in (1, 2))
    noise = F.pmod(F.xxhash64("id", F.lit(3)), F.lit(10)) == 0
    rows = models.hash_split(spark.range(3000).select("id", x.alias("x"), y.alias("y"), F.rand(5).alias("z"), ((F.col("id") * 0 + x + y > 1) != noise).cast("int").alias("label")), ["id"])
    data = models.assemble(rows, ["x", "y", "z"]).persist()
    model = fit(models.bounded_rows(data.filter("is_train = 1"), "label", ["id"]), "label")
    assert models.evaluator_auc(model.transform(data.filter("is_train = 0")), "label") > 0.8


def test_fit_partitions_follow_the_training_rows(spark):
    """However many partitions the table has; a fit sends statistics from each of them."""
    df = spark.range(0, 20_000, 1, 37).select("id", (F.col("id") % 10 == 0).cast("int").alias("y"))
    rows = models.training_rows(df, "y", ["id"], 3000)
    try:
        assert rows.rdd.getNumPartitions() == 1
        assert sorted(rows.collect()) == sorted(models.bounded_rows(df, "y", ["id"], 3000).collect())
        assert models.settled_input(rows, "id", rows=2000).rdd.getNumPartitions() == 3
    finally:
        rows.unpersist()


def test_scores_of_dense_vectors_are_those_of_sparse_ones(spark):
    """And the forest sees dense ones, in which it need not search."""
    columns = [f"c{i}" for i in range(12)]
    df = spark.range(400).select("id", *[F.when(F.col("id") % 12 == i, F.col("id") % 7).otherwise(0).cast("double").alias(c) for i, c in enumerate(columns)])
    data = models.assemble(df.withColumn("y", (F.col("id") % 7 > 3).cast("int")), columns)
    forest = models.fit_forest(data, "y", numTrees=3, maxDepth=4, minInstancesPerNode=1)
    plain, dense = (d.orderBy("id").collect() for d in (forest.transform(data), models.predict(forest, data)))
    assert {type(r.features).__name__ for r in plain} == {"SparseVector"} and {type(r.features).__name__ for r in dense} == {"DenseVector"}
    for name in ("rawPrediction", "probability", "prediction"):
        assert [r[name] for r in plain] == [r[name] for r in dense]


def test_trees_are_trained_on_every_labelled_row(spark):
    """Also on the rows of a class of more than ``PER_CLASS``; a row without a label teaches nothing."""
    label = F.when(F.col("id") < 30_000, (F.col("id") % 10 == 0).cast("int"))
    rows = models.training_rows(spark.range(0, 31_000, 1, 23).select("id", label.alias("y")), "y", ["id"])
    assert rows.rdd.getNumPartitions() <= min(3, spark.sparkContext.defaultParallelism)
    assert sorted(r.id for r in rows.collect()) == list(range(30_000))


class _Seen(Exception):
    pass


@pytest.mark.parametrize("name, fit", [("boosted_trees_fit", "fit_boosted"), ("random_forest_fit", "fit_forest"), ("feature_importance", "fit_forest")])
def test_registered_fits_see_the_whole_training_side(spark, monkeypatch, name, fit):
    def seen(df, label):
        raise _Seen(df.count())

    rows = spark.range(30_000).select(
        F.col("id").alias("customer_id"), F.lit("2020-01-31").alias("week_end"),
        (F.col("id") % 3 == 0).cast("int").alias("purchase_flag_next_4w"), (F.col("id") % 5 != 0).cast("int").alias("is_train"),
    )
    monkeypatch.setattr(learning, "_model_rows", lambda spark, sf: rows)
    monkeypatch.setattr(learning, "_fits", {})
    monkeypatch.setattr(models, fit, seen)
    with pytest.raises(_Seen) as found:
        QUERIES[name](spark, "none")
    assert found.value.args == (24_000,)
