"""Machine learning.

Fitted models differ between machines, so these queries return facts that any
correct fit must show: row counts, every row at its nearest centre, names of
the importances, bounds of the metrics. Metrics of given labels are exact.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.clustering import KMeansModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketloom.catalog import views as v
from basketloom.catalog.features import _FEATURES, customer_table, modelled, stored, table_sql, weekly, whole_table
from basketloom.catalog.registry import query
from basketloom.operators import grouping
from basketloom.operators.checks import value_counts
from basketloom.plans import customers, jobs, models, panel
from basketloom.sources.files import write_parquet
from basketloom.sources.stage import discard, settle, stage_path

_C, _P = v.CATEGORIES, v.PAYMENTS
_NAMES = customers.feature_names(_C, _P)
_SCALED = [
    "sales", "qty", "upt", "aur", "aov", "unique_categories_bought", "unique_payments_used",
    "unique_products_bought", "orders",
]
_LABEL = "purchase_flag_next_4w"


def _customers(spark, sf) -> DataFrame:
    return jobs.filled(stored(spark, sf, "customers", customer_table))


def _scaled_customers(spark, sf) -> tuple[DataFrame, PipelineModel]:
    data = _customers(spark, sf)
    stages = models.feature_stages(_NAMES, scale=_NAMES).fit(data)
    return stages.transform(data), stages


def _model_rows(spark, sf) -> DataFrame:
    """Modelling rows with their side of the split and the feature vector."""

    def build(spark, sf):
        rows = models.hash_split(jobs.filled(modelled(spark, sf)), ["customer_id", "week_end"])
        return models.assemble(rows, _FEATURES).select(
            "customer_id", "week_end", _LABEL, "is_train", "features"
        )

    return stored(spark, sf, "model_rows", build)


_fits: dict = {}


def _fitted(spark, sf, name, fit):
    """The model of all rows of the training side, fitted once a session."""
    key = (spark.sparkContext.applicationId, sf, name)
    if key not in _fits:
        train = _model_rows(spark, sf).filter("is_train = 1")
        rows = models.training_rows(train, _LABEL, ["customer_id", "week_end"])
        try:
            _fits[key] = fit(rows)
        finally:
            discard(rows)
    return _fits[key]


def _forest(spark, sf):
    return _fitted(spark, sf, "forest", lambda df: models.fit_forest(df, _LABEL))


_FILLED = ", ".join(f"coalesce(CAST({c} AS DOUBLE), 0) AS {c}" for c in _NAMES)


@query("assemble_vector", f"SELECT customer_id, {len(_NAMES)} AS size, {_FILLED} FROM customer_table", "customer_table")
def _(spark, sf):
    """The vector taken apart again, element by element."""
    vectors = models.assemble(_customers(spark, sf), _NAMES)
    values = vectors.select("customer_id", vector_to_array("features").alias("a"))
    return values.select("customer_id", F.size("a").alias("size"), *[F.col("a")[i].alias(n) for i, n in enumerate(_NAMES)])


def _minmax(c):
    x = f"CAST({c} AS DOUBLE)"
    span = f"(max({x}) OVER () - min({x}) OVER ())"
    return f"round(CASE WHEN {span} = 0 THEN 0.5 ELSE ({x} - min({x}) OVER ()) / {span} END, 12) AS {c}"


_SCALED_SQL = f"SELECT customer_id, {', '.join(_minmax(c) for c in _SCALED)} FROM customer_table"


@query("minmax_scale", _SCALED_SQL, "customer_table")
def _(spark, sf):
    data = _customers(spark, sf)
    scaled = models.feature_stages(_NAMES, scale=_SCALED).fit(data).transform(data)
    values = vector_to_array("scaled")
    return scaled.select("customer_id", *[F.round(values[i], 12).alias(c) for i, c in enumerate(_SCALED)])


_REST = [c for c in _NAMES if c not in _SCALED]


@query(
    "pipeline_fit_apply",
    _SCALED_SQL.replace(" FROM", ", " + ", ".join(f"coalesce(CAST({c} AS DOUBLE), 0) AS {c}" for c in _REST) + " FROM"),
    "customer_table",
)
def _(spark, sf):
    """Fit the stages, save, load and apply them: nine scaled elements, then the others as they are."""
    data, path = _customers(spark, sf), stage_path(spark, "stages")
    models.feature_stages(_NAMES, scale=_SCALED).fit(data).write().overwrite().save(path)
    applied = models.load_stages(path).transform(data).select("customer_id", vector_to_array("features").alias("a"))
    scaled = [F.round(F.col("a")[i], 12).alias(c) for i, c in enumerate(_SCALED)]
    return applied.select("customer_id", *scaled, *[F.col("a")[len(_SCALED) + i].alias(c) for i, c in enumerate(_REST)])


_IS_TRAIN = "CAST(substr(md5({}), 1, 8) < 'cccccccd' AS INT)"


@query(
    "train_test_split",
    f"SELECT doc_id, quality, {_IS_TRAIN.format('CAST(doc_id AS VARCHAR)')} AS is_train FROM labels",
)
def _(spark, sf):
    return models.hash_split(v.table(spark, sf, "labels"), ["doc_id"]).select("doc_id", "quality", "is_train")


def _vectors(spark, sf) -> DataFrame:
    return v.vectors(spark, sf).withColumn("features", array_to_vector(F.col("embedding").cast("array<double>")))


_ITERATIONS = 10


def _clusters_sql(points: str, key: str, ks: range) -> str:
    """(k, c, i, m): the centres of the same fits, from ``points`` (key, i, v) in whole millionths."""
    first = f"SELECT {key}, row_number() OVER (ORDER BY {key}) - 1 AS c FROM (SELECT DISTINCT {key} FROM {points}) ORDER BY {key} LIMIT {max(ks)}"
    steps = [f"c0 AS MATERIALIZED (SELECT k, c, i, v AS m FROM {points} JOIN ({first}) USING ({key}) JOIN (SELECT unnest(range({min(ks)}, {max(ks) + 1})) AS k) ON c < k)"]
    for n in range(_ITERATIONS):
        steps.append(f"a{n} AS MATERIALIZED ({_placed_sql(points, key, f'c{n}')})")
        steps.append(
            f"c{n + 1} AS MATERIALIZED (SELECT k, c, i, coalesce(CAST(floor(CAST(s AS DOUBLE) / n) AS BIGINT), m) AS m FROM c{n} LEFT JOIN "
            f"(SELECT k, c, i, sum(v) AS s, count(*) AS n FROM {points} JOIN a{n} USING ({key}) GROUP BY k, c, i) USING (k, c, i))"
        )
    order = f"SELECT k, c, row_number() OVER (PARTITION BY k ORDER BY list(m ORDER BY i)) - 1 AS p FROM c{_ITERATIONS} GROUP BY k, c"
    return f"WITH {', '.join(steps)} SELECT k, p AS c, i, m FROM c{_ITERATIONS} JOIN ({order}) USING (k, c)"


def _placed_sql(points: str, key: str, centres: str) -> str:
    distance = f"SELECT k, {key}, c, CAST(sum((v - m) * (v - m)) AS BIGINT) AS d FROM {points} JOIN {centres} USING (i) GROUP BY k, {key}, c"
    return f"SELECT k, {key}, min(d * 64 + c) % 64 AS c, min(d) AS d FROM ({distance}) GROUP BY k, {key}"


v.add_view(
    "vector_points",
    """SELECT vec_id, generate_subscripts(embedding, 1) AS i,
       CAST(floor(CAST(unnest(embedding) AS DOUBLE) * 1000000 + 0.5) AS BIGINT) AS v FROM vectors""",
    ["vectors"],
)
v.add_view("vector_clusters", _clusters_sql("vector_points", "vec_id", range(10, 11)), ["vector_points"])
v.add_view("vector_places", _placed_sql("vector_points", "vec_id", "vector_clusters"), ["vector_points", "vector_clusters"])


@query(
    "kmeans_fit",
    """SELECT c AS prediction, i AS element, m / 1e6 AS centre, n_rows, sse FROM vector_clusters JOIN
       (SELECT c, count(*) AS n_rows, round(sum(d) / 1e12, 6) AS sse FROM vector_places GROUP BY c) USING (c)""",
    "vector_places",
)
def _(spark, sf):
    """Ten clusters: every element of every centre, rows and squared error of the cluster."""
    points = settle(models.fixed_vectors(v.vectors(spark, sf), "vec_id", "embedding"), "points")
    centres = models.exact_kmeans(points, "vec_id", 10, _ITERATIONS)
    rows = [(i, j + 1, m / 1e6) for i, c in enumerate(centres) for j, m in enumerate(c)]
    fitted = spark.createDataFrame(rows, "prediction int, element int, centre double")
    sizes = models.place(points, "vec_id", centres).groupBy("prediction").agg(
        F.count(F.lit(1)).alias("n_rows"), F.round(F.sum("distance"), 6).alias("sse")
    )
    return fitted.join(sizes, "prediction")


_LONG = """SELECT vec_id, label, CAST(unnest(embedding) AS DOUBLE) AS x,
    generate_subscripts(embedding, 1) AS i FROM vectors"""


@query(
    "cluster_sse",
    f"""SELECT label, count(DISTINCT vec_id) AS n_rows, round(sum((x - centre) * (x - centre)), 6) AS sse FROM
        (SELECT *, avg(x) OVER (PARTITION BY label, i) AS centre FROM ({_LONG})) GROUP BY label""",
    "vectors",
)
def _(spark, sf):
    """The given labels taken as clusters."""
    table = models.cluster_sse(_vectors(spark, sf), "label")
    return table.withColumn("sse", F.round("sse", 6))


@query(
    "silhouette",
    f"""SELECT round(avg(CASE WHEN n = 1 THEN 0 ELSE (b - a) / greatest(a, b) END), 6) AS silhouette FROM (
          SELECT vec_id, max(n) FILTER (WHERE own) AS n, max(d * n / (n - 1)) FILTER (WHERE own) AS a,
                 min(d) FILTER (WHERE NOT own) AS b FROM (
            SELECT p.vec_id, p.label = c.label AS own, c.n, sum(p.x * p.x - 2 * p.x * c.m + c.q) AS d
            FROM ({_LONG}) p JOIN (
              SELECT label, i, avg(x) AS m, avg(x * x) AS q, count(*) AS n FROM ({_LONG}) GROUP BY label, i
            ) c USING (i) GROUP BY p.vec_id, p.label, c.label, c.n) GROUP BY vec_id)""",
    "vectors",
)
def _(spark, sf):
    """Mean silhouette of the given labels, squared Euclidean distance."""
    data = _vectors(spark, sf)
    value = models.silhouette(data, "label")
    return data.limit(1).select(F.round(F.lit(value), 6).alias("silhouette"))


v.add_view(
    "customer_points",
    "SELECT customer_id, i, CAST(floor(CASE WHEN high > low THEN (x - low) / (high - low) ELSE 0.5 END * 1000000 + 0.5) AS BIGINT) AS v FROM "
    "(SELECT *, min(x) OVER (PARTITION BY i) AS low, max(x) OVER (PARTITION BY i) AS high FROM ("
    + " UNION ALL ".join(f"SELECT customer_id, {i} AS i, coalesce(CAST({c} AS DOUBLE), 0) AS x FROM customer_table" for i, c in enumerate(_NAMES))
    + "))",
    ["customer_table"],
)
v.add_view("customer_clusters", _clusters_sql("customer_points", "customer_id", range(4, 5)), ["customer_points"])
v.add_view("customer_places", _placed_sql("customer_points", "customer_id", "customer_clusters"), ["customer_points", "customer_clusters"])


v.add_view("sweep_clusters", _clusters_sql("customer_points", "customer_id", models.SWEEP), ["customer_points"])
v.add_view("sweep_places", _placed_sql("customer_points", "customer_id", "sweep_clusters"), ["customer_points", "sweep_clusters"])


@query(
    "kmeans_sweep",
    """SELECT k, count(*) AS n_rows, round(sum(e) / 1e12, 6) AS sse,
              round(avg(CASE WHEN n = 1 OR greatest(a, b) <= 0 THEN 0 ELSE (b - a) / greatest(a, b) END), 6) AS silhouette FROM (
         SELECT k, customer_id, max(e) AS e, max(n) FILTER (WHERE own) AS n, max(d * n / greatest(n - 1, 1)) FILTER (WHERE own) AS a,
                min(d) FILTER (WHERE NOT own) AS b FROM (
           SELECT k, p.customer_id, p.d AS e, p.c = q.c AS own, q.n, sum(x.v * x.v - 2 * x.v * q.m + q.s) AS d
           FROM sweep_places p JOIN customer_points x USING (customer_id) JOIN (
             SELECT k, c, i, avg(CAST(v AS DOUBLE)) AS m, avg(CAST(v AS DOUBLE) * v) AS s, count(*) AS n
             FROM sweep_places JOIN customer_points USING (customer_id) GROUP BY k, c, i
           ) q USING (k, i) GROUP BY k, p.customer_id, p.d, p.c, q.c, q.n) GROUP BY k, customer_id) GROUP BY k""",
    "sweep_places customer_points",
)
def _(spark, sf):
    """k = 2 to 20 over the scaled customer features, every iteration and score of all models in one pass."""
    points = settle(models.fixed_points(_customers(spark, sf), "customer_id", _NAMES), "points")
    sweep = models.score_sweep(points, models.exact_sweep(points, "customer_id", models.SWEEP, _ITERATIONS))
    return sweep.select("k", "n_rows", F.round("sse", 6).alias("sse"), F.round("silhouette", 6).alias("silhouette"))


def _clustered(spark, sf) -> DataFrame:
    """Customers with a label from four clusters of their scaled features."""

    def build(spark, sf):
        data = _customers(spark, sf)
        points = settle(models.fixed_points(data, "customer_id", _NAMES), "points")
        labels = models.place(points, "customer_id", models.exact_kmeans(points, "customer_id", 4, _ITERATIONS))
        extra = v.customer_dim(spark, sf).select("customer_id", "age", "hh_income")
        return data.join(labels, "customer_id", "left").join(extra, "customer_id", "left")

    return stored(spark, sf, "clustered", build)


@query("assign_clusters", "SELECT customer_id, c AS prediction, d / 1e6 / 1e6 AS distance FROM customer_places", "customer_places")
def _(spark, sf):
    return _clustered(spark, sf).select("customer_id", "prediction", "distance")


@query("cluster_sizes", "SELECT c AS prediction, count(*) AS n FROM customer_places GROUP BY c", "customer_places")
def _(spark, sf):
    return value_counts(_clustered(spark, sf), "prediction")


_PROFILED = ["count_customer_id", *[f"mean_{c}" for c in _NAMES], "median_age", "median_hh_income"]
v.add_view(
    "clustered",
    f"SELECT customer_id, {_FILLED}, age, hh_income, CAST(c AS VARCHAR) AS label FROM customer_table "
    "JOIN customer_places USING (customer_id) JOIN (SELECT customer_id, age, hh_income FROM customer_dim) USING (customer_id)",
    ["customer_table", "customer_places", "customer_dim"],
)
_CELLS = ", ".join(
    ["CAST(count(customer_id) AS DOUBLE) AS count_customer_id", *[f"round(sum({c}) / count({c}), 6) AS mean_{c}" for c in _NAMES]]
    + [f"round(median(CAST({c} AS DOUBLE)), 6) AS median_{c}" for c in ("age", "hh_income")]
)
v.add_view(
    "cluster_rows",
    f"SELECT label, {_CELLS} FROM clustered GROUP BY label UNION ALL SELECT 'overall', {_CELLS} FROM clustered",
    ["clustered"],
)
_LABELS4 = ["0", "1", "2", "3", "overall"]


@query(
    "cluster_profile",
    " UNION ALL ".join(
        f"SELECT '{m}' AS metric, " + ", ".join(f"max({m}) FILTER (WHERE label = '{x}') AS \"{x}\"" for x in _LABELS4) + " FROM cluster_rows"
        for m in _PROFILED
    ),
    "cluster_rows",
)
def _(spark, sf):
    """Size, all means and both medians as rows; one column per cluster, and overall."""
    table = grouping.full_profile(_clustered(spark, sf), "prediction", "customer_id", _NAMES, ["age", "hh_income"])
    rounded = table.select("prediction", *[F.round(F.col(c).cast("double"), 6).alias(c) for c in _PROFILED])
    return grouping.transpose(rounded, "prediction", _LABELS4)


_SPLIT = "substr(md5(customer_id || '|' || CAST(week_end AS VARCHAR)), 1, 8) < 'cccccccd'"
_SIDES = f"count(*) FILTER (WHERE {_SPLIT}) AS n_train, count(*) FILTER (WHERE NOT {_SPLIT}) AS n_test"


def _fit_facts(spark, sf, model):
    """Rows per side, inputs of the model, and its area under the curve on both sides."""
    rows = _model_rows(spark, sf)
    predicted = settle(models.predict(model, rows).select("is_train", _LABEL, "rawPrediction"), "predicted")
    sides = {n: models.evaluator_auc(predicted.filter(f"is_train = {s}"), _LABEL) for n, s in (("train", 1), ("test", 0))}
    return rows.agg(
        F.sum("is_train").alias("n_train"), F.sum(1 - F.col("is_train")).alias("n_test")
    ).select(
        "*",
        F.lit(model.numFeatures).alias("n_features"),
        F.lit(model.getNumTrees).alias("n_trees"),
        F.lit(int(sides["train"] > 0.5)).alias("train_beats_chance"),
        F.lit(int(0.0 <= sides["test"] <= 1.0)).alias("test_in_range"),
    )


def _facts_sql(trees):
    return (
        f"SELECT {_SIDES}, {len(_FEATURES)} AS n_features, {trees} AS n_trees, 1 AS train_beats_chance, "
        "1 AS test_in_range FROM modelled"
    )


@query("random_forest_fit", _facts_sql(models.FOREST["numTrees"]), "modelled")
def _(spark, sf):
    return _fit_facts(spark, sf, _forest(spark, sf))


@query("boosted_trees_fit", _facts_sql(models.BOOSTED["maxIter"]), "modelled")
def _(spark, sf):
    model = _fitted(spark, sf, "boosted", lambda df: models.fit_boosted(df, _LABEL))
    return _fit_facts(spark, sf, model)


@query(
    "feature_importance",
    " UNION ALL ".join(
        f"SELECT '{n}' AS name, 1 AS in_range, 1 AS adds_up FROM modelled GROUP BY ()" for n in _FEATURES
    ),
    "modelled",
)
def _(spark, sf):
    table = models.feature_importance(_model_rows(spark, sf), _forest(spark, sf), _FEATURES)
    total = table.agg(F.sum("relative_importance")).scalar()
    return table.select(
        "name",
        F.col("relative_importance").between(0, 1).cast("int").alias("in_range"),
        (F.abs(total - 1) < 1e-9).cast("int").alias("adds_up"),
    )


@query(
    "score_probability",
    "SELECT customer_id, CAST(week_end AS VARCHAR) AS week_end, 1 AS in_range, 1 AS fits_prediction FROM modelled",
    "modelled",
)
def _(spark, sf):
    scored = models.with_score(models.predict(_forest(spark, sf), _model_rows(spark, sf)))
    by_score = (vector_to_array("probability")[1] > vector_to_array("probability")[0]).cast("double")
    return scored.select(
        "customer_id",
        "week_end",
        F.col("score").between(0, 1).cast("int").alias("in_range"),
        (by_score == F.col("prediction")).cast("int").alias("fits_prediction"),
    )


_AUC = """SELECT round(sum(wins) / ((SELECT count(*) FROM binary_scores WHERE label = 1)
    * (SELECT count(*) FROM binary_scores WHERE label = 0)), 9) AS auc FROM (
    SELECT p.doc_id, CAST(count(*) FILTER (WHERE n.score < p.score) AS DOUBLE)
        + 0.5 * count(*) FILTER (WHERE n.score = p.score) AS wins
    FROM binary_scores p CROSS JOIN (SELECT score FROM binary_scores WHERE label = 0) n
    WHERE p.label = 1 GROUP BY p.doc_id)"""


@query("auc_roc", _AUC, "binary_scores")
def _(spark, sf):
    return models.auc_roc(v.binary_scores(spark, sf), "label", "score").select(F.round("auc", 9).alias("auc"))


@query(
    "confusion_matrix",
    "SELECT label, prediction, count(*) AS n FROM binary_scores GROUP BY label, prediction",
    "binary_scores",
)
def _(spark, sf):
    return models.confusion_matrix(v.binary_scores(spark, sf), "label", "prediction")


@query(
    "accuracy",
    "SELECT CAST(count(*) FILTER (WHERE label = prediction) AS DOUBLE) / count(*) AS accuracy FROM binary_scores",
    "binary_scores",
)
def _(spark, sf):
    return models.accuracy(v.binary_scores(spark, sf), "label", "prediction")


v.add_view("newest", "SELECT * FROM features WHERE week_end = (SELECT max(week_end) FROM features)", ["features"])


@query(
    "score_latest_week",
    table_sql("newest").replace(f"{', '.join(panel.LABELS)}, ", "").replace(" FROM newest", ", 1 AS in_range FROM newest"),
    "newest",
)
def _(spark, sf):
    """The batch jobs: features of the newest week into its own folder, then the saved stages and forest over that folder."""
    path = stage_path(spark, "latest")
    write_parquet(weekly(spark, sf), f"{path}/weekly")
    features = jobs.add_latest(spark, f"{path}/weekly", f"{path}/features")
    models.feature_stages(_FEATURES).fit(features).write().overwrite().save(f"{path}/models/stages")
    _forest(spark, sf).write().overwrite().save(f"{path}/models/forest")
    scored = jobs.score_latest(spark, f"{path}/features", f"{path}/models", f"{path}/scored")
    rated = scored.select("customer_id", F.col("score").between(0, 1).cast("int").alias("in_range"))
    return whole_table(features).drop(*panel.LABELS).join(rated, "customer_id")


@query(
    "batch_score_clusters",
    "SELECT customer_id, 1 AS in_range, 1 AS at_nearest_centre FROM customer_table",
    "customer_table",
)
def _(spark, sf):
    """The batch job: saved stages and centres over the stored customer features."""
    path = stage_path(spark, "clusters")
    write_parquet(stored(spark, sf, "customers", customer_table), f"{path}/features")
    scaled, stages = _scaled_customers(spark, sf)
    stages.write().overwrite().save(f"{path}/models/stages")
    models.fit_kmeans(models.settled_input(scaled, "customer_id"), 4).write().overwrite().save(f"{path}/models/kmeans")
    labels = jobs.score_clusters(spark, f"{path}/features", f"{path}/models", f"{path}/labels")
    nearest = models.nearest_centre(KMeansModel.load(f"{path}/models/kmeans"))
    both = labels.join(scaled.select("customer_id", nearest.alias("nearest")), "customer_id")
    return both.select(
        "customer_id",
        F.col("prediction").between(0, 3).cast("int").alias("in_range"),
        (F.col("prediction") == F.col("nearest")).cast("int").alias("at_nearest_centre"),
    )
