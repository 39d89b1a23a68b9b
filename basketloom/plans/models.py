"""Clustering and classification with ``pyspark.ml``."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from multiprocessing.pool import ThreadPool

import numpy as np
import pyarrow as pa

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.evaluation import BinaryClassificationEvaluator, ClusteringEvaluator
from pyspark.ml.feature import MinMaxScaler, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketloom.operators.ordered import running_totals
from basketloom.sources.stage import settle

# The parameters of the forest and of the boosted trees.
FOREST = dict(
    numTrees=128,
    maxDepth=12,
    maxBins=128,
    minInstancesPerNode=25,
    minInfoGain=0.0,
    subsamplingRate=0.7,
    featureSubsetStrategy="0.3",
    impurity="gini",
    seed=125,
)
BOOSTED = dict(maxDepth=8, maxIter=16, subsamplingRate=0.7, seed=125)
SWEEP = range(2, 21)

#: Labelled rows of each class that ``bounded_rows`` keeps, about, unless told otherwise.
PER_CLASS = 10_000
#: Rows per partition of a cached training set.
FIT_ROWS = 50_000
#: The least for trees.
TREE_ROWS = 10_000


def assemble(df: DataFrame, columns: Sequence[str], out: str = "features") -> DataFrame:
    """One vector of the columns; nulls must be filled before."""
    return VectorAssembler(inputCols=list(columns), outputCol=out, handleInvalid="error").transform(df)


def feature_stages(columns: Sequence[str], scale: Sequence[str] | None = None) -> Pipeline:
    """Assembler, or assembler with min-max scaling of some of the columns.

    ``scale=None`` scales nothing; give all columns to scale everything.
    """
    if scale is None:
        return Pipeline(stages=[VectorAssembler(inputCols=list(columns), outputCol="features")])
    rest = [c for c in columns if c not in scale]
    return Pipeline(
        stages=[
            VectorAssembler(inputCols=list(scale), outputCol="to_scale"),
            MinMaxScaler(inputCol="to_scale", outputCol="scaled"),
            VectorAssembler(inputCols=["scaled", *rest], outputCol="features"),
        ]
    )


def hash_split(df: DataFrame, keys: Sequence[str], share: float = 0.8) -> DataFrame:
    """Add ``is_train``; a row's side depends on its key alone, not on partitions."""
    digest = F.md5(F.concat_ws("|", *[F.col(k).cast("string") for k in keys]))
    limit = format(round(share * 2**32), "08x")
    return df.withColumn("is_train", (F.substring(digest, 1, 8) < limit).cast("int"))


def bounded_rows(df: DataFrame, label: str, keys: Sequence[str], per_class: int = PER_CLASS) -> DataFrame:
    """About ``per_class`` rows of every class, those of the least key hashes; all of a smaller class.

    For trials on large tables; no query and no job trains on it. The rows do not
    depend on partitions or order; null labels go.
    """
    sizes = {r[0]: r[1] for r in df.filter(F.col(label).isNotNull()).groupBy(label).count().collect()}
    place = F.pmod(F.xxhash64(*[F.col(k).cast("string") for k in keys]), F.lit(1 << 32))
    kept = F.lit(False)
    for value, n in sizes.items():
        kept = kept | ((F.col(label) == F.lit(value)) & (place < min(1 << 32, -(-per_class * (1 << 32) // n))))
    return df.filter(kept)


def settled_input(df: DataFrame, *keys: str, rows: int = FIT_ROWS) -> DataFrame:
    """Cached rows in an order that repeats, for fits that read them many times.

    Partitions follow from the rows: every iteration is a job over all of them.
    """
    parts = max(1, -(-df.count() // rows))
    return df.repartition(parts, *keys).sortWithinPartitions(*keys).persist(StorageLevel.MEMORY_AND_DISK)


def training_rows(df: DataFrame, label: str, keys: Sequence[str], per_class: int | None = None) -> DataFrame:
    """All rows with a label, stored, in no more partitions than the session runs tasks at a time.

    Every partition of a fit sends the statistics of all nodes of a level, however
    few of its rows are in them. The fit keeps its own binned rows and reads these
    only a few times, so they are not cached as well. ``per_class`` asks for
    :func:`bounded_rows` instead.
    """
    kept = df.filter(F.col(label).isNotNull()) if per_class is None else bounded_rows(df, label, keys, per_class)
    parts = max(1, min(-(-kept.count() // TREE_ROWS), df.sparkSession.sparkContext.defaultParallelism))
    return settle(kept.repartition(parts, *keys).sortWithinPartitions(*keys), "training").coalesce(parts)


def fit_kmeans(df: DataFrame, k: int, features: str = "features", seed: int = 125, **params) -> KMeansModel:
    return KMeans(k=k, featuresCol=features, seed=seed, **params).fit(df)


def kmeans_sweep(
    df: DataFrame,
    key: str,
    features: str = "features",
    ks: Iterable[int] = SWEEP,
    parallelism: int = 8,
    **params,
) -> DataFrame:
    """(k, n_rows, sse, silhouette) for every k.

    The input is cached once; some fits run side by side, since the jobs of one
    fit leave executors idle between its iterations.
    """
    data = settled_input(df.select(key, features), key)
    data.count()  # fill the cache before the fits share it
    evaluator = ClusteringEvaluator(featuresCol=features)

    def run(k: int):
        model = fit_kmeans(data, k, features, **params)
        score = evaluator.evaluate(model.summary.predictions)
        return k, sum(model.summary.clusterSizes), model.summary.trainingCost, float(score)

    try:
        with ThreadPool(parallelism) as pool:
            rows = pool.map(inheritable_thread_target(df.sparkSession)(run), ks)
    finally:
        data.unpersist()
    return df.sparkSession.createDataFrame(rows, "k int, n_rows bigint, sse double, silhouette double")


def cluster_sse(df: DataFrame, cluster: str, features: str = "features") -> DataFrame:
    """Rows and sum of squared distances to the own centre, per cluster, in one pass.

    Uses sum |x|^2 - n |mean|^2, so no centre is joined back to the rows.
    """
    stats = Summarizer.metrics("count", "mean", "normL2").summary(F.col(features))
    per = df.groupBy(cluster).agg(stats.alias("s"))

    def squares(vector: str) -> Column:
        return F.aggregate(vector_to_array(vector), F.lit(0.0), lambda a, x: a + x * x)

    return per.select(
        cluster,
        F.col("s.count").alias("n_rows"),
        (squares("s.normL2") - F.col("s.count") * squares("s.mean")).alias("sse"),
    )


def silhouette(df: DataFrame, cluster: str, features: str = "features") -> float:
    """Mean silhouette with squared Euclidean distance; one pass per point, not per pair."""
    return ClusteringEvaluator(featuresCol=features, predictionCol=cluster).evaluate(
        df.withColumn(cluster, F.col(cluster).cast("double"))
    )


def nearest_centre(model: KMeansModel, features: str = "features") -> Column:
    """Index of the closest centre by plain expressions; the centres are k rows of the model."""
    x = vector_to_array(features)

    def distance(centre) -> Column:
        point = F.array(*[F.lit(float(c)) for c in centre])
        return F.aggregate(
            F.zip_with(x, point, lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda a, d: a + d
        )

    pairs = [F.struct(distance(c).alias("d"), F.lit(i).alias("i")) for i, c in enumerate(model.clusterCenters())]
    return F.array_min(F.array(*pairs))["i"]


def assign_clusters(model: KMeansModel, df: DataFrame, key: str, features: str = "features") -> DataFrame:
    """(key, prediction) for every row."""
    return model.setFeaturesCol(features).transform(df).select(key, "prediction")


# ---- clusters that do not depend on the machine ------------------------------

#: Units per 1 of a fixed-point value.
UNIT = 1_000_000


def fixed_points(df: DataFrame, key: str, columns: Sequence[str], scale: bool = True) -> DataFrame:
    """(key, point): the columns as whole millionths, min-max scaled to 0 .. 1 first unless ``scale`` is off.

    A column of one value becomes 0.5; nulls must be filled before.
    """
    values = {c: F.col(c).cast("double") for c in columns}
    if scale:
        ends = df.agg(*[f(x).alias(f"{n}_{c}") for c, x in values.items() for n, f in (("low", F.min), ("high", F.max))]).first()
        for c, x in values.items():
            low, high = ends[f"low_{c}"], ends[f"high_{c}"]
            values[c] = (x - F.lit(low)) / F.lit(high - low) if low is not None and high > low else F.lit(0.5)
    return df.select(key, F.array(*[F.floor(x * float(UNIT) + 0.5).cast("bigint") for x in values.values()]).alias("point"))


def fixed_vectors(df: DataFrame, key: str, vector: str) -> DataFrame:
    """(key, point): the elements of an array column as whole millionths."""
    return df.select(key, F.transform(vector, lambda x: F.floor(x.cast("double") * float(UNIT) + 0.5).cast("bigint")).alias("point"))


def _passed(points: DataFrame, models: Sequence[np.ndarray], score: Callable, out: str) -> DataFrame:
    """What ``score`` adds up over the points for all models, in one pass; one set of rows per task.

    ``score`` gets the points of a batch as doubles, which hold every square and
    product exactly, and what it returned for the batch before.
    """
    shared = points.sparkSession.sparkContext.broadcast([np.asarray(m, np.float64) for m in models])

    def run(batches):
        total = None
        for batch in batches:
            column = batch.column(0)
            if len(column):
                total = score(column.flatten().to_numpy().astype(np.float64).reshape(len(column), -1), shared.value, total)
        if total is not None:
            yield pa.RecordBatch.from_pydict(total.rows())

    return points.select("point").mapInArrow(run, out)


def _distances(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return (x * x).sum(1)[:, None] - 2 * (x @ centres.T) + (centres * centres).sum(1)


class _Moments:
    """Per model and cluster: rows, squared distances to the centre, squares, and every element, summed.

    The two squares are summed as multiples of HALF and the rest, so that no
    number of rows overflows.
    """

    HALF = 1 << 30

    def __init__(self, models):
        self.sums = [np.zeros((len(c), 5 + c.shape[1]), np.int64) for c in models]

    @classmethod
    def halves(cls, x: np.ndarray) -> list[np.ndarray]:
        high = np.floor(x / cls.HALF)
        return [high, x - high * cls.HALF]

    def rows(self) -> dict[str, np.ndarray]:
        cells = [(m, i, e, t[i, e]) for m, t in enumerate(self.sums) for i in range(len(t)) for e in range(t.shape[1])]
        return dict(zip(("model", "cluster", "element", "total"), map(list, zip(*cells))))


def _add_moments(x, models, total):
    total = total or _Moments(models)
    for sums, centres in zip(total.sums, models):
        d = _distances(x, centres)
        own = d.argmin(1)
        halves = [h for v in (d[np.arange(len(x)), own], (x * x).sum(1)) for h in _Moments.halves(v)]
        values = np.column_stack([np.ones(len(x)), *halves, x]).astype(np.int64)
        order = np.argsort(own, kind="stable")
        found, begin = np.unique(own[order], return_index=True)
        sums[found] += np.add.reduceat(values[order], begin)
    return total


class _Silhouettes:
    def __init__(self, models):
        self.sums = [0.0] * len(models)

    def rows(self):
        return {"model": list(range(len(self.sums))), "total": self.sums}


def _moments(points: DataFrame, models: Sequence[np.ndarray]) -> list[np.ndarray]:
    """One array of Python integers per model, a row per cluster: rows, squared distances, squares, elements.

    The driver gets no more numbers than the models hold.
    """
    rows = _passed(points, models, _add_moments, "model long, cluster long, element long, total long")
    out = [np.zeros((len(m), 5 + len(m[0])), object) for m in models]
    for m, i, e, total in rows.groupBy("model", "cluster", "element").agg(F.sum("total")).collect():
        out[m][i, e] = total
    whole = lambda t, e: t[:, e] * _Moments.HALF + t[:, e + 1]
    return [np.column_stack([t[:, 0], whole(t, 1), whole(t, 3), t[:, 5:]]) for t in out]


def exact_sweep(points: DataFrame, key: str, ks: Iterable[int], iterations: int = 10) -> dict[int, list[list[int]]]:
    """Centres of ``k`` clusters of (key, point) for every k, equal on every machine and partitioning.

    Lloyd's iterations in whole numbers, from the points of the lowest keys:
    sums are exact, a mean is rounded down, ties go to the lower cluster, an
    empty cluster keeps its centre. Clusters are numbered in the order of their
    centres. One pass over the points is one iteration of all models;
    ``points`` should be a stored table. Fewer points than k give fewer
    clusters; no points, none.
    """
    ks = sorted(ks)
    first = [list(r["point"]) for r in points.orderBy(key).limit(max(ks)).collect()]
    models = {k: first[:k] for k in ks}
    open_ = [k for k in ks if first]
    for _ in range(iterations):
        if not open_:
            break
        for k, sums in zip(list(open_), _moments(points, [models[k] for k in open_])):
            moved = [[int(t) // int(row[0]) for t in row[3:]] if row[0] else centre for row, centre in zip(sums, models[k])]
            if moved == models[k]:
                open_.remove(k)
            models[k] = moved
    return {k: sorted(m) for k, m in models.items()}


def exact_kmeans(points: DataFrame, key: str, k: int, iterations: int = 10) -> list[list[int]]:
    """:func:`exact_sweep` for one k."""
    return exact_sweep(points, key, [k], iterations)[k]


def score_sweep(points: DataFrame, models: dict[int, list[list[int]]]) -> DataFrame:
    """(k, n_rows, sse, silhouette) of all models from two passes over the points.

    The silhouette uses squared Euclidean distances, whose mean to a cluster
    follows from the cluster's moments; a cluster of one point counts 0.
    """
    moments = _moments(points, list(models.values()))

    def add(x, centres, total):
        total = total or _Silhouettes(centres)
        for m, (c, sums) in enumerate(zip(centres, moments)):
            n = sums[:, 0].astype(np.float64)
            real = n > 0
            mean = sums[real, 3:].astype(np.float64) / n[real, None]
            square = sums[real, 2].astype(np.float64) / n[real]
            apart = (x * x).sum(1)[:, None] - 2 * (x @ mean.T) + square
            own = (np.cumsum(real) - 1)[_distances(x, c).argmin(1)]
            at = np.arange(len(x))
            size = n[real][own]
            a = apart[at, own] * size / np.maximum(size - 1, 1)
            apart[at, own] = np.inf
            b = apart.min(1)
            with np.errstate(invalid="ignore", divide="ignore"):
                total.sums[m] += float(np.where((size > 1) & (np.maximum(a, b) > 0), (b - a) / np.maximum(a, b), 0.0).sum())
        return total

    found = _passed(points, list(models.values()), add, "model long, total double").groupBy("model").agg(F.sum("total")).collect()
    shape = dict(map(tuple, found))
    rows = []
    for m, (k, sums) in enumerate(zip(models, moments)):
        n = sum(int(x) for x in sums[:, 0])
        rows.append((k, n, sum(int(x) for x in sums[:, 1]) / UNIT**2, shape.get(m, 0.0) / max(n, 1)))
    return points.sparkSession.createDataFrame(rows, "k int, n_rows bigint, sse double, silhouette double")


def place(points: DataFrame, key: str, centres: Sequence[Sequence[int]]) -> DataFrame:
    """(key, prediction, distance): the cluster of every point and the squared distance to its centre, ties to the lower."""

    def distance(centre) -> Column:
        other = F.array(*[F.lit(c).cast("bigint") for c in centre])
        return F.aggregate(F.zip_with("point", other, lambda a, b: (a - b) * (a - b)), F.lit(0).cast("bigint"), lambda a, d: a + d)

    nearest = F.array_min(F.array(*[F.struct(distance(c).alias("d"), F.lit(i).alias("i")) for i, c in enumerate(centres)]))
    found = points.select(key, nearest.alias("__found"))
    return found.select(key, F.col("__found.i").alias("prediction"), (F.col("__found.d") / float(UNIT) / float(UNIT)).alias("distance"))


def fit_forest(df: DataFrame, label: str, features: str = "features", **params):
    return RandomForestClassifier(labelCol=label, featuresCol=features, **{**FOREST, **params}).fit(df)


def fit_boosted(df: DataFrame, label: str, features: str = "features", **params):
    """Boosted trees with logistic loss; zeros are ordinary values."""
    return GBTClassifier(labelCol=label, featuresCol=features, **{**BOOSTED, **params}).fit(df)


def predict(model, df: DataFrame, features: str = "features") -> DataFrame:
    """What ``model.transform`` gives, from dense vectors: trees search every element they ask of a sparse one."""
    return model.transform(df.withColumn(features, array_to_vector(vector_to_array(features))))


def feature_importance(df: DataFrame, model, columns: Sequence[str]) -> DataFrame:
    """(name, relative_importance), largest first; one row per input of the model."""
    rows = [(n, float(x)) for n, x in zip(columns, model.featureImportances.toArray(), strict=True)]
    table = df.sparkSession.createDataFrame(rows, "name string, relative_importance double")
    return table.orderBy(F.col("relative_importance").desc(), F.col("name"))


def with_score(predicted: DataFrame) -> DataFrame:
    """Probability of class 1 as float, without a Python function."""
    return predicted.withColumn("score", vector_to_array("probability")[1].cast("float"))


def auc_roc(df: DataFrame, label: str, score: str) -> DataFrame:
    """Area under the ROC curve by rank sums over distinct scores; ties count half, null labels not at all."""
    counts = settle(
        df.filter(F.col(label).isNotNull()).groupBy(score).agg(
            F.sum(F.when(F.col(label) == 1, 1).otherwise(0)).alias("pos"),
            F.sum(F.when(F.col(label) == 1, 0).otherwise(1)).alias("neg"),
        ),
        "scores",
    )
    below = running_totals(counts, [], [F.col(score)], {"neg_upto": F.col("neg")})
    wins = F.col("pos").cast("double") * (F.col("neg_upto") - F.col("neg") / F.lit(2.0))
    return below.agg(
        F.try_divide(F.sum(wins), F.sum("pos").cast("double") * F.sum("neg").cast("double")).alias("auc")
    )


def evaluator_auc(df: DataFrame, label: str, raw: str = "rawPrediction") -> float:
    return BinaryClassificationEvaluator(
        labelCol=label, rawPredictionCol=raw, metricName="areaUnderROC", numBins=0
    ).evaluate(df)


def confusion_matrix(df: DataFrame, label: str, prediction: str) -> DataFrame:
    return df.groupBy(label, prediction).agg(F.count(F.lit(1)).alias("n")).orderBy(label, prediction)


def accuracy(df: DataFrame, label: str, prediction: str) -> DataFrame:
    same = F.sum(F.when(F.col(label) == F.col(prediction), 1).otherwise(0))
    return df.agg(F.try_divide(same.cast("double"), F.count(F.lit(1))).alias("accuracy"))


def load_stages(path: str) -> PipelineModel:
    return PipelineModel.load(path)
