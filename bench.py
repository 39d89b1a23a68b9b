"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR is the table folder, BENCH_CPUS the number of local threads.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from basketloom.catalog import features, load  # noqa: E402
from basketloom.catalog import views as v  # noqa: E402
from basketloom.functions import scalars, udfs  # noqa: E402

ARGS = ["lat_a", "lng_a", "lat_b", "lng_b"]
HEADLINE = [
    "agg_customer_overall",
    "customer_features",
    "weekly_aggregate",
    "model_dataset",
    "summary_percentiles",
    "describe_grouped",
    "row_number_by_group",
    "rank_average",
    "cumulative_sum",
    "rolling_mean_7",
    "profile_by_group",
    "join_left",
    "pivot_multi",
    "auc_roc",
    "kmeans_sweep",
]


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def pairs(spark: SparkSession, sf_dir: str, n: int = 250_000):
    """Positions derived from the order lines: the size of the published timing."""
    lines = v.table(spark, sf_dir, "lineitem")

    def degrees(column, step, span, shift):
        return (F.col(column) * step % span).cast("double") / 100 - shift

    return lines.select(
        degrees("l_partkey", 37, 18000, 90).alias("lat_a"),
        degrees("l_partkey", 73, 36000, 180).alias("lng_a"),
        degrees("l_orderkey", 37, 18000, 90).alias("lat_b"),
        degrees("l_orderkey", 73, 36000, 180).alias("lng_b"),
    ).limit(n)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = load()[0]
    times: dict[str, float] = {}

    def timed(name, action, repeat=1):
        best = None
        for _ in range(repeat):
            start = time.time()
            action()
            best = min(best or 1e9, time.time() - start)
        times[name] = round(best, 3)
        print(f"{name} {times[name]}", file=sys.stderr, flush=True)

    cached = pairs(spark, sf_dir).repartition(int(cpus)).cache()
    cached.count()
    forms = {
        "expression": lambda: cached.select(F.sum(scalars.haversine(*ARGS))),
        "pandas_udf": lambda: cached.select(F.sum(udfs.haversine_pandas(*ARGS))),
        "batches": lambda: udfs.haversine_batches(cached, ARGS, "d").select(F.sum("d")),
        "python_udf": lambda: cached.select(F.sum(udfs.haversine_udf(*ARGS))),
    }
    for form, df in forms.items():
        timed(f"haversine_250k_{form}", lambda df=df: df().collect(), repeat=3)
    cached.unpersist()

    for name in HEADLINE:
        features._stored.clear()
        timed(name, lambda name=name: run(queries[name](spark, sf_dir)))

    # the table itself; the registered query adds totals over it for the SQL check
    timed("rolling_feature_table", lambda: run(features.rolling(spark, sf_dir)))

    print(
        json.dumps(
            {
                "metric": "total of headline queries",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
