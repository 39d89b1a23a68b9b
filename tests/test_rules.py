"""One small case per rule on nulls, types and edges."""

import datetime
import os
import subprocess
import sys
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from basketloom.functions import scalars, udfs
from basketloom.operators import checks, grouping, impute, joins, summaries
from basketloom.plans import enrich, models
from basketloom.sources import files, stage


def test_divide_by_zero_is_null(spark):
    df = spark.createDataFrame([(1, 0), (1, 4), (None, 2)], "a int, b int")
    assert [r[0] for r in df.select(grouping.ratio("a", "b")).collect()] == [None, 0.25, None]


def test_null_counts_see_nan_and_take_text(spark):
    df = spark.createDataFrame([(1.0, "x"), (float("nan"), None), (None, "y")], "a double, b string")
    assert [tuple(r) for r in checks.null_counts(df).collect()] == [("a", 2), ("b", 1)]


def test_null_group_is_one_key_value(spark):
    df = spark.createDataFrame([(1,), (None,), (None,)], "k int")
    assert tuple(checks.grain_check(df, ["k"]).first()) == (3, 2, 0)


def test_log_of_zero_is_null(spark):
    assert spark.range(1).select(F.log(F.lit(0.0))).first()[0] is None


def test_fill_touches_numbers_only(spark):
    from basketloom.plans.jobs import filled

    df = spark.createDataFrame([(None, None, None)], "a int, b string, c date")
    assert tuple(filled(df).first()) == (0, None, None)


def test_group_mean_keeps_null_groups_null(spark):
    df = spark.createDataFrame(
        [("a", 1.0), ("a", None), ("b", None), (None, 5.0), (None, None)], "g string, x double"
    )
    got = [r.y for r in impute.fill_group_mean(df, "x", "g", "y").collect()]
    assert sorted(got, key=str) == sorted([1.0, 1.0, None, 5.0, None], key=str)


def test_fills(spark):
    df = spark.createDataFrame([(1.0,), (1.0,), (4.0,), (10.0,), (None,)], "x double")
    last = {
        "mean": impute.fill_mean(df, "x", "y").filter("x is null").first().y,
        "median": impute.fill_median(df, "x", "y").filter("x is null").first().y,
        "mode": impute.fill_mode(df, "x", "y").filter("x is null").first().y,
    }
    assert last == {"mean": 4.0, "median": 2.5, "mode": 1.0}


def test_rename(spark):
    df = spark.createDataFrame([(1,)], "a int")
    assert df.withColumnsRenamed({"zzz": "b"}).columns == ["a"]
    with pytest.raises(ValueError):
        scalars.rename_strict(df, {"zzz": "b"})
    assert scalars.rename_strict(df, {"a": "b"}).columns == ["b"]


def test_group_by_and_rename_forms(spark):
    df = spark.createDataFrame([(1, 2, 3), (1, 4, 5)], "k int, a int, b int")
    by_map = grouping.group_by_and_rename(df, ("k",), {"avg": ["a"], "sum": ["a", "b"]})
    assert by_map.columns == ["k", "avg_a", "sum_a", "sum_b"]
    assert tuple(by_map.first()) == (1, 3.0, 6, 8)
    assert grouping.group_by_and_rename(df, [], [("max", "b")]).columns == ["max_b"]


def test_constant_column_scales_to_half(spark):
    df = spark.createDataFrame([(1.0, 3.0), (2.0, 3.0)], "a double, b double")
    out = models.feature_stages(["a", "b"], scale=["a", "b"]).fit(df).transform(df)
    assert [list(r.features) for r in out.collect()] == [[0.0, 0.5], [1.0, 0.5]]


def test_sales_group_edges(spark):
    rows = [("A", 225000), ("A", 400000), ("A", 400001), ("B", 150000), ("C", 50000), ("D", 1), ("WS", None)]
    df = spark.createDataFrame(rows, "c string, s int")
    got = [r[0] for r in df.select(scalars.sales_group("s", "c")).collect()]
    assert got == ["Low", "Medium", "High", "Medium", "Low", None, "High"]


def test_week_end_is_saturday(spark):
    days = [datetime.date(2020, 11, 29) + datetime.timedelta(i) for i in range(8)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    got = [r[0] for r in df.select(scalars.week_end("d")).collect()]
    assert got == [datetime.date(2020, 12, 5)] * 7 + [datetime.date(2020, 12, 12)]


def test_pair_with_all_takes_long_tables(spark):
    rows = spark.range(3)
    assert joins.pair_with_all(rows, spark.range(5000), "x").distinct().count() == 15_000
    assert joins.pair_with_all(rows, spark.createDataFrame([], "x string"), "x").count() == 0


def test_nothing_is_lost_in_silence(spark):
    df = spark.createDataFrame([("a", 1.0), (None, 3.0), (None, 5.0)], "g string, v double")
    got = {r["g"]: r["median_v"] for r in grouping.profile(df, "v", ["v"], ["v"], "g").collect()}
    assert got == {"a": 1.0, None: 4.0}
    text = spark.createDataFrame([(None, "x")], "empty string, full string")
    assert {r["column_name"]: r["count"] for r in summaries.describe_string(text).collect()} == {"empty": 0, "full": 1}
    sold = spark.createDataFrame([(1, "A", 2), (1, "NEW", 3)], "k int, c string, n int")
    with pytest.raises(Exception, match="not listed: NEW"):
        grouping.pivot_single(sold, "k", "c", ["A"], F.sum("n")).collect()
    assert grouping.pivot_single(sold, "k", "c", None, F.sum("n")).columns == ["k", "A", "NEW"]
    scores = spark.createDataFrame([(1, 0.9), (0, 0.1), (None, 0.95)], "y int, s double")
    assert models.auc_roc(scores, "y", "s").first()["auc"] == 1.0
    with pytest.raises(Exception, match="whole cents"):
        spark.sql("SELECT CAST(0.0049 AS DECIMAL(18,4)) AS x").select(enrich.cents("x")).collect()


def test_distances_agree_on_nulls(spark):
    df = spark.createDataFrame([(None, 0.0, 1.0, 1.0), (0.0, 0.0, 0.0, 180.0)], "a double, b double, c double, d double")
    columns = ["a", "b", "c", "d"]
    plain = [r[0] for r in df.select(scalars.haversine(*columns)).collect()]
    assert plain == [r[0] for r in df.select(udfs.haversine_udf(*columns)).collect()]
    assert plain[0] is None and plain[1] > 20_000


def test_jobs_start_from_any_folder(tmp_path):
    job = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "basketloom", "plans", "jobs.py")
    run = subprocess.run([sys.executable, job, "no-such-job"], cwd=tmp_path, env={**os.environ, "PYTHONPATH": ""}, capture_output=True, text=True)
    assert "KeyError: 'no-such-job'" in run.stderr


def test_stage_tables_lie_below_the_application(spark):
    path = stage.stage_path(spark, "x")
    assert spark.sparkContext.applicationId in path
    assert stage.settle(spark.range(5)).count() == 5


def test_stage_folder_follows_the_session():
    def session(folder, master):
        context = SimpleNamespace(applicationId="app-1", master=master)
        return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: folder), sparkContext=context)

    assert stage.shared_dir(session("s3://bucket/x/", "yarn")) == "s3://bucket/x/basketloom/app-1"
    assert stage.shared_dir(session(None, "local[2]")).endswith("/basketloom/app-1")
    with pytest.raises(ValueError):
        stage.shared_dir(session(None, "yarn"))


def test_uri(spark):
    assert files.as_uri(spark, "/a/b") == "file:/a/b"
    for path in ("s3://bucket/a", "file:/a/b"):
        assert files.as_uri(spark, path) == path


def test_blank_rows(spark, tmp_path):
    path = tmp_path / "padded.csv"
    path.write_text("a,b,\n1,x,\n,,\n2,,\n,,\n")
    df = files.drop_blank_rows(files.read_csv(spark, str(path), "a int, b string, _c2 string"))
    assert sorted(map(tuple, df.collect())) == [(1, "x"), (2, None)]
    assert files.drop_blank_rows(files.read_csv(spark, str(path))).columns == ["a", "b"]


def test_partitioned_write_gives_each_value_the_files_it_asks_for(spark, tmp_path):
    df = spark.range(1000).select("id", F.when(F.col("id") < 900, 1).when(F.col("id") < 990, 2).alias("k"))
    files.write_partitioned(df, str(tmp_path / "t"), ["k"], file_rows=100)
    back = spark.read.parquet(str(tmp_path / "t"))
    sizes = back.groupBy("k", F.input_file_name().alias("file")).count().collect()
    per = {k: [r["count"] for r in sizes if r["k"] == k] for k in (1, 2, None)}
    assert [sum(per[k]) for k in (1, 2, None)] == [900, 90, 10] and 9 <= len(per[1]) <= 12 and max(per[1]) <= 100
    assert len(per[2]) == len(per[None]) == 1
    assert "PartitionFilters: [isnotnull(k" in back.filter("k = 1")._jdf.queryExecution().executedPlan().toString()


def test_partitioned_write_replaces_touched_folders_only(spark, tmp_path):
    path = str(tmp_path / "t")
    files.write_partitioned(spark.createDataFrame([(1, "old"), (2, "old")], "k int, v string"), path, ["k"])
    files.write_partitioned(spark.createDataFrame([(2, "new"), (3, "new")], "k int, v string"), path, ["k"])
    assert sorted(map(tuple, spark.read.parquet(path).select("k", "v").collect())) == [(1, "old"), (2, "new"), (3, "new")]
    newest = files.newest_partition(spark, path, "k")
    assert newest.select("k", "v").collect() == [(3, "new")] and all("k=3" in f for f in newest.inputFiles())


def test_newest_partition_needs_folders(spark, tmp_path):
    files.write_parquet(spark.range(3), str(tmp_path / "t"))
    with pytest.raises(ValueError):
        files.newest_partition(spark, str(tmp_path / "t"), "k")


def test_describe_string_breaks_ties_by_value(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,)], "s string")
    assert tuple(summaries.describe_string(df).first()) == ("s", 2, 2, "a", 1)


def test_stage_row_counts_is_one_pass(spark):
    df = checks.stage_row_counts(spark.range(10), {"big": F.col("id") > 3, "even": F.col("id") % 2 == 0})
    assert tuple(df.first()) == (10, 6, 3)
    assert df._jdf.queryExecution().executedPlan().toString().count("Range (") == 1


def test_profile_total_row(spark):
    df = spark.createDataFrame([(1, 1, 2.0), (2, 1, 4.0), (3, 2, 9.0)], "id int, c int, x double")
    got = sorted(map(tuple, grouping.profile_with_total(df, "c", "id", ["x"]).collect()))
    assert got == [("1", 2, 3.0), ("2", 1, 9.0), ("overall", 3, 5.0)]
    wide = grouping.transpose(grouping.profile_with_total(df, "c", "id", ["x"]), "c", ["1", "2", "overall"])
    assert ("avg_x", 3.0, 9.0, 5.0) in set(map(tuple, wide.collect()))


@pytest.mark.parametrize("sketch", [20, 300, 100_000])
@pytest.mark.parametrize("interpolate", [True, False])
def test_selected_percentiles_are_exact(spark, sketch, interpolate):
    hot = F.when(F.col("id") % 3 == 0, F.lit(7.5))
    df = spark.range(6000).select(
        F.when(F.col("id") % 50 != 0, (F.col("id") % 4 == 0).cast("string")).alias("g"),
        F.coalesce(hot, F.when(F.col("id") % 11 != 0, F.hash("id") % 10_000 / 7)).alias("a"),
        F.when(F.col("id") % 2 == 0, F.col("id") % 5).alias("b"), F.lit(None).cast("int").alias("c"), (F.col("id") / 7).alias("d"),
    ).repartition(6)
    names = {"p0": 0.0, "p1": 0.001, "p25": 0.25, "p50": 0.5, "p51": 0.51, "p99": 0.999, "p100": 1.0}
    for by in ([], ["g"]):
        got = summaries.selected_percentiles(df, ["a", "b", "c", "d"], names, by, interpolate, sketch)
        want = summaries.exact_percentiles(summaries.long_form(df, ["a", "b", "c", "d"], by), [*by, "column_name"], "value", names, interpolate=interpolate)
        key = lambda df: sorted(map(str, df.select(*by, "column_name", *names).collect()))
        assert key(got) == key(want) and got.count() == 3 * (3 if by else 1)


def test_selected_percentiles_send_few_values(spark):
    df = spark.range(200_000).select(F.hash("id").cast("double").alias("a"))
    summaries.selected_percentiles(df, ["a"], {"p50": 0.5}, sketch=2000).collect()
    got = summaries.selected_percentiles(df, ["a"], {"p50": 0.5}, sketch=2000).first()["p50"]
    assert got == df.select(F.percentile("a", 0.5)).first()[0]
