"""Ordered windows over a hot group: many tasks must give what one task gives."""

import duckdb
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from basketloom.operators import ordered, ranking, summaries


@pytest.fixture(scope="module")
def rows(spark):
    """A third of the rows in one group; ties, nulls and a null group."""
    data = []
    for i in range(900):
        group = "hot" if i % 3 == 0 else (None if i % 3 == 1 and i % 2 else f"g{i % 7}")
        value = None if i % 11 == 0 else (i * 37) % 50
        data.append((i, group, value))
    df = spark.createDataFrame(data, "id bigint, g string, v bigint")
    return df.select("id", "g", F.col("v").cast("decimal(18,2)").alias("v")).persist()


@pytest.fixture(params=[1, 3, 40, 2000])
def blocks(request, monkeypatch):
    """From one block for all rows to more blocks than rows."""
    monkeypatch.setattr(ordered, "MOST_BLOCKS", request.param)
    monkeypatch.setattr(ordered, "PER_PARTITION", request.param)
    monkeypatch.setattr(ordered, "BLOCK_BYTES", 1)
    return request.param


def order():
    return [F.col("v").desc_nulls_last(), F.col("id")]


def plain(by):
    return Window.partitionBy(*by).orderBy(*order())


def same(a, b):
    assert a.dtypes == b.dtypes
    assert sorted(map(repr, a.collect())) == sorted(map(repr, b.collect()))


@pytest.mark.parametrize("by", [["g"], []])
def test_row_numbers(rows, by, blocks):
    same(ranking.row_numbers(rows, by, order(), "n"), rows.withColumn("n", F.row_number().over(plain(by)).cast("bigint")))


def test_a_hot_group_is_cut_into_blocks_of_like_size(rows):
    sizes = ordered.with_blocks(rows, ["g"], order(), 20).groupBy("__block").agg(F.count("*").alias("n"), F.countDistinct("g").alias("g")).collect()
    hot = ordered.with_blocks(rows, ["g"], order(), 20).filter("g = 'hot'").select("__block").distinct().count()
    assert len(sizes) == 20 and max(r.n for r in sizes) < 150 and hot >= 5


@pytest.mark.parametrize("way", ["asc_nulls_first", "asc_nulls_last", "desc_nulls_first", "desc_nulls_last"])
def test_blocks_follow_the_order(rows, way, blocks):
    by = [getattr(F.col("v"), way)(), F.col("id").desc()]
    cut = ordered.with_blocks(rows, ["g"], by, blocks).withColumn("n", F.row_number().over(Window.orderBy("g", *by)))
    found = [r["__block"] for r in cut.orderBy("n").collect()]
    assert found == sorted(found) and (len(set(found)) > 1 or blocks == 1)


@pytest.mark.parametrize("kind", ["string", "date", "timestamp", "double", "float", "boolean", "binary", "smallint", "decimal(38,5)"])
def test_blocks_of_any_type(spark, kind):
    base = spark.range(400).select((F.col("id") * 7919 % 400).alias("id"))
    day = F.date_add(F.lit("1969-12-01").cast("date"), F.col("id").cast("int"))
    value = {"date": day, "timestamp": day.cast("timestamp"), "boolean": F.col("id") % 2 == 0}.get(kind, F.col("id").cast("string").cast(kind))
    df = base.select("id", F.when(F.col("id") % 9 != 0, value).alias("x"))
    got = ordered.running_totals(df, [], [F.col("x"), F.col("id")], {"n": F.lit(1).cast("bigint")}, 16)
    same(got, df.withColumn("n", F.row_number().over(Window.orderBy("x", "id")).cast("bigint")))


def test_blocks_follow_from_the_bytes_that_are_read(spark, rows, monkeypatch, tmp_path):
    spark.range(1000).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t")).withColumn("g", F.col("id") % 3)
    assert ordered._blocks(df) == 1 and ordered._blocks(rows.sparkSession.createDataFrame(rows.rdd, rows.schema)) == 16
    plan = lambda: ranking.row_numbers(df, ["g"], [F.col("id")], "n")._jdf.queryExecution().executedPlan().toString()
    assert "Union" not in plan()
    monkeypatch.setattr(ordered, "BLOCK_BYTES", 1000)
    assert ordered._blocks(df) > 3 and "Union" in plan()


def test_not_a_number_is_above_all_numbers(spark, blocks):
    df = spark.range(300).select("id", F.when(F.col("id") % 7 == 0, F.lit(float("nan"))).when(F.col("id") % 5 != 0, F.col("id") * 1.5 - 90).alias("x"))
    got = ordered.running_totals(df, [], [F.col("x").desc(), F.col("id")], {"n": F.lit(1).cast("bigint")}, blocks)
    same(got, df.withColumn("n", F.row_number().over(Window.orderBy(F.col("x").desc(), "id")).cast("bigint")))


def test_orders_are_columns_of_the_table(rows):
    with pytest.raises(ValueError):
        ranking.row_numbers(rows, [], [-F.col("id")], "n")


def test_no_rows(rows):
    assert ranking.row_numbers(rows.limit(0), ["g"], order(), "n").collect() == []


@pytest.mark.parametrize("by", [["g"], []])
def test_ranks(rows, by, blocks):
    spec = Window.partitionBy(*by).orderBy(F.col("v").desc_nulls_last())
    want = rows.select(
        "*", F.rank().over(spec).cast("bigint").alias("rank_min"), F.count(F.lit(1)).over(spec).alias("rank_max"), F.dense_rank().over(spec).cast("bigint").alias("rank_dense"),
    ).withColumn("rank_average", (F.col("rank_min") + F.col("rank_max")).cast("double") / 2)
    same(ranking.value_ranks(rows, by, "v"), want)


def test_ranks_by_hand(spark):
    df = spark.createDataFrame([(1, 5), (2, 9), (3, 5), (4, None)], "id int, v int")
    got = {r.id: tuple(r)[2:] for r in ranking.value_ranks(df, [], "v").select(
        "id", "v", "rank_min", "rank_max", "rank_average", "rank_dense").collect()}
    assert got == {2: (1, 1, 1.0, 1), 1: (2, 3, 2.5, 2), 3: (2, 3, 2.5, 2), 4: (4, 4, 4.0, 3)}


def test_cumulative(rows, blocks):
    spec = plain(["g"]).rowsBetween(Window.unboundedPreceding, 0)
    want = rows.select(
        "*", F.when(F.col("v").isNotNull(), F.sum("v").over(spec)).alias("cumulative_sum"),
        F.try_divide(F.sum("v").over(spec).cast("double"), F.count("v").over(spec)).alias("expanding_mean"),
    )
    same(ranking.cumulative(rows, ["g"], order(), "v"), want)


@pytest.mark.parametrize("run", [2, 37, 5000])
@pytest.mark.parametrize("by", [["g"], []])
def test_neighbours(rows, by, run):
    """Also runs shorter than the reach."""
    def columns(spec):
        return {"far": F.lag("id", 3).over(spec), "next": F.lead("id", 2).over(spec), "sum": F.sum("v").over(spec.rowsBetween(-4, 1))}

    got = ordered.over_neighbours(rows, by, order(), columns, back=4, ahead=2, block_rows=run)
    same(got, rows.select("*", *[c.alias(n) for n, c in columns(plain(by)).items()]))


def test_rolling_mean_by_hand(rows):
    by_group = {}
    for r in sorted(rows.collect(), key=lambda r: (r.v is None, -(r.v or 0), r.id)):
        by_group.setdefault(r.g, []).append(r)
    want = {}
    for group in by_group.values():
        for i, r in enumerate(group):
            last = [x.v for x in group[max(0, i - 6) : i + 1]]
            whole = len(last) == 7 and None not in last
            want[r.id] = float(sum(last)) / 7 if whole else None
    got = {r.id: r.m for r in ranking.rolling_mean(rows, ["g"], order(), "v", 7, "m").collect()}
    assert got == want


def test_lag_lead(rows):
    want = rows.select("*", F.lag("v").over(plain(["g"])).alias("previous"), F.lead("v").over(plain(["g"])).alias("next"))
    same(ranking.lag_lead(rows, ["g"], order(), "v"), want)


def test_percentiles(rows, blocks):
    names = {"p10": 0.1, "p50": 0.5, "p99": 0.99}
    got = summaries.exact_percentiles(rows, ["g"], "v", names)
    want = rows.groupBy("g").agg(
        *[F.percentile(F.col("v").cast("double"), p).alias(n) for n, p in names.items()]
    )
    rounded = [F.round(n, 9).alias(n) for n in names]
    same(got.select("g", *rounded), want.select("g", *rounded))


def test_summaries_are_exact_above_10_000_values(spark):
    n = 60_000
    df = spark.range(n, numPartitions=7).select((F.col("id") * 7919 % n).cast("double").alias("v"), F.lit(None).cast("int").alias("none"), F.lit("x").alias("t"))
    got = {r["column_name"]: r for r in summaries.summary_percentiles(df, ["v", "none"]).collect()}
    for p in summaries.LONG_PERCENTS:
        want = duckdb.sql(f"SELECT quantile_disc(i, {p} / 100.0) FROM range({n}) t(i)").fetchall()[0][0]
        assert got["v"][f"p{p:g}".replace(".", "_")] == want
    assert got["none"]["count"] == 0 and got["none"]["p50"] is None
    rows = {r["summary"]: r for r in summaries.summary(df, ["v"], ["t"]).collect()}
    assert [rows[k]["v"] for k in ("count", "25%", "50%", "75%", "max")] == [n, n // 4 - 1, n // 2 - 1, 3 * n // 4 - 1, n - 1]
    assert rows["count"]["t"] == str(n) and rows["50%"]["t"] is None and rows["min"]["t"] == "x"


def test_first_last_and_top(rows):
    got = {r.id: (r.first_value, r.last_value) for r in ranking.first_last(rows, "g", "v").collect()}
    for r in rows.collect():
        values = [x.v for x in rows.filter(F.col("g").eqNullSafe(F.lit(r.g))).collect() if x.v is not None] if r.id < 6 else None
        if values:
            assert got[r.id] == (min(values), max(values))
    limited = ranking.top_per_group(rows, ["g"], order(), 2)
    assert "WindowGroupLimit" in limited._jdf.queryExecution().executedPlan().toString()
    top = limited.groupBy("g").count()
    assert {r["count"] for r in top.collect()} == {2}
