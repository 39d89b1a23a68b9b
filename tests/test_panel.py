"""The weekly panel against plain Python, and what its plan looks like."""

import datetime
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from basketloom.catalog import features
from basketloom.plans import enrich, jobs, panel

CATS, PAYS = ["A", "B", "C", "D", "E"], ["cash", "credit_card", "debit_card", "gift_card", "others"]


@pytest.fixture(scope="module")
def sold():
    """Sales of four customers; one of them has a third of all lines."""
    rng, rows = random.Random(7), []
    for i in range(240):
        customer = 1 if i % 3 == 0 else rng.randint(1, 4)
        day = datetime.date(2019, 1, 13) + datetime.timedelta(rng.randint(0, 500))
        rows.append((rng.randint(1, 90), customer, day, rng.randint(1, 9999), rng.randint(1, 5),
                     rng.choice(CATS), rng.choice(PAYS)))
    return rows


@pytest.fixture(scope="module")
def enriched(spark, sold):
    schema = "order_id int, customer_id int, tran_dt date, c bigint, qty int, category string, pay string"
    df = spark.createDataFrame(sold, schema)
    return df.withColumn("dollars", (F.col("c").cast("decimal(12,0)") * F.lit("0.01").cast("decimal(3,2)")).cast("decimal(18,2)")).drop("c")


@pytest.fixture(scope="module")
def table(enriched):
    weekly = panel.weekly_aggregate(enriched, CATS, PAYS)
    return panel.rolling_feature_table(panel.weekly_base(weekly), CATS, PAYS).persist()


def saturday(d):
    return d + datetime.timedelta((5 - d.weekday()) % 7)


def test_number_of_features(table):
    assert len(panel.feature_columns(table)) == 102
    assert len(table.columns) == 102 + len(panel.IDS) + len(panel.LABELS)


def test_against_plain_python(table, sold):
    last = max(saturday(r[2]) for r in sold)
    got = {(r.customer_id, r.week_end): r for r in table.collect()}
    n = 0
    for customer in {r[1] for r in sold}:
        mine = [r for r in sold if r[1] == customer]
        week, weeks = min(saturday(r[2]) for r in mine), []
        while week <= last:
            weeks.append(week)
            week += datetime.timedelta(7)
        lines = [[r for r in mine if saturday(r[2]) == w] for w in weeks]
        cents = [sum(r[3] for r in x) for x in lines]
        orders = [len({r[0] for r in x}) for x in lines]
        cash = [sum(r[3] for r in x if r[6] == "cash") for x in lines]
        for i, w in enumerate(weeks):
            r = got[(customer, w)]
            n += 1
            assert r.sales == cents[i] / 100 and r.orders == orders[i]
            for span in panel.SPANS:
                low = max(0, i - span + 1)
                assert r[f"sales_{span}w"] == sum(cents[low : i + 1]) / 100
                assert r[f"orders_{span}w"] == sum(orders[low : i + 1])
                assert r[f"pay_cash_{span}w"] == sum(cash[low : i + 1]) / 100
                assert r[f"purchase_flag_{span}w"] == sum(c > 0 for c in cents[low : i + 1])
            ahead = cents[i + 1 : i + 5]
            assert r.sales_next_4w == (sum(ahead) / 100 if ahead else None)
            assert r.purchase_flag_next_4w == (int(any(ahead)) if ahead else None)
            assert r.aov == (cents[i] / 100 / orders[i] if orders[i] else None)
            assert (r.year, r.month, r.weekofyear) == (w.year, w.month, w.isocalendar()[1])
    assert n == len(got)


def test_invariants(table):
    bad = table.filter(
        (F.col("sales_4w") > F.col("sales_13w"))
        | (F.col("sales_13w") > F.col("sales_26w"))
        | (F.col("sales_26w") > F.col("sales_52w"))
        | (F.abs(sum(F.col(f"cat_{c}") for c in CATS) - F.col("sales")) > 1e-9)
        | (F.abs(sum(F.col(f"pay_{p}_26w_perc") for p in PAYS) - 1) > 1e-9)
    )
    assert bad.count() == 0


def test_prefix_sums_equal_sliding_frames(spark, sf):
    base = features.panel_base(spark, sf)
    spec = Window.partitionBy("customer_id").orderBy("week_end")
    columns = ["sales", "orders", "cat_PROMO"]
    names = [f"{c}_{n}w" for c in columns for n in panel.SPANS]
    as_double = [F.col(n).cast("double").alias(n) for n in names]
    a = panel.trailing_sums(base, columns, panel.SPANS, spec).select("customer_id", "week_end", *as_double)
    b = panel.sliding_sums(base, columns, panel.SPANS, spec).select("customer_id", "week_end", *as_double)
    assert a.exceptAll(b).count() == 0 and a.count() == b.count()


def test_largest_payment_can_be_asked_for(enriched, sold):
    weekly = panel.weekly_aggregate(enriched, CATS, PAYS, pay_agg=F.max)
    want = max(r[3] for r in sold if r[6] == "others") / 100
    assert float(weekly.agg(F.max("pay_others")).first()[0]) == want


def test_order_of_features(spark, sf):
    assert panel.feature_columns(features.rolling(spark, sf)) == features._FEATURES


def test_one_exchange_for_all_windows(spark, sf):
    plan = features.rolling(spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" not in plan


def test_embargo_and_month_sample(table):
    rows = panel.model_dataset(table).select("week_end").distinct().collect()
    newest = table.agg(F.max("week_end")).first()[0]
    weeks = sorted(r.week_end for r in rows)
    assert weeks[-1] < newest - datetime.timedelta(21)
    assert len({(w.year, w.month) for w in weeks}) == len(weeks)


def test_cents_are_exact(spark):
    df = spark.createDataFrame([("0.29",), ("1.15",), ("123456789012.34",), ("-4.35",)], "s string")
    got = df.select(enrich.cents("s")).collect()
    assert [r[0] for r in got] == [29, 115, 12345678901234, -435]


@pytest.fixture(scope="module")
def weekly(enriched):
    return panel.weekly_aggregate(enriched, CATS, PAYS).persist()


def _rows(df, columns):
    return sorted(map(tuple, df.select(*columns).collect()), key=repr)


@pytest.mark.parametrize("thin", [1, 12, 30])
def test_model_rows_without_the_panel(enriched, thin):
    """Also for customers with years between purchases: lines are thinned out by order."""
    few = enriched.filter(F.col("order_id") % thin == 0)
    rows = panel.weekly_aggregate(few, CATS, PAYS).persist()
    full = panel.rolling_feature_table(panel.weekly_base(rows), CATS, PAYS)
    want, got = panel.model_dataset(full, panel.calendar(rows)), panel.model_table(rows, CATS, PAYS)
    assert dict(got.dtypes) == dict(want.dtypes)
    assert _rows(got, want.columns) == _rows(want, want.columns)
    assert got.count() > 0


def test_a_year_without_purchases_ends_the_model_rows(spark):
    day = lambda n: datetime.date(2019, 1, 5) + datetime.timedelta(7 * n)
    sales = [(1, 1, day(0)), (1, 2, day(150)), (2, 3, day(20)), (2, 4, day(21)), (3, 5, day(160)), (4, 6, day(170))]
    df = spark.createDataFrame(sales, "customer_id int, order_id int, tran_dt date").select(
        "*", F.lit(2).alias("qty"), F.lit("A").alias("category"), F.lit("cash").alias("pay"), F.lit(3).cast("decimal(18,2)").alias("dollars")
    )
    rows = panel.weekly_aggregate(df, CATS, PAYS).persist()
    full = panel.rolling_feature_table(panel.weekly_base(rows), CATS, PAYS)
    want, got = panel.model_dataset(full, panel.calendar(rows)), panel.model_table(rows, CATS, PAYS)
    assert _rows(got, want.columns) == _rows(want, want.columns)
    weeks = {(r.customer_id, (r.week_end - day(0)).days // 7) for r in got.collect()}
    assert max(w for c, w in weeks if c == 1 and w < 150) == 51 and not any(51 < w < 150 for c, w in weeks if c == 1)


def test_the_panel_is_never_built(weekly):
    plan = panel.model_table(weekly, CATS, PAYS)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Generate ") <= plan.count("Exchange hashpartitioning(customer_id") * 2 and "Join" not in plan
    latest = panel.latest_features(weekly, CATS, PAYS)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in latest and "Generate" not in latest and "Join" not in latest


def test_newest_week_from_one_aggregate(weekly, table):
    newest = table.agg(F.max("week_end")).first()[0]
    want, got = table.filter(F.col("week_end") == newest), panel.latest_features(weekly, CATS, PAYS)
    assert dict(got.dtypes) == dict(want.dtypes)
    assert _rows(got, want.columns) == _rows(want, want.columns)


def test_interval_sums_over_missing_weeks(spark):
    r = random.Random(3)
    cells = [(c, w, r.randint(-50, 50)) for c in range(3) for w in r.sample(range(80), 25)]
    df = spark.createDataFrame(cells, "c int, w int, x long")
    got = panel.interval_sums(df, ["x"], (1, 4, 30), ["c"], "w", ahead=5).collect()
    for row in got:
        mine = {w: x for c, w, x in cells if c == row.c}
        for n in (1, 4, 30):
            assert row[f"x_{n}w"] == sum(x for w, x in mine.items() if row.w - n < w <= row.w)
        assert row.x_next_5w == sum(x for w, x in mine.items() if row.w < w <= row.w + 5)


def test_last_week_ends(spark):
    days = [(datetime.date(2019, m, 15),) for m in range(1, 13)] + [(datetime.date(2020, 2, 1),)]
    for (day, last) in spark.createDataFrame(days, "d date").select("d", panel.last_week_end(F.col("d"))).collect():
        assert last.weekday() == 5 and last.month == day.month and (last + datetime.timedelta(7)).month != day.month


def test_only_the_newest_weeks_folder_is_scored(spark, weekly, tmp_path):
    path, features_path = str(tmp_path / "weekly"), str(tmp_path / "features")
    weekly.write.parquet(path)
    older = weekly.filter(F.col("week_end") <= datetime.date(2020, 1, 4))
    older.write.parquet(path + "_older")
    jobs.add_latest(spark, path + "_older", features_path)
    newest = jobs.add_latest(spark, path, features_path)
    assert len(list((tmp_path / "features").glob("week_end=*"))) == 2
    assert newest.count() == weekly.select("customer_id").distinct().count() and len({f.rsplit("/", 2)[1] for f in newest.inputFiles()}) == 1
    assert jobs.splits(weekly) == (CATS, PAYS)


def test_running_totals_made_before_the_fill_give_the_same_table(enriched):
    """Also with weeks that are null, missing amounts, a null customer, and customers that end before the last week."""
    odd = enriched.limit(40).withColumns({"customer_id": F.lit(None).cast("int"), "order_id": F.col("order_id") + 1000})
    undated = enriched.limit(5).withColumn("tran_dt", F.lit(None).cast("date"))
    early = enriched.filter("tran_dt < date'2019-06-01'").withColumn("customer_id", F.col("customer_id") + 10)
    bare = enriched.limit(9).withColumns({"dollars": F.lit(None).cast("decimal(18,2)"), "customer_id": F.lit(99)})
    rows = enriched.unionByName(odd).unionByName(undated).unionByName(early).unionByName(bare)
    weekly = panel.weekly_aggregate(rows, CATS, PAYS).persist()
    plain = panel.rolling_feature_table(panel.weekly_base(weekly), CATS, PAYS)
    carried = panel.rolling_feature_table(panel.weekly_base(weekly, running=True), CATS, PAYS)
    assert [(f.name, f.dataType) for f in plain.schema] == [(f.name, f.dataType) for f in carried.schema]
    assert sorted(map(repr, plain.collect())) == sorted(map(repr, carried.collect()))
    few = panel.trailing_features(panel.with_flag_and_labels(panel.weekly_base(weekly, running=True)), CATS, PAYS)
    same = panel.trailing_features(panel.with_flag_and_labels(panel.weekly_base(weekly)), CATS, PAYS)
    assert [(f.name, f.dataType) for f in few.schema] == [(f.name, f.dataType) for f in same.schema]
    assert sorted(map(repr, few.collect())) == sorted(map(repr, same.collect()))


def test_panel_queries_run_one_window_over_the_filled_weeks(spark):
    """Running totals in front of the fill, and for a trend without the split columns."""
    for build in (features.rolling, lambda s, d: panel.derived(features.trailing(s, d), panel.trend_columns()).select("customer_id", *panel.trend_columns())):
        plan = build(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
        over_weeks = plan[: plan.index("Generate explode")]
        assert over_weeks.count("Window [") == 1 and "sum(" not in over_weeks
    assert "cat_" not in plan
