"""Weekly features per customer: for all weeks, for modelling rows, or for the newest week.

``rolling_feature_table`` fills the weeks without purchases. ``model_table`` and
``latest_features`` give some of its rows from the weekly rows alone: the first
by frames over week numbers, the second by one aggregate.

Shuffles of the full table: the weekly aggregate, then one exchange by customer that serves the
gap filling, the labels and every trailing window. All windows run on weekly
rows, so a customer never has more rows than the calendar has weeks, however
large that customer's share of the sales is.
"""

from __future__ import annotations

import datetime
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketloom.functions.scalars import month_key, week_end
from basketloom.operators.grouping import listed, ratio
from basketloom.plans.enrich import cents, from_cents
from basketloom.sources.stage import settle

# The lengths of the trailing windows in weeks.
SPANS = (4, 13, 26, 52)
SHARE_SPAN = 26
AHEAD = 4

IDS = ["customer_id", "week_end", "min_week", "max_week"]
LABELS = ["purchase_flag_next_4w", "sales_next_4w"]
MONEY = "decimal(18,2)"
# Running totals that a panel may carry: of the plain measures, of the splits, and the customer's last ones.
RUN, RUN_SPLITS, RUN_END = "__run", "__run_splits", "__run_end"


def saturdays(first: Column, last: Column) -> Column:
    """One row per week from ``first`` to ``last``."""
    return F.explode(F.sequence(first, last, F.expr("interval 7 days")))


def split_columns(categories: Sequence[str], payments: Sequence[str]) -> list[str]:
    return [f"cat_{c}" for c in categories] + [f"pay_{p}" for p in payments]


def base_columns(categories: Sequence[str], payments: Sequence[str]) -> list[str]:
    """The weekly measures that get trailing sums."""
    return ["sales", "orders", "units", *split_columns(categories, payments), "purchase_flag"]


def weekly_aggregate(
    enriched: DataFrame,
    categories: Sequence[str],
    payments: Sequence[str],
    pay_agg=F.sum,
) -> DataFrame:
    """Customer by week: sales, orders, units and the splits, in one aggregate.

    ``payments`` are cleaned labels. ``pay_agg=F.max`` gives the largest single
    amount per payment type instead of the sum. A category or payment type that
    is not listed is an error; rows without one count in the totals only.
    """
    known = listed(listed(enriched, "category", categories), "pay", payments)
    rows = known.select(
        "customer_id", week_end("tran_dt").alias("week_end"), "order_id", "qty", "category", "pay",
        cents("dollars").alias("cents"),
    )
    amounts = {"sales": F.sum("cents")}
    for c in categories:
        amounts[f"cat_{c}"] = F.sum(F.when(F.col("category") == c, F.col("cents")))
    for p in payments:
        amounts[f"pay_{p}"] = pay_agg(F.when(F.col("pay") == p, F.col("cents")))
    sums = rows.groupBy("customer_id", "week_end").agg(
        *[a.alias(n) for n, a in amounts.items()],
        F.countDistinct("order_id").alias("orders"),
        F.sum("qty").alias("units"),
    )
    money = {n: from_cents(F.col(n)).cast(MONEY).alias(n) for n in amounts}
    splits = [n for n in amounts if n != "sales"]
    return sums.select(
        "customer_id", "week_end", money["sales"], "orders", "units", *[money[n] for n in splits]
    )


def weekly_base(
    weekly: DataFrame, rows_per_task: int = 500_000, stored: bool = False, running: bool = False
) -> DataFrame:
    """The panel: every week from a customer's first one to the last of all.

    Each weekly row emits itself and the empty weeks up to the customer's next
    row, so there is no calendar table and no join. Missing amounts are 0.

    The panel is many times larger than the weekly rows it is exploded from, so
    the number of tasks follows from the rows it will have, not from the bytes
    that are shuffled. ``stored`` says that ``weekly`` is a stored table already.

    With ``running`` the rows carry running totals, added up before the weeks are
    filled, since an empty week does not change them. :func:`with_flag_and_labels`
    and :func:`trailing_sums` take their sums from these and drop them at the end,
    so no row of the panel may be left out in between.
    """
    measures = [c for c in weekly.columns if c not in ("customer_id", "week_end")]
    settled = weekly if stored else settle(weekly, "weekly")
    last, rows = _last_week_and_rows(settled)
    parts = max(weekly.sparkSession.sparkContext.defaultParallelism, -(-rows // rows_per_task))
    mine = Window.partitionBy("customer_id")
    following = F.lead("week_end").over(mine.orderBy("week_end"))
    dealt = settled.repartition(parts, "customer_id")
    dealt = _with_running(dealt.filter("week_end IS NOT NULL"), measures) if running else dealt
    spans = dealt.select(
        "*",
        F.min("week_end").over(mine).alias("min_week"),
        F.max("week_end").over(mine).alias("max_week"),
        F.coalesce(F.date_sub(following, 7), F.lit(last)).alias("__until"),
    )
    filled = spans.withColumn("__week", saturdays(F.col("week_end"), F.col("__until")))
    bought = F.col("__week") == F.col("week_end")
    kind = {f.name: f.dataType for f in settled.schema.fields}
    return filled.select(
        "customer_id",
        F.col("__week").alias("week_end"),
        "min_week",
        "max_week",
        *[
            F.when(bought & F.col(m).isNotNull(), F.col(m)).otherwise(F.lit(0).cast(kind[m])).alias(m)
            for m in measures
        ],
        *[c for c in dealt.columns if c in (RUN, RUN_SPLITS, RUN_END)],
    )


def _with_running(weekly: DataFrame, measures: Sequence[str]) -> DataFrame:
    """The weekly rows with running totals in whole units; the units are in the columns' metadata.

    Splits are apart, so that plans without them do not carry them.
    """
    zero = F.lit(0).cast("bigint")
    units = {m: _whole(weekly, m) for m in measures} | {"purchase_flag": (_flag().cast("bigint"), 1)}
    splits = [m for m in measures if m.startswith(("cat_", "pay_"))]
    plain = [m for m in units if m not in splits]
    upto = _by_week().rowsBetween(Window.unboundedPreceding, 0)
    mine = Window.partitionBy("customer_id")
    added = weekly.select(
        "*",
        *[F.sum(F.coalesce(units[m][0], zero)).over(upto).alias(f"__run_{m}") for m in units],
        *[F.sum(F.coalesce(units[m][0], zero)).over(mine).alias(f"__end_{m}") for m in ("sales", "purchase_flag")],
    )

    def packed(prefix: str, names: Sequence[str], name: str) -> Column:
        of = {"units": {m: units[m][1] for m in names}}
        return F.struct(*[F.col(f"{prefix}_{m}").alias(m) for m in names]).alias(name, metadata=of)

    out = [packed("__run", plain, RUN), packed("__end", ["sales", "purchase_flag"], RUN_END)]
    return added.select(*weekly.columns, *out, *([packed("__run", splits, RUN_SPLITS)] if splits else []))


def _flag() -> Column:
    return F.when(F.col("sales") > 0, 1).otherwise(0)


def _last_week_and_rows(weekly: DataFrame) -> tuple[datetime.date | None, int]:
    """Last week of all customers and rows of the filled panel: one small aggregate."""
    first = weekly.groupBy("customer_id").agg(
        F.min("week_end").alias("first"), F.max("week_end").alias("last")
    )
    # days since 1970 as integers, so the sum needs no second pass for the last week
    row = first.agg(
        F.max("last").alias("last"),
        F.count(F.lit(1)).alias("n"),
        F.sum(F.unix_date("first").cast("bigint")).alias("days"),
    ).first()
    if not row.n:
        return None, 0
    end = (row.last - datetime.date(1970, 1, 1)).days
    return row.last, (end * row.n - row.days) // 7 + row.n


def _whole(df: DataFrame, name: str) -> tuple[Column, int]:
    """The column as bigint in its smallest unit, and units per 1."""
    kind = df.schema[name].dataType
    if isinstance(kind, T.DecimalType):
        unit = 10**kind.scale
        # through double: exact below 2**51 units and far cheaper than decimal products
        return F.rint(F.col(name).cast("double") * float(unit)).cast("bigint"), unit
    if isinstance(kind, T.IntegralType):
        return F.col(name).cast("bigint"), 1
    raise TypeError(f"{name}: trailing sums need integers or decimals, not {kind.simpleString()}")


def trailing_sums(
    df: DataFrame, columns: Sequence[str], spans: Sequence[int], spec: WindowSpec
) -> DataFrame:
    """Add ``<column>_<n>w``: the sum over the last ``n`` rows, current one included.

    One running sum per column and a lag per span, so the cost of a row does
    not grow with the span. Sums are exact integers inside; money comes out as
    double, counts as bigint. Running totals that ``df`` has already are used.
    """
    if carried := _carried(df, columns):
        return _sums_of_carried(df, carried, columns, spans, spec)
    units = {c: _whole(df, c) for c in columns}
    upto = spec.rowsBetween(Window.unboundedPreceding, 0)
    run = df.select("*", *[F.sum(units[c][0]).over(upto).alias(f"__{c}") for c in columns])
    # one lag per span over all running sums, instead of one per column and span
    packed = run.withColumn("__run", F.struct(*[F.col(f"__{c}").alias(f"c{i}") for i, c in enumerate(columns)]))
    lagged = packed.select("*", *[F.lag("__run", n).over(spec).alias(f"__run_{n}") for n in spans])

    def last_n(i: int, c: str, n: int) -> Column:
        total = F.col(f"__{c}") - F.coalesce(F.col(f"__run_{n}")[f"c{i}"], F.lit(0).cast("bigint"))
        return (total / F.lit(float(units[c][1])) if units[c][1] > 1 else total).alias(f"{c}_{n}w")

    return lagged.select(*df.columns, *[last_n(i, c, n) for i, c in enumerate(columns) for n in spans])


def _carried(df: DataFrame, columns: Sequence[str]) -> dict[str, tuple[str, int]]:
    """For each column the struct of running totals that has it, and units per 1; empty if one has none."""
    found = {
        c: (name, unit)
        for name in (RUN, RUN_SPLITS)
        if name in df.columns
        for c, unit in df.schema[name].metadata["units"].items()
    }
    return found if all(c in found for c in columns) else {}


def _sums_of_carried(
    df: DataFrame, carried: dict[str, tuple[str, int]], columns: Sequence[str], spans: Sequence[int], spec: WindowSpec
) -> DataFrame:
    packs = sorted({carried[c][0] for c in columns})
    lagged = df.select("*", *[F.lag(p, n).over(spec).alias(f"{p}_{n}") for p in packs for n in spans])

    def last_n(c: str, n: int) -> Column:
        pack, unit = carried[c]
        total = F.col(pack)[c] - F.coalesce(F.col(f"{pack}_{n}")[c], F.lit(0).cast("bigint"))
        return (total / F.lit(float(unit)) if unit > 1 else total).alias(f"{c}_{n}w")

    kept = [c for c in df.columns if c not in (RUN, RUN_SPLITS, RUN_END)]
    return lagged.select(*kept, *[last_n(c, n) for c in columns for n in spans])


def sliding_sums(
    df: DataFrame, columns: Sequence[str], spans: Sequence[int], spec: WindowSpec
) -> DataFrame:
    """The same by plain sliding frames; also for doubles, and slower."""
    return df.select(
        "*",
        *[
            F.sum(c).over(spec.rowsBetween(-(n - 1), 0)).alias(f"{c}_{n}w")
            for c in columns
            for n in spans
        ],
    )


def with_flag_and_labels(base: DataFrame, ahead: int = AHEAD) -> DataFrame:
    """0/1 purchase flag of the week, and flag and sales of the next weeks.

    The labels are null in the last week, which has no week after it.
    """
    spec = _by_week()
    flagged = base.withColumn("purchase_flag", _flag())
    if RUN in base.columns:
        return _labels_of_carried(flagged, ahead, spec)
    coming = spec.rowsBetween(1, ahead)
    cents, unit = _whole(base, "sales")
    return flagged.select(
        "*",
        F.max("purchase_flag").over(coming).alias(f"purchase_flag_next_{ahead}w"),
        (F.sum(cents).over(coming) / F.lit(float(unit))).alias(f"sales_next_{ahead}w"),
    )


def _labels_of_carried(flagged: DataFrame, ahead: int, spec: WindowSpec) -> DataFrame:
    """The running totals ``ahead`` weeks on, or else the customer's last ones, minus those of the week."""
    unit = flagged.schema[RUN].metadata["units"]["sales"]
    seen = flagged.select(
        "*", F.lead(RUN, ahead).over(spec).alias("__ahead"), F.lead("week_end", 1).over(spec).alias("__next_week")
    )

    def coming(c: str) -> Column:
        return F.coalesce(F.col("__ahead")[c], F.col(RUN_END)[c]) - F.col(RUN)[c]

    known = F.col("__next_week").isNotNull()
    return seen.select(
        *flagged.columns,
        F.when(known, F.when(coming("purchase_flag") > 0, 1).otherwise(0)).alias(f"purchase_flag_next_{ahead}w"),
        F.when(known, coming("sales") / F.lit(float(unit))).alias(f"sales_next_{ahead}w"),
    )


def _by_week() -> WindowSpec:
    return Window.partitionBy("customer_id").orderBy("week_end")


def trailing_features(
    flagged: DataFrame, categories: Sequence[str], payments: Sequence[str], spans: Sequence[int] = SPANS
) -> DataFrame:
    return trailing_sums(flagged, base_columns(categories, payments), spans, _by_week())


def _suffixes() -> list[str]:
    return ["", *[f"_{n}w" for n in SPANS]]


def ratio_columns() -> dict[str, Column]:
    """Order value, unit revenue and units per order for every span."""
    out = {}
    for s in _suffixes():
        out[f"aov{s}"] = ratio(f"sales{s}", f"orders{s}")
        out[f"aur{s}"] = ratio(f"sales{s}", f"units{s}")
        out[f"upt{s}"] = ratio(f"units{s}", f"orders{s}")
    return out


def share_columns(categories: Sequence[str], payments: Sequence[str]) -> dict[str, Column]:
    """Category and payment shares of the half-year sales."""
    total = f"sales_{SHARE_SPAN}w"
    return {
        f"{c}_{SHARE_SPAN}w_perc": ratio(f"{c}_{SHARE_SPAN}w", total)
        for c in split_columns(categories, payments)
    }


def trend_columns() -> dict[str, Column]:
    """Sales of each span over those of the next longer one."""
    names = ["1w", *[f"{n}w" for n in SPANS]]
    columns = ["sales", *[f"sales_{n}w" for n in SPANS]]
    return {
        f"sales_{a}_over_{b}": ratio(columns[i], columns[i + 1])
        for i, (a, b) in enumerate(zip(names, names[1:]))
    }


def time_columns() -> dict[str, Column]:
    return {"year": F.year("week_end"), "month": F.month("week_end"), "weekofyear": F.weekofyear("week_end")}


def derived(df: DataFrame, *groups: dict[str, Column]) -> DataFrame:
    return df.select("*", *[c.alias(n) for g in groups for n, c in g.items()])


def rolling_feature_table(base: DataFrame, categories: Sequence[str], payments: Sequence[str]) -> DataFrame:
    """Ids, labels and all features of the panel.

    With c categories and p payment types there are n = 4 + c + p weekly
    measures, 4n trailing sums, 15 ratios, c + p shares, 4 trends and 3 parts
    of the date: 102 features for five of each.
    """
    if RUN in base.columns:
        # a week's own money as its sum over one week, so no decimal goes through the windows
        money = ["sales", *split_columns(categories, payments)]
        summed = trailing_features(with_flag_and_labels(base), categories, payments, (1, *SPANS))
        names = [c for c in summed.columns if not c.endswith("_1w")]
        own = summed.select(*[F.col(f"{c}_1w").alias(c) if c in money else F.col(c) for c in names])
        return _finished(own, categories, payments)
    return _finished(trailing_features(with_flag_and_labels(base), categories, payments), categories, payments)


def _finished(trailing: DataFrame, categories: Sequence[str], payments: Sequence[str]) -> DataFrame:
    """The columns that follow from a row's own trailing sums; money as double."""
    money = ["sales", *split_columns(categories, payments)]
    plain = trailing.withColumns({m: F.col(m).cast("double") for m in money})
    return derived(
        plain, ratio_columns(), share_columns(categories, payments), trend_columns(), time_columns()
    )


def feature_columns(features: DataFrame) -> list[str]:
    return [c for c in features.columns if c not in (*IDS, *LABELS)]


def calendar(weekly: DataFrame) -> DataFrame:
    """All weeks of the panel, from the stored weekly table."""
    ends = weekly.agg(F.min("week_end").alias("a"), F.max("week_end").alias("b"))
    return ends.select(saturdays(F.col("a"), F.col("b")).alias("week_end"))


def model_rows(weeks: DataFrame, ahead: int = AHEAD) -> tuple[Column, Column]:
    """Conditions for modelling: active in the last year, and all label weeks known."""
    newest = weeks.agg(F.max("week_end")).scalar()
    return F.col("sales_52w") > 0, F.col("week_end") < F.date_sub(newest, 7 * (ahead - 1))


def month_sample(features: DataFrame, weeks: DataFrame) -> DataFrame:
    """The rows of the last week of every month."""
    ends = weeks.groupBy(month_key("week_end").alias("month")).agg(F.max("week_end").alias("week_end"))
    short = settle(ends.select("week_end"), "weeks")
    return features.join(short, "week_end", "left_semi")


def model_dataset(features: DataFrame, weeks: DataFrame | None = None) -> DataFrame:
    """One week per month, active customers, label weeks complete.

    ``weeks`` are the weeks of the panel (:func:`calendar`). With them the
    features are computed once, for the columns that are used, and need not be
    stored; without them the weeks are read from the features, which should
    then be a stored table. The filters come after the windows on purpose:
    these need every week.
    """
    weeks = features.select("week_end") if weeks is None else weeks
    active, complete = model_rows(weeks)
    return month_sample(features, weeks).filter(active & complete)


# ---- the same features without the panel ------------------------------------

def week_number(week: Column) -> Column:
    """Consecutive integers for consecutive week ends."""
    return F.floor(F.unix_date(week) / 7).cast("int")


def last_week_end(day: Column) -> Column:
    """The last week end (Saturday) in the day's month."""
    last = F.last_day(day)
    return F.date_sub(last, F.dayofweek(last) % 7)


def _month_ends(after: Column, until: Column) -> Column:
    """Last week ends of months behind ``after``, up to ``until``, which is not before it."""
    months = F.sequence(F.trunc(after, "MM"), F.trunc(until, "MM"), F.expr("interval 1 month"))
    return F.filter(F.transform(months, last_week_end), lambda week: (week > after) & (week <= until))


def interval_sums(
    df: DataFrame, columns: Sequence[str], spans: Sequence[int], keys: Sequence[str], week: str, ahead: int | None = None
) -> DataFrame:
    """Add ``<column>_<n>w``, the sum over the last ``n`` weeks, where weeks may be missing.

    ``week`` is an integer, unique within the keys. Each sum is a running total
    minus the running total at the last row ``n`` or more weeks back, found by a
    frame over the week's value, so neither missing weeks nor long spans cost
    anything. With ``ahead`` also ``<column>_next_<ahead>w``, the sum over the
    coming weeks. Sums are exact inside; money comes out as double.
    """
    units = {c: _whole(df, c) for c in columns}
    spec = Window.partitionBy(*keys).orderBy(week)
    upto = spec.rowsBetween(Window.unboundedPreceding, 0)
    run = df.select("*", *[F.sum(units[c][0]).over(upto).alias(f"__{c}") for c in columns])
    packed = run.withColumn("__run", F.struct(*[F.col(f"__{c}").alias(f"c{i}") for i, c in enumerate(columns)]))

    def reached(n: int) -> Column:
        return F.last("__run").over(spec.rangeBetween(Window.unboundedPreceding, n))

    ends = {f"__back_{n}": reached(-n) for n in spans} | ({"__ahead": reached(ahead)} if ahead else {})
    found = packed.select("*", *[c.alias(n) for n, c in ends.items()])

    def total(i: int, c: str, high: Column, low: Column) -> Column:
        whole = high - F.coalesce(low, F.lit(0).cast("bigint"))
        return whole / F.lit(float(units[c][1])) if units[c][1] > 1 else whole

    sums = [total(i, c, F.col(f"__{c}"), F.col(f"__back_{n}")[f"c{i}"]).alias(f"{c}_{n}w") for i, c in enumerate(columns) for n in spans]
    if ahead:
        sums += [total(i, c, F.col("__ahead")[f"c{i}"], F.col(f"__{c}")).alias(f"{c}_next_{ahead}w") for i, c in enumerate(columns)]
    return found.select(*df.columns, *sums)


def _measures(weekly: DataFrame) -> list[str]:
    return [c for c in weekly.columns if c not in ("customer_id", "week_end")]


def model_table(weekly: DataFrame, categories: Sequence[str], payments: Sequence[str], ahead: int = AHEAD) -> DataFrame:
    """The rows of :func:`model_dataset` with all features and both labels, from the weekly rows.

    One week per month and customer: month ends within a year of a purchase and
    with all label weeks known. A weekly row emits itself and the month ends up
    to the customer's next row, at most a year's; nothing else is filled, so
    there are never more than 13 rows per weekly row, and few in practice.
    ``weekly`` is read twice and should be a stored table.
    """
    newest = weekly.agg(F.max("week_end")).scalar()
    mine = Window.partitionBy("customer_id")
    following = F.date_sub(F.lead("week_end").over(mine.orderBy("week_end")), 7)
    year = F.date_add(F.col("week_end"), 7 * (max(SPANS) - 1))
    spans = weekly.select(
        "*", F.min("week_end").over(mine).alias("min_week"), F.max("week_end").over(mine).alias("max_week"),
        F.least(F.coalesce(following, newest), year).alias("__until"),
    )
    weeks = F.concat(F.array("week_end"), _month_ends(F.col("week_end"), F.col("__until")))
    filled = spans.withColumn("__week", F.explode(weeks))
    bought = F.col("__week") == F.col("week_end")
    kind = {f.name: f.dataType for f in weekly.schema.fields}
    rows = filled.select(
        "customer_id", F.col("__week").alias("week_end"), "min_week", "max_week",
        *[F.when(bought & F.col(m).isNotNull(), F.col(m)).otherwise(F.lit(0).cast(kind[m])).alias(m) for m in _measures(weekly)],
    )
    flagged = rows.withColumn("purchase_flag", F.when(F.col("sales") > 0, 1).otherwise(0)).withColumn("__number", week_number(F.col("week_end")))
    summed = interval_sums(flagged, base_columns(categories, payments), SPANS, ["customer_id"], "__number", ahead)
    coming = [f"{c}_next_{ahead}w" for c in base_columns(categories, payments)]
    labels = {
        f"purchase_flag_next_{ahead}w": (F.col(f"purchase_flag_next_{ahead}w") > 0).cast("int"),
        f"sales_next_{ahead}w": F.col(f"sales_next_{ahead}w"),
    }
    kept = summed.filter(
        (F.col("week_end") == last_week_end(F.col("week_end"))) & (F.col("sales_52w") > 0) & (F.col("week_end") < F.date_sub(newest, 7 * (ahead - 1)))
    )
    first = [*IDS, *_measures(weekly), "purchase_flag"]
    rest = [c for c in summed.columns if c not in (*first, *coming, "__number")]
    return _finished(kept.select(*first, *[c.alias(n) for n, c in labels.items()], *rest), categories, payments)


def latest_features(weekly: DataFrame, categories: Sequence[str], payments: Sequence[str], ahead: int = AHEAD) -> DataFrame:
    """The newest week of :func:`rolling_feature_table`, from one aggregate over the weekly rows.

    Every trailing sum is a sum over the rows young enough. Labels are null.
    ``weekly`` is read twice and should be a stored table.
    """
    newest = weekly.agg(F.max("week_end")).scalar()
    flagged = weekly.withColumn("purchase_flag", F.when(F.col("sales") > 0, 1).otherwise(0))
    columns = base_columns(categories, payments)
    units = {c: _whole(flagged, c) for c in columns}
    age = (F.datediff(newest, F.col("week_end")) / 7).cast("int")
    rows = flagged.select("customer_id", "week_end", age.alias("__age"), *[units[c][0].alias(c) for c in columns])
    young = lambda c, n: F.coalesce(F.sum(F.when(F.col("__age") < n, F.col(c))), F.lit(0).cast("bigint"))
    own = rows.groupBy("customer_id").agg(
        F.min("week_end").alias("min_week"), F.max("week_end").alias("max_week"),
        *[young(c, n).alias(f"{c}_{n}w") for c in columns for n in (1, *SPANS)],
    )
    scaled = lambda c, n: F.col(f"{c}_{n}w") / F.lit(float(units[c][1])) if units[c][1] > 1 else F.col(f"{c}_{n}w")
    kind = {f.name: f.dataType for f in flagged.schema.fields}
    trailing = own.select(
        "customer_id", newest.alias("week_end"), "min_week", "max_week",
        *[scaled(c, 1).cast(kind[c]).alias(c) for c in columns],
        F.lit(None).cast("int").alias(f"purchase_flag_next_{ahead}w"), F.lit(None).cast("double").alias(f"sales_next_{ahead}w"),
        *[scaled(c, n).alias(f"{c}_{n}w") for c in columns for n in SPANS],
    )
    return _finished(trailing, categories, payments)
