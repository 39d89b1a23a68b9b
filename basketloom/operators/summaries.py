"""Column summaries: moments, exact and approximate percentiles, top values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketloom.operators.ordered import running_totals
from basketloom.sources.stage import settle

# The percentiles of the long summary, in percent.
LONG_PERCENTS = [0.1, 1, 5, 10, 20, 25, 30, 40, 50, 60, 70, 75, 80, 90, 95, 99, 99.9]


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def long_form(df: DataFrame, columns: Sequence[str], ids: Sequence[str] = ()) -> DataFrame:
    """(ids, column_name, value): one row per cell of the given numeric columns."""
    cells = df.select(*ids, *[F.col(c).cast("double").alias(c) for c in columns])
    return cells.unpivot(list(ids), list(columns), "column_name", "value")


def exact_percentiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    names: dict[str, float],
    interpolate: bool = True,
) -> DataFrame:
    """Percentiles per group, without holding a group in one task.

    Equal values are counted first, then a running total of the counts tells
    which value sits at a rank; nulls do not count. Between two values the
    percentile is interpolated, or else the lower one, as ``quantile_disc``.
    """
    counts = settle(
        df.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("__n")),
        "values",
    )
    return _at_ranks(counts, keys, [F.col(value)], F.col(value).cast("double"), names, interpolate)


def _at_ranks(
    counts: DataFrame, keys: Sequence[str], order: Sequence[Column], value: Column, names: dict[str, float], interpolate: bool
) -> DataFrame:
    """The values at the ranks of the percentiles, from counted values (``__n``) in an order."""
    ranked = running_totals(counts, keys, order, {"__upto": F.col("__n")})
    size = counts.groupBy(*keys).agg(F.sum("__n").alias("__size"))
    if keys:
        size = size.select(*[F.col(k).alias(f"__{k}") for k in keys], "__size")
        same = [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys]
        ranked = ranked.join(size, same)
    else:
        ranked = ranked.withColumn("__size", size.select("__size").scalar())

    def at(rank: Column) -> Column:
        inside = (F.col("__upto") > rank) & (F.col("__upto") - F.col("__n") <= rank)
        return F.max(F.when(inside, value))

    def interpolated(p: float) -> Column:
        place = (F.col("__size") - 1) * F.lit(float(p))
        low, high = at(F.floor(place)), at(F.ceil(place))
        return low + (high - low) * F.max(place - F.floor(place))

    def lower(p: float) -> Column:
        size = F.col("__size")
        return at(F.greatest(size - F.floor(size - size * F.lit(float(p))), F.lit(1)) - 1)

    one = interpolated if interpolate else lower
    return ranked.groupBy(*keys).agg(*[one(p).alias(n) for n, p in names.items()])


#: Relative accuracy of the sketch behind :func:`selected_percentiles`; groups of no more values are counted in full.
SKETCH = 2_000


def selected_percentiles(
    df: DataFrame,
    columns: Sequence[str],
    names: dict[str, float],
    by: Sequence[str] = (),
    interpolate: bool = True,
    sketch: int = SKETCH,
) -> DataFrame:
    """Exact percentiles of several columns without counting all their values: (by, column_name, names).

    A sketch per group and column gives a bracket around each percentile. The
    second pass counts the values between the brackets as wholes and keeps only
    those inside them apart, some 8 / ``sketch`` of the rows per percentile; a
    running total over both finds the value at a rank. The brackets are four
    times as wide as the sketch's error; a rank that still fell outside would be
    an error, never a wrong value. Meant for few groups; the sketches of all
    groups are one small table. Nulls do not count; a column of nulls has no row.
    """
    keys = [*by, "column_name"]
    wide = [min(max(p + d, 0.0), 1.0) for p in names.values() for d in (-4 / sketch, 4 / sketch)]
    cells = df.select(*by, *[F.col(c).cast("double").alias(c) for c in columns])
    ends = F.array(*[F.lit(p) for p in wide])
    found = cells.groupBy(*by).agg(*[F.struct(F.count(c).alias("n"), F.percentile_approx(c, ends, sketch).alias("ends")).alias(f"__{c}") for c in columns])
    if by:
        sets = [_with_cells(F.col(f"__{c}"), sketch).alias(f"__{c}") for c in columns]
        found = settle(found, "brackets").select(*[F.col(k).alias(f"__by_{k}") for k in by], *sets)
        rows = cells.join(found, [F.col(k).eqNullSafe(F.col(f"__by_{k}")) for k in by])
        placed = {c: _cell(F.col(c), F.col(f"__{c}")) for c in columns}
    else:
        row, rows = found.first(), cells
        placed = {c: _known_cell(c, row[f"__{c}"]["n"] <= sketch, row[f"__{c}"]["ends"] or []) for c in columns}

    def cell(c: str) -> Column:
        value = F.when(placed[c]["inside"], F.col(c))
        return F.struct(F.lit(c).alias("column_name"), placed[c]["cell"].alias("__cell"), value.alias("__value"), F.col(c).isNull().alias("__null"))

    each = rows.select(*by, F.inline(F.array(*[cell(c) for c in columns]))).filter("not __null")
    counts = settle(each.groupBy(*keys, "__cell", "__value").agg(F.count(F.lit(1)).alias("__n")), "cells")
    lost = F.raise_error(F.lit("a percentile lies outside its bracket"))
    return _at_ranks(counts, keys, [F.col("__cell"), F.col("__value")], F.coalesce("__value", F.when(F.isnull("__value"), lost)), names, interpolate)


def _with_cells(found: Column, sketch: int) -> Column:
    """The distinct ends of brackets (low, high, low, high ..) in order, and which cells lie in one; see :func:`_cell`."""
    ends = F.array_sort(F.array_distinct(found["ends"]))
    low, high = (F.filter(found["ends"], lambda e, i: i % 2 == side) for side in (0, 1))  # noqa: B023
    brackets = F.arrays_zip(low.alias("low"), high.alias("high"))
    between = F.zip_with(F.slice(ends, 1, F.size(ends) - 1), F.slice(ends, 2, F.size(ends)), lambda a, b: F.exists(brackets, lambda x: (x["low"] <= a) & (b <= x["high"])))
    return F.struct(ends.alias("ends"), between.alias("between"), (found["n"] <= sketch).alias("all"))


def _cell(x: Column, found: Column) -> Column:
    """Struct (cell, inside): cells are even between two ends and odd on one, so they stand in the order of the values."""
    cell = F.size(F.filter(found["ends"], lambda e: e < x)) + F.size(F.filter(found["ends"], lambda e: e <= x))
    between = F.coalesce(F.get(found["between"], (cell / 2).cast("int") - 1), F.lit(False))
    return F.struct(cell.alias("cell"), (found["all"] | (cell % 2 == 1) | between).alias("inside"))


def _known_cell(name: str, whole: bool, brackets: Sequence[float]) -> Column:
    """:func:`_cell` for brackets that are known: a tree of comparisons, as one SQL expression."""
    pairs = list(zip(brackets[::2], brackets[1::2]))
    ends = sorted(set(brackets), key=lambda e: (e != e, e))
    held = [any(low <= a and b <= high for low, high in pairs) for a, b in zip(ends, ends[1:])]
    inside = [c % 2 == 1 or whole or (0 < c // 2 < len(ends) and held[c // 2 - 1]) for c in range(2 * len(ends) + 1)]

    def tree(first: int, past: int) -> str:
        """Of values above all ends before ``first`` and below all from ``past``."""
        if first == past:
            return str(2 * first)
        middle = (first + past) // 2
        end = f"double('{float(ends[middle])!r}')"
        return (
            f"CASE WHEN `{name}` < {end} THEN {tree(first, middle)} WHEN `{name}` = {end} THEN {2 * middle + 1} ELSE {tree(middle + 1, past)} END"
        )

    cell = F.expr(tree(0, len(ends)))
    return F.struct(cell.alias("cell"), F.get(F.lit(inside), cell).alias("inside"))


def describe_numeric(
    df: DataFrame, columns: Sequence[str] | None = None, by: Sequence[str] = ()
) -> DataFrame:
    """count, mean, std, min, quartiles and max; one row per (group and) column."""
    columns = list(columns or [c for c in numeric_columns(df) if c not in by])
    keys = [*by, "column_name"]
    rows = []
    for c in columns:
        x = F.col(c).cast("double")
        rows.append(
            F.struct(
                F.lit(c).alias("column_name"),
                F.count(c).alias("count"),
                F.avg(x).alias("mean"),
                F.stddev(x).alias("std"),
                F.min(x).alias("min"),
                F.max(x).alias("max"),
            )
        )
    moments = df.groupBy(*by).agg(F.array(*rows).alias("r")).select(*by, F.inline("r"))
    quartiles = selected_percentiles(df, columns, {"p25": 0.25, "p50": 0.5, "p75": 0.75}, by).select(*[F.col(k).alias(f"__{k}") for k in keys], "p25", "p50", "p75")
    same = [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys]
    return moments.join(quartiles, same, "left").select(
        *keys, "count", "mean", "std", "min", "p25", "p50", "p75", "max"
    )


def describe_string(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """count, unique, most frequent value (the smallest on ties) and its frequency."""
    columns = list(columns or string_columns(df))
    cells = df.select(*columns).unpivot([], columns, "column_name", "value")
    counts = (
        cells.filter(F.col("value").isNotNull())
        .groupBy("column_name", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    first = F.min(F.struct((-F.col("n")).alias("minus_n"), F.col("value")))
    found = counts.groupBy("column_name").agg(
        F.sum("n").alias("count"),
        F.count(F.lit(1)).alias("unique"),
        first["value"].alias("top"),
        (-first["minus_n"]).alias("freq"),
    )
    # a column that is null throughout has a row too
    names = df.sparkSession.createDataFrame([(c,) for c in columns], "column_name string")
    return names.join(found, "column_name", "left").fillna(0, ["count", "unique"])


def summary_percentiles(
    df: DataFrame,
    columns: Sequence[str],
    percents: Sequence[float] = tuple(LONG_PERCENTS),
    accuracy: int | None = None,
) -> DataFrame:
    """The long summary, typed: one row per column, with percentiles that are values of the column.

    They are exact, by :func:`selected_percentiles`. With ``accuracy`` they are bounded sketches that merge, so
    one pass is enough, and approximate beyond so many distinct values.
    """
    rows = []
    for c in columns:
        x = F.col(c).cast("double")
        rows.append(
            F.struct(
                F.lit(c).alias("column_name"),
                F.count(c).alias("count"),
                F.avg(x).alias("mean"),
                F.stddev(x).alias("stddev"),
                F.min(x).alias("min"),
                *([] if accuracy is None else [F.percentile_approx(x, F.array(*[F.lit(p / 100.0) for p in percents]), accuracy).alias("points")]),
                F.max(x).alias("max"),
            )
        )
    table = df.agg(F.array(*rows).alias("r")).select(F.inline("r"))
    names = [f"p{p:g}".replace(".", "_") for p in percents]
    if accuracy is None:
        shares = {n: p / 100.0 for n, p in zip(names, percents)}
        points = selected_percentiles(df, columns, shares, interpolate=False)
        table = table.join(points, "column_name", "left")
    else:
        table = table.select("*", *[F.col("points")[i].alias(n) for i, n in enumerate(names)])
    return table.select("column_name", "count", "mean", "stddev", "min", *names, "max")


def summary(df: DataFrame, numbers: Sequence[str], texts: Sequence[str]) -> DataFrame:
    """Spark's summary with exact quartiles, typed: one row per statistic.

    Texts have a count, a least and a largest value.
    """
    table = summary_percentiles(df, numbers, (25, 50, 75))
    stats = {"count": "count", "mean": "mean", "stddev": "stddev", "min": "min", "25%": "p25", "50%": "p50", "75%": "p75", "max": "max"}
    all_of = F.struct(*[F.col(s).cast("double").alias(s) for s in stats.values()])
    row = table.agg(*[F.max(F.when(F.col("column_name") == c, all_of)).alias(c) for c in numbers])
    for c in texts:
        parts = {"count": F.count(c).cast("string"), "min": F.min(c).cast("string"), "max": F.max(c).cast("string")}
        row = row.withColumn(c, df.agg(F.struct(*[x.alias(n) for n, x in parts.items()]).alias("s")).select("s").scalar())
    text = lambda c, s: F.col(c)[s] if s in ("count", "min", "max") else F.lit(None).cast("string")
    lines = [
        F.struct(F.lit(label).alias("summary"), *[F.col(c)[s].alias(c) for c in numbers], *[text(c, s).alias(c) for c in texts])
        for label, s in stats.items()
    ]
    return row.select(F.inline(F.array(*lines)))
