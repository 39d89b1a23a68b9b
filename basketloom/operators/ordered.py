"""Ordered windows that stay parallel inside one large group.

A plain ``Window.partitionBy(k).orderBy(o)`` sorts a whole group in one task,
so one region holding a third of all rows would be one task's work. Here the
rows are cut, by key and order, into blocks of about equal size, whatever group
they belong to; a scan in two levels adds the totals of a group's earlier blocks
to the running totals inside a block. The bounds of the blocks come from a
sample, so they shape the tasks and never the result. Their number follows from
the bytes that the plan reads: a table that fits into one block is one plain
window, and no sample is taken.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row, Window, WindowSpec
from pyspark.sql import functions as F

#: Bytes read per block; the most blocks per shuffle partition, and at all; sampled rows per block.
BLOCK_BYTES, PER_PARTITION, MOST_BLOCKS, SAMPLED = 16 << 20, 2, 4096, 16
#: Bytes read per task where rows are dealt for an aggregate that holds about one group per row.
SPREAD_BYTES = 4 << 20
#: The planner gives a table of no known size more bytes than this.
UNKNOWN = 1 << 60
#: Consecutive rows of a group that are looked at together, where rows look at their neighbours.
BLOCK_ROWS = 1_000_000

_BLOCK, _LATER, _HOME, _POS = "__block", "__later", "__home", "__pos"


@dataclass(frozen=True)
class _Place:
    """One column of an order."""

    name: str
    down: bool = False
    nulls_last: bool = False

    def before(self, a: Column, b: Column) -> Column:
        """Whether value ``a`` comes strictly before ``b``."""
        value = F.coalesce(a > b if self.down else a < b, F.lit(False))
        a_null, b_null = a.isNull() & b.isNotNull(), a.isNotNull() & b.isNull()
        return value | (b_null if self.nulls_last else a_null)

    def column(self) -> Column:
        c = F.col(f"`{self.name}`")
        if self.down:
            return c.desc_nulls_last() if self.nulls_last else c.desc_nulls_first()
        return c.asc_nulls_last() if self.nulls_last else c.asc_nulls_first()


def _places(df: DataFrame, order: Sequence[Column]) -> list[_Place]:
    """The columns, directions and null places of an order such as ``[F.col("day").desc(), F.col("id")]``."""
    out = []
    for c in order:
        name, way, nulls = re.fullmatch(r"Column<'(.*?)(?: (ASC|DESC) NULLS (FIRST|LAST))?'>", str(c), re.DOTALL).groups()
        if name not in df.columns:
            raise ValueError(f"order by columns of the table, not by {name}")
        out.append(_Place(name, way == "DESC", nulls == "LAST"))
    return out


def bytes_read(df: DataFrame) -> int:
    """Bytes of the tables behind the plan, as the planner knows them."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    return sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))


def _blocks(df: DataFrame) -> int:
    """How many blocks the bytes of the tables behind the plan ask for; of no known size, the most."""
    most = min(MOST_BLOCKS, PER_PARTITION * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return max(1, min(most, -(-bytes_read(df) // BLOCK_BYTES)))


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """The rows dealt by the keys over tasks of ``SPREAD_BYTES`` read each, so that a task's memory stays the same.

    Group by these keys or more behind it: that needs no further exchange. A plan of
    no known size gets the session's number of shuffle partitions.
    """
    size = bytes_read(df)
    parts = -(-size // SPREAD_BYTES) if size < UNKNOWN else int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(max(1, min(MOST_BLOCKS, parts)), *keys)


def _bounds(df: DataFrame, places: Sequence[_Place], blocks: int) -> list[Row]:
    """At most ``blocks`` - 1 rows, in order, that cut the table into parts of about equal size.

    One row with the least hash is kept per cell of a hash; that takes one
    combining aggregate, needs no count, and depends on the rows alone.
    """
    if blocks < 2:
        return []
    names = [f"`{p.name}`" for p in places]
    cell = F.pmod(F.xxhash64(*names), F.lit(blocks * SAMPLED))
    picked = df.groupBy(cell.alias("cell")).agg(F.min_by(F.struct(*names), F.xxhash64(F.lit(1), *names)).alias("row"))
    rows = picked.select("row.*").collect()
    for i, p in reversed(list(enumerate(places))):  # stable, so the last column first
        rows.sort(key=lambda r: _rising(r[i]), reverse=p.down)  # noqa: B023
        rows.sort(key=lambda r: (r[i] is None) == p.nulls_last)  # noqa: B023
    return [rows[len(rows) * k // blocks] for k in range(1, blocks) if len(rows) * k // blocks != len(rows) * (k - 1) // blocks]


def _rising(value) -> tuple:
    """A key in Spark's order: not-a-number is above all numbers; nulls are placed elsewhere."""
    if value is None:
        return (0,)
    return (2,) if value != value else (1, value)


def _block(df: DataFrame, places: Sequence[_Place], bounds: Sequence[Row]) -> Column:
    """How many bounds a row does not come before, found in two steps of about sqrt(bounds) comparisons."""
    if not bounds:
        return F.lit(0)
    kinds = {f.name: f.dataType for f in df.schema.fields}

    def literal(row: Row) -> Column:
        return F.struct(*[F.lit(row[i]).cast(kinds[p.name]).alias(f"c{i}") for i, p in enumerate(places)])

    def reached(bound: Column) -> Column:
        """The row comes after the bound or is equal to it."""
        found = F.lit(True)
        for i, p in reversed(list(enumerate(places))):
            here, there = F.col(f"`{p.name}`"), bound[f"c{i}"]
            found = p.before(there, here) | (here.eqNullSafe(there) & found)
        return found

    step = max(1, int(len(bounds) ** 0.5))
    parts = [bounds[i : i + step] for i in range(0, len(bounds), step)]
    coarse = F.size(F.filter(F.array(*[literal(p[0]) for p in parts]), reached))
    fine = F.array(*[F.array(*[literal(b) for b in p[1:]]) if len(p) > 1 else F.array().cast(_kind(places, kinds)) for p in parts])
    inside = F.size(F.filter(F.get(fine, coarse - 1), reached))
    return F.when(coarse == 0, F.lit(0)).otherwise((coarse - 1) * step + 1 + inside)


def _kind(places: Sequence[_Place], kinds: Mapping) -> str:
    return "array<struct<" + ", ".join(f"c{i}: {kinds[p.name].simpleString()}" for i, p in enumerate(places)) + ">>"


def with_blocks(df: DataFrame, keys: Sequence[str], order: Sequence[Column], blocks: int) -> DataFrame:
    """Add ``__block``, which never falls along the order of the keys and then of ``order``."""
    places = [*[_Place(k) for k in keys], *_places(df, order)]
    return df.withColumn(_BLOCK, _block(df, places, _bounds(df, places, blocks)))


def running_totals(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], totals: Mapping[str, Column], blocks: int | None = None
) -> DataFrame:
    """Add inclusive running sums of ``totals`` along ``order`` within ``keys``.

    ``order`` holds columns of the table and must end in a unique one of the
    group. Give exact types (integers, decimals): sums of doubles depend on the
    order of addition.

    Every block of a group starts from the sum of the group's earlier blocks,
    put in front as one extra row. With more than one block ``df`` is read three
    times, twice for the columns of the order alone; store it first if it is
    expensive.
    """
    kinds = df.select(*[c.alias(n) for n, c in totals.items()]).dtypes
    if inexact := [n for n, kind in kinds if kind in ("double", "float")]:
        raise ValueError(f"sums of doubles depend on the order of addition: {inexact}")
    blocks = _blocks(df) if blocks is None else blocks
    if blocks == 1:
        frame = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
        return df.select("*", *[F.sum(c).over(frame).alias(n) for n, c in totals.items()])
    cut = with_blocks(df, keys, order, blocks).withColumns(dict(totals))
    before = Window.partitionBy(*keys).orderBy(_BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    # one row per group and block: groups and blocks together bound their number
    sums = cut.groupBy(*keys, _BLOCK).agg(*[F.sum(n).alias(n) for n in totals])
    opening = sums.select(*keys, _BLOCK, *[F.sum(n).over(before).alias(n) for n in totals], F.lit(0).alias(_LATER))
    both = cut.withColumn(_LATER, F.lit(1)).unionByName(opening, allowMissingColumns=True)
    frame = Window.partitionBy(*keys, _BLOCK).orderBy(F.col(_LATER), *order).rowsBetween(Window.unboundedPreceding, 0)
    kinds = df.select(*[F.sum(c).alias(n) for n, c in totals.items()]).schema
    summed = both.select(*df.columns, _LATER, *[F.sum(n).over(frame).cast(kinds[n].dataType).alias(n) for n in totals])
    return summed.filter(F.col(_LATER) == 1).drop(_LATER)


def over_neighbours(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    columns: Callable[[WindowSpec], Mapping[str, Column]],
    back: int = 0,
    ahead: int = 0,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Add window columns that look at most ``back`` rows back and ``ahead`` on.

    ``columns`` gets the ordered window and returns the named expressions. Rows
    are numbered within their group and cut into runs of ``block_rows``; the
    few rows near an edge are also sent to the neighbouring run.
    """
    if _blocks(df) == 1:
        spec = Window.partitionBy(*keys).orderBy(*order)
        return df.select("*", *[c.alias(n) for n, c in columns(spec).items()])
    size = max(block_rows, back + 1, ahead + 1)
    numbered = running_totals(df, keys, order, {_POS: F.lit(1).cast("bigint")})
    at = F.pmod(F.col(_POS) - 1, F.lit(size))
    home = F.floor((F.col(_POS) - 1) / size)
    runs = F.array(F.col(_HOME), F.when(at < ahead, F.col(_HOME) - 1), F.when(at >= size - back, F.col(_HOME) + 1))
    spread = numbered.withColumn(_HOME, home).withColumn(_BLOCK, F.explode(F.array_compact(runs)))
    spec = Window.partitionBy(*keys, _BLOCK).orderBy(_POS)
    looked = spread.select(*df.columns, _HOME, _BLOCK, *[c.alias(n) for n, c in columns(spec).items()])
    return looked.filter(F.col(_HOME) == F.col(_BLOCK)).drop(_HOME, _BLOCK)
