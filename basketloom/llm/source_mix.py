"""Mixing sources to target weights by a van der Corput schedule of equal word blocks.

Every source is a stream: its documents in the order of a seeded hash, cut into
blocks of ``block`` words. The schedule has 2**k slots; slot j stands at the
van der Corput point of j, its bits reversed, and takes from the source in
whose share of the cumulative slot counts that point falls. The r-th slot of a
source takes the r-th block of its stream, which starts anew when it ends. So
every stretch of slots holds the sources in about their target shares, while
each source's words are exactly its rounded target.

The rank of a slot among its source's slots follows from the bits of its
point, so no group of slots is ever sorted or gathered.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketloom.llm import text as t
from basketloom.operators.ordered import running_totals
from basketloom.sources.stage import discard, settle

#: Weights of the sources in code point order, repeating; words of the mix per 100 words of input;
#: times a source may be taken; words of a block.
WEIGHTS, PERCENT, MOST, BLOCK = (3, 1, 2), 150, 2, 2048
#: Documents of a source that one task puts in order, about; slots made from one row.
TOGETHER, CELLS = 5_000, 1 << 14


def sizes(docs: DataFrame, seed: int = 0) -> DataFrame:
    """(doc_id, source, size, place) of every row: its words, and the hash that orders its source."""
    return docs.select(
        "doc_id", "source", F.coalesce(F.size(t.words(F.col("text"))), F.lit(0)).cast("long").alias("size"),
        F.xxhash64(F.lit(seed), "doc_id", "text").alias("place"),
    )


def _exact(value) -> Column:
    return (F.lit(str(value)) if isinstance(value, int) else value).cast("decimal(38,0)")


def targets(rows: DataFrame, weights: Sequence[int] = WEIGHTS, percent: int = PERCENT, most: int = MOST) -> DataFrame:
    """(sid, source, n_docs, source_size, weight, target): the words that each source should give.

    ``rows`` has source and size; ``sid`` numbers the sources from 1 by code
    point, null last. Sources share ``percent`` % of all words by weight; what a
    source would get above ``most`` times its size is shared again by the
    others, until none is above. Only three sums of a round reach the driver.
    Sources without words have target 0.
    """
    own = settle(rows.groupBy("source").agg(F.count(F.lit(1)).alias("n_docs"), F.sum("size").alias("source_size")), "sources")
    placed = running_totals(own, [], [F.col("source").asc_nulls_last()], {"sid": F.lit(1).cast("bigint")})
    weight = F.get(F.array(*[F.lit(w).cast("long") for w in weights]), F.pmod(F.col("sid") - 1, F.lit(len(weights))).cast("int"))
    sources = settle(placed.withColumn("weight", weight), "weighted")
    discard(own)
    whole = sources.agg(F.sum("source_size"), F.sum("weight")).first()
    total, free = int(whole[0] or 0), int(whole[1] or 0)
    # hundredths of words left to the sources below their limit, and the weights of these; the level of a unit of weight is left / free
    left, below, done = percent * total, free, None
    while True:
        full = _exact(100 * most) * _exact(F.col("source_size")) * _exact(below) <= _exact(left) * _exact(F.col("weight"))
        row = sources.filter(full).agg(F.sum("source_size"), F.sum("weight")).first()
        stopped = (int(row[0] or 0), int(row[1] or 0))
        if stopped == done or stopped[1] == free:
            break
        done, left, below = stopped, percent * total - 100 * most * stopped[0], free - stopped[1]
    share = F.col("weight") * F.lit(float(left)) / F.lit(100.0 * max(below, 1))
    return sources.withColumn("target", F.when(full, most * F.col("source_size").cast("double")).otherwise(share))


def _ahead(cell: Column, low: Column, high: Column, bits: int) -> Column:
    """How many cells of [low, high) have a reversed value below that of ``cell``.

    They agree with the cell in its lowest q bits and have a 0 where its bit q
    is 1, for one q: an arithmetic progression for each q.
    """
    count = F.lit(0).cast("long")
    for q in range(bits):
        rest = cell.bitwiseAND(F.lit((1 << q) - 1))
        upto = lambda end: F.shiftright(end - 1 - rest, q + 1)  # noqa: B023, E731
        count = count + F.shiftright(cell, q).bitwiseAND(F.lit(1)) * (upto(high) - upto(low))
    return count


def slots(sources: DataFrame, block: int = BLOCK) -> DataFrame:
    """(slot, sid, rank, block, words): the schedule.

    ``slot`` counts from 0 along the mix, ``rank`` along the source; ``block``
    is the block of the source's stream, and ``words`` the words taken from it,
    fewer only at a stream's end and in a source's last slot.
    """
    spark, size, goal = sources.sparkSession, F.col("source_size"), F.floor(F.col("target") + 0.5).cast("long")
    sized = sources.filter("source_size > 0").select("sid", "source_size", goal.alias("goal"), F.ceil(size / block).cast("long").alias("n_blocks"))
    rounds, rest = F.expr("goal div source_size"), F.expr("goal % source_size")
    sized = sized.withColumn("n_slots", rounds * F.col("n_blocks") + F.ceil(rest / block).cast("long"))
    placed = settle(running_totals(sized, [], [F.col("sid")], {"high": F.col("n_slots")}).withColumn("low", F.col("high") - F.col("n_slots")), "shares")
    total = int(placed.agg(F.max("high")).first()[0] or 0)
    bits = max(1, (total - 1).bit_length()) if total else 1
    # a large source's cells are made by many rows
    chunks = placed.filter("n_slots > 0").withColumn("first", F.explode(F.sequence(F.col("low"), F.col("high") - 1, F.lit(CELLS).cast("long"))))
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // (1 << 20)))
    cells = chunks.repartition(parts, "sid", "first").withColumn(
        "cell", F.explode(F.sequence(F.col("first"), F.least(F.col("first") + CELLS, F.col("high")) - 1))
    )
    cell, low, high = F.col("cell"), F.col("low"), F.col("high")
    ranked = cells.select("*", _ahead(cell, F.lit(0).cast("long"), F.lit(total).cast("long"), bits).alias("slot"), _ahead(cell, low, high, bits).alias("rank"))
    turned = ranked.select("*", F.expr("rank div n_blocks").alias("turn"), F.expr("rank % n_blocks").alias("block"))
    start = F.col("block") * block
    words = F.least(F.lit(block).cast("long"), size - start, F.col("goal") - F.col("turn") * size - start)
    return turned.select("slot", "sid", "rank", "block", words.alias("words"))


def streams(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """(sid, doc_id, size, start) of every row with words: its first word's place in its source's stream.

    A source is ordered in parts of about TOGETHER rows by ranges of the hash;
    each part starts from the sum of those before it.
    """
    named = sources.select("sid", F.col("source").alias("__source"), F.ceil(F.col("n_docs") / TOGETHER).cast("long").alias("__parts"))
    part = F.shiftright(F.shiftrightunsigned("place", 33) * F.col("__parts"), 31)
    dealt = rows.filter("size > 0").join(named, F.col("source").eqNullSafe(F.col("__source"))).select("sid", "doc_id", "size", "place", part.alias("part"))
    sums = dealt.groupBy("sid", "part").agg(F.sum("size").alias("sum"))
    before = Window.partitionBy("sid").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    opening = settle(sums.select("sid", "part", F.coalesce(F.sum("sum").over(before), F.lit(0)).alias("opening")), "openings")
    inside = Window.partitionBy("sid", "part").orderBy("place", "doc_id", "size").rowsBetween(Window.unboundedPreceding, 0)
    ordered = dealt.withColumn("end", F.sum("size").over(inside)).join(opening, ["sid", "part"])
    return ordered.select("sid", "doc_id", "size", (F.col("opening") + F.col("end") - F.col("size")).alias("start"))


def mixture(rows: DataFrame, sources: DataFrame, block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """The mix and the streams behind it.

    The mix (slot, sid, doc_id, start, at, first_word, words) holds for each
    slot the parts of documents it takes, in the order of ``at``, the words of
    the slot before them; ``start`` names the row in ``streams``.
    """
    placed = settle(streams(rows, sources), "streams")
    end = F.col("start") + F.col("size")
    pieces = placed.withColumn("block", F.explode(F.sequence(F.expr(f"start div {block}"), F.expr(f"(start + size - 1) div {block}"))))
    low = F.greatest(F.col("start"), F.col("block") * block)
    pieces = pieces.select(
        "sid", "block", "doc_id", "start", (low - F.col("block") * block).alias("at"), (low - F.col("start")).alias("first_word"),
        (F.least(end, (F.col("block") + 1) * block) - low).alias("length"),
    )
    joined = slots(sources, block).join(pieces, ["sid", "block"]).filter(F.col("words") > F.col("at"))
    return joined.select(
        "slot", "sid", "doc_id", "start", "at", "first_word", F.least(F.col("length"), F.col("words") - F.col("at")).alias("words")
    ), placed


def mix(docs: DataFrame, weights: Sequence[int] = WEIGHTS, percent: int = PERCENT, most: int = MOST, block: int = BLOCK, seed: int = 0) -> DataFrame:
    """(doc_id, source, size, source_size, target, taken) of every row of ``docs``.

    ``taken`` counts the row's words in the mix, with repeats: at most ``most``
    times its size. The words taken from a source are its target, rounded. The
    same rows give the same mix, in any order and partitioning.

    Needs doc_id, text and source; other columns are ignored. A null text, or
    one without words, has size 0 and is never taken; a null source is a source
    of its own, after all others; rows with equal doc_id are separate
    documents, and equal rows may exchange their shares. No rows give none.
    """
    rows = settle(sizes(docs, seed), "sizes")
    sources = settle(targets(rows, weights, percent, most), "targets")
    taken, placed = mixture(rows, sources, block)
    nothing = placed.withColumn("words", F.lit(0).cast("long"))
    parts = nothing.select("sid", "doc_id", "start", "size", "words").unionByName(
        taken.select("sid", "doc_id", "start", F.lit(0).cast("long").alias("size"), "words")
    )
    whole = parts.groupBy("sid", "doc_id", "start").agg(F.max("size").alias("size"), F.sum("words").alias("taken")).drop("start")
    named = whole.join(sources.select("sid", "source", "source_size", "target"), "sid")
    blank = rows.filter("size = 0").select("doc_id", F.col("source").alias("__source"), "size", F.lit(0).cast("long").alias("taken"))
    unused = blank.join(sources.select("source", "source_size", "target"), F.col("__source").eqNullSafe(F.col("source")))
    columns = ("doc_id", "source", "size", "source_size", "target", "taken")
    return named.select(*columns).unionByName(unused.select(*columns))
