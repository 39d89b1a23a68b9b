"""Shards of bounded bytes by extendible hashing."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketloom.sources.stage import discard, settle

#: Most bits looked at in one pass over the still oversized buckets, and bits of the hash.
STEP, BITS = 16, 60


def key_bits(*columns: Column) -> Column:
    """60 hash bits as text: the first 15 hex digits of the md5 of the columns."""
    joined = F.concat_ws("|", *[F.coalesce(c.cast("string"), F.lit("")) for c in columns])
    return F.lpad(F.conv(F.substring(F.md5(joined), 1, 15), 16, 2), BITS, "0")


def directory(sizes: DataFrame, limit: int) -> DataFrame:
    """(prefix, depth, shard_bytes, fits): the buckets of the directory.

    ``sizes`` has ``bits`` and ``bytes``. Starting from one bucket, only buckets
    above ``limit`` are split on the next bit. A pass sums the bytes per prefix
    of up to 16 more bits, combined before the shuffle; buckets that are still
    too large go to the next pass. Rows that agree in all bits end in one
    bucket with ``fits`` false.
    """
    found, left, base = None, sizes.select("bits", "bytes"), 0
    while True:
        total = left.agg(F.sum("bytes")).first()[0] or 0
        step = math.ceil(math.log2(max(1, total / limit))) + 4  # a few bits more than even buckets need
        top = min(base + min(STEP, step), BITS)
        cells = settle(left.groupBy(F.substring("bits", 1, top).alias("cell")).agg(F.sum("bytes").alias("bytes")), "cells")
        levels = cells.select("cell", "bytes", F.explode(F.sequence(F.lit(base), F.lit(top))).alias("depth"))
        sums = levels.groupBy(F.col("depth"), F.substring("cell", F.lit(1), F.col("depth")).alias("prefix")).agg(F.sum("bytes").alias("shard_bytes"))
        # a cell's bucket is its shortest prefix that fits; the deepest one if none does
        fit = sums.filter((F.col("shard_bytes") <= limit) | (F.col("depth") == top))
        own = cells.select("cell", F.explode(F.sequence(F.lit(base), F.lit(top))).alias("depth"))
        own = own.join(fit, (fit["depth"] == own["depth"]) & (F.substring("cell", F.lit(1), own["depth"]) == fit["prefix"])).select(
            "cell", own["depth"], "prefix", "shard_bytes"
        )
        first = own.groupBy("cell").agg(F.min(F.struct("depth", "prefix", "shard_bytes")).alias("b"))
        buckets = settle(first.select("b.*").distinct().withColumn("fits", F.col("shard_bytes") <= limit), "buckets")
        discard(cells)
        large = buckets.filter("not fits")
        if top == BITS or large.isEmpty():
            return buckets if found is None else found.unionByName(buckets)
        done = buckets.filter("fits")
        found = done if found is None else found.unionByName(done)
        left = left.join(large.select(F.col("prefix").alias("__p")), F.substring("bits", 1, top) == F.col("__p"), "left_semi")
        base = top


def assign(docs: DataFrame, limit: int, key: tuple[str, ...] = ("doc_id", "text")) -> DataFrame:
    """(doc_id, n_bytes, shard, depth, shard_bytes) for every row of ``docs``.

    ``shard`` is the bucket's bit prefix (empty: one bucket holds all). The hash
    covers doc_id and text; null counts as empty. Rows that are equal in both
    cannot be told apart by any bit: if they exceed the limit together, they
    are counted off into shards ``prefix-0``, ``prefix-1`` and so on, by
    their share of the bytes. A single row above the limit has a shard of its
    own. An empty table stays empty; other columns are ignored.
    """
    rows = settle(
        docs.select(
            "doc_id",
            F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
            key_bits(*[F.col(c) for c in key]).alias("bits"),
        ),
        "keys",
    )
    buckets = directory(rows.select("bits", F.col("n_bytes").alias("bytes")), limit)
    depths = [r[0] for r in buckets.select("depth").distinct().collect()]  # at most 61
    places = rows.select("*", F.explode(F.array(*[F.lit(d) for d in sorted(depths)]).cast("array<int>")).alias("depth")) if depths else rows.withColumn("depth", F.lit(0))
    places = places.withColumn("prefix", F.substring("bits", F.lit(1), F.col("depth")))
    placed = places.join(buckets, ["depth", "prefix"])
    # rows equal in all bits are numbered within blocks, and blocks by their counts
    equal = settle(
        placed.filter("not fits").select("doc_id", "n_bytes", "prefix", "depth", F.pmod(F.monotonically_increasing_id(), F.lit(1024)).alias("block")),
        "equal",
    )
    counts = equal.groupBy("prefix", "block").agg(F.count(F.lit(1)).alias("n"))
    before = counts.select("prefix", "block", (F.sum("n").over(Window.partitionBy("prefix").orderBy("block")) - F.col("n")).alias("before"))
    number = F.row_number().over(Window.partitionBy("prefix", "block").orderBy("n_bytes")) - 1 + F.col("before")
    room = F.greatest(F.lit(1), F.floor(F.lit(limit) / F.greatest(F.col("n_bytes"), F.lit(1))))
    numbered = equal.join(before, ["prefix", "block"]).select(
        "doc_id", "n_bytes", "prefix", "depth", F.floor(number / room).cast("string").alias("part")
    )
    own = numbered.groupBy("prefix", "part").agg(F.sum("n_bytes").alias("shard_bytes"))
    split = numbered.join(own, ["prefix", "part"]).select("doc_id", "n_bytes", F.concat_ws("-", "prefix", "part").alias("shard"), "depth", "shard_bytes")
    return placed.filter("fits").select("doc_id", "n_bytes", F.col("prefix").alias("shard"), "depth", "shard_bytes").unionByName(split)


SQL = """
WITH d AS (
  SELECT doc_id, CAST(coalesce(strlen(text), 0) AS BIGINT) AS n_bytes,
    lpad(bin(CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || '|' || coalesce(text, '')), 1, 15) AS BIGINT)), 60, '0') AS bits
  FROM documents),
sums AS (
  SELECT depth, substr(bits, 1, depth) AS prefix, CAST(sum(n_bytes) AS BIGINT) AS shard_bytes
  FROM d, unnest(range(0, 61)) AS r(depth) GROUP BY 1, 2),
fit AS (SELECT * FROM sums WHERE shard_bytes <= 1048576),
own AS (
  SELECT doc_id, n_bytes, min(CAST(depth AS INTEGER)) AS depth
  FROM d, unnest(range(0, 61)) AS r(depth) JOIN fit USING (depth) WHERE substr(bits, 1, depth) = prefix GROUP BY ALL)
SELECT o.doc_id, o.n_bytes, f.prefix AS shard, o.depth, f.shard_bytes
FROM own AS o JOIN d USING (doc_id) JOIN fit AS f ON f.depth = o.depth AND f.prefix = substr(d.bits, 1, o.depth)
"""
