"""Benchmark items inside documents: size-partitioned MinHash search, exact verification."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketloom.llm import text as t
from basketloom.sources.stage import settle

WORDS = 5


def _shingled(rows: DataFrame, key: str, width: int, exact: bool) -> DataFrame:
    """(key, s): all runs of ``width`` words, as text or as a 64-bit hash."""
    join = (lambda *w: F.concat_ws(" ", *w)) if exact else (lambda *w: F.xxhash64(*w))
    split = rows.select(key, t.words(F.lower("text")).alias("__w"))
    if not exact:
        split = split.select(key, F.transform("__w", lambda w: F.xxhash64(w)).alias("__w"))
    return split.select(key, t.runs("__w", width, join).alias("s"))


def _least(n: Column, percent: int) -> Column:
    """The fewest shared shingles that reach the containment."""
    return F.floor((n * percent + 99) / 100)


def find_leaks(docs: DataFrame, items: DataFrame, percent: int = 80) -> DataFrame:
    """(doc_id, item_id, n_item, n_shared, containment) of items found in documents.

    An item leaks if 100 * shared >= percent * its distinct 5-word shingles
    (items of fewer words: their whole word sequence as one). Words are
    compared in lower case.

    Search: an item keeps the ``n - least + 1`` smallest hashes of its n
    shingles, its MinHash sketch for this containment, so a document that holds
    enough of it holds one of them. Items are partitioned by size, in powers of
    two; each class has its own highest sketch hash, and a document is searched
    only for classes that it is long enough for, with its hashes up to their
    bound. So the length of a document costs nothing in recall. Candidates are
    then counted exactly, on the words themselves.

    Rows that share a doc_id (or a null doc_id) count as one document, rows
    that share an item_id as one item. Null or blank texts and items never
    match; empty tables give no rows; other columns are ignored.
    """
    work = items.select("item_id", "text").withColumn("__n", F.size(t.words(F.col("text")))).filter("__n > 0")
    work = work.withColumn("__width", F.least(F.col("__n"), F.lit(WORDS)))
    # at most five widths
    widths = sorted(r[0] for r in work.select("__width").distinct().collect())
    found = None
    for width in widths:
        own = work.filter(F.col("__width") == width)
        hashes = _shingled(own, "item_id", width, False).select("item_id", F.explode_outer("s").alias("s")).filter("s is not null").groupBy("item_id").agg(F.collect_set("s").alias("s"))
        n = F.size("s")
        sketch = settle(
            hashes.select(
                "item_id", F.floor(F.log2(n)).cast("int").alias("size_class"), n.alias("n"),
                F.explode(F.slice(F.sort_array("s"), F.lit(1), (n - _least(n, percent) + 1).cast("int"))).alias("s"),
            ),
            "sketch",
        )
        # one row per power of two
        classes = sketch.groupBy("size_class").agg(F.max("s").alias("top"), F.min(_least(F.col("n"), percent)).alias("least")).orderBy("least").collect()
        prepared = _shingled(docs.select("doc_id", "text"), "doc_id", width, False)
        bound, top = F.lit(None).cast("long"), None
        for row in classes:
            top = row["top"] if top is None else max(top, row["top"])
            bound = F.when(F.col("__n") >= int(row["least"]), F.lit(top)).otherwise(bound)
        # the filter stands behind the explode: in front of it the shingles would be computed again
        low = prepared.select("doc_id", F.size("s").alias("__n"), F.explode_outer("s").alias("s")).filter(F.col("s") <= bound)
        hit = low.join(sketch.select("item_id", "s"), "s").select("doc_id", "item_id").distinct()
        hit = settle(hit, "candidates")

        picked = docs.select("doc_id", "text").join(hit.select(F.col("doc_id").alias("__d")).distinct(), F.col("doc_id").eqNullSafe(F.col("__d")), "left_semi")
        inside = _shingled(picked, "doc_id", width, True).select("doc_id", F.explode_outer(F.array_distinct("s")).alias("s"))
        parts = _shingled(own, "item_id", width, True).select("item_id", F.explode_outer(F.array_distinct("s")).alias("s")).filter("s is not null").distinct()
        sizes = parts.groupBy("item_id").agg(F.count(F.lit(1)).alias("n_item"))
        pairs = inside.join(parts, "s").groupBy("doc_id", "item_id").agg(F.count_distinct("s").alias("n_shared"))
        wanted = hit.select(F.col("doc_id").alias("__d"), F.col("item_id").alias("__i"))
        pairs = pairs.join(wanted, F.col("doc_id").eqNullSafe(F.col("__d")) & (F.col("item_id") == F.col("__i")), "left_semi")
        counted = pairs.join(sizes, "item_id").filter(F.col("n_shared") * 100 >= F.col("n_item") * percent)
        part = counted.select("doc_id", "item_id", "n_item", "n_shared", (F.col("n_shared") / F.col("n_item")).alias("containment"))
        found = part if found is None else found.unionByName(part)
    if found is None:
        return docs.select("doc_id").join(items.select("item_id"), F.lit(False)).selectExpr("doc_id", "item_id", "0L n_item", "0L n_shared", "0D containment")
    return found


SQL = """
WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array(lower(text), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS w FROM documents),
b AS (SELECT item_id, list_filter(regexp_split_to_array(lower(text), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS w FROM benchmark),
ds AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s FROM d, unnest(range(1, len(w) - 3)) AS r(i)),
bs AS (SELECT DISTINCT item_id, array_to_string(w[i:i + 4], ' ') AS s FROM b, unnest(range(1, len(w) - 3)) AS r(i)),
n AS (SELECT item_id, count(*) AS n_item FROM bs GROUP BY item_id),
c AS (SELECT doc_id, item_id, count(*) AS n_shared FROM ds JOIN bs USING (s) GROUP BY doc_id, item_id)
SELECT doc_id, item_id, n_item, n_shared, CAST(n_shared AS DOUBLE) / n_item AS containment
FROM c JOIN n USING (item_id) WHERE 100 * n_shared >= 80 * n_item
"""
