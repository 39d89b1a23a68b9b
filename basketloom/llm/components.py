"""Connected components by contraction, without collecting links or groups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketloom.sources.stage import discard, settle


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b), one root per component.

    Each round every node moves to its neighbour, or itself, of least hash;
    links whose ends have met vanish. The hash changes every round, so a
    constant share of the nodes goes in each, whatever the shape. Only counts
    reach the driver. A node with very many links is combined before the
    shuffle and may be split by the joins. Null ends and loops are ignored.
    """
    edges = settle(
        links.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(),
        "links",
    )
    members = None
    for turn in range(200):
        if edges.isEmpty():
            break
        weight = lambda c: F.xxhash64(c, F.lit(turn))  # noqa: B023, E731
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        nearest = both.groupBy(F.col("a").alias("node")).agg(F.min(F.struct(weight(F.col("b")).alias("w"), "b")).alias("m"))
        moves = settle(
            nearest.select("node", F.when(F.col("m.w") < weight(F.col("node")), F.col("m.b")).otherwise(F.col("node")).alias("to")),
            "moves",
        )
        if members is None:
            moved = moves.select("node", F.col("to").alias("root"))
        else:
            step = moves.withColumnRenamed("node", "root")
            moved = members.join(step, "root", "left").select("node", F.coalesce("to", "root").alias("root"))
        old, members = members, settle(moved, "members")
        left = moves.select(F.col("node").alias("a"), F.col("to").alias("x"))
        right = moves.select(F.col("node").alias("b"), F.col("to").alias("y"))
        rest = edges.join(left, "a").join(right, "b").filter("x <> y")
        done, edges = edges, settle(rest.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "links")
        discard(done, moves, *([old] if old is not None else []))
    discard(edges)
    if members is None:
        kind = links.schema["a"].dataType.simpleString()
        return links.sparkSession.createDataFrame([], f"node {kind}, root {kind}")
    return members


def extended(found: DataFrame, fresh: DataFrame) -> DataFrame:
    """(node, root) of the links behind ``found`` and the ``fresh`` ones (a, b).

    Fresh links are renamed to the roots they join, so links that are known to
    connect are not contracted again. ``found`` may be deleted afterwards.
    """
    named = fresh
    for end in ("a", "b"):
        own = found.select(F.col("node").alias(end), F.col("root").alias("__root"))
        named = named.join(own, end, "left").withColumn(end, F.coalesce("__root", end)).select("a", "b")
    top = components(named)
    step = top.select(F.col("node").alias("root"), F.col("root").alias("to"))
    moved = found.join(step, "root", "left").select("node", F.coalesce("to", "root").alias("root"))
    out = settle(moved.unionByName(top.join(found.select("node"), "node", "left_anti")), "members")
    discard(top)
    return out
