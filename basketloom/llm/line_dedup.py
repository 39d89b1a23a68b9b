"""Removal of repeated runs of three lines, over all documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketloom.llm import text as t
from basketloom.sources.stage import settle

#: Lines in a window.
SPAN = 3


def repeated_lines(docs: DataFrame) -> DataFrame:
    """(doc_id, __version, covered): the line numbers, from 0, of later occurrences.

    A window is three neighbouring lines, compared by two 64-bit hashes; windows
    of blank lines only do not count. Its first occurrence, by doc_id (nulls
    first), text hash and line, stays; the lines of all others are covered, and
    overlapping windows merge. Windows travel as hashes, counted before the
    shuffle, so a window of very many documents is one row per task.
    """
    split = docs.select("doc_id", F.xxhash64("text").alias("__version"), t.lines(F.col("text")).alias("__lines"))
    seen = split.select(
        "doc_id",
        "__version",
        F.posexplode_outer(t.runs("__lines", SPAN, lambda *w: F.when(F.trim(F.concat(*w)) != "", F.struct(F.xxhash64(*w).alias("h"), F.xxhash64(F.lit(1), *w[::-1]).alias("g"))))),
    ).filter("col is not null")
    windows = settle(seen.select("doc_id", "__version", "pos", "col.h", "col.g"), "windows")
    firsts = (
        windows.groupBy("h", "g")
        .agg(F.min(F.struct("doc_id", "__version", "pos")).alias("first"), F.count(F.lit(1)).alias("n"))
        .filter("n > 1")
        .select("h", "g", "first")
    )
    later = windows.join(firsts, ["h", "g"]).filter(~F.struct("doc_id", "__version", "pos").eqNullSafe(F.col("first")))
    spots = later.groupBy("doc_id", "__version").agg(F.collect_set("pos").alias("spots"))
    around = F.flatten(F.transform("spots", lambda p: F.array(*[p + k for k in range(SPAN)])))
    return spots.select("doc_id", "__version", F.array_distinct(around).alias("covered"))


def remove_repeated_lines(docs: DataFrame) -> DataFrame:
    """``docs`` with ``text`` less its repeated lines, plus n_lines and n_removed.

    All other columns stay as they are; existing columns n_lines and n_removed
    are replaced. A null text stays null with no lines; texts of fewer than
    three lines stay whole. A text whose lines all occur elsewhere before
    becomes empty. Rows with equal doc_id and text are one document and get the
    same result; null doc_ids are compared by text. An empty table stays empty.
    Windows are equal if both of their 64-bit hashes are; the lines themselves
    are not compared. Names that begin with two underscores are reserved.
    """
    own = [c for c in docs.columns if c not in ("n_lines", "n_removed")]
    gone = repeated_lines(docs).withColumnsRenamed({"doc_id": "__doc", "covered": "__covered"})
    rows = docs.select(*own).withColumn("__v", F.xxhash64("text"))
    found = rows.join(gone, F.col("doc_id").eqNullSafe(F.col("__doc")) & (F.col("__v") == F.col("__version")), "left")
    found = found.withColumn("__lines", t.lines(F.col("text")))
    rest = F.array_except(t.positions(F.size("__lines")), F.col("__covered"))
    kept = F.array_join(F.transform(rest, lambda i: F.get(F.col("__lines"), i)), "\n")
    return found.select(
        *[F.when(F.col("__covered").isNull(), F.col("text")).otherwise(kept).alias("text") if c == "text" else F.col(c) for c in own],
        F.coalesce(F.size("__lines"), F.lit(0)).cast("long").alias("n_lines"),
        F.coalesce(F.size("__covered"), F.lit(0)).cast("long").alias("n_removed"),
    )


SQL = """
WITH split AS (SELECT doc_id, text, string_split(text, chr(10)) AS ls FROM documents),
windows AS (
  SELECT doc_id, pos, ls[pos] || chr(10) || ls[pos + 1] || chr(10) || ls[pos + 2] AS win
  FROM split, unnest(range(1, len(ls) - 1)) AS r(pos)
  WHERE trim(ls[pos] || ls[pos + 1] || ls[pos + 2]) <> ''),
ranked AS (SELECT doc_id, pos, row_number() OVER (PARTITION BY win ORDER BY doc_id, pos) AS k FROM windows),
covered AS (SELECT DISTINCT doc_id, pos + d AS line FROM ranked, unnest(range(0, 3)) AS r(d) WHERE k > 1),
kept AS (
  SELECT doc_id, string_agg(ls[line], chr(10) ORDER BY line) AS text, count(*) AS n
  FROM (SELECT doc_id, ls, unnest(range(1, len(ls) + 1)) AS line FROM split) AS a
  WHERE NOT EXISTS (SELECT 1 FROM covered AS c WHERE c.doc_id = a.doc_id AND c.line = a.line)
  GROUP BY doc_id)
SELECT s.doc_id, CASE WHEN s.text IS NULL THEN NULL ELSE coalesce(k.text, '') END AS text,
  CAST(coalesce(len(s.ls), 0) AS BIGINT) AS n_lines, CAST(coalesce(len(s.ls), 0) - coalesce(k.n, 0) AS BIGINT) AS n_removed
FROM split AS s LEFT JOIN kept AS k USING (doc_id)
"""
