"""Text statistics as column expressions, and threshold bins for learning from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketloom.llm import text as t

# The symbols that count as such, and the letters of the upper-case count.
SYMBOLS = "#*$%&|<>"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Quantiles whose values become thresholds.
BINS = 32


def without(text: Column, characters: str) -> Column:
    return F.translate(text, characters, "")


def occurrences(text: Column, characters: str) -> Column:
    """How many of the characters a text has; null for a null text."""
    return (F.length(text) - F.length(without(text, characters))).cast("long")


def base_counts(docs: DataFrame, keys: list[str]) -> DataFrame:
    """keys and n_words, word_chars, n_symbols, n_upper, n_marks, n_distinct (bigint); zeros for a null text."""
    body = docs.select(*keys, F.coalesce("text", F.lit("")).alias("__t"))
    split = body.select(*keys, "__t", t.words(F.col("__t")).alias("__w"))
    text = F.col("__t")
    return split.select(
        *keys,
        F.size("__w").cast("long").alias("n_words"),
        F.length(without(text, t.SPACE_CHARS)).cast("long").alias("word_chars"),
        occurrences(text, SYMBOLS).alias("n_symbols"),
        occurrences(text, UPPER).alias("n_upper"),
        occurrences(text, "!").alias("n_marks"),
        F.size(F.array_distinct("__w")).cast("long").alias("n_distinct"),
        "__t",
        "__w",
    )


def rate(part: str, whole: str) -> Column:
    return F.coalesce(F.try_divide(F.col(part).cast("double"), F.col(whole).cast("double")), F.lit(0.0))


def thresholds(rows: DataFrame, features: list[str], label: str) -> dict[str, list[float]]:
    """Distinct quantiles of every feature, over all rows and over each label; at most 3 * (BINS + 1) each."""
    shares = [i / BINS for i in range(BINS + 1)]
    picked = rows.agg(
        *[
            F.percentile_approx(F.when(F.lit(True) if only is None else F.col(label) == only, F.col(f)), shares, 10_000).alias(f"{f}_{k}")
            for f in features
            for k, only in enumerate((None, 0, 1))
        ]
    ).first()
    return {f: sorted({v for k in range(3) for v in (picked[f"{f}_{k}"] or ())}) for f in features}


def bin_of(value: Column, cuts: list[float]) -> Column:
    """How many thresholds lie below or at the value.

    The value is bound by a lambda of its own, so that the planner cannot move
    its expression, which may split a whole text, into the loop over thresholds.
    """
    if not cuts:
        return F.lit(0)
    limits = F.array(*[F.lit(float(c)) for c in cuts])
    return F.get(F.transform(F.array(value), lambda v: F.size(F.filter(limits, lambda c: c <= v))), F.lit(0))
