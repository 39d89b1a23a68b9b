"""Column expressions over whole texts: lines, words and word shingles."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# White space between words (blank, tab, newline, VT, FF, CR), as a pattern and as characters.
SPACE = r"[\x20\x09-\x0D]"
SPACE_CHARS = " \t\n\x0b\x0c\r"


def words(text: Column) -> Column:
    """Words of a text, in order; null for a null text."""
    return F.filter(F.split(text, SPACE + "+"), lambda w: w != "")


def lines(text: Column) -> Column:
    """Parts between newlines; one empty line for an empty text, null for a null text."""
    return F.split(text, "\n", -1)


def positions(count: Column) -> Column:
    """0 .. count - 1; empty unless count is positive."""
    return F.when(count > 0, F.sequence(F.lit(0), count - 1)).otherwise(F.array().cast("array<int>"))


def runs(array: str, size: int, join) -> Column:
    """``join`` of every ``size`` neighbouring elements of an array column.

    Give the name of a column that a select has made, so it is not computed again per element, and
    use the ``_outer`` forms of explode on the result: the plain ones make the optimizer add a
    filter on the array below that select, which brings the repeated work back.
    """
    at = lambda i, k: F.get(F.col(array), i + k)
    return F.transform(positions(F.size(array) - (size - 1)), lambda i: join(*[at(i, k) for k in range(size)]))
