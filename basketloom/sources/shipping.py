"""Send the package to the Python workers."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable
from functools import wraps

import basketloom
from pyspark.sql import DataFrame, SparkSession

_sent: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Make the package importable on every executor, once per application."""
    app = spark.sparkContext.applicationId
    if app in _sent:
        return
    home = os.path.dirname(os.path.abspath(basketloom.__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="basketloom-"), "basketloom.zip")
    with zipfile.ZipFile(path, "w") as out:
        for folder, _, names in os.walk(home):
            for name in sorted(n for n in names if n.endswith(".py")):
                full = os.path.join(folder, name)
                out.write(full, os.path.relpath(full, os.path.dirname(home)))
    spark.sparkContext.addPyFile(path)
    _sent.add(app)


def shipped(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """The query, after the package has gone to the workers of its session."""

    @wraps(fn)
    def call(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return fn(spark, sf_dir)

    return call
