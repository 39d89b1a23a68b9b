"""The distance as user-defined functions, to compare them with the expression."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketloom.functions.scalars import EARTH_KM


def _km(lat_a, lng_a, lat_b, lng_b):
    if None in (lat_a, lng_a, lat_b, lng_b):
        return None
    pa, pb = math.radians(lat_a), math.radians(lat_b)
    u = math.sin((pb - pa) / 2) ** 2
    w = math.sin((math.radians(lng_b) - math.radians(lng_a)) / 2) ** 2
    return round(2 * EARTH_KM * math.asin(min(1.0, math.sqrt(u + math.cos(pa) * math.cos(pb) * w))), 3)


def _km_arrays(lat_a, lng_a, lat_b, lng_b):
    pa, pb = np.radians(lat_a), np.radians(lat_b)
    u = np.sin((pb - pa) / 2) ** 2
    w = np.sin((np.radians(lng_b) - np.radians(lng_a)) / 2) ** 2
    return np.round(2 * EARTH_KM * np.arcsin(np.minimum(1.0, np.sqrt(u + np.cos(pa) * np.cos(pb) * w))), 3)


#: Row at a time: the slow way.
haversine_udf = F.udf(_km, T.DoubleType())


@F.pandas_udf(T.DoubleType())
def haversine_pandas(a: pd.Series, b: pd.Series, c: pd.Series, d: pd.Series) -> pd.Series:
    return _km_arrays(a, b, c, d)


def haversine_batches(df: DataFrame, columns: list[str], out: str) -> DataFrame:
    """The same on whole Arrow batches with ``mapInPandas``."""

    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            arrays = [batch[c].to_numpy() for c in columns]
            yield batch.assign(**{out: _km_arrays(*arrays)})

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    return df.mapInPandas(add, f"{fields}, `{out}` double")
