"""Readers and writers for delimited text and Parquet."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketloom.sources.stage import discard, settle

Schema = str | T.StructType


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: Schema | None = None,
    sep: str = ",",
    header: bool = True,
) -> DataFrame:
    """Delimited text from a file, a folder or a list of them.

    Without a schema the types are inferred, at the price of a second pass.
    """
    reader = spark.read.option("header", header).option("sep", sep)
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    return reader.csv(path)


def read_csv_gz(
    spark: SparkSession, path: str, schema: Schema | None = None, partitions: int | None = None
) -> DataFrame:
    """Gzip files cannot be split, so each is one task; spread the rows after."""
    df = read_csv(spark, path, schema)
    parts = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(parts)


def read_named(spark: SparkSession, path: str | list[str], columns: Mapping[str, str]) -> DataFrame:
    """The named columns of a delimited file with a header, wherever they stand, cast to the given types.

    One pass: nothing is inferred. A value that its type cannot hold is an error.
    """
    text = spark.read.option("header", True).option("inferSchema", False).csv(path)
    return text.select(*[F.trim(F.col(f"`{c}`")).cast(kind).alias(c) for c, kind in columns.items()])


def drop_blank_rows(df: DataFrame) -> DataFrame:
    """Drop columns without a name (``_c8``) and rows that are null throughout."""
    named = [c for c in df.columns if not (c.strip() == "" or (c[:2] == "_c" and c[2:].isdigit()))]
    return df.select(*named).dropna(how="all")


def read_parquet(spark: SparkSession, *paths: str, merge_schema: bool = False) -> DataFrame:
    return spark.read.option("mergeSchema", merge_schema).parquet(*paths)


def as_uri(spark: SparkSession, path: str) -> str:
    """The path with a scheme; a bare path belongs to the session's default file system."""
    if re.match(r"[A-Za-z][A-Za-z0-9+.-]*:", path):
        return path
    bare = spark._jvm.org.apache.hadoop.fs.Path(path)
    return bare.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(bare).toString()


def write_csv(df: DataFrame, path: str, single_file: bool = False, **options: str) -> None:
    """CSV with header. ``single_file`` is for small profiles only; they are still computed by all tasks."""
    out = df.repartition(1) if single_file else df
    out.write.options(header=True, **options).mode("overwrite").csv(path)


def write_parquet(df: DataFrame, path: str, files: int | None = None) -> None:
    out = df.repartition(files) if files else df
    out.write.mode("overwrite").parquet(path)


def write_partitioned(df: DataFrame, path: str, by: Sequence[str], file_rows: int = 1_000_000) -> None:
    """One folder per value of ``by``, with as many files as the value's rows ask.

    A count per value comes first, so a value that holds most rows is dealt over
    as many tasks as it needs files of ``file_rows`` rows, and a small value is
    one file. Folders of values that do not occur stay as they are. The rows are
    read twice; rows that are equal in every column stay together.
    """
    names = {c: f"__{c}" for c in by}
    counts = df.groupBy(*by).agg(F.ceil(F.count(F.lit(1)) / file_rows).alias("__files"))
    files = settle(counts.select(*[F.col(c).alias(n) for c, n in names.items()], "__files"), "files")
    same = [F.col(c).eqNullSafe(F.col(n)) for c, n in names.items()]
    part = F.pmod(F.xxhash64(*df.columns), F.col("__files"))
    dealt = df.join(files, same).withColumn("__part", part).repartition(*by, "__part")
    (
        dealt.select(*df.columns)
        .write.partitionBy(*by)
        .option("maxRecordsPerFile", file_rows)
        .option("partitionOverwriteMode", "dynamic")
        .mode("overwrite")
        .parquet(path)
    )
    discard(files)


def newest_partition(spark: SparkSession, path: str, column: str) -> DataFrame:
    """The folder with the greatest value of a partition column; the other folders are listed, not read.

    A table that is not in folders by the column is read for its rows of the greatest value.
    """
    base = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = base.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(base)
    values = [name[len(column) + 1 :] for f in found if (name := f.getPath().getName()).startswith(f"{column}=")]
    values = [v for v in values if v != "__HIVE_DEFAULT_PARTITION__"]
    if not values:
        table = spark.read.parquet(path)
        if column not in table.columns:
            raise ValueError(f"{path} has neither folders nor a column of {column}")
        return table.filter(F.col(column) == table.agg(F.max(column)).scalar())
    return spark.read.option("basePath", path).parquet(f"{path}/{column}={max(values)}")


def sample_export(df: DataFrame, path: str, order: Sequence[str], n: int = 50) -> None:
    """The first ``n`` rows along ``order`` as one CSV file."""
    df.orderBy(*order).limit(n).coalesce(1).write.options(header=True).mode("overwrite").csv(path)
