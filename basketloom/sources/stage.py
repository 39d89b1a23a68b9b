"""Stage tables in the folder all executors share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

_local_base: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """Folder for stage tables: ``spark.checkpoint.dir`` of the session.

    Only a local session may leave it unset; it then gets a fresh temporary
    folder. A cluster needs storage that outlives an executor.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        app = spark.sparkContext.applicationId
        if app not in _local_base:
            _local_base[app] = tempfile.mkdtemp(prefix="basketloom-")
        base = _local_base[app]
    return f"{base.rstrip('/')}/basketloom/{spark.sparkContext.applicationId}"


def stage_path(spark: SparkSession, label: str) -> str:
    """A path nobody has used yet, below :func:`shared_dir`."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex[:12]}"


_made: ContextVar[list[tuple[SparkSession, str]] | None] = ContextVar("made", default=None)


@contextmanager
def released() -> Iterator[None]:
    """Delete the stage tables made inside when the block ends, also by an error.

    A DataFrame returned from such a block must not be read behind it: write or
    collect the result inside.
    """
    token = _made.set([])
    try:
        yield
    finally:
        made = _made.get()
        _made.reset(token)
        for spark, path in made:
            _delete(spark, path)


@contextmanager
def cached(df: DataFrame) -> Iterator[DataFrame]:
    """The rows kept in memory and on disk while the block runs, and released behind it."""
    df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield df
    finally:
        df.unpersist()


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def settle(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage, survives lost executors, fixes non-deterministic columns
    such as partition ids, and lets the planner see the true size, so it
    broadcasts the result only if it is below the broadcast threshold.
    """
    spark = df.sparkSession
    path = stage_path(spark, label)
    if (made := _made.get()) is not None:
        made.append((spark, path))
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Bytes of a method above which the JVM never compiles it.
COMPILED = 8000


@contextmanager
def compiled(spark: SparkSession) -> Iterator[None]:
    """Jobs run inside use no generated method that the JVM would leave to its interpreter.

    A stage over dozens of computed columns becomes one such method and is several
    times slower than its operators one by one. The setting is put back at the end.
    """
    name = "spark.sql.codegen.hugeMethodLimit"
    before = spark.conf.get(name)
    spark.conf.set(name, COMPILED)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def discard(*tables: DataFrame) -> None:
    """Delete stage tables that no later plan reads; anything else is left alone."""
    for df in tables:
        spark = df.sparkSession
        base = shared_dir(spark).split(":", 1)[-1].lstrip("/")
        for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            if base in folder:
                _delete(spark, folder)
