"""Stage tables that a restarted job finds again.

    stages = Stages(spark, "s3://bucket/job")
    weekly = stages.table("weekly", lambda: weekly_aggregate(rows, ...), reads=[sales, product], version="2")
    model = stages.table("model", lambda: model_table(weekly, ...), reads=["weekly"])

A stage is a folder with its data and, written last, a manifest: what it was
made from, its schema, its files. A restarted job reads a stage again if the
manifest says that it was made from the same files and version and all of its
data is there; any other stage is made anew, and so are the stages that read it.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


class Stages:
    """Named stage tables below a folder that all executors, and later jobs, can reach."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        #: Stages of this run by how they came about.
        self.made: list[str] = []
        self.found: list[str] = []
        self._runs: dict[str, str] = {}

    def table(self, name: str, build: Callable[[], DataFrame], reads: Sequence[DataFrame | str] = (), version: str = "") -> DataFrame:
        """The stage ``name``, from storage or from ``build``.

        ``reads`` names what it is made from: source tables, whose files count
        by path, length and time, and earlier stages of this job. Change
        ``version`` when the code changes.
        """
        origin = self._origin(reads, version)
        for manifest in self._manifests(name):
            if manifest["origin"] == origin and self._files(f"{self.folder}/{name}/{manifest['run']}") == manifest["files"]:
                self.found.append(name)
                return self._opened(name, manifest["run"], manifest["schema"])
        run = uuid.uuid4().hex
        path = f"{self.folder}/{name}/{run}"
        df = build()
        df.write.parquet(path)
        manifest = {"run": run, "origin": origin, "schema": df.schema.json(), "files": self._files(path)}
        self._put(f"{self.folder}/{name}/manifest-{run}.json", json.dumps(manifest))
        self._drop_others(name, run)
        self.made.append(name)
        return self._opened(name, run, manifest["schema"])

    def discard(self, *names: str) -> None:
        """Delete stages, all of them unless some are named."""
        for path in [f"{self.folder}/{n}" for n in names] or [self.folder]:
            where = self._path(path)
            self._system(where).delete(where, True)

    def _opened(self, name: str, run: str, schema: str) -> DataFrame:
        self._runs[name] = run
        kind = T.StructType.fromJson(json.loads(schema))
        return self.spark.read.schema(kind).parquet(f"{self.folder}/{name}/{run}")

    def _origin(self, reads: Sequence[DataFrame | str], version: str) -> str:
        digest = hashlib.sha256(version.encode())
        for one in reads:
            if isinstance(one, str):
                if one not in self._runs:
                    raise ValueError(f"stage {one} is read before it is made")
                digest.update(f"stage {one} {self._runs[one]}\n".encode())
                continue
            for file in sorted(one.inputFiles()):
                where = self._path(file)
                status = self._system(where).getFileStatus(where)
                digest.update(f"file {file} {status.getLen()} {status.getModificationTime()}\n".encode())
            digest.update(b"table\n")
        return digest.hexdigest()

    # ---- storage ----

    def _path(self, path: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(path)

    def _system(self, path):
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _listed(self, folder: str) -> list:
        where = self._path(folder)
        system = self._system(where)
        return list(system.listStatus(where)) if system.exists(where) else []

    def _files(self, folder: str) -> list:
        """Names and lengths of the data files."""
        return sorted([f.getPath().getName(), f.getLen()] for f in self._listed(folder) if f.getPath().getName().startswith("part-"))

    def _manifests(self, name: str) -> list[dict]:
        out = []
        for f in self._listed(f"{self.folder}/{name}"):
            if f.getPath().getName().startswith("manifest-"):
                stream = self._system(f.getPath()).open(f.getPath())
                try:
                    out.append(json.loads(bytes(stream.readAllBytes())))
                except ValueError:  # cut off while it was written: the stage is not there
                    pass
                finally:
                    stream.close()
        return out

    def _put(self, path: str, text: str) -> None:
        where = self._path(path)
        stream = self._system(where).create(where, False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()

    def _drop_others(self, name: str, run: str) -> None:
        """Stale runs: manifests first, so that a stage never counts as whole while it goes."""
        others = [f.getPath() for f in self._listed(f"{self.folder}/{name}") if run not in f.getPath().getName()]
        for path in sorted(others, key=lambda p: not p.getName().startswith("manifest-")):
            self._system(path).delete(path, True)
