"""Stage tables of a job that is stopped and started again, and their release."""

import os

import pytest
from pyspark.sql import functions as F

from basketloom.sources import stage
from basketloom.sources.resume import Stages


class Stopped(Exception):
    pass


@pytest.fixture
def source(spark, tmp_path):
    path = str(tmp_path / "source")
    spark.range(100).write.parquet(path)
    return path


def job(spark, source, folder, stop_after=None, version=""):
    """Three stages; ends with an error behind one of them, as a lost driver would."""
    stages, table = Stages(spark, folder), spark.read.parquet(source)
    steps = [
        ("double", lambda t: table.select((F.col("id") * 2).alias("x")), [table]),
        ("even", lambda t: t["double"].filter("x % 4 = 0"), ["double"]),
        ("sum", lambda t: t["even"].agg(F.sum("x").alias("s")), ["even"]),
    ]
    done = {}
    for name, build, reads in steps:
        done[name] = stages.table(name, lambda: build(done), reads=reads, version=version if name == "even" else "")  # noqa: B023
        if name == stop_after:
            raise Stopped
    return stages, done["sum"].first()["s"]


def test_a_stopped_job_goes_on_behind_its_last_stage(spark, source, tmp_path):
    folder = str(tmp_path / "job")
    with pytest.raises(Stopped):
        job(spark, source, folder, stop_after="even")
    stages, total = job(spark, source, folder)
    assert (stages.found, stages.made, total) == (["double", "even"], ["sum"], sum(range(0, 200, 4)))
    stages, again = job(spark, source, folder)
    assert stages.made == [] and again == total


def test_changed_input_or_version_makes_later_stages_anew(spark, source, tmp_path):
    folder = str(tmp_path / "job")
    job(spark, source, folder)
    stages, _ = job(spark, source, folder, version="2")
    assert (stages.found, stages.made) == (["double"], ["even", "sum"])
    spark.range(100, 110).write.mode("append").parquet(source)
    stages, total = job(spark, source, folder, version="2")
    assert stages.made == ["double", "even", "sum"] and total == sum(x for x in range(0, 220, 2) if x % 4 == 0)
    # stale runs are gone: one run and one manifest per stage
    assert all(len(os.listdir(os.path.join(folder, n))) - sum(f.endswith(".crc") for f in os.listdir(os.path.join(folder, n))) == 2 for n in stages.made)


@pytest.mark.parametrize("loss", ["data", "manifest"])
def test_half_written_stages_do_not_count(spark, source, tmp_path, loss):
    folder = str(tmp_path / "job")
    job(spark, source, folder)
    place = os.path.join(folder, "even")
    run = next(d for d in os.listdir(place) if os.path.isdir(os.path.join(place, d)))
    if loss == "data":
        files = [f for f in os.listdir(os.path.join(place, run)) if f.startswith("part-")]
        os.remove(os.path.join(place, run, files[0]))
    else:
        path = next(os.path.join(place, f) for f in os.listdir(place) if f.startswith("manifest-"))
        crc = os.path.join(place, f".{os.path.basename(path)}.crc")
        if os.path.exists(crc):
            os.remove(crc)
        with open(path, "r+") as file:
            file.truncate(20)
    stages, total = job(spark, source, folder)
    assert stages.found == ["double"] and stages.made == ["even", "sum"] and total == sum(range(0, 200, 4))


def test_a_stage_must_be_made_before_it_is_read(spark, tmp_path):
    with pytest.raises(ValueError):
        Stages(spark, str(tmp_path)).table("b", lambda: spark.range(1), reads=["a"])


def test_stages_are_discarded(spark, source, tmp_path):
    folder = str(tmp_path / "job")
    stages, _ = job(spark, source, folder)
    stages.discard("sum")
    assert sorted(os.listdir(folder)) == ["double", "even"]
    stages.discard()
    assert not os.path.exists(folder)


def test_stage_tables_are_released(spark):
    outside = stage.settle(spark.range(3))
    with pytest.raises(Stopped), stage.released():
        inside = stage.settle(spark.range(5))
        assert inside.count() == 5
        path = inside.inputFiles()[0].split(":", 1)[-1].replace("///", "/")
        assert os.path.exists(path)
        raise Stopped
    assert not os.path.exists(os.path.dirname(path)) and outside.count() == 3


def test_a_cache_is_released(spark):
    df = spark.range(7)
    with pytest.raises(Stopped), stage.cached(df) as kept:
        assert kept.count() == 7 and kept.storageLevel.useMemory
        raise Stopped
    assert not df.storageLevel.useMemory
