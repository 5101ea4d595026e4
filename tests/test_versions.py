"""Registers in versions: published at once, kept when a job fails, read as of a version."""

import datetime
import threading
from pathlib import Path

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from netaudit.plans import jobs
from netaudit.sinks import versions
from netaudit.sources.registers import read_register


def register(spark, *names):
    return spark.createDataFrame([(n, None) for n in names], "name string, `削除日` date")


def read(spark, root, name, version=None):
    return sorted(r.name for r in read_register(spark, f"{root}/{name}", "name string", version=version).collect())


def test_a_job_that_fails_midway_changes_nothing(spark, tmp_path):
    root, today = str(tmp_path), datetime.date(2025, 1, 1)
    first = {"users": register(spark, "a"), "assets": register(spark, "x", "y")}
    assert jobs.refresh_registers(first, "users", today, root) == 1
    # The first register of the second run is written whole, the next one dies in a task.
    dies = register(spark, "z").withColumn("name", F.when(F.col("name") == "z", F.raise_error(F.lit("lost"))).otherwise(F.col("name")))
    with pytest.raises(PySparkException):
        jobs.refresh_registers({"users": register(spark, "b", "c"), "assets": dies}, "users", today, root)
    assert versions.versions(spark, root) == [1]
    assert read(spark, root, "users") == ["a"] and read(spark, root, "assets") == ["x", "y"]
    assert jobs.refresh_registers({"users": register(spark, "b", "c"), "assets": register(spark)}, "users", today, root) == 2
    assert read(spark, root, "users") == ["b", "c"] and read(spark, root, "assets") == []
    assert read(spark, root, "users", 1) == ["a"] and read(spark, root, "assets", 1) == ["x", "y"]


def test_registers_of_other_jobs_stay(spark, tmp_path):
    root = str(tmp_path)
    versions.write_registers(spark, root, {"vpn": register(spark, "v")})
    versions.write_registers(spark, root + "/", {"deny": register(spark, "d")})
    assert set(versions.registers_of(spark, root)) == {"vpn", "deny"} and set(versions.registers_of(spark, root, 1)) == {"vpn"}
    assert read(spark, root, "vpn") == ["v"] and read(spark, root, "deny", 2) == ["d"]
    with pytest.raises(versions.NoSuchVersion):
        read(spark, root, "vpn", 9)


def test_a_folder_without_versions_is_read_as_it_is(spark, tmp_path):
    (tmp_path / "hand").mkdir()
    (tmp_path / "hand" / "a.json").write_text('{"name":"h"}\n')
    assert read(spark, tmp_path, "hand") == ["h"]
    versions.write_registers(spark, str(tmp_path), {"other": register(spark, "o")})
    assert read(spark, tmp_path, "hand") == ["h"]


def test_jobs_that_publish_at_once_keep_each_other(spark, tmp_path):
    root, failed = str(tmp_path), []

    def publish(i):
        try:
            versions.publish(spark, root, {f"r{i}": f"r{i}/v-{i}"})
        except Exception as error:
            failed.append(error)

    threads = [threading.Thread(target=publish, args=(i,)) for i in range(8)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    numbers = versions.versions(spark, root)
    assert not failed and numbers == list(range(1, len(numbers) + 1))
    # A taken number is seen whatever the timing.
    files = versions._Files(spark, root)
    assert files.create("{}", versions.MANIFESTS, f"{numbers[-1]:09d}.json") is False
    assert files.create("{}", versions.MANIFESTS, f"{numbers[-1] + 1:09d}.json") is True
    assert not [p for p in (tmp_path / versions.MANIFESTS).iterdir() if p.name.startswith(".") and not p.name.endswith(".crc")]


def test_one_of_many_gets_a_number(spark, tmp_path):
    files = versions._Files(spark, str(tmp_path))
    files.system.mkdirs(files.path(str(tmp_path), versions.MANIFESTS))
    for number in range(30):
        start, got = threading.Barrier(8), []

        def create(i):
            start.wait()
            got.append((i, files.create(f"{i}", versions.MANIFESTS, f"{number:09d}.json")))

        threads = [threading.Thread(target=create, args=(i,)) for i in range(8)]
        for t in threads:
            t.start()
        for t in threads:
            t.join()
        [first] = [i for i, made in got if made]
        assert len(got) == 8 and files.read(versions.MANIFESTS, f"{number:09d}.json") == f"{first}"


def test_a_number_taken_meanwhile_is_left(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    versions.publish(spark, root, {"a": "a/v-1"})
    known, real = [], versions.versions

    def late(session, path):
        found = real(session, path)
        if not known:
            known.append(versions.publish)
            monkeypatch.setattr(versions, "versions", real)
            versions.publish(session, path, {"b": "b/v-1"})  # another job, between reading and publishing
        return found

    monkeypatch.setattr(versions, "versions", late)
    assert versions.publish(spark, root, {"c": "c/v-1"}) == 3
    assert versions.registers_of(spark, root) == {"a": "a/v-1", "b": "b/v-1", "c": "c/v-1"}


def test_old_versions_are_removed(spark, tmp_path):
    root = str(tmp_path)
    for names in ("a", "b", "c"):
        versions.write_registers(spark, root, {"users": register(spark, names)})
    versions.write_registers(spark, root, {"other": register(spark, "o")})
    assert len(versions.remove_old(spark, root, 2)) == 2
    assert versions.versions(spark, root) == [3, 4] and len(list(Path(root, "users").iterdir())) == 1
    assert read(spark, root, "users") == ["c"] and read(spark, root, "users", 3) == ["c"]
    with pytest.raises(ValueError):
        versions.remove_old(spark, root, 0)
