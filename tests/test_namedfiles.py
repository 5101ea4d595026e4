"""Files named by their content: one commit, bounded number, ranges of a key by the index."""

import hashlib
import random
import time
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from netaudit.registry import files
from netaudit.sinks import namedfiles, versions


def keyed(spark, n=3000):
    rng = random.Random(5)
    rows = [("hot" if rng.random() < 0.4 else rng.choice([None, "a/b=c", *(f"k{i}" for i in range(400))]), f"line {i} é", i) for i in range(n)] + [("empty", None, 0), ("", "of no key", 0)]
    return rows, spark.createDataFrame(rows, "k string, l string, i int").repartition(7)


def test_lines_are_read_back_by_key(spark, tmp_path):
    rows, df = keyed(spark)
    path = str(tmp_path / "found")
    namedfiles.write_keyed_lines(df, "k", "l", ["i"], path, file_bytes=2000)
    want = Counter((k, l or "") for k, l, _ in rows)
    assert Counter(map(tuple, namedfiles.read_keyed_lines(spark, path).collect())) == want
    some = spark.createDataFrame([("hot",), ("k7",), ("none",), ("a/b=c",), ("",)], "x string")
    got = Counter(map(tuple, namedfiles.read_keyed_lines(spark, path, some).collect()))
    assert got == Counter({r: n for r, n in want.items() if r[0] in ("hot", "k7", "a/b=c", "")})


def test_a_file_of_many_ranges_is_not_copied_for_each(spark, tmp_path):
    """Cutting each of 30,000 ranges out of a copy of the file of 36 MB takes minutes, reading it once a moment."""
    path = str(tmp_path / "found")
    key = F.concat(F.lit("k"), F.lpad(F.col("id").cast("string"), 6, "0"))
    rows = spark.range(30000).select(key.alias("k"), F.concat(key, F.repeat(F.lit("x"), 1200)).alias("l"))
    namedfiles.write_keyed_lines(rows.coalesce(1), "k", "l", ["l"], path, file_bytes=1 << 30)
    began = time.monotonic()
    found = namedfiles.read_keyed_lines(spark, path)
    counts = found.agg(F.count("*"), F.count_if(F.startswith("line", F.col("key")) & (F.length("line") == 1207)), F.count_distinct("key")).first()
    assert tuple(counts) == (30000,) * 3
    assert time.monotonic() - began < 20


def test_each_named_byte_is_read_once(spark, tmp_path, monkeypatch):
    rows, df = keyed(spark)
    path = str(tmp_path / "found")
    namedfiles.write_keyed_lines(df, "k", "l", ["i"], path, file_bytes=2000)
    index = namedfiles.line_index(spark, path).filter("key in ('hot', 'k7', 'k8', 'empty', '') or key is null").orderBy("file", "first").toArrow()
    read, places = [], namedfiles.Store.open

    class Counted:
        def __init__(self, file):
            self.file = file

        def __enter__(self):
            return self

        def __exit__(self, *_):
            self.file.close()

        def read_at(self, n, at):
            read.append(n)
            return self.file.read_at(n, at)

    monkeypatch.setattr(namedfiles, "READ_BYTES", 100)
    monkeypatch.setattr(namedfiles.Store, "open", lambda store, name: Counted(places(store, name)))
    cut = namedfiles._cut(versions.register_folder(spark, path))(iter(index.to_batches(max_chunksize=5)))
    got = Counter((k, l) for b in cut for k, l in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True))
    assert got == Counter((k, l or "") for k, l, _ in rows if k in ("hot", "k7", "k8", "empty", "", None))
    assert sum(read) == sum(index["bytes"].to_pylist()) and max(read) <= 100


def test_a_file_that_ends_too_early_is_an_error(spark, tmp_path):
    _, df = keyed(spark)
    path = str(tmp_path / "found")
    namedfiles.write_keyed_lines(df, "k", "l", ["i"], path)
    file = max(tmp_path.rglob("*.txt"), key=lambda p: p.stat().st_size)
    file.write_bytes(file.read_bytes()[:-30])
    (file.parent / f".{file.name}.crc").unlink(missing_ok=True)
    with pytest.raises(Exception, match="lines end before byte"):
        namedfiles.read_keyed_lines(spark, path).collect()


def test_files_are_few_and_named_by_content(spark, tmp_path):
    rows, df = keyed(spark)
    path = str(tmp_path / "found")
    namedfiles.write_keyed_lines(df, "k", "l", ["i"], path, file_bytes=2000)
    files = list(tmp_path.rglob("*.txt"))
    assert all(p.stem == hashlib.sha256(p.read_bytes()).hexdigest()[:32] for p in files)
    size = sum(p.stat().st_size for p in files)
    assert size / 2000 <= len(files) <= size / 2000 + spark.sparkContext.defaultParallelism + 8 < 400
    # The lines of the hot key are in several files, those of a file in order.
    index = namedfiles.line_index(spark, path)
    assert index.filter("key = 'hot'").select("file").distinct().count() > 3
    assert not list(tmp_path.rglob(".staging-*"))


def test_a_task_that_fails_leaves_nothing(spark, tmp_path):
    _, df = keyed(spark)
    path = str(tmp_path / "found")
    namedfiles.write_keyed_lines(df.limit(10), "k", "l", ["i"], path)
    before = sorted(p for p in tmp_path.rglob("*"))
    dies = df.withColumn("l", F.when(F.col("i") == 1500, F.raise_error(F.lit("lost"))).otherwise(F.col("l")))
    with pytest.raises(Exception, match="lost"):
        namedfiles.write_keyed_lines(dies, "k", "l", ["i"], path, file_bytes=500)
    assert [p for p in sorted(tmp_path.rglob("*")) if p.is_file()] == [p for p in before if p.is_file()]
    assert namedfiles.read_keyed_lines(spark, path).count() == 10


def test_documents_have_their_names_and_stay(spark, tmp_path):
    path = str(tmp_path / "records")
    texts = spark.createDataFrame([("記録 202501.md", "一\n二"), ("b c.md", None)], "name string, text string")
    namedfiles.write_documents(texts, path)
    assert {p.name: p.read_text() for p in Path(path).iterdir()} == {"記録 202501.md": "一\n二", "b c.md": ""}
    namedfiles.write_documents(texts.withColumn("text", F.lit("new")), path)
    assert Path(path, "b c.md").read_text() == ""
    namedfiles.write_documents(texts.withColumn("text", F.lit("new")), path, replace=True)
    assert Path(path, "b c.md").read_text() == "new"
    with pytest.raises(Exception, match="no name of a file"):
        namedfiles.write_documents(spark.createDataFrame([("ok.md", "x"), ("../out.md", "x")], "name string, text string").coalesce(1), path)
    assert sorted(p.name for p in Path(path).iterdir()) == ["b c.md", "記録 202501.md"]


def test_no_lines(spark, tmp_path):
    _, df = keyed(spark, 1)
    path = str(tmp_path / "found")
    namedfiles.write_keyed_lines(df.limit(0), "k", "l", ["i"], path)
    assert namedfiles.read_keyed_lines(spark, path).count() == 0


def test_a_large_file_is_sorted_in_ranges(spark, tmp_path, monkeypatch):
    """No task sorts more than a range; the file holds all lines in order, and small files stand beside it."""
    merged = []
    in_one = files._in_one
    monkeypatch.setattr(files, "RANGE_ROWS", 100)
    monkeypatch.setattr(files, "_in_one", lambda spark, parts, *rest: merged.append(len(parts)) or in_one(spark, parts, *rest))
    name = F.when(F.col("id") == 500, "a/b c.txt").otherwise("large.txt")
    line = F.when(F.col("id") != 7, F.concat(F.lit("lineä\r "), F.col("id")))
    rows = spark.range(1000).repartition(7).select(name.alias("file"), F.lit(0).cast("long").alias("chunk"), F.col("id").alias("pos"), line.alias("line"))
    files.write_files(rows, str(tmp_path / "out"))
    wanted = ["" if i == 7 else f"lineä\r {i}" for i in range(1000) if i != 500]
    assert (tmp_path / "out" / "large.txt").read_bytes().decode().split("\n") == [*wanted, ""]
    assert (tmp_path / "out" / "a" / "b c.txt").read_bytes().decode() == "lineä\r 500\n"
    assert merged and merged[0] >= 8
    plain = rows.filter("line is not null").withColumn("line", F.replace("line", F.lit("\r")))
    files.write_files(plain, str(tmp_path / "wide"), "UTF-16")
    assert (tmp_path / "wide" / "large.txt").read_bytes().decode("UTF-16").split("\n") == [*[w.replace("\r", "") for w in wanted if w], ""]
