"""Files whose names follow from what they hold, written by tasks and put in place together.

A Python data source with a commit in two phases: tasks write below a staging folder of the job
and report their files; when all have ended the driver renames the files to their names. If a
task fails for good the staging folder goes and nothing else has been touched.

``documents`` are files of one text each, under the name that the row gives. ``lines`` are lines
of many keys in files of bounded size, named by a hash of their bytes, so that a task run twice
makes the same files; an index tells for each key the files and ranges of bytes that hold it. So
the number of files follows the size of the lines, not the number of keys, and a key that holds a
large share of the lines is in many files.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.fs
import pyarrow.parquet
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from netaudit.session import ship_package
from netaudit.sinks.versions import publish, register_folder

#: Bytes at which a file of lines is closed, and ranges in one file of the index.
FILE_BYTES, INDEX_ROWS = 1 << 26, 1 << 20
#: Bytes of a file that are read at once.
READ_BYTES = 1 << 22
INDEX_SCHEMA = "key string, file string, first long, bytes long"
_INDEX = pa.schema([("key", pa.string()), ("file", pa.string()), ("first", pa.int64()), ("bytes", pa.int64())])


class Store:
    """Files below a root, which is a path or the address of a store."""

    def __init__(self, root: str):
        if re.match("[a-z0-9]+:", root):
            self.system, self.root = pa.fs.FileSystem.from_uri(re.sub("^file:/+", "file:///", root.rstrip("/")))
        else:
            self.system, self.root = pa.fs.LocalFileSystem(), root.rstrip("/")

    def place(self, name: str) -> str:
        return f"{self.root}/{name}"

    def exists(self, name: str) -> bool:
        return self.system.get_file_info(self.place(name)).type != pa.fs.FileType.NotFound

    def write(self, name: str, content: bytes) -> None:
        self.system.create_dir(self.place(name).rpartition("/")[0], recursive=True)
        with self.system.open_output_stream(self.place(name)) as out:
            out.write(content)

    def open(self, name: str) -> pa.NativeFile:
        return self.system.open_input_file(self.place(name))

    def move(self, name: str, to: str) -> None:
        self.system.create_dir(self.place(to).rpartition("/")[0], recursive=True)
        self.system.move(self.place(name), self.place(to))

    def remove(self, folder: str) -> None:
        if self.exists(folder):
            self.system.delete_dir(self.place(folder))


@dataclass
class Written(WriterCommitMessage):
    """Names of a task's files, each with its place in the staging folder."""

    files: list[tuple[str, str]] = field(default_factory=list)


class _Task:
    """Files of one attempt of a task."""

    def __init__(self, store: Store, staging: str):
        self.store, self.folder = store, f"{staging}/{uuid.uuid4().hex}"
        self.message = Written()

    def add(self, name: str, content: bytes) -> None:
        staged = f"{self.folder}/{len(self.message.files)}"
        self.store.write(staged, content)
        self.message.files.append((name, staged))

    def documents(self, batches: Iterator[pa.RecordBatch]) -> None:
        for batch in batches:
            for name, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if not name or "/" in name or name.startswith((".", "_")):
                    raise ValueError(f"no name of a file: {name!r}")
                self.add(name, (text or "").encode())

    def lines(self, batches: Iterator[pa.RecordBatch], file_bytes: int) -> None:
        """Lines of a key follow each other in the input of a task."""
        parts, size, ranges, index = [], 0, [], []

        def close_file() -> None:
            nonlocal parts, size, ranges
            content = b"".join(parts)
            name = f"{hashlib.sha256(content).hexdigest()[:32]}.txt"
            self.add(f"lines/{name}", content)
            index.extend((key, name, first, last - first) for key, first, last in ranges)
            parts, size, ranges = [], 0, []

        def close_index() -> None:
            table = pa.table([pa.array([row[i] for row in index], f.type) for i, f in enumerate(_INDEX)], schema=_INDEX)
            out = pa.BufferOutputStream()
            pa.parquet.write_table(table, out, compression="zstd")
            content = out.getvalue().to_pybytes()
            self.add(f"index/{hashlib.sha256(content).hexdigest()[:32]}.parquet", content)
            index.clear()

        for batch in batches:
            for key, line in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                content = f"{line or ''}\n".encode()
                if ranges and ranges[-1][0] == key:
                    ranges[-1] = key, ranges[-1][1], size + len(content)
                else:
                    ranges.append((key, size, size + len(content)))
                parts.append(content)
                size += len(content)
                if size >= file_bytes:
                    close_file()
                    if len(index) >= INDEX_ROWS:
                        close_index()
        if parts:
            close_file()
        if index:
            close_index()


class _Writer(DataSourceArrowWriter):
    def __init__(self, options):
        self.root, self.layout = options["path"], options["layout"]
        self.file_bytes, self.replace = int(options["file_bytes"]), options["replace"] == "true"
        self.staging = f".staging-{uuid.uuid4().hex}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        store = Store(self.root)
        task = _Task(store, self.staging)
        try:
            task.documents(iterator) if self.layout == "documents" else task.lines(iterator, self.file_bytes)
        except BaseException:
            store.remove(task.folder)
            raise
        return task.message

    def commit(self, messages: list[Written | None]) -> None:
        store = Store(self.root)
        store.system.create_dir(store.root, recursive=True)
        for message in messages:
            for name, staged in message.files if message else ():
                # Files of one hash are the same.
                if self.replace or not store.exists(name):
                    store.move(staged, name)
        store.remove(self.staging)

    def abort(self, messages: list[Written | None]) -> None:
        Store(self.root).remove(self.staging)


class NamedFiles(DataSource):
    """Writes two text columns: name and text of ``documents``, key and line of ``lines``."""

    @classmethod
    def name(cls) -> str:
        return "named_files"

    def writer(self, schema, overwrite: bool) -> _Writer:
        return _Writer(self.options)


def _write(rows: DataFrame, path: str, layout: str, file_bytes: int = FILE_BYTES, replace: bool = False) -> None:
    spark = rows.sparkSession
    ship_package(spark)
    spark.dataSource.register(NamedFiles)
    options = {"layout": layout, "file_bytes": str(file_bytes), "replace": str(replace).lower()}
    rows.write.format(NamedFiles.name()).mode("append").options(**options).save(path)


def write_documents(documents: DataFrame, path: str, replace: bool = False) -> None:
    """One file per row of ``name, text``, with this name; files that are there stay unless ``replace``.

    Meant for few documents, such as one per period.
    """
    _write(documents.select("name", "text"), path, "documents", replace=replace)


def write_keyed_lines(rows: DataFrame, key: str, line: str, order: list[str], path: str, file_bytes: int = FILE_BYTES) -> None:
    """Lines of many keys as a new version of ``path``, which replaces the last one at once.

    Rows are put in ranges of key and order, so that the lines of a key are together and those of
    a hot key in several ranges.
    """
    root, _, name = path.rstrip("/").rpartition("/")
    folder = f"{name}/v-{uuid.uuid4().hex}"
    by = [key, *order]
    ranges = rows.select(F.col(key).alias("key"), F.col(line).alias("line"), *[F.col(c).alias(f"o{i}") for i, c in enumerate(by)])
    places = [f"o{i}" for i in range(len(by))]
    ordered = ranges.repartitionByRange(*places).sortWithinPartitions(*places)
    _write(ordered.select("key", "line"), f"{root}/{folder}", "lines", file_bytes)
    publish(rows.sparkSession, root, {name: folder})


def line_index(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """Which bytes of which file hold lines of a key: ``key, file, first, bytes``."""
    folder = register_folder(spark, path, version)
    return spark.read.schema(INDEX_SCHEMA).option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true").parquet(folder)


def _cut(folder: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Lines of ranges ``key, file, first, bytes`` that come in the order of files and places."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store = Store(folder)
        for batch in batches:
            keys, names = batch.column(0), batch.column(1).to_pylist()
            first = batch.column(2).to_numpy()
            after = first + batch.column(3).to_numpy()
            for name, reads in groupby(_reads(names, first, after), lambda own: names[own.start]):
                with store.open(f"lines/{name}") as file:
                    for own in reads:
                        for content, start in _pieces(file, int(first[own.start]), int(after[own.stop - 1])):
                            texts, ends = _texts(content)
                            of_line = own.start + np.searchsorted(after[own], start + ends, side="right")
                            yield pa.RecordBatch.from_arrays([keys.take(pa.array(of_line)), texts], ["key", "line"])

    return run


def _reads(names: list[str], first: np.ndarray, after: np.ndarray) -> Iterator[slice]:
    """Ranges that follow each other without a gap in a file, up to the bytes that are read at once."""
    begin = 0
    for i in range(1, len(names) + 1):
        if i == len(names) or names[i] != names[begin] or first[i] != after[i - 1] or after[i] - first[begin] > READ_BYTES:
            yield slice(begin, i)
            begin = i


def _pieces(file: pa.NativeFile, first: int, after: int) -> Iterator[tuple[bytes, int]]:
    """Bytes from ``first`` to before ``after``, behind a line end, in pieces of whole lines, each with its place."""
    left = b""
    while first < after:
        read = file.read_at(min(READ_BYTES, after - first - len(left)), first + len(left))
        if not read:
            raise ValueError(f"lines end before byte {after}, which the index names")
        content = left + read
        whole = content.rfind(b"\n") + 1
        left = content[whole:]
        if whole:
            yield content[:whole], first
            first += whole


def _texts(content: bytes) -> tuple[pa.StringArray, np.ndarray]:
    """Lines without their ends, and where these are."""
    written = np.frombuffer(content, dtype=np.uint8)
    ends = np.flatnonzero(written == ord("\n"))
    offsets = np.concatenate(([0], ends - np.arange(len(ends)))).astype(np.int32)
    return pa.StringArray.from_buffers(len(ends), pa.py_buffer(offsets), pa.py_buffer(np.delete(written, ends))), ends


def read_keyed_lines(spark: SparkSession, path: str, keys: DataFrame | None = None, version: int | None = None) -> DataFrame:
    """``key, line`` of all keys, or of those in the one column of ``keys``: only the ranges that the index names are read.

    The ranges that begin in the same part of a file go to one task, which reads each byte once.
    """
    index = line_index(spark, path, version)
    if keys is not None:
        # By the size of a compressed table Spark may take the keys for few and broadcast them.
        index = index.join(keys.select(F.col(keys.columns[0]).alias("key")).distinct().hint("merge"), "key", "left_semi")
    ship_package(spark)
    # A number of parts, as the size of the index says little of the lines.
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    dealt = index.repartition(parts, "file", F.floor(F.col("first") / READ_BYTES)).sortWithinPartitions("file", "first")
    return dealt.select("key", "file", "first", "bytes").mapInArrow(_cut(register_folder(spark, path, version)), "key string, line string")
