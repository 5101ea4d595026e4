"""Registers of a folder in versions that replace each other at once.

A register is written to a folder of its own. What the folder's registers are is said by
manifests ``_versions/<number>.json``, each a whole map of names to folders. A job writes all it
has and publishes one manifest last, by a rename (on a local disk a link) that fails if the number is taken; then it takes
the next number and keeps what the other job published. So a job that dies leaves the registers
as they were, readers see all registers of a job or none, and older versions can be read.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession

MANIFESTS = "_versions"


class NoSuchVersion(ValueError):
    pass


def _split(path: str) -> tuple[str, str]:
    root, _, name = path.rstrip("/").rpartition("/")
    return root, name


class _Files:
    """The file system of a path, by Spark's own classes, so that any store that Spark reads will do."""

    def __init__(self, spark: SparkSession, root: str):
        self.jvm, self.gateway = spark._jvm, spark.sparkContext._gateway
        self.root = root
        self.configuration = spark._jsc.hadoopConfiguration()
        self.system = self.path(root).getFileSystem(self.configuration)

    def path(self, *parts: str):
        return self.jvm.org.apache.hadoop.fs.Path("/".join(parts))

    def names(self, folder: str) -> list[str]:
        place = self.path(self.root, folder) if folder else self.path(self.root)
        return sorted(s.getPath().getName() for s in self.system.listStatus(place)) if self.system.exists(place) else []

    def read(self, *parts: str) -> str:
        stream = self.system.open(self.path(self.root, *parts))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def create(self, text: str, *parts: str) -> bool:
        """Put a file with its whole content in its place, unless there is one."""
        made, wanted = self.path(self.root, MANIFESTS, f".{uuid.uuid4().hex}"), self.path(self.root, *parts)
        stream = self.system.create(made, True)
        stream.write(text.encode())
        stream.close()
        if self._linked(made, wanted):
            self.system.delete(made, False)
            return True
        context = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(wanted.toUri(), self.configuration)
        no_options = self.gateway.new_array(getattr(self.jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
        try:
            # Without an option a rename does not replace.
            context.rename(self.system.makeQualified(made), self.system.makeQualified(wanted), no_options)
            return True
        except Exception:
            self.system.delete(made, False)
            if self.system.exists(wanted):
                return False
            raise

    def _linked(self, made, wanted) -> bool:
        """Whether a local file got a second name that was free. A local rename looks if it is and then replaces what came meanwhile."""
        if self.system.getUri().getScheme() != "file":
            return False
        places = [self.jvm.java.io.File(self.system.makeQualified(p).toUri().getPath()).toPath() for p in (wanted, made)]
        try:
            self.jvm.java.nio.file.Files.createLink(*places)
            return True
        except Exception:
            return False


def versions(spark: SparkSession, root: str) -> list[int]:
    """Numbers of the published versions, ascending."""
    names = _Files(spark, root).names(MANIFESTS)
    return [int(n.removesuffix(".json")) for n in names if n.endswith(".json") and not n.startswith(".")]


def _manifest(files: _Files, number: int, part: str = "registers") -> dict[str, str]:
    return json.loads(files.read(MANIFESTS, f"{number:09d}.json"))[part]


def registers_of(spark: SparkSession, root: str, version: int | None = None) -> dict[str, str]:
    """Folders of the registers below ``root`` by name, of the last version or of ``version``; empty if there is none."""
    known = versions(spark, root)
    if version is not None and version not in known:
        raise NoSuchVersion(f"{root} has no version {version}")
    if not known:
        return {}
    return _manifest(_Files(spark, root), known[-1] if version is None else version)


def notes_of(spark: SparkSession, root: str) -> dict[str, str]:
    """What the jobs noted about the registers of the last version, by name."""
    known = versions(spark, root)
    return _manifest(_Files(spark, root), known[-1], "notes") if known else {}


def register_folder(spark: SparkSession, path: str, version: int | None = None) -> str:
    """Folder that holds the register ``path``; itself where no version names it, as for files put there by hand."""
    root, name = _split(path)
    folder = registers_of(spark, root, version).get(name) if root else None
    return path if folder is None else f"{root}/{folder}"


def publish(spark: SparkSession, root: str, folders: Mapping[str, str], notes: Mapping[str, str] | None = None) -> int:
    """Make ``folders`` the registers of their names, the others staying, and give the version's number.

    ``notes`` by name say something about the registers, such as what they were made from.
    """
    files = _Files(spark, root)
    files.system.mkdirs(files.path(root, MANIFESTS))
    while True:
        known = versions(spark, root)
        number = known[-1] + 1 if known else 1
        whole = (_manifest(files, known[-1]) if known else {}) | dict(folders)
        noted = (_manifest(files, known[-1], "notes") if known else {}) | dict(notes or {})
        manifest = {"version": number, "changed": sorted(folders), "registers": whole, "notes": noted}
        text = json.dumps(manifest, ensure_ascii=False, sort_keys=True)
        if files.create(text, MANIFESTS, f"{number:09d}.json"):
            return number


def write_registers(
    spark: SparkSession, root: str, registers: Mapping[str, DataFrame], fmt: str = "json",
    then: Callable[[], Mapping[str, DataFrame]] = dict,
) -> int:
    """Write registers, then those that ``then`` makes, such as counts of the first, and publish all together; the version's number."""
    root = root.rstrip("/")
    folders = {}
    for made in (registers.items, lambda: then().items()):
        for name, register in made():
            folders[name] = f"{name}/v-{uuid.uuid4().hex}"
            register.write.format(fmt).save(f"{root}/{folders[name]}")
    return publish(spark, root, folders)


def remove_old(spark: SparkSession, root: str, keep: int) -> list[str]:
    """Drop all but the last ``keep`` versions and the folders that none of these names; those folders.

    Not while a job writes below ``root``: its folders are not named yet.
    """
    root = root.rstrip("/")
    files, known = _Files(spark, root), versions(spark, root)
    kept = known[-keep:] if keep else []
    if not kept:
        raise ValueError("at least the last version stays")
    used = {folder for number in kept for folder in _manifest(files, number).values()}
    for number in known[:-keep]:
        files.system.delete(files.path(root, MANIFESTS, f"{number:09d}.json"), False)
    removed = []
    for name in files.names(""):
        places = [name] if name.startswith("v-") else [f"{name}/{f}" for f in files.names(name) if f.startswith("v-")] if name != MANIFESTS else []
        for place in places:
            if place not in used:
                files.system.delete(files.path(root, place), True)
                removed.append(place)
    return removed
