"""Session settings and the one place where lineage is cut."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

#: Folder of each local application that names none, and the tables of the jobs now running.
_local_folders: dict[str, str] = {}
_jobs: list[list[str]] = []
_shipped: set[str] = set()


def local_session(cores: int | str = 8, shuffle_partitions: int = 8, app: str = "netaudit", checkpoint_dir: str | None = None) -> SparkSession:
    """Session for tests and the bench. On a cluster the caller brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.checkpoint.dir", checkpoint_dir or tempfile.mkdtemp(prefix="run-"))
        .getOrCreate()
    )


def scratch_folder(spark: SparkSession) -> str:
    """Shared folder for intermediate tables.

    The cluster names it in ``spark.checkpoint.dir``. Only a local session that names none
    gets a temporary folder, one per application.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if folder is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        application = spark.sparkContext.applicationId
        folder = _local_folders.setdefault(application, "") or tempfile.mkdtemp(prefix="run-")
        _local_folders[application] = folder
    return folder


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, once per application, for functions that run in Python there."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = Path(__file__).parent
    # Spark copies the file from the driver; executors do not see this folder.
    archive = Path(tempfile.mkdtemp(prefix="run-"), "netaudit-package.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for source in sorted(root.rglob("*.py")):
            out.write(source, f"{root.name}/{source.relative_to(root)}")
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)


@contextmanager
def job_tables(spark: SparkSession) -> Iterator[None]:
    """Own the intermediate tables made inside and remove them at the end, when the job's output is written."""
    _jobs.append([])
    try:
        yield
    finally:
        for path in _jobs.pop():
            place = spark._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def job_folder(spark: SparkSession, name: str = "netaudit") -> str:
    """A new path in the scratch folder; inside ``job_tables`` what is written there goes with its job."""
    path = f"{scratch_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    if _jobs:
        _jobs[-1].append(path)
    return path


def checkpointed(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Write ``df`` as a table in the scratch folder and read it back.

    Later steps start from the table: it survives lost executors, its size is known to the
    planner, and several readers share one run of what made it. Filters on the columns ``by``
    then read only their part. Inside ``job_tables`` the table goes with its job; otherwise it
    stays until the folder is emptied.
    """
    path = job_folder(df.sparkSession)
    # Rows of one folder are brought together, and large folders split again by size.
    (df.hint("rebalance", *by) if by else df).write.partitionBy(*by).option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
