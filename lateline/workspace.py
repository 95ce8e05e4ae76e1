"""Session settings and the shared place for tables a job writes and reads again."""

from __future__ import annotations

import tempfile
import threading
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


#: Used where the session doesn't say otherwise. A task that sorts or groups what it reads holds it in memory, so splits are
#: smaller than Spark's 128 MB; stored tables are zstd, smaller by a third than with snappy.
PREFERRED = {"spark.sql.files.maxPartitionBytes": str(32 << 20), "spark.sql.parquet.compression.codec": "zstd"}


def configure(spark: SparkSession) -> SparkSession:
    """The settings every job here relies on: UTC wall clock, nanosecond columns as longs, adaptive plans; and those it
    prefers, unless the session has others."""
    for key, value in {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.legacy.parquet.nanosAsLong": "true",
        "spark.sql.adaptive.enabled": "true",
        **{key: spark.conf.get(key, value) for key, value in PREFERRED.items()},
    }.items():
        spark.conf.set(key, value)
    return spark


_local_root: tempfile.TemporaryDirectory | None = None


def shared_root(spark: SparkSession) -> str:
    """The shared folder the cluster names; a temporary one only in local mode, where there is a single machine."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    global _local_root
    if _local_root is None:
        _local_root = tempfile.TemporaryDirectory(prefix="lateline-")
    return _local_root.name


def _located(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def path_exists(spark: SparkSession, path: str) -> bool:
    files, target = _located(spark, path)
    return files.exists(target)


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders right below a path."""
    files, target = _located(spark, path)
    return sorted(f.getPath().getName() for f in files.listStatus(target) if f.isDirectory()) if files.exists(target) else []


def delete(spark: SparkSession, path: str) -> None:
    files, target = _located(spark, path)
    files.delete(target, True)


def files(spark: SparkSession, path: str) -> list[str]:
    """Names of the files right below a path."""
    system, target = _located(spark, path)
    return sorted(f.getPath().getName() for f in system.listStatus(target) if f.isFile()) if system.exists(target) else []


def write_file(spark: SparkSession, path: str, text: str) -> None:
    """A small file that is there whole or not at all: written under another name, then renamed."""
    system, target = _located(spark, path)
    _, draft = _located(spark, f"{target.getParent()}/.{target.getName()}.draft")
    system.mkdirs(target.getParent())
    out = system.create(draft, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    if not system.rename(draft, target):
        raise OSError(f"can't write {path}")


def read_file(spark: SparkSession, path: str) -> str:
    return spark.read.option("wholetext", True).text(path).first()[0]


def _aside(spark: SparkSession, goal):
    """Where the old content of a folder waits while the new one moves in; readers of the parent don't see it."""
    return _located(spark, f"{goal.getParent()}/_old-{goal.getName()}")[1]


def settle_folder(spark: SparkSession, target: str) -> None:
    """Removes the old content that a replacement which broke off at its very end has left."""
    system, goal = _located(spark, target)
    system.delete(_aside(spark, goal), True)


def replace_folder(spark: SparkSession, staged: str, target: str) -> None:
    """Puts a staged folder in the place of another one. File systems rename; object stores copy."""
    system, source = _located(spark, staged)
    _, goal = _located(spark, target)
    old = _aside(spark, goal)
    system.mkdirs(goal.getParent())
    system.delete(old, True)
    if system.exists(goal) and not system.rename(goal, old):
        raise OSError(f"can't move {target} aside")
    if not system.rename(source, goal):
        system.rename(old, goal)
        raise OSError(f"can't move {staged} to {target}")
    system.delete(old, True)


def stored_bytes(spark: SparkSession, *paths: str) -> int:
    """Size of files or folders, from the file system's own summary; missing ones have none."""
    found = [_located(spark, path) for path in paths]
    return sum(files.getContentSummary(target).getLength() for files, target in found if files.exists(target))


@contextmanager
def sized_shuffles(spark: SparkSession, input_bytes: int, per_partition: int = 256 << 20) -> Iterator[int]:
    """Shuffle partitions to suit the input while a job runs: at least what the session has, and as before afterwards.

    Adaptive plans merge partitions that turn out small but cannot cut finer than they began, so the default of 200
    would leave half a terabyte to each reducer of a 100 TB shuffle.
    """
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    spark.conf.set(key, max(int(before), -(-input_bytes // per_partition)))
    try:
        yield int(spark.conf.get(key))
    finally:
        spark.conf.set(key, before)


#: Spark's setting to remove the shuffle files of a query at its end; older versions don't look at it.
REMOVE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Queries that run in here leave no shuffle files, which otherwise stay until the driver collects its garbage."""
    before = spark.conf.get(REMOVE_SHUFFLES, None)
    spark.conf.set(REMOVE_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.unset(REMOVE_SHUFFLES) if before is None else spark.conf.set(REMOVE_SHUFFLES, before)


class Workspace:
    """Tables of one application, each written once to shared storage and read back from there.

    Reading back cuts the lineage: a lost executor costs a re-read, not a re-run of the steps before, and later
    steps see column statistics, pruned columns and exact sizes instead of a long plan.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{shared_root(spark)}/lateline/{spark.sparkContext.applicationId}/{name}"
        self._written: set[str] = set()
        self._tables: dict[str, DataFrame] = {}
        self._lock = threading.RLock()

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def once(self, name: str, write: Callable[[str], None]) -> str:
        """The path of a table, written by the first caller; others wait for it."""
        with self._lock:
            if name not in self._written:
                with shuffles_removed(self.spark):  # what comes after reads the stored table
                    write(self.path(name))
                self._written.add(name)
        return self.path(name)

    def table(self, name: str, build: Callable[[], DataFrame], **options: str) -> DataFrame:
        """``options`` are those of the writer."""
        with self._lock:
            if name not in self._tables:
                model = build()
                path = self.once(name, lambda path: model.write.mode("overwrite").options(**options).parquet(path))
                self._tables[name] = self.spark.read.schema(model.schema).parquet(path)
            return self._tables[name]
