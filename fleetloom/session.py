"""Sessions and the shared scratch folder."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_local_scratch: tempfile.TemporaryDirectory | None = None
_scopes = threading.local()


def local_session(cpus: str | int = "*", shuffle_partitions: int = 8, app: str = "fleetloom") -> SparkSession:
    """A session for tests and benchmarks on one machine; clusters bring their own."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        # Many small files per task; see the README for clusters.
        .config("spark.sql.files.openCostInBytes", str(64 * 1024))
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.driver.host", "127.0.0.1")
        .getOrCreate()
    )


def scratch_root(spark: SparkSession) -> str:
    """The shared folder for intermediate tables, as the cluster names it.

    Only a local session without that setting gets a folder of its own, which
    goes away with the Python process.
    """
    global _local_scratch
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        named_by_context = spark.sparkContext._jsc.sc().getCheckpointDir()
        named = named_by_context.get() if named_by_context.isDefined() else None
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        if _local_scratch is None:
            _local_scratch = tempfile.TemporaryDirectory(prefix="fleetloom-")
        named = _local_scratch.name
    return f"{named.rstrip('/')}/fleetloom/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def scratch_table(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    This cuts the lineage, so lost executors cost no recomputation beyond this
    point, and the planner knows the table's size on disk when it chooses joins.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    table._scratch_path = path
    for scope in getattr(_scopes, "open", [])[-1:]:
        scope.made.append(path)
    return table


class Scope:
    """The tables that ``scratch_table`` wrote since the scope was opened."""

    def __init__(self) -> None:
        self.made: list[str] = []
        self.kept: set[str] = set()

    def keep(self, table: DataFrame) -> DataFrame:
        """A table that is read after the scope has ended."""
        self.kept.add(table._scratch_path)
        return table


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[Scope]:
    """Delete the tables written inside at the end, but for those kept, which an outer scope takes over.

    Whatever is made of the others must have been written by then. Shuffle files that
    nothing refers to any more go too, as Spark looks for them only when it collects garbage.
    """
    if not hasattr(_scopes, "open"):
        _scopes.open = []
    scope = Scope()
    _scopes.open.append(scope)
    try:
        yield scope
    finally:
        _scopes.open.pop()
        for path in scope.made:
            if path not in scope.kept:
                _delete(spark, path)
        for outer in _scopes.open[-1:]:
            outer.made.extend(scope.kept)
        forget_shuffles(spark)


def forget_shuffles(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of queries that are over."""
    spark.sparkContext._jvm.System.gc()


def qualified(spark: SparkSession, path: str) -> str:
    """The path from the file system's root, without scheme and host."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(where).toUri().getPath().rstrip("/")


def qualified_uri(spark: SparkSession, path: str) -> str:
    """The path with its scheme, as Spark's sources give it."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(where).toString()


def move_folder(spark: SparkSession, path: str, target: str) -> None:
    """Give a folder another name; one that had it goes first."""
    where, there = (spark.sparkContext._jvm.org.apache.hadoop.fs.Path(p) for p in (path, target))
    system = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    system.delete(there, True)
    if not system.rename(where, there):
        raise OSError(f"could not rename {path} to {target}")


def path_exists(spark: SparkSession, pattern: str) -> bool:
    """True if a file or folder matches the pattern, wherever the path points."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(pattern)
    found = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(where)
    return found is not None and len(found) > 0


def _delete(spark: SparkSession, path: str) -> bool:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def release(*tables: DataFrame) -> None:
    """Delete what ``scratch_table`` wrote, once all that reads it has been written itself."""
    for table in tables:
        _delete(table.sparkSession, table._scratch_path)


def drop_scratch(spark: SparkSession) -> bool:
    """Delete every intermediate table this application wrote."""
    return _delete(spark, scratch_root(spark))
