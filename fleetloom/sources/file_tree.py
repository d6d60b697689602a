"""Trees of files: listed folder by folder in tasks, and written one file per name.

Spark's own file sources leave out files of zero bytes and keep every file's name in the
driver, and its writers choose the file names. Here tasks list folders, so every file of a
tree is a row, tasks open the files of their rows, and a data source writes rows to the file
that each row names. All open the file system that a path's scheme names: local, HDFS or an
object store.
"""

from __future__ import annotations

import functools
import hashlib
import itertools
import os
import sys
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.types import StructType

from fleetloom.functions.paths import glob_literal
from fleetloom.session import path_exists, qualified_uri, scratch_path, scratch_table

_LISTED = "path string, is_folder boolean, length bigint, modified timestamp"
NAMED_ROWS = "src_file string, name string, row_no bigint, line string, content binary, copy_of string, error string"
# Of a folder's names, and of a file's bytes.
_LISTED_AT_ONCE = 20_000
_READ_AT_ONCE = 8 << 20

# What one task opens, so there are neither millions of tasks nor very long ones.
FILES_PER_TASK = 2_000
BYTES_PER_TASK = 64 << 20


def place(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path as Spark names it, and the path there."""
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri.removeprefix("file:").lstrip("/")
    if "://" not in uri:
        return fs.LocalFileSystem(), uri
    scheme, rest = uri.split("://", 1)
    authority, _, path = rest.partition("/")
    system, root = fs.FileSystem.from_uri(f"{scheme}://{authority}/")
    return system, f"{root.rstrip('/')}/{path}"


def pieces(uri: str) -> Iterator[bytes]:
    """A file's bytes as they stand there, also those of a compressed one, a piece at a time."""
    system, path = place(uri)
    with system.open_input_stream(path, compression=None) as file:
        while some := file.read(_READ_AT_ONCE):
            yield some


def whole_content(uri: str) -> pa.Buffer:
    system, path = place(uri)
    with system.open_input_stream(path, compression=None) as file:
        return file.read_buffer()


def _entries(folder: str) -> Iterator[list[fs.FileInfo]]:
    """What a folder holds, a part at a time; a store gives its listing whole."""
    system, path = place(folder)
    if not isinstance(system, fs.LocalFileSystem):
        found = system.get_file_info(fs.FileSelector(path, allow_not_found=True))
        yield from (found[i : i + _LISTED_AT_ONCE] for i in range(0, len(found), _LISTED_AT_ONCE))
        return
    try:
        inside = os.scandir(path)
    except FileNotFoundError:
        return
    with inside:
        names = (f"{path}/{x.name}" for x in inside)
        while some := list(itertools.islice(names, _LISTED_AT_ONCE)):
            found = [x for x in system.get_file_info(some) if x.type != fs.FileType.NotFound]
            # A linked folder may lead back up.
            yield [x for x in found if not (x.type == fs.FileType.Directory and os.path.islink(x.path))]


def _list_folders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for folder in batch.column("path").to_pylist():
            for found in _entries(folder):
                # As Spark does, names that start with a dot or an underscore are left out.
                found = [x for x in found if x.base_name[:1] not in "._"]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([f"{folder}/{x.base_name}" for x in found], pa.string()),
                        pa.array([x.type == fs.FileType.Directory for x in found], pa.bool_()),
                        pa.array([x.size or 0 for x in found], pa.int64()),
                        pa.array([x.mtime_ns // 1000 if x.mtime_ns else None for x in found], pa.int64()).cast(pa.timestamp("us", "UTC")),
                    ],
                    names=["path", "is_folder", "length", "modified"],
                )


def list_folders(folders: DataFrame) -> DataFrame:
    """What the folders (path) hold: path, is_folder, length, modified; nothing below them."""
    tasks = folders.sparkSession.sparkContext.defaultParallelism
    return folders.select("path").repartition(tasks, "path").mapInArrow(_list_folders, _LISTED)


def list_files(spark: SparkSession, folder: str) -> DataFrame:
    """Every file below ``folder``, also of zero bytes: path, length, modified.

    Paths are those that Spark's sources give. A round lists all folders of one depth, spread
    over the tasks; a folder that is gone by then holds nothing, and names that start
    with a dot or an underscore are left out.
    """
    waiting = spark.createDataFrame([(qualified_uri(spark, folder).rstrip("/"),)], "path string")
    rounds = []
    while True:
        rounds.append(scratch_table(list_folders(waiting), "listing"))
        waiting = rounds[-1].where("is_folder").select("path")
        if waiting.isEmpty():
            return functools.reduce(DataFrame.union, rounds).where("not is_folder").select("path", "length", "modified")


def spread_files(files: DataFrame) -> DataFrame:
    """``files`` (path, length, and other columns) dealt out to the tasks that open them.

    Their number follows from how many files there are and how long they are together; only
    these two numbers reach the driver.
    """
    number, size = files.agg(F.count(F.lit(1)), F.coalesce(F.sum("length"), F.lit(0))).first()
    tasks = max(files.sparkSession.sparkContext.defaultParallelism, -(-number // FILES_PER_TASK), -(-size // BYTES_PER_TASK))
    return files.repartition(tasks, "path")


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        paths, digests = batch.column("path").to_pylist(), []
        for path in paths:
            digest = hashlib.md5(usedforsecurity=False)
            for some in pieces(path):
                digest.update(some)
            digests.append(digest.hexdigest())
        yield pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(digests, pa.string())], ["path", "digest"])


def file_digests(files: DataFrame) -> DataFrame:
    """path and digest (MD5 of the content, also of none) of every one of the files (path, length)."""
    return spread_files(files.select("path", "length")).select("path").mapInArrow(_digests, "path string, digest string")


def _runs(name: pa.Array) -> list[tuple[int, int]]:
    """Where the stretches of equal names begin and end."""
    changes = pc.indices_nonzero(pc.not_equal(name.slice(1), name.slice(0, len(name) - 1))).to_numpy() + 1
    edges = [0, *changes.tolist(), len(name)]
    return list(zip(edges[:-1], edges[1:], strict=True))


class _TreeWriter(DataSourceArrowWriter):
    """Every task writes to a folder of its own and, once done, moves its files to a common one.

    The common one takes the target's name when all tasks are done: before that nothing can
    be seen there, and a failed task or job leaves nothing. A task that runs again replaces
    what it had moved. What became of each file is written beside the tree, a table that
    takes its place in the same way.
    """

    def __init__(self, target: str, outcomes: str):
        folder, _, name = target.rstrip("/").rpartition("/")
        self.target, self.outcomes = target.rstrip("/"), outcomes
        self.staging = f"{folder}/_staging-{name}-{uuid.uuid4().hex}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        system, staging = place(self.staging)
        own, out = f"{staging}/task-{uuid.uuid4().hex}", None
        files: dict[str, list] = {}  # name: src_file, rows, error; of this task only
        folders: set[str] = set()

        def made(path: str) -> str:
            """The path, whose folder is made once."""
            folder = path.rpartition("/")[0]
            if folder not in folders:
                system.create_dir(folder, recursive=True)
                folders.add(folder)
            return path

        current = None
        try:
            for batch in iterator:
                if not batch.num_rows:
                    continue
                # Once a batch, as a batch holds many short files.
                columns = {c: batch.column(c) for c in batch.schema.names}
                edges = _runs(columns["name"])
                firsts = pa.array([first for first, _ in edges])
                names, sources, errors = (columns[c].take(firsts).to_pylist() for c in ("name", "src_file", "error"))
                numbered = np.concatenate([[0], np.cumsum(pc.fill_null(pc.greater_equal(columns["row_no"], 0), False).to_numpy(zero_copy_only=False))])
                lines, contents, copies = (columns[c] if columns[c].null_count < batch.num_rows else None for c in ("line", "content", "copy_of"))
                for (first, last), name, source, error in zip(edges, names, sources, errors, strict=True):
                    if name != current:
                        if name in files:
                            raise ValueError(f"the rows of {name} do not stand together")
                        if out is not None:
                            out.close()
                        current, out = name, None
                        files[name] = [source, 0, error]
                        if error is None:
                            out = system.open_output_stream(made(f"{own}/{name}"), compression=None)
                    files[name][1] += int(numbered[last] - numbered[first])
                    if out is None:
                        continue
                    for content in contents.slice(first, last - first).drop_null() if contents is not None else ():
                        out.write(content.as_buffer())
                    for copied_from in copies.slice(first, last - first).drop_null().to_pylist() if copies is not None else ():
                        for some in pieces(copied_from):
                            out.write(some)
                    text = [x for x in lines.slice(first, last - first).to_pylist() if x is not None] if lines is not None else []
                    if text:
                        out.write(("\n".join(text) + "\n").encode())
        finally:
            if out is not None:
                out.close()
        for name, (_, _, error) in files.items():
            if error is None:
                system.move(f"{own}/{name}", made(f"{staging}/all/{name}"))
        if files:
            self._note(files, f"part-{TaskContext.get().partitionId()}.parquet")
        return WriterCommitMessage()

    def _note(self, files: dict[str, list], part: str) -> None:
        system, folder = place(f"{self.staging}/outcomes")
        system.create_dir(folder, recursive=True)
        columns = list(zip(*[(source, name, rows, error) for name, (source, rows, error) in files.items()], strict=True))
        types = (pa.string(), pa.string(), pa.int64(), pa.string())
        table = pa.table([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["src_file", "name", "rows", "error"])
        pq.write_table(table, f"{folder}/_{part}", filesystem=system)
        system.move(f"{folder}/_{part}", f"{folder}/{part}")

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        system, staging = place(self.staging)
        for made, target in ((f"{staging}/outcomes", self.outcomes), (f"{staging}/all", self.target)):
            system.create_dir(made, recursive=True)
            system.create_dir(place(target)[1].rpartition("/")[0], recursive=True)
            system.move(made, place(target)[1])
        system.delete_dir(staging)

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        system, staging = place(self.staging)
        if system.get_file_info(staging).type != fs.FileType.NotFound:
            system.delete_dir(staging)


class NamedFiles(DataSource):
    """Sink of named files; see ``write_named_files``."""

    @classmethod
    def name(cls) -> str:
        return "fleetloom_named_files"

    def schema(self) -> str:
        return NAMED_ROWS

    def writer(self, schema, overwrite: bool) -> DataSourceArrowWriter:
        return _TreeWriter(self.options["path"], self.options["outcomes"])


def write_named_files(rows: DataFrame, path: str) -> DataFrame:
    """Write each row to the file below the new folder ``path`` that it names.

    ``rows`` has ``name`` (a path below the folder), ``row_no`` and ``line``, or ``content``
    (bytes), or ``copy_of``, a file whose bytes are taken; a row with none of them makes an
    empty file, and one with an ``error`` none. Columns that are not there are null. Rows of
    one name stand next to each other in one partition, in order: as a task that parses
    whole files gives them, or after ``in_files``.

    Returns, without another look at the rows, src_file, name, rows (those numbered from
    0) and error of every file.
    """
    spark = rows.sparkSession
    path, outcomes = qualified_uri(spark, path), qualified_uri(spark, scratch_path(spark, "outcomes"))
    if path_exists(spark, glob_literal(path)):
        raise FileExistsError(path)
    spark.dataSource.register(NamedFiles)
    columns = [F.col(f.name) if f.name in rows.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in StructType.fromDDL(NAMED_ROWS)]
    rows.select(*columns).write.format(NamedFiles.name()).mode("append").option("outcomes", outcomes).save(path)
    return spark.read.schema("src_file string, name string, rows bigint, error string").parquet(outcomes)


def in_files(rows: DataFrame) -> DataFrame:
    """``rows`` of named files, brought together by name and sorted by ``row_no``."""
    return rows.repartition("name").sortWithinPartitions("name", "row_no")


# Executors need not have this package installed: the lister and the writer travel with the plan.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
