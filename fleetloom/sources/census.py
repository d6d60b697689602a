"""What columns the files of a folder have, read from footers and header lines in tasks."""

from __future__ import annotations

import csv
import io
import sys
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetloom.functions import paths
from fleetloom.session import qualified_uri
from fleetloom.sources.file_tree import list_files, list_folders, place

HEADERS = "src_file string, columns array<string>, types array<string>, rows bigint, error string"
# Files whose headers one Arrow batch of a task's output holds.
_FILES_PER_BATCH = 1000


def _parquet_header(uri: str) -> tuple[list[str], list[str], int]:
    system, path = place(uri)
    with system.open_input_file(path) as file:
        footer = pq.read_metadata(file)
    schema = footer.schema.to_arrow_schema()
    return schema.names, [str(t) for t in schema.types], footer.num_rows


def _csv_header(uri: str) -> tuple[list[str], None, None]:
    system, path = place(uri)
    with system.open_input_stream(path) as file:
        csv.field_size_limit(sys.maxsize)
        return next(csv.reader(io.TextIOWrapper(file, "utf-8-sig", newline="")), []), None, None


def _headers(format: str):
    read = {"parquet": _parquet_header, "csv": _csv_header}[format]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            uris = batch.column("path").to_pylist()
            for first in range(0, len(uris), _FILES_PER_BATCH):
                made = []
                for uri in uris[first : first + _FILES_PER_BATCH]:
                    try:
                        made.append((uri, *read(uri), None))
                    except (OSError, ValueError, csv.Error) as problem:  # Arrow's errors are among them
                        made.append((uri, None, None, None, f"{type(problem).__name__}: {problem}"))
                types = (pa.string(), pa.list_(pa.string()), pa.list_(pa.string()), pa.int64(), pa.string())
                columns = [pa.array(c, t) for c, t in zip(zip(*made, strict=True), types, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, names=["src_file", "columns", "types", "rows", "error"])

    return run


def file_headers(spark: SparkSession, path: str, format: str = "parquet", recursive: bool = False) -> DataFrame:
    """Every day table's columns in order, with types and rows where the format's footer has them.

    Temporary and system files are left out. No data page and no line but the header is
    read; a file that cannot be read, or is empty where it must not be, has an ``error``.
    """
    if format not in ("parquet", "csv"):
        raise ValueError(f"headers are read from parquet or csv, not {format!r}")
    uri = qualified_uri(spark, path).rstrip("/")
    if recursive:
        files = list_files(spark, path)
    else:
        files = list_folders(spark.createDataFrame([(uri,)], "path string")).where("not is_folder")
    name = paths.file_name(F.col("path"))
    files = files.where((paths.extension(F.col("path")) == f".{format}") & ~paths.is_temporary(name)).select("path")
    tasks = spark.sparkContext.defaultParallelism
    return files.repartition(tasks, "path").mapInArrow(_headers(format), HEADERS)


def header_groups(headers: DataFrame) -> DataFrame:
    """Equal headers together: columns, types, files, rows, first_file and whether they are the ``expected`` ones.

    Expected are those of the first file by path.
    """
    groups = headers.groupBy("columns", "types", "error").agg(
        F.count(F.lit(1)).alias("files"), F.sum("rows").alias("rows"), F.min("src_file").alias("first_file")
    )
    first = headers.agg(F.min_by("columns", "src_file")).scalar()
    return groups.withColumn("expected", F.col("columns").eqNullSafe(first) & F.col("error").isNull())


# Executors need not have this package installed: the readers travel with the plan.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
