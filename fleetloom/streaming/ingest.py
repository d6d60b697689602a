"""Cleaning newly arrived files, each exactly once, and trying failed ones again."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetloom import fixed
from fleetloom.functions import paths
from fleetloom.operators.cleanse import drop_cell, replace_cells, replace_text
from fleetloom.session import move_folder, path_exists, scratch_table
from fleetloom.sources.csv_files import (
    WHOLE_FILE_BYTES,
    cells_of_files,
    cells_of_lines,
    lines_of_text,
    long_file_text,
    short_bytes,
    small_csv_files,
)
from fleetloom.sources.file_tree import list_files, list_folders

# Failed files read again in one round.
RETRY_FILES = 1000


def clean_rows(
    rows: DataFrame,
    column_index: int | None = 0,
    old: str = fixed.MISREAD_CHAR,
    new: str = fixed.CORRECT_CHAR,
) -> DataFrame:
    """Drop a column, replace the character in cells and file name, mark failed files.

    The column is dropped first, as a file with too few cells keeps them all.
    ``column_index`` None drops nothing.
    """
    cells = F.col("cells") if column_index is None else drop_cell(F.col("cells"), column_index)
    name = paths.file_name(F.col("src_file"))
    return rows.select(
        "src_file",
        replace_text(name, old, new).alias("new_name"),
        F.contains(name, F.lit(old)).alias("renamed"),
        "row_no",
        replace_cells(cells, old, new).alias("cells"),
        "error",
        F.when(F.col("error").isNull(), "ok").otherwise("failed").alias("status"),
    )


# The columns of a stored run, and of its ledger: a row per file.
STORED = (
    "src_file string, new_name string, renamed boolean, row_no bigint, cells array<string>, error string, "
    "status string, stored_at timestamp, run string"
)
LEDGER = "src_file string, status string, rows bigint, error string, stored_at timestamp, run string"


def _store(rows: DataFrame, target: str, run: str) -> None:
    """Write one run, its rows and its ledger, which appear together; a run of the same name is replaced.

    The ledger is made of the stored rows' other columns: their cells are not read again.
    """
    spark = rows.sparkSession
    hidden = f"{target}/_run-{uuid.uuid4().hex}"
    rows.withColumn("stored_at", F.current_timestamp()).write.parquet(f"{hidden}/rows")
    per_file = (
        spark.read.schema(STORED)
        .parquet(f"{hidden}/rows")
        .groupBy("src_file")
        .agg(
            F.max("status").alias("status"),
            F.count_if(F.col("row_no") >= 0).alias("rows"),
            F.max("error").alias("error"),
            F.max("stored_at").alias("stored_at"),
        )
    )
    per_file.write.parquet(f"{hidden}/ledger")
    move_folder(spark, hidden, f"{target}/run={run}")


def noted(files: DataFrame, error: str | None = None) -> DataFrame:
    """A row without cells for each of the files (path)."""
    return files.select(
        F.col("path").alias("src_file"),
        F.lit(-1).cast("bigint").alias("row_no"),
        F.lit(None).cast("array<string>").alias("cells"),
        F.lit(error).cast("string").alias("error"),
    )


def clean_new_files(
    spark: SparkSession,
    source: str,
    target: str,
    checkpoint: str,
    column_index: int | None = 0,
    old: str = fixed.MISREAD_CHAR,
    new: str = fixed.CORRECT_CHAR,
    files_per_run: int | None = None,
    whole_file_bytes: int = WHOLE_FILE_BYTES,
) -> None:
    """Clean all CSV files of ``source`` not seen before, then stop.

    One stream parses the files of up to ``whole_file_bytes`` whole; files longer than that
    are not opened by it. A second one, which opens only these, reads them by lines, so a
    file of any length is shared by many tasks and none stops the others. Their
    checkpoints remember the files, each of which only one of them stores. A batch that is
    run again after a failure replaces its run, so its rows are there once. An unreadable
    file becomes a row with status ``failed``; one of zero bytes, which Spark's sources pass
    over, is noted with no rows.
    """
    limit = short_bytes(spark, whole_file_bytes)
    short = small_csv_files(spark, source, stream=True, files_per_trigger=files_per_run).where(F.col("length") <= limit)
    long = long_file_text(spark, source, limit, stream=True, files_per_trigger=files_per_run)

    def store_short(rows: DataFrame, batch: int) -> None:
        _store(rows, target, f"batch-{batch}")

    def store_long(text: DataFrame, batch: int) -> None:
        if not text.isEmpty():
            _store(clean_rows(cells_of_lines(lines_of_text(text)), column_index, old, new), target, f"long-{batch}")

    streams = [(clean_rows(cells_of_files(short), column_index, old, new), store_short, checkpoint), (long, store_long, f"{checkpoint.rstrip('/')}-long")]
    running = [
        rows.writeStream.foreachBatch(store).option("checkpointLocation", place).trigger(availableNow=True).start()
        for rows, store, place in streams
    ]
    for query in running:
        query.awaitTermination()
    empty = scratch_table(pending_files(spark, source, target).where("length = 0"), "empty-files")
    if not empty.isEmpty():
        _store(clean_rows(noted(empty), column_index, old, new), target, f"empty-{uuid.uuid4().hex}")


def _runs(spark: SparkSession, target: str, part: str, schema: str) -> DataFrame:
    """A part of all runs; before the first one there are no rows."""
    if not path_exists(spark, f"{target}/run=*/{part}"):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", target).parquet(f"{target}/run=*/{part}")


def attempts(spark: SparkSession, target: str) -> DataFrame:
    """The ledger's rows: one per file and run. No stored cell is read."""
    return _runs(spark, target, "ledger", LEDGER)


def ledger(spark: SparkSession, target: str) -> DataFrame:
    """Per file: the last attempt's status and time, rows stored, and its error."""
    last = F.struct("stored_at", "status", "rows", "error", "run")
    return attempts(spark, target).groupBy("src_file").agg(F.max(last).alias("_last"), F.count(F.lit(1)).alias("attempts")).select(
        "src_file", "_last.*", "attempts"
    )


def pending_files(spark: SparkSession, source: str, target: str) -> DataFrame:
    """CSV files of ``source``, also of zero bytes, that no run has stored yet. Reads the listing and the ledger."""
    done = attempts(spark, target).select(F.col("src_file").alias("path")).distinct()
    there = list_files(spark, source).where(F.endswith("path", F.lit(".csv"))).select("path", "length")
    return there.join(done, "path", "left_anti")


def ledger_report(spark: SparkSession, target: str) -> DataFrame:
    """One row per status: files, rows, and the time of the last attempt."""
    return (
        ledger(spark, target)
        .groupBy("status")
        .agg(F.count(F.lit(1)).alias("files"), F.sum("rows").alias("rows"), F.max("stored_at").alias("last_stored_at"))
    )


def cleaned_rows(spark: SparkSession, target: str) -> DataFrame:
    """The clean rows of all files read well."""
    return _runs(spark, target, "rows", STORED).where("status = 'ok' and row_no >= 0").drop("run", "status", "stored_at", "error")


def quarantine(spark: SparkSession, target: str) -> DataFrame:
    """Files whose last attempt failed, with the error."""
    return ledger(spark, target).where("status = 'failed'").select("src_file", "error", "attempts")


def retry_failed(
    spark: SparkSession,
    target: str,
    label: str,
    column_index: int | None = 0,
    old: str = fixed.MISREAD_CHAR,
    new: str = fixed.CORRECT_CHAR,
    whole_file_bytes: int = WHOLE_FILE_BYTES,
) -> int:
    """Read every quarantined file once more; returns how many were tried.

    ``label`` names this retry. Every attempt is a run of its own and replaces none, so
    what an earlier one recovered stays, also if that one broke off. A file that is gone
    is a failed one. Tasks list the files' folders to see which are there. Only file names,
    ``RETRY_FILES`` at a time, pass through the driver; long files are read by lines.
    """
    limit = short_bytes(spark, whole_file_bytes)
    waiting = scratch_table(quarantine(spark, target).select(F.col("src_file").alias("path")), "quarantine")
    folders = waiting.select(paths.parent(F.col("path")).alias("path")).distinct()
    found = list_folders(folders).where("not is_folder").select("path", "length")
    waiting = scratch_table(waiting.join(found, "path", "left"), "to-retry")
    attempt, tried, last = uuid.uuid4().hex, 0, ""
    while True:
        files = waiting.where(F.col("path") > last).orderBy("path").limit(RETRY_FILES).collect()
        if not files:
            return tried
        short = [paths.glob_literal(f.path) for f in files if f.length is not None and 0 < f.length <= limit]
        long = [paths.glob_literal(f.path) for f in files if f.length is not None and f.length > limit]
        rows = noted(spark.createDataFrame([(f.path,) for f in files if f.length is None], "path string"), "FileNotFoundError: no such file")
        rows = rows.union(noted(spark.createDataFrame([(f.path,) for f in files if f.length == 0], "path string")))
        if short:
            rows = rows.union(cells_of_files(spark.read.format("binaryFile").load(short)))
        if long:
            rows = rows.union(cells_of_lines(lines_of_text(long_file_text(spark, long, limit, "*"))))
        _store(clean_rows(rows, column_index, old, new), target, f"retry-{label}-{attempt}-{tried}")
        tried, last = tried + len(files), files[-1].path
