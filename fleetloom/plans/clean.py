"""Cleaning a directory tree in one pass."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from fleetloom import fixed
from fleetloom.functions import paths
from fleetloom.operators import cleanse, reports
from fleetloom.session import qualified, scratch_table
from fleetloom.sources.csv_files import WHOLE_FILE_BYTES, listed_csv_parts
from fleetloom.sources.file_tree import in_files, list_files, spread_files, write_named_files
from fleetloom.sources.sinks import csv_line, write_by, write_ragged_csv
from fleetloom.streaming.ingest import clean_rows, noted

LAYOUTS = ("table", "files", "folders", "csv")


class RenameClash(ValueError):
    """Two files would get one name."""


def _below(spark: SparkSession, path: str, source: str) -> F.Column:
    """The part of a path below the folder ``source``."""
    root = f"{qualified(spark, source)}/"
    return F.substr(path, F.instr(path, root) + len(root))


def files_to_clean(spark: SparkSession, source: str, old: str = fixed.MISREAD_CHAR, new: str = fixed.CORRECT_CHAR) -> DataFrame:
    """Every file that a clean processes: CSV files, and others whose names hold the character.

    path, length, is_csv, name (its path below ``source``), new_name (its path after the
    clean) and renamed. Tasks list the folders; files of zero bytes are there too.
    """
    files = list_files(spark, source).where(cleanse.needs_replacement(F.col("path"), old))
    files = files.select("path", "length", paths.is_csv(F.col("path")).alias("is_csv"), _below(spark, "path", source).alias("name"))
    return cleanse.rename_files(files, "name", old, new).withColumnRenamed("new_path", "new_name")


def _cleaned(
    spark: SparkSession, source: str, column_index: int | None, old: str, new: str, allow_clashes: bool, whole_file_bytes: int
) -> tuple[DataFrame, DataFrame | None]:
    """The clean rows of all files to process: of those parsed whole, and of long ones, if there are any."""
    files = scratch_table(files_to_clean(spark, source, old, new), "files-to-clean")
    if not allow_clashes:
        clash = cleanse.rename_clashes(files, "name", "new_name").orderBy("new_name").first()
        if clash is not None:
            raise RenameClash(f"{clash.files} files would be named {clash.new_name}")

    def cleaned(rows: DataFrame) -> DataFrame:
        rows = clean_rows(rows, column_index, old, new)
        return rows.withColumn("new_name", paths.joined(paths.parent(_below(spark, "src_file", source)), F.col("new_name")))

    small, long = listed_csv_parts(files.where("length > 0 and is_csv"), whole_file_bytes)
    bare = noted(spread_files(files.where("length = 0 or not is_csv")))
    return cleaned(small.union(bare)), None if long is None else cleaned(long)


def clean_directory(
    spark: SparkSession,
    source: str,
    target: str | None = None,
    column_index: int | None = 0,
    old: str = fixed.MISREAD_CHAR,
    new: str = fixed.CORRECT_CHAR,
    layout: str = "table",
    allow_clashes: bool = False,
    whole_file_bytes: int = WHOLE_FILE_BYTES,
) -> DataFrame:
    """Drop a column and replace the character in cells and names of all CSV files.

    Other files whose names hold the character get their new name only; files without
    rows keep their place. ``new_name`` is the new path below ``source``, so files of one
    name in two folders stay apart.

    Writes beside ``source`` unless ``target`` is given, and returns the outcome per
    file. ``layout`` is

    * ``table``: one parquet table of ``new_name``, ``row_no`` and ``cells``, with a
      row holding ``error`` for each file that cannot be read, and one without cells for
      a file without rows. Files are read, cleaned and written in one stage; only their
      names are shuffled.
    * ``files``: a tree of files under their new names, CSV lines or copied bytes, whose
      writer counts the rows. Only the rows of files longer than ``whole_file_bytes`` are
      shuffled. A file that cannot be read is in the outcome, but not in the tree.
    * ``folders``: a folder of parquet files per new path.
    * ``csv``: a folder of CSV lines per new path.

    Folders are for thousands of files rather than millions.
    """
    if layout not in LAYOUTS:
        raise ValueError(f"layout is one of {', '.join(LAYOUTS)}, not {layout!r}")
    target = paths.processed_dir(source) if target is None else target
    small, long = _cleaned(spark, source, column_index, old, new, allow_clashes, whole_file_bytes)
    if layout == "files":
        lines = small if long is None else small.union(in_files(long.withColumn("name", F.col("new_name"))).drop("name"))
        copied = F.when(~paths.is_csv(F.col("src_file")), F.col("src_file"))
        line = csv_line(F.col("cells"))
        made = write_named_files(lines.select("src_file", F.col("new_name").alias("name"), "row_no", line.alias("line"), copied.alias("copy_of"), "error"), target)
        return reports.outcomes_of(made)
    rows = small if long is None else small.union(long)
    if layout == "table":
        rows.write.parquet(target)
        stored = spark.read.schema(rows.schema).parquet(target)
    else:
        stored = scratch_table(rows, "cleaned")
        good = stored.where("status = 'ok' and row_no >= 0").select("new_name", "row_no", "cells")
        if layout == "csv":
            write_ragged_csv(good, target, "new_name")
        else:
            write_by(good, target, "new_name")
    return reports.file_outcomes(stored, "src_file", F.lit(True), F.col("error"), F.col("row_no") >= 0)


def clean_summary(
    spark: SparkSession,
    source: str,
    target: str | None = None,
    column_index: int | None = 0,
    old: str = fixed.MISREAD_CHAR,
    new: str = fixed.CORRECT_CHAR,
    allow_clashes: bool = False,
    whole_file_bytes: int = WHOLE_FILE_BYTES,
) -> DataFrame:
    """``clean_directory`` to a table, with ``run_summary`` of it in one row.

    The counts are observed while the rows are written; nothing is read again. Every file
    has just one row numbered 0, or -1 if it has no rows.
    """
    target = paths.processed_dir(source) if target is None else target
    small, long = _cleaned(spark, source, column_index, old, new, allow_clashes, whole_file_bytes)
    seen = Observation()
    observed = (small if long is None else small.union(long)).observe(
        seen,
        F.count_if(F.col("row_no") <= 0).alias("files"),
        F.count_if(F.col("error").isNotNull()).alias("failed"),
        F.count_if(F.col("row_no") >= 0).alias("rows"),
    )
    observed.write.parquet(target)
    files, failed, rows = (seen.get[c] for c in ("files", "failed", "rows"))
    summary = (files, files - failed, failed, 100.0 * (files - failed) / files if files else 0.0, rows, rows, 0)
    schema = "files bigint, ok bigint, failed bigint, success_pct double, rows_before bigint, rows_after bigint, rows_deleted bigint"
    return spark.createDataFrame([summary], schema)


def dry_run_files(spark: SparkSession, source: str, old: str = fixed.MISREAD_CHAR, new: str = fixed.CORRECT_CHAR) -> DataFrame:
    """What a clean would do to each file it processes: name, new_name, is_csv, renamed, length. Opens no file."""
    return files_to_clean(spark, source, old, new).select("name", "new_name", "is_csv", "renamed", "length")


def dry_run_directory(spark: SparkSession, source: str, old: str = fixed.MISREAD_CHAR) -> DataFrame:
    """One row: files a clean would process and rename. Reads the listing only."""
    return dry_run_files(spark, source, old).agg(
        F.count_if("is_csv").alias("csv_files"),
        F.count(F.lit(1)).alias("files_to_process"),
        F.count_if("renamed").alias("files_to_rename"),
    )
