"""Cleaning cells, column names and file names."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetloom import fixed
from fleetloom.functions import dates, paths
from fleetloom.functions.columns import quoted, tidy_date_column


def drop_cell(cells: Column, index: int = 0) -> Column:
    """The cells without the one at ``index``; shorter rows stay as they are."""
    if index < 0:
        raise ValueError("column index must not be negative")
    after = F.slice(cells, index + 2, F.greatest(F.size(cells) - (index + 1), F.lit(0)))
    return F.concat(F.slice(cells, 1, index), after)


def replace_text(text: Column, old: str = fixed.MISREAD_CHAR, new: str = fixed.CORRECT_CHAR) -> Column:
    """Every literal occurrence of ``old`` replaced."""
    if not old:
        raise ValueError("the text to replace must not be empty")
    return F.replace(text, F.lit(old), F.lit(new))


def replace_cells(cells: Column, old: str = fixed.MISREAD_CHAR, new: str = fixed.CORRECT_CHAR) -> Column:
    return F.transform(cells, lambda cell: replace_text(cell, old, new))


def replace_in_table(
    df: DataFrame, old: str = fixed.MISREAD_CHAR, new: str = fixed.CORRECT_CHAR, skip: Iterable[str] = ()
) -> DataFrame:
    """Replace in every text column and in the column names."""
    skip = set(skip)
    out = []
    for field in df.schema.fields:
        column = quoted(field.name)
        if field.name in skip:
            out.append(column)
            continue
        if isinstance(field.dataType, T.StringType):
            column = replace_text(column, old, new)
        out.append(column.alias(field.name.replace(old, new)))
    return df.select(*out)


def rename_files(
    df: DataFrame, path: str, old: str = fixed.MISREAD_CHAR, new: str = fixed.CORRECT_CHAR
) -> DataFrame:
    """Add ``new_path`` and ``renamed``; only the file name changes, not its folder."""
    name = paths.file_name(quoted(path))
    return df.withColumn(
        "new_path", paths.joined(paths.parent(quoted(path)), replace_text(name, old, new))
    ).withColumn("renamed", F.contains(name, F.lit(old)))


def rename_clashes(files: DataFrame, path: str, new_path: str = "new_path") -> DataFrame:
    """New paths that more than one old path would take, with their number."""
    return (
        files.groupBy(path, new_path).count().groupBy(new_path).agg(F.count(F.lit(1)).alias("files"))
    ).where(F.col("files") > 1)


def name_holds(path: Column, old: str = fixed.MISREAD_CHAR) -> Column:
    """File predicate: the file name holds the text."""
    return F.contains(paths.file_name(path), F.lit(old))


def needs_replacement(path: Column, old: str = fixed.MISREAD_CHAR) -> Column:
    """File predicate: the file name holds the text, or the file is a CSV."""
    return name_holds(path, old) | paths.is_csv(path)


def clean_files(
    df: DataFrame, path: str, content: str, old: str = fixed.MISREAD_CHAR, new: str = fixed.CORRECT_CHAR
) -> DataFrame:
    """Replace in the content of CSV files and in every file's name."""
    cleaned = F.when(paths.is_csv(quoted(path)), replace_text(quoted(content), old, new)).otherwise(quoted(content))
    return rename_files(df, path, old, new).withColumn(content, cleaned)


def tidy_dates(df: DataFrame, columns: Iterable[str] | None = None, summary_flag: str | None = None) -> DataFrame:
    """Tidy the first date column, or the given ones; optionally flag summary rows."""
    columns = [tidy_date_column(df)] if columns is None else list(columns)
    if summary_flag:
        flag = F.lit(False)
        for c in columns:
            flag = flag | dates.is_summary_cell(quoted(c))
        df = df.withColumn(summary_flag, flag)
    return df.withColumns({c: dates.tidy_date_text(quoted(c)) for c in columns})


def dry_run(df: DataFrame, path: str, content: str, old: str = fixed.MISREAD_CHAR) -> DataFrame:
    """One row: what cleaning would touch. Nothing is written."""
    name_hit = name_holds(quoted(path), old)
    csv = paths.is_csv(quoted(path))
    return df.agg(
        F.count(F.lit(1)).alias("files"),
        F.count_if(csv).alias("csv_files"),
        F.count_if(name_hit | csv).alias("files_to_process"),
        F.count_if(name_hit).alias("files_to_rename"),
        F.count_if(csv & F.contains(quoted(content), F.lit(old))).alias("contents_to_change"),
    )
