"""Counts per file and per run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetloom.functions.columns import quoted
from fleetloom.functions.dates import name_date_kind, prefixed_name_date


def file_outcomes(
    df: DataFrame, src_file: str, kept: Column, error: Column | None = None, is_row: Column | None = None
) -> DataFrame:
    """Per file: rows before and after, status and error text.

    ``is_row`` is false for the row that only notes an empty or unreadable file;
    a file with an error failed.
    """
    error = F.lit(None).cast("string") if error is None else error
    is_row = F.lit(True) if is_row is None else is_row
    return (
        df.groupBy(src_file)
        .agg(
            F.count_if(is_row).alias("rows_before"),
            F.count_if(is_row & kept).alias("rows_after"),
            F.max(error).alias("error"),
        )
        .withColumn("status", F.when(F.col("error").isNull(), "ok").otherwise("failed"))
    )


def outcomes_of(files: DataFrame) -> DataFrame:
    """``file_outcomes`` of files whose rows (rows, error) a writer has counted."""
    status = F.when(F.col("error").isNull(), "ok").otherwise("failed")
    return files.select("src_file", F.col("rows").alias("rows_before"), F.col("rows").alias("rows_after"), "error", status.alias("status"))


def run_summary(outcomes: DataFrame) -> DataFrame:
    """One row over all files: how many went well, and rows before, after, deleted."""
    files = F.count(F.lit(1))
    ok = F.count_if(F.col("status") != "failed")
    before = F.coalesce(F.sum("rows_before"), F.lit(0))
    after = F.coalesce(F.sum("rows_after"), F.lit(0))
    return outcomes.agg(
        files.alias("files"),
        ok.alias("ok"),
        (files - ok).alias("failed"),
        F.when(files == 0, F.lit(0.0)).otherwise(ok * F.lit(100.0) / files).alias("success_pct"),
        before.alias("rows_before"),
        after.alias("rows_after"),
        (before - after).alias("rows_deleted"),
    )


def table_shape(df: DataFrame, src_file: str) -> DataFrame:
    """Rows and columns per file; ``src_file`` itself is no data column."""
    return df.groupBy(src_file).agg(F.count(F.lit(1)).alias("rows")).withColumn(
        "columns", F.lit(len(df.columns) - 1).cast("bigint")
    )


def name_date_stats(files: DataFrame, stem: Column) -> DataFrame:
    """Files per shape of the date in their name, with the years seen."""
    return (
        files.select(name_date_kind(stem).alias("kind"), F.year(prefixed_name_date(stem)).alias("_year"))
        .groupBy("kind")
        .agg(
            F.count(F.lit(1)).alias("files"),
            F.min("_year").cast("bigint").alias("first_year"),
            F.max("_year").cast("bigint").alias("last_year"),
        )
    )


def date_range(df: DataFrame, day: Column) -> DataFrame:
    """One row: first and last day, and rows without a day."""
    return df.agg(
        F.min(day).alias("first_day"), F.max(day).alias("last_day"), F.count_if(day.isNull()).alias("undated_rows")
    )


def distinct_plates(df: DataFrame, plate: str) -> DataFrame:
    return df.agg(F.count_distinct(quoted(plate)).alias("plates"))
