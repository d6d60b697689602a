"""Lists of plates, with and without a date in the file name."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetloom import fixed
from fleetloom.functions.columns import ColumnNotFound, plate_column, quoted
from fleetloom.functions.dates import list_name_date


def _present(column: Column) -> Column:
    return column.isNotNull() & ~column.isin(*fixed.MISSING_TEXTS)


def plates_of(table: DataFrame, column: str | None = None) -> DataFrame:
    """Distinct trimmed plates of a table: the plate column, else its first column."""
    if column is None:
        try:
            column = plate_column(table)
        except ColumnNotFound:
            column = table.columns[0]
    trimmed = F.trim(quoted(column))
    return (
        table.where(_present(quoted(column)))
        .select(trimmed.alias("plate"))
        .where(~F.col("plate").isin(*fixed.NOT_A_PLATE))
        .distinct()
    )


def read_plate_list(spark: SparkSession, path: str, column: str | None = None) -> DataFrame:
    """A plate list: ``plate``, without duplicates, blanks and missing values."""
    return plates_of(spark.read.option("header", True).option("escape", '"').csv(path), column)


def read_dated_lists(spark: SparkSession, folder: str) -> DataFrame:
    """All ``from_yyyy_mm_dd.csv`` lists: ``plate``, ``from_date``, ``list_name``.

    The first column holds the plates. A repeated header row is dropped.
    """
    lists = (
        spark.read.schema("plate string")
        .option("header", True)
        .option("enforceSchema", True)
        .option("escape", '"')
        .option("pathGlobFilter", "from_*.csv")
        .csv(folder)
    )
    return (
        lists.select("plate", list_name_date(F.col("_metadata.file_name")).alias("from_date"), F.col("_metadata.file_name").alias("list_name"))
        .where(F.col("from_date").isNotNull())
        .where(_present(F.col("plate")) & (F.col("plate") != fixed.LIST_HEADER))
    )
