"""Writing results as new datasets; nothing is changed in place."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetloom.functions.columns import quoted


def write_by(df: DataFrame, path: str, *keys: str, format: str = "parquet", mode: str = "errorifexists") -> None:
    """One directory per value of ``keys``: an input file, a band label, a pair key.

    Rows are rebalanced on the keys first: small keys share a task and a huge one
    is split over several, so neither tiny files nor one huge task come out.
    """
    df.hint("rebalance", *keys).write.format(format).mode(mode).partitionBy(*keys).save(path)


def write_clustered(df: DataFrame, path: str, *order: str, format: str = "parquet", mode: str = "errorifexists") -> None:
    """One table whose part files follow ``order``, each sorted inside.

    Readers that filter on the order's columns skip the other files by their statistics.
    """
    df.repartitionByRange(*order).sortWithinPartitions(*order).write.format(format).mode(mode).save(path)


def write_in_order(df: DataFrame, path: str, pos: str = "pos", format: str = "parquet", mode: str = "errorifexists") -> None:
    """One consolidated table in row order."""
    write_clustered(df, path, pos, format=format, mode=mode)


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Plain CSV with a header, UTF-8, quotes doubled."""
    df.write.mode(mode).option("header", True).option("escape", '"').csv(path)


def csv_line(cells: Column) -> Column:
    """A row of cells as one CSV line, quoted only where needed."""

    def written(cell: Column) -> Column:
        text = F.coalesce(cell, F.lit(""))
        doubled = F.concat(F.lit('"'), F.replace(text, F.lit('"'), F.lit('""')), F.lit('"'))
        return F.when(text.rlike('[",\r\n]'), doubled).otherwise(text)

    plain = F.array_join(cells, ",", "")
    commas = F.length(plain) - F.length(F.replace(plain, F.lit(","), F.lit("")))
    needs_quotes = (commas >= F.size(cells)) | plain.rlike('["\r\n]')
    return (
        F.when((F.size(cells) == 1) & (plain == ""), F.lit('""'))
        .when(needs_quotes & (F.size(cells) > 0), F.array_join(F.transform(cells, written), ","))
        .otherwise(plain)
    )


def write_ragged_csv(
    rows: DataFrame, path: str, key: str, row_no: str = "row_no", cells: str = "cells", mode: str = "errorifexists"
) -> None:
    """Rows of cells as CSV text, one directory per ``key``, rows in order."""
    (
        rows.select(quoted(key).alias(key), quoted(row_no).alias("_row_no"), quoted(cells).alias("_cells"))
        .repartitionByRange(key, "_row_no")
        .sortWithinPartitions(key, "_row_no")
        .select(key, csv_line(F.col("_cells")).alias("value"))
        .write.mode(mode)
        .partitionBy(key)
        .text(path)
    )
