"""Stacking tables under strict or lenient schema rules, in file order."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetloom.functions.columns import quoted
from fleetloom.operators.lookups import lookup
from fleetloom.operators.position import row_index, running_total


class SchemaMismatch(ValueError):
    """A table's columns differ from the first table's."""


def concat_strict(frames: Sequence[DataFrame], same_types: bool = False) -> DataFrame:
    """Stack tables whose column names agree in order.

    Types may differ unless ``same_types``; the wider one is taken, text being
    the widest. For a whole directory use one read instead of many frames.
    """
    first = frames[0]
    for place, other in enumerate(frames[1:], 1):
        if other.columns != first.columns:
            raise SchemaMismatch(f"table {place} has columns {other.columns}, the first has {first.columns}")
        if same_types and [f.dataType for f in other.schema] != [f.dataType for f in first.schema]:
            raise SchemaMismatch(f"table {place} has types {other.dtypes}, the first has {first.dtypes}")
    as_text = {
        name
        for i, name in enumerate(first.columns)
        if len({f.schema[i].dataType.simpleString() for f in frames}) > 1
        and any(isinstance(f.schema[i].dataType, T.StringType) for f in frames)
    }
    aligned = [
        f.select(*[quoted(c).cast("string").alias(c) if c in as_text else quoted(c) for c in f.columns])
        for f in frames
    ]
    return reduce(DataFrame.union, aligned)


def concat_lenient(left: DataFrame | None, right: DataFrame) -> DataFrame:
    """Stack by column name; a column one side lacks is null there.

    Without a left table, or with one that has no columns, the right one is the result.
    """
    if left is None or not left.columns:
        return right
    return left.unionByName(right, allowMissingColumns=True)


def header_offenders(headers: DataFrame, src_file: str = "src_file", columns: str = "columns") -> DataFrame:
    """Files whose ordered column names differ from the first file's.

    ``headers`` has one or more rows per file; equal ones are merged map-side.
    """
    distinct = headers.select(src_file, columns).distinct()
    expected = headers.agg(F.min_by(columns, F.struct(src_file, columns)))
    return distinct.withColumn("expected", expected.scalar()).where(F.col(columns) != F.col("expected"))


def check_headers(headers: DataFrame, src_file: str = "src_file", columns: str = "columns") -> None:
    """Raise on the first file whose columns differ."""
    offender = header_offenders(headers, src_file, columns).orderBy(src_file).first()
    if offender is not None:
        raise SchemaMismatch(f"{offender[src_file]} has columns {offender[columns]}, expected {offender['expected']}")


def check_paired_table(df: DataFrame, columns: int = 10) -> None:
    """Raise unless the table has exactly ``columns`` columns and at least one row."""
    if len(df.columns) != columns:
        raise SchemaMismatch(f"the table should have {columns} columns, it has {len(df.columns)}")
    if df.isEmpty():
        raise SchemaMismatch("the table has no rows")


def concat_in_order(
    df: DataFrame, file_order: Sequence[str], row_no: str, name: str = "pos", dense: bool = False
) -> DataFrame:
    """Number the rows of all files: by ``file_order``, nulls first, then ``row_no``.

    ``file_order`` must identify the file. If ``row_no`` counts each file's rows
    from 0 without gaps (``dense``), only the per-file counts are ordered: no row
    is sorted, and a row's place is its file's start plus its own number.
    """
    file_order = list(file_order)
    by_file: list[Column] = [quoted(c).asc_nulls_first() for c in file_order]
    if not dense:
        return row_index(df, [*by_file, quoted(row_no)], name)
    files = df.groupBy(*file_order).agg(F.count(F.lit(1)).alias("_rows"))
    starts = running_total(files, by_file, F.col("_rows"), "_start")
    # A null in the order, such as an unknown date, must still find its file.
    keys = {c: f"_file{i}" for i, c in enumerate(file_order)}
    starts = starts.select(F.struct(*[quoted(c).alias(k) for c, k in keys.items()]).alias("_file"), "_start")
    placed = lookup(
        df.withColumn("_file", F.struct(*[quoted(c).alias(k) for c, k in keys.items()])), starts, ["_file"], "inner"
    )
    return placed.select(*[quoted(c) for c in df.columns], (F.col("_start") + quoted(row_no)).alias(name))


def concat_by_name(df: DataFrame, src_name: str, row_no: str, name: str = "pos", dense: bool = False) -> DataFrame:
    return concat_in_order(df, [src_name], row_no, name, dense)


def concat_by_date(
    df: DataFrame, file_date: str, src_name: str, row_no: str, name: str = "pos", dense: bool = False
) -> DataFrame:
    """By date, then name; files without a date come first."""
    return concat_in_order(df, [file_date, src_name], row_no, name, dense)
