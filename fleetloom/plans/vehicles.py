"""From day tables to one consolidated, shuffled table; and the calendar."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetloom import fixed
from fleetloom.functions import dates, paths
from fleetloom.functions.columns import mileage_column, plate_column, quoted
from fleetloom.operators import bands, calendar, cleanse, concat, pairing, position, purge
from fleetloom.operators.bands import Band
from fleetloom.session import scratch_table
from fleetloom.sources.plate_lists import read_dated_lists
from fleetloom.sources.workbooks import column_names, headers_of, table_of_cells


def purge_files(
    records: DataFrame,
    lists: DataFrame,
    src_file: str = "src_file",
    order: str = "row_no",
    plate: str | None = None,
    name_date: Column | None = None,
) -> DataFrame:
    """Flag the records that go, by the date of their file's name or content.

    ``name_date`` is an expression over ``src_file``, such as
    ``month_day_name_date(stem(col), year)``. Filter on ``purged`` for the records
    left, or pass the result to ``purge_report``.
    """
    plate = plate_column(records, plate)
    content = purge.content_dates(records, src_file, order)
    dated = purge.with_file_date(records, src_file, F.lit(None).cast("date") if name_date is None else name_date, content)
    return purge.flag_purged(dated, lists, plate, "file_date").drop("file_date")


def tidy_and_band(
    records: DataFrame,
    keep: int = fixed.KEEP_COLUMNS,
    carry: Sequence[str] = ("src_file", "row_no"),
    selected: Iterable[Band] = bands.DEFAULT_BANDS,
    value: str | None = None,
) -> DataFrame:
    """Keep the first columns, tidy the date, and fan the rows out to their bands.

    ``carry`` names the columns that identify a row and are not data.
    """
    data = [c for c in records.columns if c not in carry]
    kept = records.select(*[quoted(c) for c in carry], *[quoted(c) for c in (data[:keep] if keep > 0 else data)])
    value = mileage_column(kept) if value is None else value
    return bands.band_fan_out(cleanse.tidy_dates(kept), value, selected)


def consolidate(
    banded: DataFrame,
    key: str,
    order: Sequence[str],
    seed: int = fixed.BASE_SEED,
    shuffle_seed: int = fixed.BASE_SEED,
    labels: tuple[str, str] = ("low", "medium"),
    file_date: Column | None = None,
    label: str = "range_label",
) -> DataFrame:
    """Pair the two bands of every key, stack the keys in order, shuffle the right half.

    Keys are stacked by ``file_date``, an expression over ``key``, then by key. The two
    bands are written once, so what ``banded`` is made of is computed once.
    """
    banded = scratch_table(banded.where(quoted(label).isin(*labels)), "banded")
    left, right = (banded.where(quoted(label) == name).drop(label) for name in labels)
    paired = pairing.pair_rows(left, right, key, order, order, seed, tuple(f"{name}_" for name in labels))
    stacked_order = [quoted(key), F.col("pos")]
    if file_date is not None:
        stacked_order.insert(0, file_date.asc_nulls_first())
    left_columns = [c for c in paired.columns if c in (key, "pos") or c.startswith(f"{labels[0]}_")]
    shuffled = position.shuffle_right(paired, left_columns, stacked_order, shuffle_seed, "row_no")
    return shuffled.drop("pos")


class UnreadableFile(ValueError):
    """A file that should be stacked could not be read."""


def stack_files(cells: DataFrame, by_date: bool = True, default_year: int = fixed.DEFAULT_NAME_YEAR) -> DataFrame:
    """Stack the files of a cell table under one header, numbered by ``pos``.

    Files come by the date in their name, undated ones first, or by name alone. All
    must be readable and have the same columns in the same order, or nothing is
    stacked, and the first other file is named. A file has as many columns as its widest
    row has cells, so no cell is lost; blank names become ``Unnamed: `` and the column's
    place, and a repeated name gets a number. The rows are not sorted: only the files' row
    counts are. The cells are written once, so files are parsed once.
    """
    cells = scratch_table(cells, "cells")
    broken = cells.where("error is not null").orderBy("src_file").first()
    if broken is not None:
        raise UnreadableFile(f"{broken.src_file}: {broken.error}")
    headers = headers_of(cells)
    concat.check_headers(headers)
    first = headers.first()
    if first is None:
        raise UnreadableFile("no file has a header")
    src_file = F.col("src_file")
    clashing = {"src_file", "row_no", "pos", "_file_date", "_src_name"}
    names = column_names([f"{c}.0" if c in clashing else c for c in first.columns])
    table = table_of_cells(cells, names).withColumns(
        {
            "_file_date": dates.prefixed_name_date(paths.stem(src_file), default_year),
            "_src_name": paths.file_name(src_file),
        }
    )
    order = ["_file_date", "_src_name", "src_file"] if by_date else ["_src_name", "src_file"]
    return concat.concat_in_order(table, order, "row_no", dense=True).drop("_file_date", "_src_name")


def add_calendar(spark: SparkSession, folder: str, table: DataFrame | None, end: str = fixed.CALENDAR_END) -> DataFrame:
    """The calendar of the dated lists in ``folder``, stacked below ``table`` by name."""
    return concat.concat_lenient(table, calendar.plate_calendar(read_dated_lists(spark, folder), end))
