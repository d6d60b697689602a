"""Dates out of cell texts, file names and file contents, in native expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from fleetloom import fixed

# --- fixed values: the accepted shapes ---------------------------------------
YEAR_FIRST_SLASH = r"(\d{4}/\d{1,2}/\d{1,2})"
YEAR_FIRST_DASH = r"(\d{4}-\d{1,2}-\d{1,2})"
YEAR_LAST_SLASH = r"(\d{1,2}/\d{1,2}/\d{4})"
LIST_NAME = r"^from_(\d{4})_(\d{2})_(\d{2})\.csv"
# -----------------------------------------------------------------------------


def _found(text: Column, pattern: str, group: int = 1) -> Column:
    """The matched group, or null where the pattern does not match."""
    return F.nullif(F.regexp_extract(text, pattern, group), F.lit(""))


def _date(year: Column, month: Column, day: Column) -> Column:
    """Digits to a date; null for days no calendar has."""
    return F.concat(year, F.lit("-"), month, F.lit("-"), day).try_cast("date")


def _date_of_month_day(year: Column, month_day: Column) -> Column:
    return _date(year, F.substring(month_day, 1, 2), F.substring(month_day, 3, 2))


def _date_of_tidy(text: Column) -> Column:
    """year/month/day to a date; null for anything else."""
    tidy = text.rlike(r"^\d{4}/\d{1,2}/\d{1,2}$")
    return F.when(tidy, F.replace(text, F.lit("/"), F.lit("-")).try_cast("date"))


def tidy_date_text(column: Column) -> Column:
    """The date part of a text as year/month/day; digits keep their padding.

    Year-first with slashes wins over year-first with dashes, which wins over
    month/day/year. A text without any of them stays as it is.
    """
    text = column.cast("string")
    return F.coalesce(
        _found(text, YEAR_FIRST_SLASH),
        F.replace(_found(text, YEAR_FIRST_DASH), F.lit("-"), F.lit("/")),
        F.regexp_replace(_found(text, YEAR_LAST_SLASH), r"^(\d+)/(\d+)/(\d+)$", "$3/$1/$2"),
        text,
    )


def date_of_text(column: Column) -> Column:
    """The date a text stands for, null where it has none; for ordering only."""
    return _date_of_tidy(tidy_date_text(column))


def short_day_text(day: Column) -> Column:
    """year/month/day without padding, such as 2025/2/1."""
    return F.date_format(day, "y/M/d")


def is_summary_cell(column: Column) -> Column:
    """True for the text of a summary row; false for null."""
    text = column.cast("string")
    found = F.contains(text, F.lit(fixed.SUMMARY_RANGE_MARK)) & F.contains(text, F.lit(fixed.SUMMARY_TOTAL_MARK))
    return F.coalesce(found, F.lit(False))


def summary_cell_date(column: Column) -> Column:
    """The date a summary text starts with; null where it is not y/m/d."""
    before = F.trim(F.split_part(column.cast("string"), F.lit(fixed.SUMMARY_RANGE_MARK), F.lit(1)))
    first_word = F.regexp_extract(before, r"^(\d{4}/\d{1,2}/\d{1,2})(?:\s|$)", 1)
    return _date_of_tidy(first_word)


def month_day_name_date(stem: Column, year: int, accept_year: bool = False) -> Column:
    """Date of a four-digit MMDD stem in ``year``.

    ``accept_year`` also takes eight digits, yyyyMMdd.
    """
    dated = F.when(stem.rlike(r"^[0-9]{4}$"), _date_of_month_day(F.lit(f"{year:04d}"), stem))
    if accept_year:
        dated = dated.when(stem.rlike(r"^[0-9]{8}$"), _date_of_month_day(F.substring(stem, 1, 4), F.substring(stem, 5, 4)))
    return dated


def _name_piece(stem: Column, place: int) -> Column:
    """A piece of a stem in front of an underscore, if it is four digits; else null."""
    pieces = F.split(stem, "_")
    piece = F.get(pieces, F.lit(place))
    digits = (F.length(piece) == 4) & (F.translate(piece, "0123456789", "") == "")
    return F.when((F.size(pieces) > place + 1) & digits, piece)


def _with_year_date(stem: Column) -> Column:
    year, month_day = _name_piece(stem, 0), _name_piece(stem, 1)
    return F.when(year.between("1900", "2100"), _date_of_month_day(year, month_day))


def _default_year_date(stem: Column, default_year: int) -> Column:
    return _date_of_month_day(F.lit(f"{default_year:04d}"), _name_piece(stem, 0))


def prefixed_name_date(stem: Column, default_year: int = fixed.DEFAULT_NAME_YEAR) -> Column:
    """Date of a YYYY_MMDD_* stem, else of MMDD_* in ``default_year``, else null."""
    return F.coalesce(_with_year_date(stem), _default_year_date(stem, default_year))


def name_date_kind(stem: Column, default_year: int = fixed.DEFAULT_NAME_YEAR) -> Column:
    """Which shape gave the date: with_year, without_year or failed."""
    return (
        F.when(_with_year_date(stem).isNotNull(), "with_year")
        .when(_default_year_date(stem, default_year).isNotNull(), "without_year")
        .otherwise("failed")
    )


def list_name_date(file_name: Column) -> Column:
    """Date in a list's file name, from_yyyy_mm_dd.csv."""
    parts = [_found(file_name, LIST_NAME, g) for g in (1, 2, 3)]
    return _date(*parts)
