"""Find and pick columns by name or place; metadata only, no Spark job."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetloom import fixed


class ColumnNotFound(LookupError):
    """A required column is missing; the message names the columns there are."""

    def __init__(self, wanted: object, available: Sequence[str]):
        super().__init__(f"no column for {wanted!r}; available columns: {list(available)}")
        self.wanted = wanted
        self.available = list(available)


def quoted(name: str) -> Column:
    """The column of exactly this name, dots and brackets included."""
    return F.col("`" + name.replace("`", "``") + "`")


def column_by_keyword(df: DataFrame, keywords: Iterable[str], ignore_case: bool = True) -> str:
    """First column, in column order, whose name holds one of ``keywords``."""
    keywords = tuple(keywords)
    for name in df.columns:
        text = name.lower() if ignore_case else name
        if any(word in text for word in keywords):
            return name
    raise ColumnNotFound(keywords, df.columns)


def columns_by_keyword(df: DataFrame, keywords: Iterable[str]) -> list[str]:
    """All columns whose lower-cased name holds one of ``keywords``."""
    keywords = tuple(keywords)
    return [name for name in df.columns if any(word in name.lower() for word in keywords)]


def column_by_candidates(df: DataFrame, candidates: Iterable[str]) -> str:
    """First candidate that is a column; the candidates' order decides."""
    candidates = tuple(candidates)
    for name in candidates:
        if name in df.columns:
            return name
    raise ColumnNotFound(candidates, df.columns)


def plate_column(df: DataFrame, name: str | None = None) -> str:
    """The plate column: the given name, else found by keyword."""
    if name is not None:
        return column_by_candidates(df, (name,))
    return column_by_keyword(df, fixed.PLATE_KEYWORDS)


def tidy_date_column(df: DataFrame) -> str:
    return column_by_keyword(df, fixed.TIDY_DATE_KEYWORDS, ignore_case=False)


def mileage_column(df: DataFrame) -> str:
    return column_by_candidates(df, fixed.MILEAGE_COLUMNS)


def keep_first_columns(df: DataFrame, count: int = fixed.KEEP_COLUMNS) -> DataFrame:
    """The first ``count`` columns; zero or less keeps all."""
    return df.select(*[quoted(c) for c in df.columns[:count]]) if count > 0 else df


def drop_column_at(df: DataFrame, index: int = 0) -> DataFrame:
    """Drop the column at ``index``; a table too narrow for it stays as it is."""
    if index < 0:
        raise ValueError("column index must not be negative")
    return df.select(*[quoted(c) for i, c in enumerate(df.columns) if i != index])


def split_columns(df: DataFrame, left: int = fixed.PAIR_SIDE_COLUMNS) -> tuple[list[str], list[str]]:
    """Column names of the left part and of the rest."""
    return df.columns[:left], df.columns[left:]


def prefix_columns(df: DataFrame, prefix: str, keep: Iterable[str] = ()) -> DataFrame:
    """Put ``prefix`` before every column name not in ``keep``."""
    keep = set(keep)
    return df.toDF(*[c if c in keep else prefix + c for c in df.columns])


def normal_text(column: Column) -> Column:
    """Text without surrounding blanks, lower-cased."""
    return F.lower(F.trim(column.cast("string")))
