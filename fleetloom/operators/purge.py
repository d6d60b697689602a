"""Removing listed plates, at once or from a date on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetloom import fixed
from fleetloom.functions import dates
from fleetloom.functions.columns import ColumnNotFound, columns_by_keyword, quoted
from fleetloom.operators.lookups import lookup
from fleetloom.session import scratch_table


def purge_terms(lists: DataFrame, plate: str = "plate", from_date: str = "from_date") -> DataFrame:
    """All lists in one row per plate: from which date it is purged, or always.

    A plate may be on many lists; the earliest date decides, no date means always.
    """
    return (
        lists.where(quoted(plate).isNotNull())
        .groupBy(quoted(plate).alias("_plate"))
        .agg(
            F.bool_or(quoted(from_date).isNull()).alias("_always"),
            F.min(quoted(from_date)).alias("_since"),
        )
    )


def purge_listed(records: DataFrame, plates: DataFrame, plate: str, list_plate: str = "plate") -> DataFrame:
    """Records whose plate is not listed; records without a plate stay."""
    listed = plates.select(quoted(list_plate).cast("string").alias("_plate")).where("_plate is not null").distinct()
    return lookup(records.withColumn("_plate", quoted(plate).cast("string")), listed, ["_plate"], "left_anti").drop("_plate")


def flag_purged(
    records: DataFrame,
    lists: DataFrame,
    plate: str,
    file_date: str,
    list_plate: str = "plate",
    from_date: str = "from_date",
) -> DataFrame:
    """Add ``listed`` and ``purged`` to each record, all lists in one pass.

    A record goes if its plate is listed without a date, if its file's date is
    unknown, or if that date is not before the listed one.
    """
    terms = purge_terms(lists, list_plate, from_date)
    matched = lookup(records.withColumn("_plate", quoted(plate).cast("string")), terms, ["_plate"])
    due = F.col("_always") | quoted(file_date).isNull() | (quoted(file_date) >= F.col("_since"))
    return matched.select(
        *[quoted(c) for c in records.columns],
        F.col("_always").isNotNull().alias("listed"),
        F.coalesce(due & F.col("_always").isNotNull(), F.lit(False)).alias("purged"),
    )


def purge_from_date(records: DataFrame, lists: DataFrame, plate: str, file_date: str, **names: str) -> DataFrame:
    """Records left after purging each plate from its date on."""
    return flag_purged(records, lists, plate, file_date, **names).where(~F.col("purged")).drop("listed", "purged")


def purge_report(flagged: DataFrame, src_file: str) -> DataFrame:
    """Per file: rows before, listed, deleted and after, and a status.

    ``skipped`` files hold listed plates but are dated before the lists take effect.
    """
    counts = flagged.groupBy(src_file).agg(
        F.count(F.lit(1)).alias("rows_before"),
        F.count_if("listed").alias("rows_listed"),
        F.count_if("purged").alias("rows_deleted"),
    )
    return counts.withColumn("rows_after", F.col("rows_before") - F.col("rows_deleted")).withColumn(
        "status",
        F.when(F.col("rows_deleted") > 0, "purged").when(F.col("rows_listed") > 0, "skipped").otherwise("clean"),
    )


def content_dates(
    df: DataFrame,
    src_file: str,
    order: str,
    columns: list[str] | None = None,
) -> DataFrame:
    """Each file's date, read from the first summary cell of its date columns.

    A column's first summary cell by ``order`` gives the date, wherever it stands; if
    that is no date, the next column is tried. One cell per file and column leaves each
    task, however many rows the file has.
    """
    columns = columns_by_keyword(df, fixed.CONTENT_DATE_KEYWORDS) if columns is None else columns
    if not columns:
        raise ColumnNotFound(fixed.CONTENT_DATE_KEYWORDS, df.columns)
    cells = F.explode(
        F.array(*[F.struct(F.lit(i).alias("place"), quoted(c).cast("string").alias("cell")) for i, c in enumerate(columns)])
    )
    per_column = (
        df.select(quoted(src_file).alias("src_file"), quoted(order).alias("_order"), cells.alias("_c"))
        .select("src_file", "_order", F.col("_c.place").alias("_place"), F.col("_c.cell").alias("_cell"))
        .where(dates.is_summary_cell(F.col("_cell")))
        .groupBy("src_file", "_place")
        .agg(F.min_by(dates.summary_cell_date(F.col("_cell")), F.col("_order")).alias("_date"))
        .where(F.col("_date").isNotNull())
    )
    return per_column.groupBy("src_file").agg(F.min_by("_date", "_place").alias("file_date"))


def with_file_date(df: DataFrame, src_file: str, name_date: Column, content: DataFrame) -> DataFrame:
    """Add ``file_date``: from the file's name, else from its content, else null."""
    known = scratch_table(
        content.select(F.col("src_file").alias(src_file), F.col("file_date").alias("_content_date")), "content-dates"
    )
    return (
        lookup(df, known, [src_file])
        .withColumn("file_date", F.coalesce(name_date, F.col("_content_date")))
        .drop("_content_date")
    )


def purge_laid_out(records: DataFrame, lists: DataFrame, plate: str, file_date: str, **names: str) -> DataFrame:
    """``purge_from_date`` for records whose files are laid out by ``file_date``.

    The date from which the lists say anything is a filter on the partitions: earlier days
    are handed on as they are, without a join, and the scan of the others leaves them out.
    A plate that is listed without a date touches every day.
    """
    terms = scratch_table(purge_terms(lists, names.get("list_plate", "plate"), names.get("from_date", "from_date")), "purge-terms")
    always = F.bool_or("_always")
    start = F.when(always, F.lit("0001-01-01").cast("date")).otherwise(F.coalesce(F.min("_since"), F.lit("9999-12-31").cast("date")))
    since = terms.agg(start).scalar()
    day = quoted(file_date)
    untouched = records.where(day < since)
    touched = records.where(day.isNull() | (day >= since))
    return untouched.unionByName(purge_from_date(touched, lists, plate, file_date, **names))
