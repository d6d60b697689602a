"""The plate by day calendar and its statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetloom import fixed
from fleetloom.functions.columns import quoted
from fleetloom.functions.dates import short_day_text


def plate_days(plates: DataFrame, end: str = fixed.CALENDAR_END, from_date: str = "from_date") -> DataFrame:
    """One row per plate and day from its date to ``end``; none if it starts later."""
    end_day = F.lit(end).cast("date")
    started = plates.where(quoted(from_date) <= end_day)
    return started.withColumn("day", F.explode(F.sequence(quoted(from_date), end_day)))


def plate_calendar(
    plates: DataFrame,
    end: str = fixed.CALENDAR_END,
    plate: str = "plate",
    from_date: str = "from_date",
    extra_plate: str = fixed.FILLER_PLATE,
    extra_day: str = fixed.FILLER_DAY,
) -> DataFrame:
    """The calendar with day texts and the filler columns."""
    return plate_days(plates.where(quoted(plate).isNotNull()), end, from_date).select(
        quoted(plate).alias(fixed.CALENDAR_PLATE),
        short_day_text(F.col("day")).alias(fixed.CALENDAR_DAY),
        F.lit(extra_plate).alias(fixed.CALENDAR_EXTRA_PLATE),
        F.lit(extra_day).alias(fixed.CALENDAR_EXTRA_DAY),
    )


def top_counts(df: DataFrame, column: str, limit: int = 10, count: str = "rows") -> DataFrame:
    """The most frequent values; ties by value."""
    return (
        df.where(quoted(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias(count))
        .orderBy(F.col(count).desc(), quoted(column))
        .limit(limit)
    )


def calendar_stats(
    plates: DataFrame,
    end: str = fixed.CALENDAR_END,
    list_name: str = "list_name",
    plate: str = "plate",
    from_date: str = "from_date",
) -> DataFrame:
    """Per list: distinct plates, days to ``end``, and calendar rows, without expanding it."""
    days = F.greatest(F.date_diff(F.lit(end).cast("date"), quoted(from_date)) + 1, F.lit(0)).cast("bigint")
    return (
        plates.where(quoted(plate).isNotNull())
        .groupBy(list_name, from_date)
        .agg(F.count_distinct(quoted(plate)).alias("plates"), F.count(F.lit(1)).alias("_rows"), F.first(days).alias("days"))
        .select(list_name, from_date, "plates", "days", (F.col("_rows") * F.col("days")).alias("rows"))
    )
