"""The calendar; suppliers stand for vehicles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetloom import fixed
from fleetloom.operators import calendar
from fleetloom.queries.registry import query, table

# --- fixed values: the dates of the lists ------------------------------------
LIST_DATES = ("2025-02-01", "2025-02-18", "2025-03-01", "2025-03-20", "2025-05-18")
# -----------------------------------------------------------------------------


def _plates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers on five dated lists and one that starts after the calendar ends."""
    place = (F.col("s_suppkey") % 6).cast("int")
    day = F.get(F.array(*[F.lit(d) for d in (*LIST_DATES, "2025-07-01")]), place)
    return table(spark, sf_dir, "supplier").select(
        F.col("s_name").alias("plate"),
        day.cast("date").alias("from_date"),
        F.concat(F.lit("from_"), F.replace(day, F.lit("-"), F.lit("_")), F.lit(".csv")).alias("list_name"),
    )


_PLATES_SQL = f"""
    SELECT s_name AS plate, CAST(d AS DATE) AS from_date, 'from_' || replace(d, '-', '_') || '.csv' AS list_name
    FROM (SELECT s_name, [{", ".join(f"'{d}'" for d in LIST_DATES)}, '2025-07-01'][CAST(s_suppkey % 6 AS INT) + 1] AS d FROM supplier)
"""
_DAYS_SQL = f"""
    SELECT plate, CAST(unnest(generate_series(CAST(from_date AS TIMESTAMP), TIMESTAMP '2025-06-30', INTERVAL 1 DAY)) AS DATE) AS day
    FROM ({_PLATES_SQL}) WHERE from_date <= DATE '2025-06-30'
"""


@query(
    f"""
    SELECT plate AS "车号", year(day) || '/' || month(day) || '/' || day(day) AS "日期", '{fixed.FILLER_PLATE}' AS "补充车辆", '{fixed.FILLER_DAY}' AS "补充日期"
    FROM ({_DAYS_SQL})
    """
)
def plate_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    return calendar.plate_calendar(_plates(spark, sf_dir))


@query(f'SELECT plate AS "车号", count(*) AS rows FROM ({_DAYS_SQL}) GROUP BY plate ORDER BY rows DESC, plate LIMIT 10')
def calendar_top10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return calendar.top_counts(calendar.plate_calendar(_plates(spark, sf_dir)), fixed.CALENDAR_PLATE)


@query(
    f"""
    SELECT list_name, CAST(from_date AS VARCHAR) AS from_date, count(DISTINCT plate) AS plates,
           greatest(date_diff('day', from_date, DATE '2025-06-30') + 1, 0) AS days,
           count(*) * greatest(date_diff('day', from_date, DATE '2025-06-30') + 1, 0) AS rows
    FROM ({_PLATES_SQL}) GROUP BY list_name, from_date
    """
)
def calendar_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = calendar.calendar_stats(_plates(spark, sf_dir))
    return stats.withColumn("from_date", F.col("from_date").cast("string"))
