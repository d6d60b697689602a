"""The whole way of the vehicle records, over the events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetloom.functions.dates import short_day_text
from fleetloom.operators import purge
from fleetloom.plans import vehicles
from fleetloom.queries.bands import pairing_sql
from fleetloom.queries.cleanse import SHORT_DAY_SQL
from fleetloom.queries.registry import draw_sql, query, table

_LIST_SQL = """
    SELECT c_custkey AS plate, CASE WHEN c_nationkey % 3 <> 0 THEN DATE '2024-01-01' + c_nationkey END AS from_date
    FROM customer WHERE c_acctbal < 0
"""
_TIDY_SQL = f"""
    SELECT event_id, strftime(ts, '%Y%m%d') AS src_file, {SHORT_DAY_SQL.format('ts')} AS day_text, user_id, event_type, value
    FROM events e
    WHERE NOT EXISTS (SELECT 1 FROM ({_LIST_SQL}) l WHERE l.plate = e.user_id
                      AND (l.from_date IS NULL OR CAST(e.ts AS DATE) >= l.from_date))
"""
_COLUMNS = ["event_id", "day_text", "user_id", "event_type", "value"]


def _band(lo: int, hi: int) -> str:
    return f"SELECT * FROM ({_TIDY_SQL}) WHERE value BETWEEN {lo} AND {hi}"


def _side(prefix: str) -> str:
    return ", ".join(f"{prefix}_{c}" for c in _COLUMNS)


def _renamed(alias: str, prefix: str) -> str:
    return ", ".join(f'{alias}.{prefix}_{c} AS "{prefix}_{c.replace("day_text", "日期")}"' for c in _COLUMNS)


_PAIRED_SQL = pairing_sql(_band(0, 30), _band(45, 85), "src_file", "event_id", _COLUMNS)


@query(
    f"""
    WITH placed AS (SELECT *, row_number() OVER (ORDER BY src_file, pos) - 1 AS row_no FROM ({_PAIRED_SQL})),
    moved AS (
        SELECT {_side('medium')}, row_number() OVER (ORDER BY {draw_sql(42, 'row_no')}, row_no) - 1 AS row_no FROM placed
    )
    SELECT row_no, src_file, {_renamed('p', 'low')}, {_renamed('m', 'medium')}
    FROM placed p JOIN moved m USING (row_no)
    """
)
def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Purge by dated list, tidy, band, pair, stack by day, shuffle the right half."""
    day = F.to_date("ts")
    records = table(spark, sf_dir, "events").select(
        F.date_format("ts", "yyyyMMdd").alias("src_file"),
        day.alias("file_date"),
        "event_id",
        F.concat(short_day_text(day), F.lit(" 0:00:00")).alias("日期"),
        "user_id",
        "event_type",
        "value",
        "props",
    )
    nation = F.col("c_nationkey")
    lists = table(spark, sf_dir, "customer").where("c_acctbal < 0").select(
        F.col("c_custkey").alias("plate"),
        F.when(nation % 3 != 0, F.date_add(F.lit("2024-01-01").cast("date"), nation)).alias("from_date"),
    )
    left = purge.purge_from_date(records, lists, "user_id", "file_date").drop("file_date")
    banded = vehicles.tidy_and_band(left, carry=("src_file",), value="value")
    return vehicles.consolidate(banded, "src_file", ["event_id"])
