"""Purging listed plates; customers stand for vehicles, months of orders for files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetloom.operators import position, purge, reports
from fleetloom.plans import vehicles
from fleetloom.queries.registry import query, table
from fleetloom.session import scratch_path
from fleetloom.sources.sinks import write_by


def _records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders by month; the dates of December files are unknown, some plates missing."""
    month = F.date_format("o_orderdate", "yyyyMM")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderkey") % 97 != 0, F.col("o_custkey").cast("string")).alias("plate"),
        month.alias("src_file"),
        F.when(~F.endswith(month, F.lit("12")), F.to_date(F.trunc("o_orderdate", "month"))).alias("file_date"),
        "o_totalprice",
    )


_RECORDS_SQL = """
    SELECT o_orderkey, CASE WHEN o_orderkey % 97 <> 0 THEN CAST(o_custkey AS VARCHAR) END AS plate,
           strftime(o_orderdate, '%Y%m') AS src_file,
           CASE WHEN month(o_orderdate) <> 12 THEN CAST(date_trunc('month', o_orderdate) AS DATE) END AS file_date,
           o_totalprice
    FROM orders
"""


def _lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two lists: by nation with a date or none, and by balance from 1999 on."""
    customer, nation = table(spark, sf_dir, "customer"), F.col("c_nationkey")
    plate = F.col("c_custkey").cast("string").alias("plate")
    start = F.date_add(F.lit("1995-01-01").cast("date"), nation * 200)
    by_nation = customer.where(nation < 10).select(plate, F.when(nation % 4 != 0, start).alias("from_date"))
    by_balance = customer.where("c_acctbal < 0").select(plate, F.lit("1999-01-01").cast("date").alias("from_date"))
    return by_nation.union(by_balance)


_LISTS_SQL = """
    SELECT CAST(c_custkey AS VARCHAR) AS plate,
           CASE WHEN c_nationkey % 4 <> 0 THEN DATE '1995-01-01' + c_nationkey * 200 END AS from_date
    FROM customer WHERE c_nationkey < 10
    UNION ALL
    SELECT CAST(c_custkey AS VARCHAR), DATE '1999-01-01' FROM customer WHERE c_acctbal < 0
"""

_FLAGGED_SQL = f"""
    SELECT r.*,
           EXISTS (SELECT 1 FROM ({_LISTS_SQL}) l WHERE l.plate = r.plate) AS listed,
           EXISTS (SELECT 1 FROM ({_LISTS_SQL}) l WHERE l.plate = r.plate
                   AND (l.from_date IS NULL OR r.file_date IS NULL OR r.file_date >= l.from_date)) AS purged
    FROM ({_RECORDS_SQL}) r
"""


@query(
    f"""
    SELECT o_orderkey, plate, o_totalprice FROM ({_RECORDS_SQL}) r
    WHERE plate IS NULL OR plate NOT IN (SELECT CAST(c_custkey AS VARCHAR) FROM customer WHERE c_acctbal < 0)
    """
)
def purge_listed(spark: SparkSession, sf_dir: str) -> DataFrame:
    listed = table(spark, sf_dir, "customer").where("c_acctbal < 0").select(F.col("c_custkey").cast("string").alias("plate"))
    return purge.purge_listed(_records(spark, sf_dir).select("o_orderkey", "plate", "o_totalprice"), listed, "plate")


@query(f"SELECT o_orderkey, plate, src_file, o_totalprice FROM ({_FLAGGED_SQL}) WHERE NOT purged")
def purge_from_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return purge.purge_from_date(_records(spark, sf_dir), _lists(spark, sf_dir), "plate", "file_date").drop("file_date")


_REPORT_SQL = f"""
    SELECT src_file, rows_before, rows_listed, rows_deleted, rows_before - rows_deleted AS rows_after,
           CASE WHEN rows_deleted > 0 THEN 'purged' WHEN rows_listed > 0 THEN 'skipped' ELSE 'clean' END AS status
    FROM (SELECT src_file, count(*) AS rows_before, count(*) FILTER (listed) AS rows_listed, count(*) FILTER (purged) AS rows_deleted
          FROM ({_FLAGGED_SQL}) GROUP BY src_file)
"""


def _report(spark: SparkSession, sf_dir: str) -> DataFrame:
    flagged = purge.flag_purged(_records(spark, sf_dir), _lists(spark, sf_dir), "plate", "file_date")
    return purge.purge_report(flagged, "src_file")


@query(_REPORT_SQL)
def purge_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _report(spark, sf_dir)


@query(
    f"""
    SELECT count(*) AS files, count(*) AS ok, CAST(0 AS BIGINT) AS failed, 100.0::DOUBLE AS success_pct,
           CAST(sum(rows_before) AS BIGINT) AS rows_before, CAST(sum(rows_after) AS BIGINT) AS rows_after,
           CAST(sum(rows_deleted) AS BIGINT) AS rows_deleted
    FROM ({_REPORT_SQL})
    """
)
def purge_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.run_summary(_report(spark, sf_dir))


def _marked_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders of a customer as a file with two date columns, some cells being summaries."""
    key = F.col("o_orderkey")
    day = F.date_format("o_orderdate", "y/M/d")
    summary = F.concat(day, F.lit(" 0:00:00---"), day, F.lit(" 0:00:00合计:"))
    return table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("src_file"),
        "o_orderkey",
        F.when(key % 21 == 0, "2025/2/30 0:00:00---2025/2/30 0:00:00合计:")
        .when(key % 13 == 0, summary)
        .when(key % 3 != 0, day)
        .alias("日期"),
        F.when(key % 11 == 0, summary).when(key % 2 == 0, day).alias("时间"),
    )


_CONTENT_DATE_SQL = """
    WITH days AS (
        SELECT o_custkey, o_orderkey, year(o_orderdate) || '/' || month(o_orderdate) || '/' || day(o_orderdate) AS d FROM orders
    ), cells AS (
        SELECT o_custkey, o_orderkey, 0 AS place,
               CASE WHEN o_orderkey % 21 = 0 THEN '2025/2/30 0:00:00---2025/2/30 0:00:00合计:'
                    WHEN o_orderkey % 13 = 0 THEN d || ' 0:00:00---' || d || ' 0:00:00合计:'
                    WHEN o_orderkey % 3 <> 0 THEN d END AS cell FROM days
        UNION ALL
        SELECT o_custkey, o_orderkey, 1,
               CASE WHEN o_orderkey % 11 = 0 THEN d || ' 0:00:00---' || d || ' 0:00:00合计:' WHEN o_orderkey % 2 = 0 THEN d END FROM days
    ), firsts AS (
        SELECT o_custkey, place, arg_min(cell, o_orderkey) AS cell FROM cells
        WHERE contains(cell, '---') AND contains(cell, '合计') GROUP BY o_custkey, place
    ), parsed AS (
        SELECT o_custkey, place, CAST(try_strptime(split_part(cell, ' ', 1), '%Y/%m/%d') AS DATE) AS d FROM firsts
    )
    SELECT o_custkey AS src_file, CAST(arg_min(d, place) AS VARCHAR) AS file_date FROM parsed WHERE d IS NOT NULL GROUP BY o_custkey
"""


@query(_CONTENT_DATE_SQL)
def content_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = purge.content_dates(_marked_records(spark, sf_dir), "src_file", "o_orderkey")
    return found.withColumn("file_date", F.col("file_date").cast("string"))


@query(
    f"""
    WITH dates AS ({_CONTENT_DATE_SQL}),
    lists AS (
        SELECT 'P' || n_nationkey AS plate,
               CASE WHEN n_nationkey % 5 <> 0 THEN DATE '1996-01-01' + n_regionkey * 365 END AS from_date FROM nation
    ), records AS (
        SELECT o_custkey AS src_file, o_orderkey, 'P' || (o_orderkey % 40) AS "Plate", CAST(d.file_date AS DATE) AS file_date
        FROM orders LEFT JOIN dates d ON d.src_file = o_custkey
    )
    SELECT src_file, o_orderkey, "Plate" FROM records r
    WHERE NOT EXISTS (SELECT 1 FROM lists l WHERE l.plate = r."Plate"
                      AND (l.from_date IS NULL OR r.file_date IS NULL OR r.file_date >= l.from_date))
    """
)
def purge_by_content_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole purge: file dates from the content, plates found by column name."""
    plate = F.concat(F.lit("P"), (F.col("o_orderkey") % 40).cast("string"))
    records = _marked_records(spark, sf_dir).withColumn("Plate", plate)
    nation = F.col("n_nationkey")
    lists = table(spark, sf_dir, "nation").select(
        F.concat(F.lit("P"), nation.cast("string")).alias("plate"),
        F.when(nation % 5 != 0, F.date_add(F.lit("1996-01-01").cast("date"), F.col("n_regionkey") * 365)).alias("from_date"),
    )
    flagged = vehicles.purge_files(records, lists, order="o_orderkey")
    return flagged.where(~F.col("purged")).select("src_file", "o_orderkey", "Plate")


@query(
    """
    SELECT src_file, rows_before, rows_after, CAST(NULL AS VARCHAR) AS error, 'ok' AS status
    FROM (SELECT strftime(o_orderdate, '%Y%m') AS src_file, count(*) AS rows_before,
                 count(*) FILTER (o_totalprice >= 100000) AS rows_after FROM orders GROUP BY 1)
    """
)
def file_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.file_outcomes(_records(spark, sf_dir), "src_file", F.col("o_totalprice") >= 100000)


@query("SELECT count(DISTINCT plate) AS plates FROM (" + _RECORDS_SQL + ")")
def distinct_plates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.distinct_plates(_records(spark, sf_dir), "plate")


@query(
    "SELECT src_file, count(*) AS rows, CAST(4 AS BIGINT) AS columns FROM (" + _RECORDS_SQL + ") GROUP BY src_file"
)
def table_shape(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.table_shape(_records(spark, sf_dir), "src_file")


_RANKED_SQL = """
    WITH cells AS (
        SELECT o_custkey AS src_file, o_orderkey, 'a' AS "column", CASE WHEN o_orderkey % 3 <> 0 THEN CAST(o_orderkey AS VARCHAR) END AS cell FROM orders
        UNION ALL
        SELECT o_custkey, o_orderkey, 'b', CASE WHEN o_orderkey % 2 = 0 THEN o_orderstatus END FROM orders
    )
    SELECT src_file, "column", row_number() OVER (PARTITION BY src_file, "column" ORDER BY o_orderkey) - 1 AS rank, cell
    FROM cells WHERE cell IS NOT NULL
"""


def _gappy(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("src_file"), key, F.when(key % 3 != 0, key.cast("string")).alias("a"), F.when(key % 2 == 0, F.col("o_orderstatus")).alias("b")
    )


@query(_RANKED_SQL)
def non_null_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The place of every cell among those of its file and column that are not null."""
    return position.non_null_rank(_gappy(spark, sf_dir), "src_file", ["o_orderkey"], ["a", "b"])


@query(f"SELECT * FROM ({_RANKED_SQL}) WHERE rank < 10")
def first_non_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first ten of them."""
    return position.first_non_null(_gappy(spark, sf_dir), "src_file", ["o_orderkey"], ["a", "b"])


_LATE_LISTS_SQL = "SELECT CAST(c_custkey AS VARCHAR) AS plate, DATE '1999-01-01' + c_nationkey * 30 AS from_date FROM customer WHERE c_acctbal < 2000"


@query(
    f"""
    SELECT o_orderkey, plate, src_file, o_totalprice, CAST(file_date AS VARCHAR) AS file_date FROM ({_RECORDS_SQL}) r
    WHERE NOT EXISTS (SELECT 1 FROM ({_LATE_LISTS_SQL}) l WHERE l.plate = r.plate AND (r.file_date IS NULL OR r.file_date >= l.from_date))
    """
)
def purge_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records laid out by date: months before the first list takes effect are not joined."""
    path = scratch_path(spark, "laid-out")
    records = _records(spark, sf_dir)
    write_by(records, path, "file_date")
    plate = F.col("c_custkey").cast("string").alias("plate")
    since = F.date_add(F.lit("1999-01-01").cast("date"), F.col("c_nationkey") * 30).alias("from_date")
    lists = table(spark, sf_dir, "customer").where("c_acctbal < 2000").select(plate, since)
    kept = purge.purge_laid_out(spark.read.schema(records.schema).parquet(path), lists, "plate", "file_date")
    return kept.withColumn("file_date", F.col("file_date").cast("string"))
